"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors by the concatenated signs of random projections and compares every vector with the
WINDOW ones before it. Pairs are verified by cosine in double precision and united over the passes. Equal vectors
are joined first and stand as one.

Two linked vectors share the first lead_bits signs in some of the passes, as many as RECALL asks for. Where at most
WINDOW vectors share them the window holds both. Where more do, a crowd, all of them are compared instead, in blocks of
bounded size that meet pairwise: there links are counted and components joined within the blocks, and no pair is
written. A pair that is in a crowd together counts in the first pass where it is, and not in the windows, so that what is
found and counted doesn't depend on how many vectors lie close to each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.common import components, save

MIN_COSINE = 0.95
#: Neighbours before a vector, in each pass, that it is compared with.
WINDOW = 256
#: Vectors that one block of a crowd holds, about.
BLOCK = 8192
#: Signs in a sort key.
BITS = 62
#: Wanted share of the links at MIN_COSINE that some pass finds; closer vectors are found more often.
RECALL = 0.999
#: Vectors that one task orders in a pass, about.
TASK_ROWS = 20_000
SEED = 7

_FOUND = "a long, b long, part int, side string, place int, dims int, pass int, id long, unit array<double>, crowds array<long>"


def lead_bits(rows: int) -> int:
    """Signs that about WINDOW vectors share if they are spread evenly."""
    return 1 + math.ceil(max(0.0, math.log2(max(rows, 1) / WINDOW)))


def passes_for(rows: int) -> int:
    """Passes after which two vectors at MIN_COSINE have shared their lead_bits once with probability RECALL.

    Such vectors share a sign with probability 1 - angle / pi.
    """
    same = 1 - math.acos(MIN_COSINE) / math.pi
    return max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - same ** lead_bits(rows))))


def usable(vector: str) -> Column:
    """Vectors that can link: not null, not zero, all components finite."""
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, wrong) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _keyed(distinct: DataFrame, passes: int) -> DataFrame:
    """(id, copies, dims, unit, keys): the unit vector and its sort key in each pass."""
    signs: dict[int, np.ndarray] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                column = batch.column(2)
                sizes = np.diff(column.offsets.to_numpy())
                flat, begin = column.flatten().to_numpy(), np.cumsum(sizes) - sizes
                for dims in np.unique(sizes).tolist():
                    if dims not in signs:
                        signs[dims] = np.random.default_rng([SEED, dims]).standard_normal((dims, passes * BITS))
                    rows = np.flatnonzero(sizes == dims)
                    vectors = flat[begin[rows][:, None] + np.arange(dims)]
                    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                    keys = ((unit @ signs[dims] > 0).reshape(len(rows), passes, BITS) * bit).sum(axis=2)
                    lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in (unit, keys)]
                    own = [batch.column(k).take(pa.array(rows)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(rows), dims, np.int32)), *lists], ["id", "copies", "dims", "unit", "keys"])

    return distinct.select("id", "copies", "vector").mapInArrow(run, "id long, copies long, dims int, unit array<double>, keys array<long>")


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of rows of one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _crowds(column: pa.Array, passes: int) -> np.ndarray:
    """The crowds of each row, by pass; 0 where it is in none."""
    sizes = np.diff(column.offsets.to_numpy())
    found = np.zeros((len(column), passes), np.int64)
    found[sizes > 0] = column.flatten().to_numpy().reshape(-1, passes)
    return found


def _pairs(ids: np.ndarray, units: np.ndarray, crowds: np.ndarray, carried: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked (later, earlier) pairs at most WINDOW apart that share no crowd; the later isn't one of the first `carried`."""
    later, earlier = [], []
    for first in range(carried, len(ids), 512):
        last, low = min(first + 512, len(ids)), max(0, first - WINDOW)
        cosines = units[first:last] @ units[low:last].T
        i, j = np.nonzero(cosines >= MIN_COSINE)
        apart = (i + first) - (j + low)
        near = (apart > 0) & (apart <= WINDOW)
        i, j = i[near] + first, j[near] + low
        apart = ~((crowds[i] == crowds[j]) & (crowds[i] != 0)).any(axis=1)
        later.append(ids[i[apart]])
        earlier.append(ids[j[apart]])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *later]), np.concatenate([none, *earlier])


def _found(pairs: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    n = len(pairs[0])
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64()), *(pa.nulls(n, t) for t in kinds)], _NAMES)


_NAMES = [x.split()[0] for x in _FOUND.split(", ")]


def _edge(rows: pa.RecordBatch, part: int, side: str, places: np.ndarray) -> pa.RecordBatch:
    n = rows.num_rows
    return pa.RecordBatch.from_arrays([
        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array([side] * n), pa.array(places, pa.int32()),
        *(rows.column(x) for x in ("dims", "pass", "id", "unit", "crowds")),
    ], _NAMES)


def _within(passes: int):
    """Pairs within a sorted partition, and its first and last WINDOW rows for the partitions beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, carry = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            if seen < WINDOW:
                head = batch.slice(0, WINDOW - seen)
                yield _edge(head, part, "head", np.arange(seen, seen + head.num_rows))
            seen += batch.num_rows
            kept = carry.num_rows if carry is not None else 0
            rows = pa.Table.from_batches([carry, batch] if kept else [batch]).combine_chunks().to_batches()[0]
            turn = rows.column("dims").to_numpy().astype(np.int64) * 100_000 + rows.column("pass").to_numpy()
            limits = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(turn)]
            for a, b in zip(limits[:-1], limits[1:]):
                if b > kept:
                    own = rows.slice(a, b - a)
                    yield _found(_pairs(own.column("id").to_numpy(), _matrix(own.column("unit")), _crowds(own.column("crowds"), passes), max(0, kept - a)))
            carry = rows.slice(max(0, rows.num_rows - WINDOW))
        if carry is not None:
            yield _edge(carry, part + 1, "tail", np.arange(-carry.num_rows, 0))

    return run


def _between(passes: int):
    """Pairs across the border of two partitions."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place").combine_chunks()
        turn = table.column("dims").to_numpy().astype(np.int64) * 100_000 + table.column("pass").to_numpy()
        ids, places = table.column("id").to_numpy(), table.column("place").to_numpy()
        found = []
        for t in np.unique(turn):
            own = np.flatnonzero(turn == t)
            carried = int((places[own] < 0).sum())
            units, crowds = (table.column(x).take(pa.array(own)).combine_chunks() for x in ("unit", "crowds"))
            a, b = _pairs(ids[own], _matrix(units), _crowds(crowds, passes), carried)
            crosses = np.isin(b, ids[own][:carried])
            found.append((a[crosses], b[crosses]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *(x for x, _ in found)]), "b": np.concatenate([none, *(x for _, x in found)])})

    return run


def window_links(vectors: DataFrame, rows: int, passes: int) -> DataFrame:
    """Links (a, b), a > b, that some pass brings within WINDOW, of vectors that share no crowd."""
    order = ["dims", "pass", "key", "id"]
    parts = max(1, math.ceil(rows * passes / TASK_ROWS))
    keyed = vectors.select("dims", F.posexplode("keys").alias("pass", "key"), "id", "unit", "crowds")
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = save(ordered.mapInArrow(_within(passes), _FOUND))
    across = found.where("side is not null").groupBy("part").applyInArrow(_between(passes), "a long, b long")
    both = found.where("side is null").select("a", "b").unionByName(across)
    return both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def crowd_rows(keyed: DataFrame, rows: int) -> DataFrame:
    """(id, pass, crowd, size): the crowds of every vector, more than WINDOW that share their lead_bits in a pass."""
    head = F.shiftright("key", BITS - lead_bits(rows)).alias("head")
    each = keyed.select("id", "dims", F.posexplode("keys").alias("pass", "key")).select("id", "dims", "pass", head)
    sizes = each.groupBy("dims", "pass", "head").agg(F.count("*").alias("size")).where(F.col("size") > WINDOW)
    # Never 0, which stands for no crowd.
    name = F.xxhash64("dims", "pass", "head").bitwiseOR(F.lit(1))
    return each.join(sizes, ["dims", "pass", "head"]).select("id", "pass", name.alias("crowd"), "size")


def _linked(units: np.ndarray, crowds: np.ndarray, copies: np.ndarray, turn: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of a block: the links that count in this pass, and the smallest row reachable by all links.

    Rows `left` meet rows `right`; if these are the same, every two of them meet.
    """
    counts, label = np.zeros(len(units), np.int64), np.arange(len(units))
    edges: list[np.ndarray] = []
    for first in range(0, len(left), 512):
        rows = left[first : first + 512]
        links = units[rows] @ units[right].T >= MIN_COSINE
        links &= rows[:, None] != right[None, :]
        if not links.any():
            continue
        edges.append(np.packbits(links, axis=1))
        fresh = links
        for q in range(turn):
            before = crowds[rows, q][:, None] == crowds[right, q][None, :]
            fresh = fresh & ~(before & (crowds[rows, q] != 0)[:, None])
        counts[rows] += fresh @ copies[right]
        if left is not right:
            counts[right] += copies[rows] @ fresh
        edges[-1] = (rows, edges[-1])
    before = None
    while before is None or (before != label).any():
        before = label.copy()
        for rows, bits in edges:
            links = np.unpackbits(bits, axis=1, count=len(right)).astype(bool)
            lowest = np.where(links, label[right][None, :], len(units)).min(axis=1)
            label[rows] = np.minimum(label[rows], lowest)
            back = np.where(links, label[rows][:, None], len(units)).min(axis=0)
            label[right] = np.minimum(label[right], back)
    return counts, label


def crowd_links(vectors: DataFrame, crowds: DataFrame, passes: int) -> DataFrame:
    """(a, b, n): rows (a, n) with links of a to count, and rows (a, b) of vectors that are joined.

    A crowd of up to BLOCK vectors is one block. A larger one is split by hash into parts of half a block; every two
    parts meet in a block, and so does each part with itself.
    """
    parts = F.when(F.col("size") > BLOCK, F.ceil(2 * F.col("size") / BLOCK)).otherwise(1).cast("int").alias("parts")
    placed = crowds.select("id", "pass", "crowd", parts).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    met = placed.withColumn("x", F.explode(both))
    units = met.select(F.xxhash64("crowd", "x.i", "x.j").alias("block"), F.when(F.col("x.i") < F.col("x.j"), F.col("own") == F.col("x.i")).alias("first"), "pass", "id")
    rows = units.join(vectors.select("id", "copies", "unit", "crowds"), "id").select("block", "first", "pass", "id", "copies", "unit", "crowds")

    def solved(block: pa.Table) -> pa.RecordBatch:
        block = block.combine_chunks()
        ids, copies = block.column("id").to_numpy(), block.column("copies").to_numpy()
        units, own = _matrix(block.column("unit").combine_chunks()), _crowds(block.column("crowds").combine_chunks(), passes)
        first = block.column("first").to_pylist()
        left = np.array([i for i, x in enumerate(first) if x is not False], np.int64)
        right = left if first[0] is None else np.array([i for i, x in enumerate(first) if x is False], np.int64)
        counts, label = _linked(units, own, copies, block.column("pass")[0].as_py(), left, right)
        some, joined = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([ids[some], ids[joined]])),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[label[joined]], pa.int64())]),
            pa.concat_arrays([pa.array(counts[some], pa.int64()), pa.nulls(len(joined), pa.int64())]),
        ], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            names = batch.column("block").to_numpy()
            limits = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for a, b in zip(limits[:-1], limits[1:]):
                if held and held[0].column("block")[0].as_py() != names[a]:
                    yield solved(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield solved(pa.Table.from_batches(held))

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long, n long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) for every row; keys are distinct whole numbers.

    n_links counts the other rows found at a cosine of MIN_COSINE or more, component_id is the smallest key
    reachable, kept whether that is the row itself. Null vectors and such with null, non-finite or only zero
    components link with nothing, nor do vectors of other lengths. A row with a null key links with nothing and isn't kept.
    """
    rows = vectors.select(key, F.col(vector).cast("array<double>").alias("vector"))
    good = rows.where(F.col(key).isNotNull() & usable("vector"))
    distinct = save(good.groupBy("vector").agg(F.min(key).alias("id"), F.count("*").alias("copies")))
    count = distinct.count()
    passes = passes_for(count)
    keyed = save(_keyed(distinct, passes))
    crowds = save(crowd_rows(keyed, count))
    by_pass = F.map_from_entries(F.collect_list(F.struct("pass", "crowd")))
    own = crowds.groupBy("id").agg(by_pass.alias("own"))
    none = F.array().cast("array<long>")
    listed = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda p: F.coalesce(F.col("own")[p], F.lit(0).cast("long")))
    every = keyed.join(own, "id", "left").withColumn("crowds", F.when(F.col("own").isNull(), none).otherwise(listed)).drop("own")
    links = save(window_links(every, count, passes))
    dense = save(crowd_links(every, crowds, passes))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weighted = both.join(distinct.select(F.col("id").alias("b"), "copies"), "b").select("a", F.col("copies").alias("n"))
    others = weighted.unionByName(dense.where("n is not null").select("a", "n")).groupBy("a").agg(F.sum("n").alias("others"))
    joined = links.unionByName(dense.where("b is not null").select("a", "b"))
    classes = (
        distinct.join(others, F.col("id") == F.col("a"), "left").drop("a")
        .join(components(joined), F.col("id") == F.col("node"), "left")
        .select("vector", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    linked = good.join(classes, "vector").select(key, "n_links", "component_id")
    alone = rows.where(~(F.col(key).isNotNull() & usable("vector"))).select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def op8_vector_dedup(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return near_vectors(vectors)
