"""Jaccard self-join of word n-gram sets by prefix trees.

Sets are 64-bit hashes of word n-grams. Equal sets are found by their digests and stand as one. A prefix of each set
in hash order must then hold some n-grams that other sets' prefixes hold as well, else the set links with nothing;
this leaves out most sets by counting alone. Of what is left, two sets that share an n-gram of few holders are a pair,
which must share enough of them; sets that could link by n-grams of many holders alone are grouped by the rarest of
these. So sets that share a little with ever others, by chance or by a common passage, form no group, and groups
don't grow together with the table. Within each unit of a group the whole sets form a prefix tree, in one order of
n-grams for the unit, frequent ones first. Walking it, sets with a common start share the overlaps counted so far, and
a subtree is left unseen when the longest rest in it is too short for any set outside to reach the threshold. Every
test is a bound, so no link of two sets is lost.

Texts are never shuffled, and of n-grams only the prefixes, once, and the whole sets of groups: tasks read the texts
again and take what a bitmap of the wanted keys holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from courtside.llm.collocations import Bitmap, bitmap
from courtside.llm.common import components, distinct_runs, passes, range_hashes, save, slices, small_batches, utf8, word_hashes

WORDS = 5
#: Two sets link when PERCENT * |union| <= 100 * |intersection|.
PERCENT = 75
#: One in SPARE n-grams is added to the prefix, so that a pair must share about as many there.
SPARE = 8
#: N-grams of up to so many rows make pairs of their holders.
PAIRED = 8
#: N-grams of all sets that one task joins; larger groups are split into pairs of parts.
TASK_GRAMS = 1 << 20


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct n-gram hashes of each text, one after the other, and their limits.

    A text of fewer words has its whole sequence as the one n-gram; a text without words has none.
    """
    hashes, first = word_hashes(texts, lower=True)
    count = np.diff(first)
    grams = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    limits = np.concatenate([[0], np.cumsum(grams)])
    owner = np.repeat(np.arange(len(texts)), grams)
    starts = first[:-1][owner] + np.arange(limits[-1]) - limits[:-1][owner]
    return distinct_runs(range_hashes(hashes, starts, starts + np.minimum(words, count[owner])), limits)


def _least(n):
    """Fewest common members of a set of n with any set it links to."""
    return (PERCENT * n + 99) // 100


def _shingled(batches: Iterator[pa.RecordBatch], wanted: Bitmap | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows (text, key) at a time, their sets one after the other, and the limits; only rows of wanted keys, and perhaps others."""
    for batch in slices(batches):
        if wanted is not None:
            batch = batch.filter(pa.array(wanted.holds([batch.column(1).to_numpy().view(np.uint64)])))
        texts = utf8(batch.column(0))
        for a, b in passes(texts):
            yield batch.slice(a, b - a), *shingle_sets(texts[a:b])


def _digests(grams: np.ndarray, limits: np.ndarray) -> list[pa.Array]:
    return [pa.array(range_hashes(x, limits[:-1], limits[1:]).view(np.int64)) for x in (grams, grams ^ (grams >> np.uint64(7)))]


def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n and two digest longs of every row."""
    schema = docs.select(key).schema
    for name in ("n", "d1", "d2"):
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, grams, limits in _shingled(batches):
            yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(np.diff(limits)), *_digests(grams, limits)], schema.names)

    return docs.select(text, key).mapInArrow(run, schema)


def _of_nodes(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> tuple[DataFrame, Broadcast[Bitmap]]:
    """text and node of the rows with a key, and the bitmap of nodes."""
    return docs.where(F.col(key).isNotNull()).select(text, F.col(key).cast("long").alias("node")), docs.sparkSession.sparkContext.broadcast(bitmap(nodes, ["node"]))


def _whole(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """node, n, two digest longs and grams of the rows of these nodes, and perhaps of others."""
    rows, wanted = _of_nodes(docs, key, text, nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, grams, limits in _shingled(batches, wanted.value):
            lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(grams.view(np.int64)))
            columns = [rows.column(1), pa.array(np.diff(limits)), *_digests(grams, limits), lists]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "d1", "d2", "grams"])

    return rows.mapInArrow(run, "node long, n long, d1 long, d2 long, grams array<long>")


def _prefixes(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(gram, node): the prefix of the set of each row of these nodes, and perhaps of others."""
    rows, wanted = _of_nodes(docs, key, text, nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, grams, limits in _shingled(batches, wanted.value):
            n = np.diff(limits)
            taken = np.minimum(n, n - _least(n) + n // SPARE + 1)
            at = np.arange(taken.sum()) + np.repeat(limits[:-1] - np.cumsum(taken) + taken, taken)
            owner = rows.column(1).take(pa.array(np.repeat(np.arange(len(n)), taken)))
            yield pa.RecordBatch.from_arrays([pa.array(grams[at].view(np.int64)), owner], ["gram", "node"])

    return rows.mapInArrow(run, "gram long, node long")


def _holders(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """node, the sizes low and high of its sets, its prefixes' n-grams that others hold: few (up to PAIRED rows), and many (df, gram).

    Nodes that share too few of them to link are left out. Nodes are those of nodes (node, n), which may repeat.
    """
    # Both uses read the one shuffle, since the filter that the join asks for stands in both.
    grams = _prefixes(docs, key, text, nodes).where("gram is not null and node is not null").repartition("gram")
    ends = grams.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("df"))
    shared = ends.where("low < high").select("gram", "df")
    paired = F.col("df") <= PAIRED
    held = grams.join(shared.hint("shuffle_hash"), "gram").groupBy("node").agg(
        F.collect_set(F.when(paired, F.col("gram"))).alias("few"), F.collect_set(F.when(~paired, F.struct("df", "gram"))).alias("many")
    )
    sizes = nodes.groupBy("node").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    needed = F.expr(f"cast(({PERCENT} * low + 99) div 100 div {SPARE} + 1 as int)")
    return held.join(sizes, "node").withColumn("needed", needed).where("size(few) + size(many) >= needed")


def _pairs(held: DataFrame) -> DataFrame:
    """Nodes (a, b) that share n-grams of few holders, and enough to link if all those of many holders that the lesser has are shared."""
    holders = held.select("node", F.explode("few").alias("gram")).repartition("gram").groupBy("gram")
    places = holders.agg(F.array_sort(F.collect_set("node")).alias("nodes")).where("size(nodes) > 1").select("nodes", F.posexplode("nodes").alias("i", "a"))
    pairs = places.select("a", F.explode(F.slice("nodes", F.col("i") + 2, F.size("nodes"))).alias("b")).groupBy("a", "b").agg(F.count("*").alias("common"))
    for x in ("a", "b"):
        own = held.select(F.col("node").alias(x), F.col("low").alias(f"low_{x}"), F.col("high").alias(f"high_{x}"), F.size("many").alias(f"many_{x}"))
        pairs = pairs.join(own, x)
    alike = f"100 * high_a >= {PERCENT} * low_b and 100 * high_b >= {PERCENT} * low_a"
    return pairs.where(f"{alike} and common + least(many_a, many_b) >= least(low_a, low_b) div {SPARE} + 1").select("a", "b")


def _stars(held: DataFrame) -> DataFrame:
    """Nodes (a, b) of which a could link by n-grams of many holders alone: b is the smallest such node with one of a's rarest, which joins them."""
    kept = F.slice(F.array_sort("many"), F.lit(1), F.greatest(F.size("many") - F.col("needed") + 1, F.lit(0)))
    blocks = held.where("size(many) >= needed").select("node", F.explode(kept).alias("x")).select("node", F.col("x.gram").alias("gram"))
    first = blocks.groupBy("gram").agg(F.min("node").alias("b"))
    return blocks.join(first, "gram").select(F.col("node").alias("a"), "b")


def _groups(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(node, component): groups outside which a set of the group links with nothing.

    Sets that link share at least `n div SPARE + 1` n-grams of their prefixes, with n of the smaller one: each prefix is as much
    longer than what the other may lack. If none of these has few holders, the rarest is among those that _stars keeps of both.
    """
    held = save(_holders(docs, key, text, nodes))
    return components(_pairs(held).unionByName(_stars(held)))


def _wanted(sizes: np.ndarray, size: int) -> np.ndarray:
    """Fewest common members of sets of these sizes with a set of this size that they link to."""
    return -(-PERCENT * (sizes + size) // (100 + PERCENT))


def _paths(sets: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each set's members that others have too, as ranks, frequent ones first; the holders of each rank and their limits."""
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    members, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.empty(len(members), np.int64)
    order[np.lexsort((members, -df))] = np.arange(len(members))
    rank = order[code]
    holders = owner[np.argsort(rank, kind="stable")]
    last = int((df > 1).sum())  # members of one set only come last; they overlap with nothing
    limits = np.concatenate([[0], np.cumsum(np.sort(df)[::-1])])[: last + 1]
    chosen = rank < last
    paths = np.split(rank[chosen], np.cumsum(np.bincount(owner[chosen], minlength=len(sets)))[:-1])
    return [np.sort(x) for x in paths], holders, limits


def _common(a: np.ndarray, b: np.ndarray) -> int:
    m = min(len(a), len(b))
    differs = np.flatnonzero(a[:m] != b[:m])
    return int(differs[0]) if len(differs) else m


def trie_links(ids: np.ndarray, sets: list[np.ndarray], seen: dict[str, int] | None = None) -> list[tuple[int, int]]:
    """Links (id, id) of sets that join them as all links would: one link between any two parts that meet.

    Sets are the paths of a prefix tree, one order for all sets of a unit, frequent members first. Going down to
    a node adds its members to the overlaps of the path with every set, once for all sets below. A node is
    left, with everything below, when its longest path leaves too few members for any set outside their
    part, by its overlap so far, to reach the threshold with even its smallest set. ``seen`` counts the sets
    compared and those that were left unseen below a node.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    paths, holders, limits = _paths(sets)
    walk = sorted(range(len(sets)), key=lambda i: paths[i].astype(">i4").tobytes())
    lengths = np.array([len(paths[i]) for i in walk], np.int64)
    in_order = sizes[walk]
    # Members that a set shares with the one before it; none with what follows the last.
    shared = np.array([0, *(_common(paths[i], paths[j]) for i, j in zip(walk, walk[1:])), 0], np.int64)
    lower = np.zeros(len(shared), np.int64)  # the next place with a smaller number; none after the last
    rising: list[int] = []
    for i, length in enumerate(shared.tolist()):
        while rising and shared[rising[-1]] > length:
            lower[rising.pop()] = i
        rising.append(i)
    part = np.arange(len(sets))
    counts = np.zeros(len(sets), np.int32)
    stack: list[int] = []
    links: list[tuple[int, int]] = []
    seen = {} if seen is None else seen

    def add(overlap: np.ndarray, members: np.ndarray, by: int) -> None:
        for t in members.tolist():
            overlap[holders[limits[t] : limits[t + 1]]] += by

    def hopeless(first: int, end: int, depth: int) -> bool:
        """Whether nothing below a node can add a link: the sets walk[first:end], whose paths share its depth."""
        own = part[walk[first:end]]
        small, large = in_order[first:end].min(), in_order[first:end].max()
        open_ = (sizes >= _least(small)) & (large >= _least(sizes))
        open_ &= counts + (lengths[first:end].max() - depth) >= _wanted(sizes, small)
        if (own == own[0]).all():
            open_ &= part != own[0]
        return not open_.any()

    def descend(first: int) -> int:
        """Go down the nodes above walk[first] that hold more sets; where one is left, the end of its sets, else first."""
        path = paths[walk[first]]
        # The nodes are where the least common length of the sets from here on grows smaller.
        ends: list[tuple[int, int]] = []
        i = first + 1
        while shared[i] > len(stack):
            ends.append((int(shared[i]), int(lower[i])))
            i = lower[i]
        for node, end in reversed(ends):
            add(counts, path[len(stack) : node], 1)
            stack.extend(path[len(stack) : node].tolist())
            if hopeless(first, end, node):
                return end
        return first

    at = 0
    while at < len(walk):
        gone = stack[shared[at] :]
        add(counts, np.array(gone, np.int64), -1)
        del stack[shared[at] :]
        end = descend(at)
        if end > at:
            seen["left"] = seen.get("left", 0) + end - at
            at = end
            continue
        s = walk[at]
        at += 1
        if not lengths[at - 1] or hopeless(at - 1, at, len(stack)):
            continue
        seen["compared"] = seen.get("compared", 0) + 1
        overlap = counts.copy()
        add(overlap, paths[s][len(stack) :], 1)
        open_ = (part != part[s]) & (100 * overlap >= PERCENT * (sizes + sizes[s] - overlap))
        for o in np.flatnonzero(open_).tolist():
            if part[o] != part[s]:
                links.append((int(ids[s]), int(ids[o])))
                part[part == part[o]] = part[s]
    return links


def _units(sets: DataFrame) -> DataFrame:
    """The sets (node, n, d1, d2, component) with the units of work they take part in, so that every pair of a group that could link meets.

    A group of up to TASK_GRAMS members is one unit. In a larger one, sets are banded by size, such that
    links stay within a band and its neighbours; bands are split by hash, and every two parts meet in a unit.
    """
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / PERCENT))).cast("int")
    banded = sets.withColumn("band", band)
    loads = banded.groupBy("component", "band").agg(F.sum("n").alias("load"))
    whole = loads.groupBy("component").agg(F.sum("load").alias("total"))
    parts = loads.join(whole, "component").select(
        "component", "band", F.when(F.col("total") > TASK_GRAMS, F.ceil(2 * F.col("load") / TASK_GRAMS)).otherwise(0).cast("int").alias("parts")
    )
    above = parts.select("component", (F.col("band") - 1).alias("band"), F.col("parts").alias("above"))
    below = parts.select("component", (F.col("band") + 1).alias("band"), F.col("parts").alias("below"))
    known = parts.join(above, ["component", "band"], "left").join(below, ["component", "band"], "left")
    own = F.pmod(F.xxhash64("node", "d1"), F.greatest("parts", F.lit(1))).cast("int")
    numbers = lambda c: F.when(F.col(c) > 0, F.sequence(F.lit(0), F.col(c) - 1)).otherwise(F.array().cast("array<int>"))
    none = F.lit(None).cast("int")
    unit = lambda band, a, other, b: F.struct(band.alias("band"), a.alias("a"), other.alias("other"), b.alias("b"))
    here = F.col("band")
    meets: Column = F.concat(
        F.transform(numbers("parts"), lambda i: unit(here, F.least(i, F.col("own")), here, F.greatest(i, F.col("own")))),
        F.transform(numbers("above"), lambda i: unit(here, F.col("own"), here + 1, i)),
        F.transform(numbers("below"), lambda i: unit(here - 1, i, here, F.col("own"))),
    )
    units = F.when(F.col("parts") == 0, F.array(unit(none, none, none, none))).otherwise(meets)
    placed = banded.join(known, ["component", "band"]).withColumn("own", own)
    return placed.select("node", "n", "d1", "d2", "component", units.alias("units"))


def _join_unit(table: pa.Table) -> pa.Table:
    column = table.column("grams").combine_chunks()
    limits, flat = column.offsets.to_numpy(), column.values.to_numpy()
    sets = [flat[a:b] for a, b in zip(limits[:-1], limits[1:])]
    links = trie_links(table.column("node").to_numpy(), sets)
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every row.

    Rows link when PERCENT * |union| <= 100 * |intersection| of their sets; component_id is the smallest key
    reachable. Null and empty texts have no n-grams and stand alone, as do rows with a null key (component
    null unless others have their set). Rows that share a key are one node. Keys are whole numbers.
    The session's Arrow batches are bounded, since the executors hold them beside their heap.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(key, text)
    every = save(_sets(rows, key, text))
    first = save(every.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(key).cast("long").alias("node")))
    group = _groups(rows, key, text, first.where("node is not null"))
    sets = every.where("n > 0").select(F.col(key).cast("long").alias("node"), "n", "d1", "d2").join(group, "node")
    once = save(sets.groupBy("component", "n", "d1", "d2").agg(F.min("node").alias("node")))
    same = ["node", "n", "d1", "d2"]
    whole = _whole(rows, key, text, once).dropDuplicates(same).join(_units(once), same)
    met = whole.select("component", "node", "grams", F.explode("units").alias("unit"))
    linked = components(met.groupBy("component", "unit").applyInArrow(_join_unit, "a long, b long"))
    component = (
        first.join(linked, "node", "left")
        .select(F.col("n").alias("n0"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "node").alias("found"))
    )
    same = (F.col("n") == F.col("n0")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
    return every.join(component, same, "left").select(
        key, F.col("n").alias("n_shingles"), F.coalesce("found", key).alias("component_id")
    )


def op5_ngram_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return near_duplicates(docs)
