"""Helpers that several text operators share: saved intermediates, batches, hashes, components."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

FILES_PER_CORE = 8
#: Bytes of text that one numpy pass holds at once; a longer text is a pass of its own.
PASS_BYTES = 1 << 18
#: Rows of an Arrow batch between executors and their Python workers, which both hold it while they work on it.
BATCH_ROWS = 1000

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediates that driver and executors share: spark.checkpoint.dir.

    Only where that is unset, as in tests, a temporary one is set.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches: with whole texts, the default 10,000 rows are tens of megabytes a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def few_files(df: DataFrame) -> DataFrame:
    """df in at most FILES_PER_CORE parts for each core: small tables shouldn't become many small files."""
    return df.coalesce(FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def save(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and cut its lineage; what only led to it can then be freed.

    Shuffle files go when the driver's garbage collector finds their plans unused, which may be long after.
    """
    shared_folder(df.sparkSession)
    saved = few_files(df).checkpoint()
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return saved


#: What a Python worker keeps from one task to the next, by name: bounded by whoever puts it there.
KEPT: dict[str, object] = {}


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000, keep: str = "") -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows, to bound what a Python worker holds of them.

    Workers are reused, so what tasks of another kind left in KEPT is dropped first, except what is named keep, and
    Arrow's unused memory is given back at the end.
    """
    for name in [x for x in KEPT if x != keep]:
        del KEPT[name]
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)
    batch = None
    pa.default_memory_pool().release_unused()


def passes(texts: list[bytes], size: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes together."""
    first = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield first, i
            first, total = i, 0
        total += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that close inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand; a worker keeps at most KEPT of each."""

    KEPT = 1 << 21

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up[:n], self.down[:n]
        size = 1 << (n - 1).bit_length()
        steps = lambda x: np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)])
        up, down = steps(_BASE), steps(pow(_BASE, -1, 1 << 64))
        if size <= self.KEPT:
            self.up, self.down = up, down
        return up[:n], down[:n]


_POWERS = _Powers()


class RangeHashes:
    """64-bit hashes of any values[start:end]; values are 64-bit codes."""

    def __init__(self, values: np.ndarray) -> None:
        up, self.down = _POWERS.get(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))

    def of_width(self, width: int) -> np.ndarray:
        """The hashes of all stretches of that many values, by their starts."""
        found = (self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width]
        return mix(found + np.uint64(width * 0xD6E8FEB86659FD93 & (1 << 64) - 1))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end]; values are 64-bit codes."""
    return RangeHashes(values).of(starts, ends)


def word_spans(texts: list[bytes], white: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' joined bytes, begin and end of each word, and each text's first word.

    Words are what stands between the bytes marked in white, by default [^\\x20\\x09-\\x0D]+; a newline must be marked.
    """
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    white = white[data]
    starts = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    limits = np.cumsum([1, *(len(x) + 1 for x in texts)])
    return data, starts, ends, np.searchsorted(starts, limits)


def hashed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word; A-Z count as a-z if lower."""
    return range_hashes(_TABLE[_LOWER[data] if lower else data], starts, ends)


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin."""
    data, starts, ends, first = word_spans(texts)
    return hashed_words(data, starts, ends, lower), first


def distinct_runs(found: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort each found[limits[i]:limits[i+1]] and drop its repeats; the values left and their limits."""
    for a, b in zip(limits[:-1], limits[1:]):
        found[a:b].sort()
    owner = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[fresh], minlength=len(limits) - 1)
    return found[fresh], np.concatenate([[0], np.cumsum(sizes)])


#: Links that a task of a component step takes, about; small steps then write few files.
TASK_LINKS = 100_000


#: Links that a task takes when it leaves out links, about, and nodes that it holds at once.
FOREST_NODES = 1 << 17


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every FOREST_NODES nodes' links (u, v), as many as join the same nodes: each node to the smallest one it meets.

    These are never more than the links given, so links that come once each bound them, however many tasks there are.
    """
    parent: dict[int, int] = {}

    def stars() -> pa.RecordBatch:
        rows = []
        for x in parent:
            top = x
            while parent[top] != top:
                top = parent[top]
            if top != x:
                rows.append((x, top))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.int64())], ["u", "v"])

    for batch in batches:
        for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = pair
            while (up := parent.setdefault(a, a)) != a:
                parent[a] = a = parent[up]
            while (up := parent.setdefault(b, b)) != b:
                parent[b] = b = parent[up]
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= FOREST_NODES:
            yield stars()
            parent.clear()
    yield stars()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component), component the smallest node.

    Alternates large-star and small-star steps. No node's neighbours are gathered: each step is a
    minimum per node, combined before the shuffle, and a join back that adaptive execution can split.
    Nodes without links are absent; null ends and self-links are ignored. Links may repeat: they are made distinct
    first, since each task would otherwise give a link to nearly every node of a group again.
    """
    kept = links.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    distinct = save(kept.distinct())
    edges = save(distinct.coalesce(1 + distinct.count() // FOREST_NODES).mapInArrow(_forest, "u long, v long"))
    summary = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    state, before = summary(), None
    while state != before:
        few = lambda x: x.coalesce(1 + state[0] // TASK_LINKS)  # noqa: E731, B023
        both = few(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = few(both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
        )
        edges = save(few(few(small).distinct()))
        state, before = summary(), state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
