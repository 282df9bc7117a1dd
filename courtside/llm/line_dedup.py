"""Line deduplication: MinHash bands over character shingles, exact Jaccard, union-find.

A line is a non-blank part between newlines, compared lower-cased with single spaces. Of all lines that are
joined by links, over all documents, the first one (by document, then place) is kept.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from courtside.llm.collocations import bitmap
from courtside.llm.common import RangeHashes, components, distinct_runs, mix, passes, save, slices

#: Characters in a shingle; a shorter line is one shingle.
WIDTH = 8
#: Two lines link when PERCENT * |union| <= 100 * |intersection| of their shingle sets.
PERCENT = 75
BANDS, ROWS = 10, 4
BINS = BANDS * ROWS
#: Characters of all lines that are compared at once; larger band values are split into pairs of parts.
UNIT_CHARS = 1 << 18

#: White space that a normal form does not have.
_ODD_ASCII = ["  ", *(x for x in map(chr, range(128)) if x.isspace() and x not in " \n")]
_ODD = [*_ODD_ASCII, *(x for x in map(chr, range(128, sys.maxunicode + 1)) if x.isspace())]
#: Most lines of a small unit, and the bits of the bins by which its lines are told apart.
SMALL_UNIT, BOUND_BITS = 128, 9
#: Pairs of lines whose bins are compared at once, about, and lines whose empty bins are filled at once.
BOUND_PAIRS, FILLED_LINES = 1 << 9, 1 << 12
#: Lines, their parts and their sides.
Unit = tuple[list[str], np.ndarray, np.ndarray]
#: Bits of the bitmap that chooses the lines whose contents are needed, at most 2^BITMAP_BITS.
BITMAP_BITS = 25

#: The spread codes of the characters that most texts consist of.
_CODES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def lines_of(text: str) -> tuple[list[int], list[str]]:
    """Places and normal forms of the lines that aren't blank."""
    text = text.lower()
    spaces = _ODD_ASCII if text.isascii() else _ODD
    if any(x in text for x in spaces):
        parts = [" ".join(line.split()) for line in text.split("\n")]
    else:  # between words there are single spaces only
        parts = [line.strip(" ") for line in text.split("\n")]
    return [i for i, x in enumerate(parts) if x], [x for x in parts if x]


def line_id(line: str) -> int:
    return int(line_ids([line])[0])


def line_ids(lines: list[str]) -> np.ndarray:
    blake = hashlib.blake2b
    return np.frombuffer(b"".join([blake(x.encode("utf-8", "surrogatepass"), digest_size=8).digest() for x in lines]), "<i8")


def _shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, with repeats, and their limits."""
    codes = np.frombuffer("".join([*lines, "\0" * WIDTH]).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(x) for x in lines], np.int64)
    begins = np.cumsum(sizes) - sizes
    count = np.maximum(sizes - WIDTH + 1, 1)
    limits = np.concatenate([[0], np.cumsum(count)])
    hashes = RangeHashes(_CODES[codes] if codes.max() < len(_CODES) else mix(codes.astype(np.uint64) + np.uint64(1)))
    found = hashes.of_width(WIDTH)[np.repeat(begins - limits[:-1], count) + np.arange(limits[-1])]
    short = np.flatnonzero(sizes < WIDTH)
    found[limits[short]] = hashes.of(begins[short], begins[short] + sizes[short])
    return found, limits


def _lowest(lines: list[str]) -> np.ndarray:
    """The lowest value of each bin (lines x BINS), EMPTY where there is none."""
    found, limits = _shingles(lines)
    owner = np.repeat(np.arange(len(lines)) * BINS, np.diff(limits))
    bins = ((found >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).view(np.int64)
    lowest = np.full(len(lines) * BINS, EMPTY)
    np.minimum.at(lowest, owner + bins, found * _SPREAD >> np.uint64(1))  # within a bin, low bits decide
    return lowest.reshape(len(lines), BINS)


def _filled(known: np.ndarray) -> np.ndarray:
    """The bins of lines, the empty ones filled.

    An empty bin takes the value of another one, drawn anew for each bin until that one has any. The draws are the
    same for all lines, so that like lines draw alike, but the bins of a line draw apart.
    """
    lowest, draw = known.ravel().copy(), np.random.default_rng(BINS)
    cells = np.flatnonzero(lowest == EMPTY)
    while len(cells):
        row, bin_ = np.divmod(cells, BINS)
        drawn = known[row, draw.integers(0, BINS, BINS)[bin_]]
        lowest[cells] = drawn
        cells = cells[drawn == EMPTY]
    return lowest


def bands(lines: list[str]) -> np.ndarray:
    """The band values (lines x BANDS) of one-permutation MinHash signatures; lines aren't empty."""
    weights = mix(np.arange(1, ROWS + 1, dtype=np.uint64))
    found = [np.empty((0, BANDS), np.int64)]
    for first in range(0, len(lines), FILLED_LINES):
        some = lines[first : first + FILLED_LINES]
        lowest = _filled(np.concatenate([_lowest(some[a:b]) for a, b in _passes(some)]))  # few rounds for many lines
        values = (mix(lowest).reshape(len(some), BANDS, ROWS) * weights).sum(axis=2, dtype=np.uint64)
        found.append(mix(values + np.arange(BANDS, dtype=np.uint64)).view(np.int64))
    return np.concatenate(found)


class Sets:
    """The shingle sets of lines, and their sizes in bins: two lines share at most what they share in each bin."""

    def __init__(self, lines: list[str]) -> None:
        self.flat, self.limits = distinct_runs(*_shingles(lines))
        self.sizes = np.diff(self.limits)
        owner = np.repeat(np.arange(len(lines)), self.sizes)
        bins = owner << BOUND_BITS | (self.flat >> np.uint64(64 - BOUND_BITS)).view(np.int64)
        held = np.bincount(bins, minlength=len(lines) << BOUND_BITS).reshape(len(lines), -1)
        self.held = held.astype(np.uint8 if held.max() < 256 else np.int32)

    def _enough(self, common, x, y):
        return 100 * common >= PERCENT * (self.sizes[x] + self.sizes[y] - common)

    def may_link(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each two lines could link by what they share in bins; all that link do."""
        found = self._enough(np.minimum(self.sizes[x], self.sizes[y]), x, y)
        at = np.flatnonzero(found)
        for first in range(0, len(at), BOUND_PAIRS):
            some = at[first : first + BOUND_PAIRS]
            common = np.minimum(self.held[x[some]], self.held[y[some]]).sum(axis=1, dtype=np.int64)
            found[some] = self._enough(common, x[some], y[some])
        return found

    def link(self, x: int, y: int) -> bool:
        both = np.concatenate([self.flat[self.limits[i] : self.limits[i + 1]] for i in (x, y)])
        both.sort(kind="stable")  # two sorted runs are merged
        return bool(self._enough(np.count_nonzero(both[1:] == both[:-1]), x, y))


def alike(left: list[str], right: list[str]) -> np.ndarray:
    """Whether each two lines link, by their exact shingle sets."""
    place = {x: i for i, x in enumerate(dict.fromkeys([*left, *right]))}
    sets = Sets(list(place))
    x, y = (np.array([place[line] for line in lines], np.int64) for lines in (left, right))
    found = sets.may_link(x, y)
    for i in np.flatnonzero(found & (x != y)).tolist():
        found[i] = sets.link(x[i], y[i])
    return found


def _passes(lines: list[str]) -> Iterator[tuple[int, int]]:
    return passes([range(8 * len(x)) for x in lines])


def _band_rows(docs: DataFrame, text: str) -> DataFrame:
    """(band, line): the bands of every line, once for the repeats that a task meets in one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lines = list({x for text in batch.column(0).to_pylist() for x in lines_of(text or "")[1]})
            for first in range(0, len(lines), FILLED_LINES):
                some = lines[first : first + FILLED_LINES]
                yield pa.RecordBatch.from_arrays([pa.array(bands(some).ravel()), pa.array(np.repeat(line_ids(some), BANDS))], ["band", "line"])

    return docs.select(text).mapInArrow(run, "band long, line long")


def _contents(docs: DataFrame, text: str, wanted: DataFrame, key: str | None = None) -> DataFrame:
    """(line, content) of the wanted lines, with repeats, and perhaps of some others.

    With a key, (owner, lines, places) of every text with lines as well, in rows of their own.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, ["line"], BITMAP_BITS))
    docs = docs.select(text, (F.lit(None).cast("long") if key is None else F.col(key)).alias("owner"))
    kind = docs.schema["owner"].dataType.simpleString()
    lists = [pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["owner", "lines", "places", "line", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [lines_of(x or "") for x in batch.column(0).to_pylist()]
            lines, sizes = [x for _, own in rows for x in own], np.array([len(x) for x, _ in rows], np.int64)
            owner, own = batch.column(1), line_ids(lines)
            chosen = np.zeros(len(lines), bool)
            chosen[np.unique(own, return_index=True)[1]] = True
            at = np.flatnonzero(chosen)
            at = at[bits.value.holds([own[at].view(np.uint64)])]
            empty = [pa.nulls(len(at), x) for x in (owner.type, *lists)]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(own[at]), pa.array([lines[i] for i in at.tolist()], pa.string())], names)
            if key is not None:
                some = np.flatnonzero(sizes)
                limits = pa.array(np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int32))
                parts = [pa.array(own), pa.array([i for x, _ in rows for i in x], pa.int32())]
                arrays = [owner.take(pa.array(some)), *(pa.ListArray.from_arrays(limits, x) for x in parts)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.string())], names)

    return docs.mapInArrow(run, f"owner {kind}, lines array<long>, places array<int>, line long, content string")


def _repeated(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(line, owner, place) of all lines that come twice or have a class, and perhaps of some others."""
    every = texts.select("owner", F.explode("lines").alias("line"))
    twice = every.groupBy("line").count().where("count > 1").select("line")
    bits = texts.sparkSession.sparkContext.broadcast(bitmap(save(twice.unionByName(classes.select("line"))), ["line"], BITMAP_BITS))
    kind = texts.schema["owner"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own, place = (batch.column(i).flatten() for i in (1, 2))
            at = np.flatnonzero(bits.value.holds([own.to_numpy().view(np.uint64)]))
            row = pa.array(np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())[at])
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([own.take(at), batch.column(0).take(row), place.take(at)], ["line", "owner", "place"])

    return texts.select("owner", "lines", "places").mapInArrow(run, f"line long, owner {kind}, place int")


def _led(docs: DataFrame, text: str) -> DataFrame:
    """(band, line, lead): the lines of every band value with several, with the smallest one, which has no row."""
    # Both uses read the one shuffle, since the filter that the join asks for stands in both; no sort, no window.
    rows = _band_rows(docs, text).where("band is not null and line is not null").repartition("band")
    shared = rows.groupBy("band").agg(F.min("line").alias("lead"), F.max("line").alias("last")).where("lead < last").select("band", "lead")
    return rows.join(shared.hint("shuffle_hash"), "band").where("line <> lead").distinct()


def _verified(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines that link."""
    with_text = (
        pairs.join(contents.select(F.col("line").alias("a"), F.col("content").alias("left")), "a")
        .join(contents.select(F.col("line").alias("b"), F.col("content").alias("right")), "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            left, right = (batch.column(i).to_pylist() for i in (2, 3))
            for a, b in _passes([x + y for x, y in zip(left, right)]):
                chosen = pa.array(alike(left[a:b], right[a:b]))
                yield batch.slice(a, b - a).select([0, 1]).filter(chosen)

    return with_text.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _units(rows: DataFrame) -> DataFrame:
    """(unit, side, line, component, content): the units in which every two lines of a band value meet.

    A band value of up to UNIT_CHARS characters is one unit. A larger one is split by hash, every two parts meet in
    a unit, and so does each part with itself.
    """
    loads = rows.groupBy("band").agg(F.sum(F.length("content")).alias("load"))
    parts = loads.select("band", F.when(F.col("load") > UNIT_CHARS, F.ceil(2 * F.col("load") / UNIT_CHARS)).otherwise(1).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("line"), F.col("parts")).cast("int")
    placed = rows.join(parts, "band").withColumn("own", own)
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.struct(F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")))
    met = placed.withColumn("x", F.explode(others))
    return met.select(F.xxhash64("band", "x.i", "x.j").alias("unit"), F.when(F.col("x.i") < F.col("x.j"), F.col("own")).alias("side"), "line", "component", "content")


def unit_links(lines: list[str], part: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links of lines of different parts (and sides, unless these are -1), one between any two parts that meet."""
    flat, limits = distinct_runs(*_shingles(lines))
    sizes, links, part = np.diff(limits), [], part.copy()
    _, code = np.unique(flat, return_inverse=True)
    holders = np.repeat(np.arange(len(lines)), sizes)[np.argsort(code, kind="stable")]
    count = np.bincount(code)
    begins = np.cumsum(count) - count
    for i in range(1, len(lines)):
        open_ = (part[:i] != part[i]) & ((side[:i] != side[i]) | (side[i] < 0))
        open_ &= (100 * sizes[:i] >= PERCENT * sizes[i]) & (100 * sizes[i] >= PERCENT * sizes[:i])
        if not open_.any():
            continue
        own = code[limits[i] : limits[i + 1]]
        n = count[own]
        at = np.repeat(begins[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(holders[at], minlength=len(lines))[:i]
        for j in np.flatnonzero(open_ & (100 * common >= PERCENT * (sizes[i] + sizes[:i] - common))).tolist():
            if part[j] != part[i]:
                links.append((i, j))
                part[part == part[j]] = part[i]
    return links


def small_links(units: list[Unit], seen: dict[str, int] | None = None) -> list[list[tuple[int, int]]]:
    """The unit_links of each of many small units, whose shingles are made and counted in bins at once.

    Only those lines are compared that could link by their bins. ``seen`` counts these.
    """
    sets, seen = Sets([x for lines, _, _ in units for x in lines]), {} if seen is None else seen
    part, side = (np.concatenate([unit[k] for unit in units]) for k in (1, 2))
    count = np.array([len(x) for x, _, _ in units])
    unit = np.repeat(np.arange(len(units)), count)
    begin = np.cumsum(count) - count
    before = np.arange(len(unit)) - begin[unit]  # lines of the unit before each one
    ends = np.cumsum(before)
    links: list[list[tuple[int, int]]] = [[] for _ in units]
    a = 0
    while a < len(unit):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - before[a] + 16 * BOUND_PAIRS, "right")))
        x = np.repeat(np.arange(a, b), before[a:b])
        y = np.arange(len(x)) - np.repeat(ends[a:b] - before[a:b] - ends[a] + before[a] - begin[unit[a:b]], before[a:b])
        open_ = (part[x] != part[y]) & ((side[x] != side[y]) | (side[x] < 0))
        x, y = x[open_], y[open_]
        maybe = sets.may_link(x, y)
        for i, j in zip(x[maybe].tolist(), y[maybe].tolist()):
            if part[i] == part[j]:
                continue
            seen["compared"] = seen.get("compared", 0) + 1
            if sets.link(i, j):
                first = begin[unit[i]]
                links[unit[i]].append((int(i - first), int(j - first)))
                own = part[first : first + count[unit[i]]]
                own[own == part[j]] = part[i]
        a = b
    return links


def _joined(units: DataFrame) -> DataFrame:
    """Links (a, b) of components whose lines link in some unit; pairs are compared in the tasks, never written."""

    def linked(units: list[list[tuple]]) -> pa.RecordBatch:
        units = [x for x in units if len({row[2] for row in x}) > 1]
        args = [([x[3] for x in unit], np.array([x[2] for x in unit], np.int64), np.array([-1 if x[1] is None else x[1] for x in unit])) for unit in units]
        small = [k for k, unit in enumerate(units) if len(unit) <= SMALL_UNIT]
        found = dict(zip(small, small_links([args[k] for k in small]))) if small else {}
        found |= {k: unit_links(*args[k]) for k in range(len(units)) if k not in found}
        return _links([(units[k][i][2], units[k][j][2]) for k, pairs in found.items() for i, j in pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple] = []
        whole: list[list[tuple]] = []
        chars = 0
        for batch in slices(batches):
            for row in zip(*(x.to_pylist() for x in batch.columns)):
                if unit and unit[0][0] != row[0]:
                    whole.append(unit)
                    unit = []
                    if chars >= UNIT_CHARS:
                        yield linked(whole)
                        whole, chars = [], 0
                unit.append(row)
                chars += len(row[3])
        yield linked([*whole, unit] if unit else whole)

    return units.select("unit", "side", "component", "content").repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def _links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])


def line_classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the ids of lines that link to others, and (owner, lines, places) of the texts with lines.

    Lines of a band value are compared with the smallest id among them. In the band values whose other lines are not
    one component by then, every two of them in different components are compared as well.
    """
    left = save(_led(docs, text))
    candidates = save(left.select("line").unionByName(left.select(F.col("lead").alias("line"))).distinct())
    read = save(_contents(docs, text, candidates, key))
    contents = save(read.where("line is not null").select("line", "content").dropDuplicates(["line"]))
    pairs = left.select(F.col("line").alias("a"), F.col("lead").alias("b")).distinct()
    first = save(components(_verified(pairs, contents)))
    placed = left.select("band", "line").join(first.withColumnRenamed("node", "line"), "line", "left")
    placed = placed.select("band", "line", F.coalesce("component", "line").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    rows = save(placed.join(mixed, "band").join(contents, "line"))
    second = components(_joined(_units(rows))).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    known = first.join(second, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    lone = second.withColumnRenamed("component", "node").join(first, "node", "left_anti")
    classes = known.unionByName(lone.select("node", F.col("whole").alias("component")))
    return classes, read.where("lines is not null").select("owner", "lines", "places")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, removed): places (from 0, blank lines counted as places) of the lines to remove.

    One row for each key that has lines. Rows with a null key or text take no part. Rows that share a key
    count as one document given twice: what is kept of one is kept of the other.
    """
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key, text)
    classes, texts = line_classes(rows, key, text)
    classes = save(classes.withColumnRenamed("node", "line"))
    owners = save(texts.groupBy("owner").agg(F.count("*").alias("texts"), F.sum(F.size("lines")).alias("lines")))
    # Lines that come once and link to none stay: of these, only those of shared keys must be told apart.
    found, shared = _repeated(texts, classes), owners.where("texts > 1").select("owner")
    if together := not shared.isEmpty():
        whole = texts.join(shared, "owner", "left_semi").select("owner", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("places").alias("place"))))
        found = found.unionByName(whole)
    found = found.join(classes, "line", "left").select("owner", "place", F.coalesce("component", "line").alias("class"))
    every = save(found.distinct() if together else found)
    kept = every.groupBy("class").agg(F.min(F.struct("owner", "place")).alias("kept"))
    marked = every.join(kept, "class").select("owner", "place", (F.struct("owner", "place") != F.col("kept")).alias("gone"))
    marks = marked.groupBy("owner").agg(
        F.count("*").alias("told"), F.array_sort(F.collect_list(F.when(F.col("gone"), F.col("place")))).alias("removed")
    )
    return owners.join(marks, "owner", "left").select(
        F.col("owner").alias(key), F.when(F.col("texts") > 1, F.col("told")).otherwise(F.col("lines")).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without their repeated lines; a document that loses every line goes.

    Blank lines stay. Documents without any line (null, empty or blank text) and with a null key stay as they are.
    """
    marks = repeated_lines(docs, key, text)
    marks = marks.select(F.col(key).alias("__key"), F.col("n_lines").alias("__lines"), F.col("removed").alias("__removed"))
    joined = docs.join(marks, F.col(key) == F.col("__key"), "left").where("__lines is null or __lines > size(__removed)")
    split = F.split(text, "\n")
    places = F.filter(F.sequence(F.lit(0), F.size(split) - 1), lambda i: ~F.array_contains("__removed", i))
    cut = F.array_join(F.transform(places, lambda i: F.get(split, i)), "\n")
    return joined.select(*(F.when(F.size("__removed") > 0, cut).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in docs.columns))


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (places of the removed lines) of every document."""
    marks = repeated_lines(docs)
    zero = F.lit(0).cast("long")
    return docs.select("doc_id").join(marks, "doc_id", "left").select(
        "doc_id", F.coalesce("n_lines", zero).alias("n_lines"),
        F.coalesce(F.size("removed").cast("long"), zero).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )
