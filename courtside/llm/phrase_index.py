"""Benchmark decontamination by a distributed positional inverted index.

The training texts are indexed once: a table of shards, each with the terms of about a megabyte of text, sorted, and the
positions of each term. Test phrases are windows of consecutive words. A shard is searched for a window from its term
that is rarest in all training texts: the positions of that term less its place in the window are the candidates, which
the lists of the other terms, offset by their places, cut down one after the other, again from the rarest on.
A window whose terms don't all occur needs no list at all. With slop 0 what is left are the exact occurrences of the
phrase; otherwise each word may stand up to slop words before or after its place as seen from the rarest term.

Test phrases are dealt by hash to blocks of about BLOCK_WINDOWS windows, and one block at a time is sent to all tasks,
so what is broadcast is bounded however large the benchmark is; the index is stored once and read again for each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from courtside.llm.common import few_files, hashed_words, passes, range_hashes, save, shared_folder, slices, utf8, word_spans

WINDOW = 10
#: Windows that one search sends to the tasks: at most WINDOW longs each.
BLOCK_WINDOWS = 1 << 16
#: A reader holds the shards of a row group at once.
ROW_GROUP_BYTES = 8 << 20

_BETWEEN = ~np.isin(np.arange(256), np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)), np.uint8))
_NO_TERM = -1


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z, and each text's first word."""
    data, starts, ends, first = word_spans(texts, _BETWEEN)
    return hashed_words(data, starts, ends, True).view(np.int64), first


# -- index ---------------------------------------------------------------------------------------------


def _index_schema(key: T.DataType) -> T.StructType:
    array = lambda kind: T.ArrayType(kind)
    return T.StructType([
        T.StructField("rows", array(T.LongType())), T.StructField("keys", array(key)), T.StructField("limits", array(T.IntegerType())),
        T.StructField("terms", array(T.LongType())), T.StructField("ends", array(T.IntegerType())), T.StructField("positions", array(T.IntegerType())),
    ])


def _listed(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of all texts, written to the shared folder: one row per shard.

    rows: a number for each row of docs (keys may repeat or be null); keys; limits: first position of each text, and the
    end; terms: hashes of the distinct words, ascending; ends: where each term's positions end; positions: by term,
    ascending. Null texts have no words. A text longer than a shard is a shard of its own.
    """
    schema = _index_schema(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(2))
            for a, b in passes(texts):
                found, first = terms_of(texts[a:b])
                order = np.argsort(found, kind="stable")
                last = np.flatnonzero(np.append(found[order][1:] != found[order][:-1], True)) if len(order) else order
                columns = [
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(first.astype(np.int32)),
                    pa.array(found[order][last]), pa.array((last + 1).astype(np.int32)), pa.array(order.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays([_listed(x) for x in columns], schema.names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key), F.col(text))
    path = f"{shared_folder(docs.sparkSession)}/phrase-index-{uuid.uuid4()}"
    few_files(numbered.mapInArrow(run, schema)).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def indexed_rows(index: DataFrame, key: str = "doc_id") -> DataFrame:
    """(row, key, n_words) of every indexed row."""
    sizes = F.transform(F.sequence(F.lit(1), F.size("rows")), lambda k: F.element_at("limits", k + 1) - F.element_at("limits", k))
    one = F.explode(F.arrays_zip(F.col("rows").alias("row"), F.col("keys").alias("key"), sizes.cast("array<long>").alias("n_words")))
    return index.select(one.alias("one")).select("one.row", F.col("one.key").alias(key), "one.n_words")


# -- test phrases ---------------------------------------------------------------------------------------


def windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, window, terms): every `size` consecutive words of an item, all of them if it has fewer; window is their hash.

    Items without words have none; items with a null key are left out. A repeated key stands for all its texts.
    """
    schema = T.StructType([T.StructField(key, items.schema[key].dataType), T.StructField("window", T.LongType()), T.StructField("terms", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(1))
            for a, b in passes(texts, 1 << 18):
                found, first = terms_of(texts[a:b])
                counts = np.diff(first)
                n = np.where(counts > size, counts - size + 1, np.minimum(counts, 1))
                owner = np.repeat(np.arange(b - a), n)
                starts = np.arange(len(owner)) - (np.cumsum(n) - n)[owner] + first[:-1][owner]
                ends = np.minimum(starts + size, first[1:][owner])
                sizes = ends - starts
                upto = np.concatenate([[0], np.cumsum(sizes)])
                places = np.repeat(starts - upto[:-1], sizes) + np.arange(upto[-1])
                name = range_hashes(found.view(np.uint64), starts, ends).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(found[places]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner + a)), pa.array(name), lists], schema.names)

    return items.where(F.col(key).isNotNull()).select(key, text).mapInArrow(run, schema)


@dataclass
class Block:
    """Windows as a matrix of places in terms, from the rarest term on, with each one's offset in the window."""

    names: np.ndarray
    sizes: np.ndarray
    terms: np.ndarray
    which: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, names: np.ndarray, lists: list[list[int]], counts: dict[int, int]) -> Block:
        """Windows of which a term doesn't occur at all are left out; equal counts go by the offset."""
        lists = [[(counts.get(t, 0), k, t) for k, t in enumerate(x)] for x in lists]
        some = [i for i, x in enumerate(lists) if all(n for n, _, _ in x)]
        terms = np.unique(np.array([t for i in some for _, _, t in lists[i]], np.int64))
        width = max((len(lists[i]) for i in some), default=0)
        which, offsets = np.full((len(some), width), _NO_TERM, np.int64), np.zeros((len(some), width), np.int64)
        for row, i in enumerate(some):
            for column, (_, k, t) in enumerate(sorted(lists[i])):
                which[row, column], offsets[row, column] = np.searchsorted(terms, t), k
        return cls(names[some], np.array([len(lists[i]) for i in some], np.int64), terms, which, offsets)

    def search(self, limits: np.ndarray, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, text, and start within the text of each match in a shard."""
        nothing = np.zeros(0, np.int64)
        if not len(terms) or not len(self.names):
            return nothing, nothing, nothing
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        there = np.append(terms[at] == self.terms, True)  # the last one for _NO_TERM
        alive = np.flatnonzero(there[self.which].all(axis=1))
        at = np.append(at, 0)
        begins = np.concatenate([[0], ends[:-1]])
        rarest = at[self.which[alive, 0]]
        n = ends[rarest] - begins[rarest]
        window = np.repeat(alive, n)
        anchor = positions[np.repeat(begins[rarest] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64)
        text = np.searchsorted(limits, anchor, side="right") - 1
        start = anchor - self.offsets[window, 0]
        # Each posting as one number, by term and position: one search finds a term's next position anywhere.
        total = np.int64(limits[-1])
        postings = np.repeat(np.arange(len(terms)), ends - begins) * total + positions
        for k in range(self.which.shape[1]):
            term = self.which[window, k]
            want = start + self.offsets[window, k]
            low, high = np.maximum(want - slop, limits[text]), np.minimum(want + slop, limits[text + 1] - 1)
            base = at[term] * total
            next_one = np.searchsorted(postings, base + low)
            met = (low <= high) & (postings[np.minimum(next_one, len(postings) - 1)] <= base + high) & (next_one < len(postings))
            kept = met | (term == _NO_TERM)
            window, text, start = window[kept], text[kept], start[kept]
        return window, text, start - limits[text]


def _shards(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Each shard's lists as Arrow arrays."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(batch.column(name)[k].values for name in names)


def _int64(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def term_counts(index: DataFrame, terms: np.ndarray) -> dict[int, int]:
    """How often each of the given terms (sorted) occurs in all training texts; terms that don't occur are absent."""
    held = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(held.value), np.int64)
        for own, ends in _shards(batches, "terms", "ends"):
            own, counts = _int64(own), np.diff(_int64(ends), prepend=0)
            if len(own):
                at = np.minimum(np.searchsorted(own, held.value), len(own) - 1)
                totals += np.where(own[at] == held.value, counts[at], 0)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(held.value[some]), pa.array(totals[some])], ["term", "n"])

    counted = index.select("terms", "ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    return dict(zip(found.column("term").to_pylist(), found.column("n").to_pylist()))


def matches(index: DataFrame, phrases: DataFrame, key: str = "doc_id", slop: int = 0, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(row, key, window, size, at): for each indexed row and window of phrases that occurs in it, where (array, ascending).

    phrases has the columns window and terms. at counts words from 0; with slop above 0 it is where the window would begin
    as seen from its rarest term, which may lie before the text. The result is lazy, one scan of the index per block.
    """
    spark = index.sparkSession
    distinct = save(phrases.groupBy("window").agg(F.first("terms").alias("terms")))
    blocks = max(1, -(-distinct.count() // block))
    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField(key, index.schema["keys"].dataType.elementType), T.StructField("window", T.LongType()),
        T.StructField("size", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())),
    ])
    found = spark.createDataFrame([], schema)
    for number in range(blocks):
        local = dealt.where(F.col("block") == number).select("window", "terms").toArrow()
        lists = local.column("terms").to_pylist()
        counts = term_counts(index, np.unique(np.array([t for x in lists for t in x], np.int64)))
        held = spark.sparkContext.broadcast(Block.of(local.column("window").to_numpy(), lists, counts))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for rows, keys, *lists in _shards(batches, "rows", "keys", "limits", "terms", "ends", "positions"):
                window, text, start = held.value.search(*map(_int64, lists), slop)
                order = np.lexsort((start, window, text))
                window, text, start = window[order], text[order], start[order]
                new = np.ones(len(order), bool)
                new[1:] = (window[1:] != window[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                of = pa.array(text[first])
                places = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(start.astype(np.int32)))
                one = window[first]
                columns = [rows.take(of), keys.take(of), pa.array(held.value.names[one]), pa.array(held.value.sizes[one].astype(np.int32)), places]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        found = found.unionByName(index.mapInArrow(run, schema))
    return found


# -- what the query reports ------------------------------------------------------------------------------


def _covered(spans: list[dict]) -> int:
    """Words that lie in any of the spans (size, at)."""
    starts = np.concatenate([np.asarray(x["at"], np.int64) for x in spans])
    ends = np.concatenate([np.asarray(x["at"], np.int64) + x["size"] for x in spans])
    order = np.lexsort((ends, starts))
    starts, upto = starts[order], np.maximum.accumulate(ends[order])
    before = np.concatenate([[0], upto[:-1]])
    return int(np.maximum(upto - np.maximum(starts, before), 0).sum())


def hit_words(found: DataFrame) -> DataFrame:
    """(row, n_hit): distinct word places of each row inside any exact match."""
    spans = found.groupBy("row").agg(F.collect_list(F.struct("size", "at")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sums = [_covered(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], ["row", "n_hit"])

    return spans.mapInArrow(run, "row long, n_hit long")


def op12_decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document row.

    A null text has no words; rows that share a doc_id, and those where it is null, are reported one by one.
    """
    index = build_index(docs)
    phrases = save(windows(items.select(F.col("item_id").cast("string").alias("item_id"), "text")))
    found = save(matches(index, phrases))
    members = phrases.select("window", "item_id").distinct()
    pairs = found.select("row", "window").join(members, "window").select("row", "item_id").distinct()
    named = pairs.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    marked = indexed_rows(index).join(hit_words(found), "row", "left").join(named, "row", "left")
    listed = F.coalesce(F.array_join("items", ","), F.lit(""))
    return marked.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
