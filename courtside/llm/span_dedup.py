"""Substring deduplication by sliding sentence spans.

A sentence ends with a word that ends in . ! or ?, or at a newline. From every sentence starts one span: the
shortest run of at least MIN_SENTENCES sentences and MIN_WORDS words, or the sentence alone if it has LONG_WORDS;
and with every other sentence ends one, the shortest such run. Together they cover what all such runs would: what
follows the last span that starts in a repeated run is part of the one that ends with it.
Spans are compared over all documents by their words, A-Z as a-z; all but the first place of a span (by
document, then sentence) are repeats, and every sentence that a repeat covers is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from courtside.llm.common import hashed_words, mix, passes, range_hashes, slices, utf8, word_spans

MIN_SENTENCES = 2
MIN_WORDS = 15
LONG_WORDS = 20


def sentences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes; first word of each sentence; each text's first sentence; begin of each word; length of all bytes."""
    data, starts, ends, first = word_spans(texts)
    closes = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
    newlines = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(starts) + 1, bool)
    opens[1:-1] = closes[:-1] | (newlines[starts[1:]] > newlines[ends[:-1]])
    begins = np.flatnonzero(opens)[:-1] if len(starts) else np.zeros(0, np.int64)
    return hashed_words(data, starts, ends, True), begins, np.searchsorted(begins, first), starts, np.int64(len(data))


def spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first sentence within it, sentences, and two hashes of each span."""
    words, begins, first, _, _ = sentences(texts)
    edges = np.append(begins, len(words))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    at = np.arange(len(begins))
    ends = np.maximum(np.searchsorted(edges, begins + MIN_WORDS), at + MIN_SENTENCES)
    ends = np.where(np.diff(edges) >= LONG_WORDS, at + 1, ends)
    whole = ends <= first[1:][owner]
    # The same backwards; a long last sentence stands alone, and spans that start before it reach it.
    back = np.minimum(np.searchsorted(edges, edges[1:] - MIN_WORDS, side="right") - 1, np.arange(len(begins)) + 1 - MIN_SENTENCES)
    more = (back >= first[:-1][owner]) & (np.diff(edges) < LONG_WORDS)
    more &= (ends[back] != np.arange(len(begins)) + 1)  # not also one of the others
    at, ends = np.concatenate([at[whole], back[more]]), np.concatenate([ends[whole], np.flatnonzero(more) + 1])
    owner = np.concatenate([owner[whole], owner[more]])
    hashes = [range_hashes(x, edges[at], edges[ends]).view(np.int64) for x in (words, mix(words))]
    return owner, at - first[:-1][owner], ends - at, *hashes


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, repeats): the spans (at, n) of each document that are not the first of their kind."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("owner", kind), T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(1))
            for a, b in passes(texts):
                owner, at, n, h1, h2 = spans(texts[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), batch.column(0).take(pa.array(owner + a)), pa.array(at, pa.int32()), pa.array(n, pa.int32())], schema.names)

    found = docs.where(F.col(key).isNotNull()).select(key, text).mapInArrow(run, schema)
    place = F.struct("owner", "at")
    kept = found.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(place).alias("kept")).where("times > 1").drop("times")
    later = found.join(kept, ["h1", "h2"]).where(place != F.col("kept"))
    return later.groupBy("owner").agg(F.collect_set(F.struct("at", "n")).alias("repeats")).withColumnRenamed("owner", key)


def _cut(text: bytes, found: list[tuple[int, int]]) -> tuple[bytes, int, list[int]]:
    """The text without the sentences of the spans found, its number of sentences, and those removed."""
    _, begins, _, starts, length = sentences([text])
    gone = np.zeros(len(begins) + 1, np.int64)
    for at, n in found:
        gone[at] += 1
        gone[at + n] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    if not gone.any():
        return text, len(begins), []
    edges = np.append(starts[begins] - 1, length - 2)  # the joined bytes have one newline before the text
    edges[0] = 0
    kept = b"".join(text[edges[i] : edges[i + 1]] for i in np.flatnonzero(~gone))
    return kept.rstrip(b" \t\n\r\x0b\x0c"), len(begins), np.flatnonzero(gone).tolist()


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the text cut, and n_sentences long, removed array<int> (sentences from 0).

    White space after a removed sentence goes with it. Null texts stay null with no sentences. Rows with a null key
    are not compared. Rows that share a key count as one document given twice. Columns of those names are replaced.
    """
    rest = [c for c in docs.columns if c not in ("n_sentences", "removed")]
    marks = repeats(docs, key, text).select(F.col(key).alias("__key"), F.col("repeats").alias("__repeats"))
    joined = docs.select(rest).join(marks, F.col(key) == F.col("__key"), "left").select(*rest, "__repeats")
    fields = [*docs.select(rest).schema.fields, T.StructField("n_sentences", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(fields)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            marked = batch.column(len(rest)).to_pylist()
            rows = [_cut(x or b"", [(y["at"], y["n"]) for y in found or ()]) for x, found in zip(texts, marked)]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array([None if x is None else row[0].decode() for x, row in zip(texts, rows)], batch.column(at).type)
            columns += [pa.array([row[1] for row in rows], pa.int64()), pa.array([row[2] for row in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return joined.mapInArrow(run, schema)


def op7_span_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed, text (what is left) of every document."""
    cut = remove_repeats(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_sentences", F.size("removed").cast("long").alias("n_removed"), "removed", "text")
