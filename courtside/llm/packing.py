"""Packing of documents into sequences by cutting-stock column generation.

Tokenized documents are cut at every CAPACITY tokens. Piece lengths, rounded up to UNIT tokens, form a
histogram of CAPACITY / UNIT classes. A linear program over packing patterns, whose columns a knapsack
recursion prices, gives how often each pattern is used; the rounded patterns are then dealt to the
pieces of each class by rank. Only the histogram and the patterns pass the driver: their size is bounded by
the number of classes, whatever the input.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from courtside.llm.common import KEPT, passes, save, slices, utf8

CAPACITY = 2048
UNIT = 16
CLASSES = CAPACITY // UNIT
END_ID = 1
#: Bytes of words and their ids that a Python worker remembers, about; beyond it the memory starts anew.
KNOWN_BYTES = 160 << 20
#: What a remembered word takes besides its characters: its object, its place in the dictionary, its ids.
WORD_BYTES = 200
#: Bytes of text split into words at once.
SPLIT_BYTES = 4 << 20


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_PLAIN = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b".,!?;:*$%&#|<>()[]{}/=+-_@~^\"", np.uint8))


class WordTokenizer:
    """Ids of whole texts by a lower-casing tokenizer that no white space joins: each distinct word is encoded once.

    The tokenizer splits before its merges wherever a mark follows a letter or a digit, so that such words can be
    split there beforehand and fewer are distinct. An apostrophe isn't one of these marks: it can join.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # where the ids of the k-th known word end

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        """One for each Python worker, so that later tasks of the same kind find the words known."""
        held = KEPT.get("tokenizer")
        if held is None or held[0] != path:
            KEPT["tokenizer"] = held = (path, cls(path))
        return held[1]

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(found), np.uint32)
            n, last = len(self.known), int(self.ends[len(self.known) - 1]) if self.known else 0
            if last + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)])
            if n + len(some) > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros(max(len(self.ends), len(some)), np.int64)])
            self.ids[last : last + len(flat)] = flat
            self.ends[n : n + len(some)] = last + np.cumsum([len(x) for x in found])
            self.known.update(zip(some, range(n, n + len(some))))

    def _codes(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.known]
        size = sum(map(len, new)) + WORD_BYTES * len(new)
        if self.known and self.size + size > KNOWN_BYTES:
            self._forget()
            new, size = words, sum(map(len, words)) + WORD_BYTES * len(words)
        self.size += size
        self._learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin and end."""
        data = _LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        cuts = np.flatnonzero(_PLAIN[data[:-1]] & _MARKS[data[1:]]) + 1 if len(data) else np.zeros(0, np.int64)
        limits = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        cuts = cuts[~np.isin(cuts, limits)]
        limits = limits + np.searchsorted(cuts, limits)
        buffers = [None, pa.py_buffer(limits.astype(np.int32)), pa.py_buffer(np.insert(data, cuts, 32))]
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), buffers))
        words = split.flatten().dictionary_encode()
        code = self._codes(words.dictionary.to_pylist())
        ends = self.ends[code]
        begins = np.where(code > 0, self.ends[code - 1], 0)
        at = words.indices.to_numpy(zero_copy_only=False)
        sizes = (ends - begins)[at]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(begins[at] - upto[:-1], sizes) + np.arange(upto[-1])
        return self.ids[places], upto[split.offsets.to_numpy()]


PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, start, length, ids_crc32, doc_tokens): each document's ids and END_ID in pieces of at most CAPACITY."""
    schema = docs.select(key).schema
    for part in PIECES.split(", "):
        schema = schema.add(*part.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(tokenizer_path)
        for batch in slices(batches, 2000, keep="tokenizer"):
            whole = utf8(batch.column(1))
            for first, last in passes(whole, SPLIT_BYTES):
                texts = whole[first:last]
                ids, limits = tokenizer.encode(texts)
                rows: list[tuple[int, int, int, int, int]] = []
                for i in range(len(texts)):
                    own = np.append(ids[limits[i] : limits[i + 1]], np.uint32(END_ID)).astype("<u4")
                    for at in range(0, len(own), CAPACITY):
                        piece = own[at : at + CAPACITY]
                        rows.append((i, at, len(piece), zlib.crc32(piece.tobytes()), len(own)))
                columns = list(zip(*rows))
                keys = batch.column(0).take(pa.array(np.array(columns[0], np.int64) + first))
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in columns[1:])], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def best_patterns(demand: np.ndarray, units: int = CLASSES, rounds: int = 5000) -> list[tuple[dict[int, int], int]]:
    """Patterns ({class: pieces}, uses) that hold exactly demand[i] pieces of each class i = 1..units.

    Solves min sum(x) with patterns @ x = demand by column generation: a revised simplex whose entering
    column is the best knapsack for the present dual values. Uses are rounded down; the few pieces left
    over are packed first-fit, longest first. Stopping after `rounds` costs padding, never pieces.
    """
    sizes = np.flatnonzero(demand)
    m = len(sizes)
    if not m:
        return []
    want = demand[sizes].astype(float)
    basis = np.diag(units // sizes).astype(float)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(m))
        column = _knapsack(worth, sizes, units)
        if worth @ column <= 1 + 1e-9:
            break
        now, step = np.linalg.solve(basis, np.column_stack([want, column])).T
        ratio = np.where(step > 1e-9, np.maximum(now, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, ratio.argmin()] = column
    uses = np.floor(np.maximum(np.linalg.solve(basis, want), 0) + 1e-6).astype(np.int64)
    columns = basis.astype(np.int64)
    left = demand[sizes].astype(np.int64) - columns @ uses
    while (left < 0).any():  # a rounding error let a pattern run over
        over = int(np.flatnonzero(left < 0)[0])
        k = int(np.flatnonzero((columns[over] > 0) & (uses > 0))[0])
        uses[k] -= 1
        left += columns[:, k]
    found = [({int(s): int(a) for s, a in zip(sizes, columns[:, k]) if a}, int(uses[k])) for k in range(m) if uses[k]]
    return found + _first_fit({int(s): int(n) for s, n in zip(sizes, left) if n}, units)


def _knapsack(worth: np.ndarray, sizes: np.ndarray, units: int) -> np.ndarray:
    """The column of most worth that fits into units: unbounded knapsack by dynamic programming."""
    best, last = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        fits = sizes <= room
        values = np.where(fits, worth + best[room - np.where(fits, sizes, 0)], -np.inf)
        k = int(values.argmax())
        if values[k] > best[room - 1] + 1e-12:
            best[room], last[room] = values[k], k
        else:
            best[room] = best[room - 1]
    column, room = np.zeros(len(sizes)), units
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            column[last[room]] += 1
            room -= sizes[last[room]]
    return column


def _first_fit(left: dict[int, int], units: int) -> list[tuple[dict[int, int], int]]:
    """Greedy patterns for what is left, each filled with the longest pieces that fit and used as often as they last."""
    found = []
    while left:
        pattern, room = {}, units
        for size in sorted(left, reverse=True):
            if n := min(left[size], room // size):
                pattern[size] = n
                room -= n * size
        uses = min(left[s] // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[s] -= n * uses
        left = {s: n for s, n in left.items() if n}
        found.append((pattern, uses))
    return found


def _deal(ranked: DataFrame, patterns: list[tuple[dict[int, int], int]]) -> DataFrame:
    """Sequence and slot of the piece of each rank (0..) in its class."""
    spans: dict[int, list[tuple[int, int, int, int]]] = {}
    base, taken = 0, dict.fromkeys(range(1, CLASSES + 1), 0)
    for pattern, uses in patterns:
        slot = 0
        for size in sorted(pattern, reverse=True):
            spans.setdefault(size, []).append((taken[size], pattern[size], base, slot))
            taken[size] += pattern[size] * uses
            slot += pattern[size]
        base += uses
    tables = {size: np.array(x, np.int64).T for size, x in spans.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ranks = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("kind", "rank"))
            sequence, slot = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for kind in np.unique(kinds):
                mine = kinds == kind
                first, each, begin, place = tables[int(kind)]
                k = np.searchsorted(first, ranks[mine], "right") - 1
                use, at = np.divmod(ranks[mine] - first[k], each[k])
                sequence[mine], slot[mine] = begin[k] + use, place[k] + at
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(slot)], [*batch.schema.names, "sequence_id", "slot"])

    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("slot", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack(pieces: DataFrame) -> DataFrame:
    """Add sequence_id and offset to rows with a length of 1..CAPACITY; no row is lost or cut again.

    Pieces are ranked within their class by the part of the saved table that holds them, then by its
    rows, so that no class has to fit into one task.
    """
    kind = F.ceil(F.col("length") / UNIT).cast("int").alias("kind")
    kept = save(pieces.select("*", kind, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")))
    counts = kept.groupBy("part", "kind").agg(F.count("*").alias("n"))
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "kind", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    demand = np.zeros(CLASSES + 1, np.int64)
    for row in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect():  # at most CLASSES rows
        demand[row["kind"]] = row["n"]
    own = Window.partitionBy("part", "kind").orderBy("row")
    ranked = kept.join(starts, ["part", "kind"]).withColumn("rank", F.col("first") + F.row_number().over(own) - 1)
    dealt = _deal(ranked.select(*pieces.columns, "kind", "rank"), best_patterns(demand))
    in_order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    offset = (F.sum("length").over(in_order) - F.col("length")).alias("offset")
    return dealt.select(*pieces.columns, "sequence_id", offset)


def op6_packing(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    return pack(cut(docs, tokenizer_path))
