"""Byte-level BPE encoding and decoding of whole texts.

Spark's regular expressions split a text into words. A task folds the distinct words of a batch of texts: the ids
of their bytes are merged, the pair of lowest rank first, until no pair has a rank. Words of one length are folded
together, a merge in each of them at a time. Only the rank file is sent to the tasks.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from courtside.llm.common import KEPT, slices

#: Most words that are folded at once, and their most bytes; a longer word is folded on its own, and so are few words.
MAX_WORDS = 1 << 15
MAX_WORD_BYTES = 64
FEW_WORDS = 16
_WORDS = "__words"
_SPACES = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def java_pattern(pattern: str) -> str:
    r"""The split pattern with \s and \S as Unicode white space, as the tokenizer's library has them."""
    return pattern.replace(r"[^\s", f"[^{_SPACES}").replace(r"\S", f"[^{_SPACES}]").replace(r"\s", f"[{_SPACES}]")


def words_of(text: Column, pattern: str) -> Column:
    """All matches of the split pattern, in order; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(pattern)), F.lit(0))


def _fold_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a search for each merge, which is faster for few bytes."""
    get, none = ranks.get, 1 << 62
    parts = [word[i : i + 1] for i in range(len(word))]
    found = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while found and (low := min(found)) < none:
        i = found.index(low)
        pair = parts[i] + parts[i + 1]
        parts[i : i + 2] = [pair]
        del found[i]
        if i < len(found):
            found[i] = get(pair + parts[i + 1], none)
        if i:
            found[i - 1] = get(parts[i - 1] + pair, none)
    return [ranks[p] for p in parts]


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: the adjacent pair of lowest rank, leftmost first, is merged until none has a rank."""
    if len(word) <= MAX_WORD_BYTES:
        return _fold_short(word, ranks)
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i, p) for i in range(n - 1) if (p := word[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= n or len(parts[i]) + len(parts[j]) != len(pair):
            continue  # one of the two was merged with another since
        parts[i], parts[j] = pair, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (p := pair + parts[k]) in ranks:
                heapq.heappush(heap, (ranks[p], i, p))
        if (h := before[i]) >= 0 and (p := parts[h] + pair) in ranks:
            heapq.heappush(heap, (ranks[p], h, p))
    return [ranks[p] for p in parts if p is not None]


class _Merges:
    """Folds many words at once; two adjacent ids give the rank of their token, if there is one."""

    NONE = np.int64(1) << 40

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.missing = ranks, max(ranks.values()) + 1
        self.base = self.missing + 1
        self.tokens, self.of_token = pa.array(list(ranks), pa.binary()), np.array(list(ranks.values()), np.int64)
        self.of_byte = np.array([ranks.get(bytes([x]), self.missing) for x in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token) if len(token) <= MAX_WORD_BYTES else 0):
                if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None:
                    pairs[left * self.base + right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)  # a last one that no pair has
        self.found = np.array([*(pairs[x] for x in keys.tolist()), self.NONE], np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.base + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.found[at], self.NONE)

    def fold(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows that are done and their ids, from the ids of the bytes of words of one length, a word a row.

        Each round merges one pair in every row that has a ranked one, so that all rows left are equally long.
        """
        rows = np.arange(len(ids))
        found = self.ranks_of(ids[:, :-1], ids[:, 1:])
        while found.shape[1]:
            at = found.argmin(axis=1)
            low = found[np.arange(len(rows)), at]
            if (done := low >= self.NONE).any():
                yield rows[done], ids[done]
                rows, ids, found, at, low = (x[~done] for x in (rows, ids, found, at, low))
                if not len(rows):
                    return
            n, width = ids.shape
            each = np.arange(n)
            ids[each, at] = low
            kept = np.ones((n, width), bool)
            kept[each, at + 1] = False
            ids = ids[kept].reshape(n, width - 1)
            kept = np.ones((n, width - 1), bool)
            kept[each, at] = False
            found = found[kept].reshape(n, width - 2)
            for side in (at - 1, at):  # the pairs that the merged one is now in
                x = np.flatnonzero((side >= 0) & (side < width - 2))
                y = side[x]
                found[x, y] = self.ranks_of(ids[x, y], ids[x, y + 1])
        yield rows, ids

    def words(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each word, one after the other, and their limits."""
        whole = pc.index_in(words, value_set=self.tokens)
        known = whole.is_valid().to_numpy(zero_copy_only=False)
        limits = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(limits)
        sizes = np.ones(len(words), np.int64)
        parts = [(np.flatnonzero(known), self.of_token[whole.drop_null().to_numpy()][:, None])]
        other = np.flatnonzero(~known)
        other = other[np.argsort(lengths[other], kind="stable")]
        for same in np.split(other, np.flatnonzero(np.diff(lengths[other])) + 1):
            length = int(lengths[same[0]]) if len(same) else 0
            if len(same) < FEW_WORDS or length > MAX_WORD_BYTES:
                for x in same.tolist():
                    parts.append((np.array([x]), np.array([fold(data[limits[x] : limits[x + 1]].tobytes(), self.ranks)], np.int64)))
            else:
                folded = self.fold(self.of_byte[data[limits[same][:, None] + np.arange(length)]])
                parts += ((same[rows], ids) for rows, ids in folded)
        for own, ids in parts:
            sizes[own] = ids.shape[1]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        pool = np.empty(ends[-1], np.int32)
        for own, ids in parts:
            pool[ends[own][:, None] + np.arange(ids.shape[1])] = ids
        if (pool == self.missing).any():
            raise KeyError("a byte has no rank")
        return pool, ends

    def encode(self, words: pa.ListArray, max_words: int = MAX_WORDS) -> pa.ListArray:
        """The ids of each list of words, a batch of lists at once."""
        flat = words.flatten().dictionary_encode()
        distinct, step = flat.dictionary.cast(pa.binary()), max(1, max_words)
        done = [self.words(distinct.slice(i, step)) for i in range(0, len(distinct), step)]
        pool = np.concatenate([x for x, _ in done] or [np.empty(0, np.int32)])
        sizes = np.concatenate([np.diff(x) for _, x in done] or [np.empty(0, np.int64)])
        begins = np.cumsum(sizes) - sizes
        at = flat.indices.to_numpy(zero_copy_only=False)
        size = sizes[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = pool[np.repeat(begins[at] - upto[:-1], size) + np.arange(upto[-1])]
        offsets = words.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(upto[offsets - offsets[0]], pa.int32()), pa.array(ids, pa.int32()))


def _joined(ids: pa.ListArray, pieces: pa.BinaryArray) -> pa.BinaryArray:
    """The pieces of each list of ids, concatenated."""
    taken = pieces.take(ids.flatten())
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False))])
    limits = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
    data = taken.buffers()[2] or pa.py_buffer(b"")
    rows = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends[limits].astype(np.int32)), data])
    return pc.if_else(ids.is_null(), pa.scalar(None, pa.binary()), rows)


class ByteBPE:
    """Encoder and decoder for a rank file (base64 of a token and its rank on each line)."""

    def __init__(self, spark: SparkSession, rank_file: str, pattern: str) -> None:
        self.rank_file, self.pattern = rank_file, pattern
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._ranks = spark.sparkContext.broadcast(ranks)

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids", max_words: int = MAX_WORDS) -> DataFrame:
        """Add the ids of each whole text; null and empty texts have none. At most max_words words are folded at once."""
        ranks, others = self._ranks, [c for c in docs.columns if c != ids]
        split = docs.select(*others, words_of(F.col(text), self.pattern).alias(_WORDS))
        name = self.rank_file
        schema = T.StructType([*docs.select(*others).schema, T.StructField(ids, T.ArrayType(T.IntegerType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, keep="byte_bpe"):
                held = KEPT.get("byte_bpe")
                if held is None or held[0] != name:
                    KEPT["byte_bpe"] = held = (name, _Merges(ranks.value))
                coded = held[1].encode(batch.column(len(others)), max_words)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], coded], schema.names)

        return split.mapInArrow(run, schema)

    def decode(self, coded: DataFrame, ids: str = "ids", data: str = "data") -> DataFrame:
        """Add the bytes of each array of ids: their pieces, concatenated. Null ids give null."""
        ranks, others = self._ranks, [c for c in coded.columns if c != data]
        schema = T.StructType([*coded.select(*others).schema, T.StructField(data, T.BinaryType())])
        place = others.index(ids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            by_id = {rank: token for token, rank in ranks.value.items()}
            pieces = pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.binary())
            for batch in slices(batches, keep="byte_bpe"):
                yield pa.RecordBatch.from_arrays([*batch.columns, _joined(batch.column(place), pieces)], schema.names)

        return coded.select(*others).mapInArrow(run, schema)


def op3_byte_bpe(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    coder = ByteBPE(docs.sparkSession, rank_file, pattern)
    coded = coder.decode(coder.encode(docs.select("doc_id", "text")).select("doc_id", "ids"))
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
