"""Phrase collocations by best-first branch-and-bound growth of phrases.

Phrases grow word by word to the right. The occurrences of a prefix P bound all that begins with it: a phrase Q that
extends P occurs a <= f(P) times, and its cut after the first word w gives at most 2a / (f(w) + a) (times SCALE), since
the rest of Q occurs at least a times; with a at most f(P) that is bound(P) = SCALE * 2 f(P) / (f(w) + f(P)). It is no
less than the score of P itself, nor than the bound of any longer prefix.

The frontier is opened down to a level per language, the highest bounds first: prefixes with bound(P) >= level are
expanded by one word to either side, so that every phrase with a score of the level or more is counted, scored, and
known to be covered by a longer phrase or not (a phrase of one more word is enough to tell: what lies in a
longer one lies in it at least as often). When a language has `limit` surviving phrases at its level, the limit-th score
and its ties are settled; otherwise its level falls to where four times as many word pairs lie, at last to 0, which
opens everything.

Counting passes read the texts in Spark tasks. Which n-grams a pass emits is decided by bitmaps of the frontier, at
most 2^MAX_BITS bits whatever its size: a full bitmap lets more n-grams pass, which are then counted for nothing,
but none is lost, so results don't depend on it. N-grams are rows of word codes, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from courtside.llm.common import hashed_words, mix, passes, save, slices, utf8, word_spans

LIMIT = 2000
LEAST = 30
COVERED_PERCENT = 80
SCALE = 1_000_000
NO_LANGUAGE = "und"
#: Bitmaps have 16 bits for each phrase, between 2^MIN_BITS and 2^MAX_BITS.
MIN_BITS, MAX_BITS = 12, 27
#: Bins that the levels are chosen from: a score is from 0 to SCALE.
BIN = 1000

_BREAKS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_BETWEEN = _BREAKS | np.isin(np.arange(256), np.frombuffer(b" \t", np.uint8))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

W = ["w1", "w2", "w3", "w4"]


# -- reading words ---------------------------------------------------------------------------------------


def _language_code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Words:
    """The words of some texts: code (of language and word), piece, place in the joined bytes, text."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        self.data, self.starts, self.ends, first = word_spans(texts, _BETWEEN)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(first))
        own = {x: _language_code(x) for x in set(langs)}
        salt = np.array([own[x] for x in langs], np.uint64)
        self.codes = mix(hashed_words(self.data, self.starts, self.ends, True) ^ salt[self.owner])
        self.piece = np.cumsum(_BREAKS[self.data])[self.starts] if len(self.starts) else np.zeros(0, np.int64)

    def grams(self, n: int) -> np.ndarray:
        """Where n words follow each other within a piece."""
        at = np.arange(max(0, len(self.codes) - n + 1))
        return at[self.piece[at] == self.piece[at + n - 1]]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    for batch in slices(batches):
        texts = utf8(batch.column(0))
        langs = [NO_LANGUAGE if x is None else x for x in batch.column(1).to_pylist()]
        for a, b in passes(texts):
            yield Words(texts[a:b], langs[a:b]), langs[a:b]


def _key(columns: Sequence[np.ndarray]) -> np.ndarray:
    """One hash of several word codes, by row."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for x in columns:
        total = mix(total ^ x) * np.uint64(0x9E3779B97F4A7C15)
    return mix(total)


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, word, f): every word of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, langs in _read(batches):
            codes, first, n = np.unique(found.codes, return_index=True, return_counts=True)
            lower = _LOWER[found.data].tobytes()
            words = [lower[a:b] for a, b in zip(found.starts[first].tolist(), found.ends[first].tolist())]
            own = [langs[k] for k in found.owner[first].tolist()]
            columns = [pa.array(own, pa.string()), pa.array(codes.view(np.int64)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "word", "f"])

    counted = docs.select(text, lang).mapInArrow(run, "lang string, code long, word string, f long")
    return counted.groupBy("lang", "code", "word").agg(F.sum("f").alias("f"))


# -- bitmaps ---------------------------------------------------------------------------------------------


class Bitmap:
    """A set of phrases by the bits of their hashes: holds all of them, and perhaps others."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def holds(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        at = _key(columns) & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def bitmap(phrases: DataFrame, columns: Sequence[str], most: int = MAX_BITS) -> Bitmap:
    """The bitmap of some phrases. What comes to the driver is one long for each 64 bits: at most 2^most bits together."""
    size = 1 << min(most, max(MIN_BITS, (16 * phrases.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.to_numpy(zero_copy_only=False).view(np.uint64) for x in batch.columns]
            at = np.unique(_key(found) & np.uint64(size - 1))
            slot, first = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.uint64(1) << (at & np.uint64(63))
            bits = np.bitwise_or.reduceat(bits, first) if len(first) else bits
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(bits.view(np.int64))], ["slot", "bits"])

    parts = phrases.select(*columns).mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    whole = np.zeros(size // 64, np.int64)
    whole[parts.column("slot").to_numpy()] = parts.column("bits").to_numpy()
    return Bitmap(whole.view(np.uint8))


def count_grams(docs: DataFrame, choose: Callable[[Words], Iterator[tuple[int, np.ndarray]]], text: str, lang: str) -> DataFrame:
    """(w1, w2, w3, w4, a): occurrences of the n-grams (n, places) that `choose` picks; words beyond n are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _ in _read(batches):
            for n, at in choose(found):
                _, first, times = np.unique(_key([found.codes[at + k] for k in range(n)]), return_index=True, return_counts=True)
                at = at[first]
                words = [pa.array(found.codes[at + k].view(np.int64)) if k < n else pa.nulls(len(at), pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([*words, pa.array(times)], [*W, "a"])

    counted = docs.select(text, lang).mapInArrow(run, "w1 long, w2 long, w3 long, w4 long, a long")
    return counted.groupBy(*W).agg(F.sum("a").alias("a"))


# -- scores, bounds, cover -------------------------------------------------------------------------------


def _share(a: str, total: str) -> Column:
    """floor(2 * SCALE * a / total) without rounding."""
    return F.expr(f"CAST((CAST({a} AS DECIMAL(20, 0)) * CAST({2 * SCALE} AS DECIMAL(8, 0))) DIV ({total}) AS BIGINT)")


def _sum(l: str, r: str) -> str:  # noqa: E741
    return f"CAST({l} AS DECIMAL(20, 0)) + CAST({r} AS DECIMAL(20, 0))"


def _scored(rows: DataFrame, cuts: Sequence[tuple[str, str]]) -> DataFrame:
    """Add score, l, r of the lowest-scoring cut (of equal ones the first), and the bound of all that begins with the row."""
    each = [F.struct(_share("a", _sum(l, r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]
    lowest = F.least(*each) if len(each) > 1 else each[0]
    return rows.withColumn("cut", lowest).select("*", "cut.score", "cut.l", "cut.r").drop("cut").withColumn("bound", _share("a", _sum("f1", "a")))


def _level(name: str, level: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with `name` at their language's level or above."""
    return rows.join(level, "lang").where(F.col(name) >= F.col("level")).drop("level")


def _levels(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, level): the highest bin border with at least `wanted` scores at or above it, 0 if there are not as many."""
    bins = pairs.groupBy("lang", F.floor(F.col("score") / BIN).alias("bin")).count()
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("bin")))
    return bins.withColumn("upto", upto).groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= wanted, F.col("bin") * BIN)), F.lit(0)).cast("long").alias("level")
    )


def _uncovered(rows: DataFrame, longer: DataFrame, n: int, least: int) -> DataFrame:
    """Rows (phrases of n words) that no phrase of n + 1 words, itself often enough, holds in COVERED_PERCENT of its places."""
    own, more = W[:n], longer.where(F.col("a") >= least)
    around = more.select(*own, F.col("a").alias("most")).unionByName(
        more.select(*(F.col(W[k + 1]).alias(W[k]) for k in range(n)), F.col("a").alias("most"))
    )
    most = around.groupBy(*own).agg(F.max("most").alias("most"))
    wide = lambda x: F.col(x).cast("decimal(20,0)")
    joined = rows.join(most, own, "left")
    return joined.where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * COVERED_PERCENT)).drop("most")


class Growth:
    """The counts that all levels share, and what is opened down to a level."""

    def __init__(self, docs: DataFrame, text: str, lang: str, least: int) -> None:
        self.docs, self.text, self.lang, self.least = docs, text, lang, least
        self.words = save(count_words(docs, text, lang))
        often = self.words.where(F.col("f") >= least).select("lang", "code", "f")
        heads = self._send(bitmap(often, ["code"]))

        def both(found: Words) -> Iterator[tuple[int, np.ndarray]]:
            known, at = heads.value.holds([found.codes]), found.grams(2)
            yield 2, at[known[at] & known[at + 1]]

        pairs = self._often(count_grams(docs, both, text, lang)).select("w1", "w2", "a")
        first = often.select("lang", F.col("code").alias("w1"), F.col("f").alias("f1"))
        last = often.select(F.col("code").alias("w2"), F.col("f").alias("f2"))
        self.pairs = save(_scored(pairs.join(first, "w1").join(last, "w2"), [("f1", "f2")]))
        self.all_pairs = self._send(bitmap(self.pairs, W[:2]))

    def _send(self, bits: Bitmap):
        return self.docs.sparkSession.sparkContext.broadcast(bits)

    def _often(self, counted: DataFrame) -> DataFrame:
        return counted.where(F.col("a") >= self.least)

    def opened(self, level: DataFrame) -> DataFrame:
        """Survivors at or above each language's level: lang, w1..w4, a, l, r, score."""
        open_pairs = _level("bound", level, self.pairs)
        pairs, all_pairs = self._send(bitmap(open_pairs, W[:2])), self.all_pairs

        def triples_of(found: Words) -> tuple[np.ndarray, np.ndarray]:
            """Places of three words whose pairs are both frequent, and whether one of these pairs is open."""
            at = found.grams(3)
            x, y, z = (found.codes[at + k] for k in range(3))
            frequent = all_pairs.value.holds([x, y]) & all_pairs.value.holds([y, z])
            at, x, y, z = at[frequent], x[frequent], y[frequent], z[frequent]
            return at, pairs.value.holds([x, y]) | pairs.value.holds([y, z])

        def three(found: Words) -> Iterator[tuple[int, np.ndarray]]:
            at, is_open = triples_of(found)
            yield 3, at[is_open]

        counted = save(self._often(count_grams(self.docs, three, self.text, self.lang)).select(*W[:3], "a"))
        triples = save(self._score_triples(counted))
        open_triples = _level("bound", level, triples)
        grown = self._send(bitmap(open_triples, W[:3]))
        # The rest of a phrase of four begins with the last two words of an open triple: those not counted yet are now.
        ends = self._send(bitmap(open_triples.select("w2", "w3").distinct(), W[1:3]))

        def four(found: Words) -> Iterator[tuple[int, np.ndarray]]:
            at, is_open = triples_of(found)
            late = at[~is_open]
            yield 3, late[ends.value.holds([found.codes[late], found.codes[late + 1]])]
            inside = np.zeros(len(found.codes) + 1, bool)
            inside[at[grown.value.holds([found.codes[at + k] for k in range(3)])]] = True
            frequent = np.zeros(len(found.codes) + 1, bool)
            frequent[at] = True
            at = found.grams(4)
            yield 4, at[frequent[at] & frequent[at + 1] & (inside[at] | inside[at + 1])]

        more = save(self._often(count_grams(self.docs, four, self.text, self.lang)))
        late = self._score_triples(more.where("w4 is null").select(*W[:3], "a"))
        triples = triples.unionByName(late)
        fours = self._score_fours(more.where("w4 is not null"), triples)
        best = [
            _uncovered(_level("score", level, self.pairs), counted.withColumn("w4", F.lit(None).cast("long")), 2, self.least),
            _uncovered(_level("score", level, triples), more.where("w4 is not null"), 3, self.least),
            _level("score", level, fours),
        ]
        same = lambda x: x.select("lang", *(F.col(w) if w in x.columns else F.lit(None).cast("long").alias(w) for w in W), "a", "l", "r", "score")
        return save(same(best[0]).unionByName(same(best[1])).unionByName(same(best[2])))

    def _score_triples(self, counted: DataFrame) -> DataFrame:
        front = self.pairs.select("w1", "w2", "lang", "f1", F.col("a").alias("a12"))
        back = self.pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"), F.col("f2").alias("f3"))
        joined = counted.join(front, ["w1", "w2"]).join(back, ["w2", "w3"])
        return _scored(joined, [("f1", "a23"), ("a12", "f3")])

    def _score_fours(self, counted: DataFrame, triples: DataFrame) -> DataFrame:
        """Phrases of four whose both triples are counted: those with another first triple score below the level."""
        front = triples.select("w1", "w2", "w3", "lang", "f1", "a12", F.col("a").alias("a123"))
        back = triples.select(
            F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("a").alias("a234"),
            F.col("a23").alias("a34"), F.col("f3").alias("f4"),
        )
        joined = counted.join(front, W[:3]).join(back, W[1:])
        return _scored(joined, [("f1", "a234"), ("a12", "a34"), ("a123", "f4")])


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", limit: int = LIMIT, least: int = LEAST, guess: int = 2
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `limit` surviving phrases of two to four words.

    By score, then a, both descending, then phrase in byte order. Null texts are empty, a null language counts as `und`;
    repeated rows count each time; other columns play no part. The levels start where `guess` times `limit`
    word pairs lie, which changes only how many passes it takes. A language without such phrases has no rows.
    """
    growth = Growth(docs, text, lang, least)
    wanted = guess * limit
    while True:
        level = save(_levels(growth.pairs, wanted))
        best = growth.opened(level)
        enough = best.groupBy("lang").agg(F.count("*").alias("found"))
        short = level.join(enough, "lang", "left").where((F.col("level") > 0) & (F.coalesce("found", F.lit(0)) < limit))
        if short.isEmpty():
            break
        wanted *= 4
    texts = growth.words.where(F.col("f") >= least).select("code", "word")
    named = best
    for w in W:
        named = named.join(texts.select(F.col("code").alias(w), F.col("word").alias(f"text_{w}")), w, "left")
    named = named.withColumn("phrase", F.concat_ws(" ", *(f"text_{w}" for w in W)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    totals = growth.words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first 2,000 collocations of each language; see collocations."""
    return collocations(docs)
