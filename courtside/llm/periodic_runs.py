"""Periodic runs of words, found by uniting suffix classes in the order of falling longest common prefixes.

A run is a stretch of words with smallest period q, at least MIN_LENGTH words and MIN_TIMES periods long, that can't
be extended to either side. The suffixes of a text are sorted, and neighbours in that order are united from the
longest common prefix (LCP) down, as Kruskal's algorithm unites edges. Each class keeps its positions in order. When
two classes meet at level l, positions i < j of different classes that become neighbours within their class repeat
words i..i+l at distance j - i: if that is at most l, they lie in a stretch of l + j - i words with this period.
The start s of a run of length L and its s + q have the LCP L - q and become neighbours just then: a position between
them in their class would give the run a shorter period. So every run has exactly one seed, the one whose stretch
cannot be extended to the left, and the levels below MIN_LENGTH - MIN_LENGTH / MIN_TIMES hold none.
"""

from __future__ import annotations

import zlib
from bisect import bisect
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from courtside.llm.common import RangeHashes, hashed_words, mix, passes, slices, utf8, word_spans

MIN_LENGTH = 24
MIN_TIMES = 3
#: No run has its seed below this level: L - q is least where L is MIN_LENGTH and q as long as it may be.
MIN_LCP = MIN_LENGTH - MIN_LENGTH // MIN_TIMES

Run = tuple[int, int, int]


def suffix_order(codes: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions sorted by text, then by the rest of their text; a text's end comes before any word.

    Ranks by 1, 2, 4, ... words; only positions that still share a rank are sorted again.
    """
    n = len(codes)
    order = np.lexsort((codes, owner))
    fresh = np.ones(n, bool)
    fresh[1:] = (codes[order[1:]] != codes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    width = 1
    while len(slots := np.flatnonzero(~(fresh & np.append(fresh[1:], True)))):
        members = order[slots]
        after = members + width
        second = np.where(after < ends[owner[members]], rank[np.minimum(after, n - 1)], 0)
        by = np.lexsort((second, rank[members]))
        members, second = members[by], second[by]
        first = rank[members]
        cut = np.ones(len(slots), bool)
        cut[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        order[slots], fresh[slots] = members, cut
        rank[members] = np.maximum.accumulate(np.where(cut, slots, 0)) + 1
        width *= 2
    return order


def common_prefixes(hashes: RangeHashes, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words from i and j on are the same, at most limit."""
    found = np.zeros(len(i), np.int64)
    step = 1 << int(limit.max(initial=0)).bit_length()
    while step:
        at = np.flatnonzero(found + step <= limit)
        a, b = i[at] + found[at], j[at] + found[at]
        found[at[hashes.of(a, a + step) == hashes.of(b, b + step)]] += step
        step >>= 1
    return found


def united(order: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Unite neighbours order[t], order[t + 1] by falling lcp[t]; (i, j, level) that become neighbours, 2 (j - i) <= level.

    A run is at least three periods long, so its seed's distance is at most half the level.
    """
    levels = np.flatnonzero(lcp >= MIN_LCP)
    levels = levels[np.argsort(-lcp[levels], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    positions = order.tolist()

    def root(x: int) -> int:
        if x not in parent:
            parent[x], members[x] = x, [positions[x]]
            return x
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for t, level in zip(levels.tolist(), lcp[levels].tolist()):
        a, b = root(t), root(t + 1)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        places = [bisect(large, x) for x in small]
        for k, (x, place) in enumerate(zip(small, places)):
            if place and (k == 0 or places[k - 1] != place) and 2 * (x - large[place - 1]) <= level:
                yield large[place - 1], x, level
            if place < len(large) and (k + 1 == len(small) or places[k + 1] != place) and 2 * (large[place] - x) <= level:
                yield x, large[place], level
        if 8 * len(small) < len(large):
            for x, place in zip(reversed(small), reversed(places)):
                large.insert(place, x)
        else:
            large += small
            large.sort()


def runs(codes: np.ndarray, limits: np.ndarray) -> dict[int, list[Run]]:
    """Runs (start, length, period) of each text that has any, by start, then period.

    The words of text t are codes[limits[t]:limits[t + 1]].
    """
    n, owner = len(codes), np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    # A run repeats its first MIN_LCP words, so texts that repeat no such stretch have none.
    at = np.flatnonzero(limits[1:][owner] - np.arange(n) >= MIN_LCP)
    keys = RangeHashes(codes).of(at, at + MIN_LCP) ^ mix(owner[at].astype(np.uint64) + np.uint64(1))
    by = np.argsort(keys, kind="stable")
    again = np.unique(owner[at[by[1:][keys[by[1:]] == keys[by[:-1]]]]])
    if not len(again):
        return {}
    where = np.concatenate([np.arange(limits[t], limits[t + 1]) for t in again])
    codes, sizes = codes[where], np.diff(limits)[again]
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(again)), sizes)
    order = suffix_order(codes, owner, ends)
    i, j = order[:-1], order[1:]
    room = np.where(owner[i] == owner[j], np.minimum(ends[owner[i]] - i, ends[owner[j]] - j), 0)
    lcp = common_prefixes(RangeHashes(codes), i, j, room)
    found: dict[int, list[Run]] = {}
    begins = ends - sizes
    for i, j, level in united(order, lcp):
        first = begins[owner[i]]
        if level + j - i >= MIN_LENGTH and (i == first or codes[i - 1] != codes[j - 1]):
            found.setdefault(int(again[owner[i]]), []).append((int(i - first), level + j - i, j - i))
    return {t: sorted(some, key=lambda x: (x[0], x[2])) for t, some in found.items()}


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words joined by one space, without those that lie in a run after its first period."""
    if not found:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)])


def strongest(found: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    return max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if found else None


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add runs array<struct<start, length, period>> by start and period, strongest (one of them) and collapsed (text).

    Words are [^\\x20\\x09-\\x0D]+, numbered from 0. A null or empty text has no words: no runs, strongest null,
    collapsed empty. Every row stands alone, so repeated rows, rows with a null key and rows that share one get equal
    results for equal texts. A text is worked on whole in one task, in memory of about 150 bytes a word; columns
    of the three names are replaced, all others stay.
    """
    rest = [c for c in docs.columns if c not in ("runs", "strongest", "collapsed")]
    schema = T.StructType(docs.select(rest).schema.fields)
    schema = schema.add("runs", T.ArrayType(RUN)).add("strongest", RUN).add("collapsed", T.StringType())
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = utf8(batch.column(at))
            all_runs: list[list[Run]] = []
            for a, b in passes(texts):
                data, starts, ends, first = word_spans(texts[a:b])
                found = runs(hashed_words(data, starts, ends, False), first)
                all_runs += [found.get(t, []) for t in range(b - a)]
            rows = [[dict(zip(RUN.names, x)) for x in found] for found in all_runs]
            best = [x and dict(zip(RUN.names, x)) for x in map(strongest, all_runs)]
            left = [collapsed(x.split(), found).decode() for x, found in zip(texts, all_runs)]
            added = [pa.array(rows, pa.list_(_ARROW_RUN)), pa.array(best, _ARROW_RUN), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return docs.select(rest).mapInArrow(run, schema)


def _with_tail(key: int | None, text: bytes) -> bytes:
    words = text.split()
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not words:
        return text
    g = h // 10
    a = g % len(words)
    period = 1 + (len(words) - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + k % period] for k in range(len(words) - a)])


def with_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the hash of doc_id, repeat a stretch up to their end.

    A document with a null doc_id stays as it is; a null text becomes empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = map(_with_tail, batch.column(0).to_pylist(), utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.decode() for x in texts], pa.string())], ["doc_id", "text"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, rows.schema)


def op11_periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, digests of all runs and of the collapsed text; see periodic_runs."""
    found = periodic_runs(with_tails(docs))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
