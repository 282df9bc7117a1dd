"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from courtside.llm.periodic_runs import op11_periodic_runs, periodic_runs, runs, strongest

DOCS = "doc_id long, text string"


def every_run(words, least=24, times=3):
    """All maximal stretches of each period, smallest periods first; a longer period of the same stretch is none."""
    found, n = [], len(words)
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            stretch = words[start : start + length]
            if end > start and length >= max(least, times * q) and not any(
                all(stretch[k] == stretch[k + p] for k in range(length - p)) for p in range(1, q)
            ):
                found.append((start, length, q))
            start = end + 1
    return sorted(found, key=lambda x: (x[0], x[2]))


def as_codes(texts):
    numbers = {}
    codes = np.array([numbers.setdefault(w, len(numbers) + 1) for t in texts for w in t], np.uint64)
    return codes * np.uint64(0x9E3779B97F4A7C15), np.cumsum([0, *map(len, texts)])


def some_words(rng):
    """Random words with periodic stretches, stretches within stretches, and small alphabets."""
    words = [rng.choice("abc") for _ in range(rng.randrange(40))]
    for _ in range(rng.randrange(4)):
        block = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 30))]
        words += (block * rng.randint(1, 12))[: rng.randint(1, 200)] + [rng.choice("xyz")] * rng.randint(0, 30)
        if rng.random() < 0.3:
            words = words * rng.randint(1, 4)
    return words[:600]


def test_runs_equal_a_search_of_every_period():
    rng = random.Random(11)
    for _ in range(25):
        texts = [some_words(rng) for _ in range(6)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("abcdefgh") * 3, list("abcdefghi") * 3]
        found = runs(*as_codes(texts))
        assert {t: every_run(w) for t, w in enumerate(texts) if every_run(w)} == found


def test_fibonacci_words_have_nested_runs():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    for word in (list(b), list(b[::-1]), list("ab" * 200 + "ba" * 200)):
        assert runs(*as_codes([word])).get(0, []) == every_run(word)


def test_a_very_long_text_of_one_word():
    n = 300_000
    assert runs(np.ones(n, np.uint64), np.array([0, n])) == {0: [(0, n, 1)]}


def test_strongest_breaks_ties_exactly():
    assert strongest([]) is None
    assert strongest([(9, 30, 10), (2, 24, 8), (2, 27, 9)]) == (2, 24, 8)
    assert strongest([(0, 3 * 10**15 + 1, 10**15), (5, 30, 10)]) == (0, 3 * 10**15 + 1, 10**15)


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = every_run(words)
    best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda x: hashlib.sha256(x).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found).encode()
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], digest(listed), digest(kept))


def test_query_equals_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(some_words(rng)) for _ in range(60)]
    texts += [None, "", " \t\n", "w", "a b " * 30, "é\x0bz\r" * 40, "x " * 2000, "long " * 10 + "word" * 5000 + " x" * 30]
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][: len(texts)]
    rows = [*enumerate(texts), *zip(planted, reversed(texts)), (None, "b " * 30), (7, "same " * 30), (7, "same " * 30)]
    found = [tuple(r) for r in op11_periodic_runs(spark.createDataFrame(rows, DOCS)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=key) == sorted((expected(*r) for r in rows), key=key)


def test_clashing_columns_and_empty_tables(spark):
    rows = spark.createDataFrame([("k", "a b " * 20, 5, "runs", "r")], "id string, text string, start long, runs string, collapsed string")
    row = periodic_runs(rows).first()
    assert (row["id"], row["start"], row["collapsed"]) == ("k", 5, "a b") and tuple(row["runs"][0]) == (0, 40, 2)
    assert op11_periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("text", ["text", "body"])
def test_any_text_column(spark, text):
    rows = spark.createDataFrame([("z " * 24,)], f"{text} string")
    assert tuple(periodic_runs(rows, text).first()["strongest"]) == (0, 24, 1)
