"""Collocations against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import collocations as c

DOCS = "doc_id long, text string, lang string"
LOWER = str.maketrans({chr(x): chr(x + 32) for x in range(65, 91)})


def expected(docs, limit, least):
    counts, total = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    often = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    covered = set()
    for (lang, *words), a in often.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inner = (lang, *words[i : i + n])
                if 100 * a >= 80 * often[inner]:
                    covered.add(inner)
    rows = {}
    for phrase, a in often.items():
        if phrase not in covered:
            lang, words = phrase[0], phrase[1:]
            cuts = [(counts[(lang, *words[:k])], counts[(lang, *words[k:])]) for k in range(1, len(words))]
            score, k = min((2_000_000 * a // (l + r), k) for k, (l, r) in enumerate(cuts))
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), *cuts[k]))
    found = []
    for lang, some in rows.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(some)[:limit], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(found)


def some_docs(rng, n=120):
    names = ["New York City Hall", "ad hoc", "Rio de la Plata", "état-major général", "x y", "La la la la la"]
    common = "the a of and river stone light Garden winter morning".split()
    docs = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, "und", "zz"])
        parts = []
        for _ in range(rng.randrange(60)):
            parts.append(rng.choice(names) if rng.random() < 0.2 else rng.choice(common))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "! "]))
        docs.append((i, "".join(parts), lang))
    return docs + [(n, None, "en"), (n, "", None), (n + 1, "...", "xx"), (None, "new york city hall", "en")]


@pytest.mark.parametrize(("limit", "least", "guess"), [(2000, 3, 2), (5, 3, 2), (12, 2, 1), (1, 4, 1), (40, 2, 1)])
def test_equal_to_counting_every_phrase(spark, limit, least, guess):
    docs = some_docs(random.Random(limit + least))
    found = c.collocations(spark.createDataFrame(docs, DOCS).repartition(3), limit=limit, least=least, guess=guess)
    assert sorted(tuple(r) for r in found.collect()) == expected(docs, limit, least)


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    docs = some_docs(random.Random(77), 60)
    monkeypatch.setattr(c.bitmap, "__defaults__", (6,))
    found = c.collocations(spark.createDataFrame(docs, DOCS), limit=10, least=2, guess=1)
    assert sorted(tuple(r) for r in found.collect()) == expected(docs, 10, 2)


def test_levels_leave_prefixes_closed(spark):
    """With a small limit fewer triples are counted than with all prefixes open."""
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in some_docs(random.Random(3), 200)], DOCS)
    growth = c.Growth(docs, "text", "lang", 2)
    levels = c._levels(growth.pairs, 10)
    assert 0 < levels.first()["level"] < c.SCALE
    opened = c._level("bound", levels, growth.pairs).count()
    assert 10 <= opened < growth.pairs.count()


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(9 * 10**15, 9 * 10**15 + 1, 9 * 10**15), (1, 3, 4)], "a long, f1 long, f2 long")
    scored = c._scored(rows, [("f1", "f2")]).orderBy("f2").collect()
    assert [r["score"] for r in scored] == [2_000_000 // 7, 2_000_000 * 9 * 10**15 // (18 * 10**15 + 1)]
    assert scored[1]["bound"] == 2_000_000 * 9 * 10**15 // (18 * 10**15 + 1)


def test_ties_go_by_cut_and_bytes(spark):
    docs = [(i, "b a. é z. a b c.", "en") for i in range(30)]
    found = c.op13_collocations(spark.createDataFrame(docs, DOCS)).collect()
    assert [tuple(r) for r in sorted(found, key=lambda r: r["rank"])] == [tuple(r) for r in expected(docs, 2000, 30)]


def test_empty_tables_and_other_columns(spark):
    assert c.op13_collocations(spark.createDataFrame([], DOCS)).count() == 0
    rows = spark.createDataFrame([("a b " * 5, "en", 1, "x")], "text string, lang string, score int, phrase string")
    found = c.collocations(rows, least=4).collect()
    assert [tuple(r) for r in found] == expected([(0, "a b " * 5, "en")], 2000, 4)


def test_bitmap_holds_what_it_is_made_of(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("w1"), F.xxhash64("id", "id").alias("w2"))
    bits = c.bitmap(rows, ["w1", "w2"])
    table = rows.toArrow()
    columns = [table.column(k).to_numpy().view(np.uint64) for k in range(2)]
    assert bits.holds(columns).all() and bits.holds(columns[::-1]).mean() < 0.2
