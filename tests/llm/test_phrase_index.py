"""The positional index against a search of every place, and decontamination against SQL-free brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from courtside.llm import phrase_index
from courtside.llm.phrase_index import build_index, indexed_rows, matches, op12_decontamination, windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
VOCABULARY = ["red", "green", "blue", "naïve", "x2", "Ünder", "fox", "the", "the", "the"]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def item_windows(text, size=10):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def expected(doc_id, text, items):
    own, hit, ids = words(text), set(), set()
    for item_id, item in items:
        for window in item_windows(item) if item_id is not None else ():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return (doc_id, len(own), len(hit), len(ids), digest, bool(hit))


def some_text(rng, n):
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", ", ", "-", "\n", "; "]) for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(12)
    items = [(i, some_text(rng, rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(30)]
    items += [(30, None), (31, "..."), (32, items[0][1]), (5, "fox fox fox"), (None, "red"), (100, "Zebra crossing here"), (2, some_text(rng, 200))]
    docs = [(i, some_text(rng, rng.randrange(60))) for i in range(60)]
    for i in range(60, 90):
        inside = rng.choice(items)[1] or ""
        docs.append((i, some_text(rng, 5) + " " + inside.upper() + " " + some_text(rng, 5)))
    docs += [(90, None), (91, ""), (92, "the " * 50), (93, "ZEBRA crossing-here"), (None, items[3][1]), (7, items[4][1]), (7, items[4][1])]
    docs += [(94, " ".join(x or "" for _, x in items) * 20)]
    return docs, items


@pytest.mark.parametrize("block", [phrase_index.BLOCK_WINDOWS, 40])
def test_query_equals_brute_force(spark, tables, monkeypatch, block):
    docs, items = tables
    monkeypatch.setattr(phrase_index.matches, "__defaults__", ("doc_id", 0, block))
    found = op12_decontamination(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted((expected(*d, items) for d in docs), key=key)


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_matches(spark, slop):
    rng = random.Random(slop)
    docs = [(i, some_text(rng, rng.randrange(80))) for i in range(40)]
    items = [(i, some_text(rng, rng.choice([2, 4, 6]))) for i in range(20)]
    counts = {}
    for _, text in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    wanted = set()
    for _, item in items:
        window = words(item)
        rarest = min(range(len(window)), key=lambda k: (counts.get(window[k], 0), k))
        for doc_id, text in docs:
            own = words(text)
            for p in (p for p, w in enumerate(own) if w == window[rarest]):
                start = p - rarest
                near = lambda k: any(own[q] == window[k] for q in range(max(0, start + k - slop), min(len(own), start + k + slop + 1)))
                if all(near(k) for k in range(len(window))):
                    wanted.add((doc_id, " ".join(window), start))
    index = build_index(spark.createDataFrame(docs, DOCS))
    phrases = windows(spark.createDataFrame(items, ITEMS))
    names = {r["window"]: " ".join(words(dict(items)[r["item_id"]])) for r in phrases.collect()}
    rows = matches(index, phrases, slop=slop).select("doc_id", "window", F.explode("at").alias("at")).collect()
    assert {(r["doc_id"], names[r["window"]], r["at"]) for r in rows} == wanted and len(rows) == len(wanted)


def test_a_match_stays_within_its_text(spark):
    index = build_index(spark.createDataFrame([(1, "a b c"), (2, "d e f")], DOCS).coalesce(1))
    phrases = windows(spark.createDataFrame([(1, "c d"), (2, "b c"), (3, "d e f")], ITEMS))
    assert sorted((r["doc_id"], r["size"], list(r["at"])) for r in matches(index, phrases).collect()) == [(1, 2, [1]), (2, 3, [0])]
    assert sorted(tuple(r)[1:] for r in indexed_rows(index).collect()) == [(1, 3), (2, 3)]


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "a b", "r", 5, "w")], "doc_id long, text string, row string, n_words int, window string")
    items = spark.createDataFrame([("k", "a b", 1)], "item_id string, text string, terms int")
    assert op12_decontamination(none[0], items).count() == 0
    row = op12_decontamination(one, none[1]).first()
    assert (row["doc_id"], row["n_words"], row["n_hit"], row["contaminated"]) == (1, 2, 0, False)
    assert op12_decontamination(one, items).first()["items_sha256"] == hashlib.sha256(b"k").hexdigest()


def test_very_long_text(spark):
    text = "word " * 400_000 + "needle in the hay " + "word " * 10
    found = op12_decontamination(spark.createDataFrame([(1, text)], DOCS), spark.createDataFrame([(1, "Needle in the hay")], ITEMS)).first()
    assert (found["n_words"], found["n_hit"]) == (400_014, 4)
