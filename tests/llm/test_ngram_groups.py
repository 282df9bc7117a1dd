"""Which sets of the n-gram join meet in a task, and that no link is lost by it."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtside.llm import ngram_join


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(n)]


def sets(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def lowest(texts, keys):
    """The smallest key that each one reaches by links of all pairs; rows of one key are one node."""
    found, reach = [sets(x) for x in texts], {k: k for k in keys}
    links = [(keys[a], keys[b]) for a, x in enumerate(found) for b, y in enumerate(found[:a]) if x and 100 * len(x & y) >= 75 * len(x | y)]
    while True:
        before = dict(reach)
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
        if reach == before:
            return reach


def run(spark, monkeypatch, texts, keys=None, step=ngram_join.op5_ngram_join, value="component_id"):
    """That value of each key, and how many sets were given to tasks that compare them."""
    joined, met = ngram_join._join_unit, spark.sparkContext.accumulator(0)

    def counted(table):
        met.add(table.num_rows)
        return joined(table)

    monkeypatch.setattr(ngram_join, "_join_unit", counted)
    keys = list(range(len(texts))) if keys is None else keys
    rows = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string").repartition(3)
    found = step(rows).select("doc_id", value).collect()
    monkeypatch.setattr(ngram_join, "_join_unit", joined)
    return dict(map(tuple, found)), met.value


def chain(rng):
    """Each shares a passage with the next one."""
    passages = [words(rng, 20) for _ in range(41)]
    return [" ".join([*a, *words(rng, 200), *b]) for a, b in zip(passages, passages[1:])]


def patchwork(rng):
    """All of each one is passages of ten others."""
    between = {(a, b): words(rng, 24) for a in range(20) for b in range(a) if (a - b) % 20 in (1, 3, 5, 7, 9, 11, 13, 15, 17, 19)}
    return [" ".join(w for pair, x in between.items() if k in pair for w in x) for k in range(20)]


def passage(rng):
    """One passage stands in all."""
    common = words(rng, 30)
    return [" ".join([*words(rng, 100), *common, *words(rng, 100)]) for _ in range(40)]


@pytest.mark.parametrize("made", (chain, patchwork, passage))
def test_sets_that_share_a_little_with_many_meet_none(spark, monkeypatch, made):
    texts = made(random.Random(5))
    found, met = run(spark, monkeypatch, texts)
    assert found == {k: k for k in range(len(texts))} and met == 0


def test_sets_that_share_a_little_stay_in_the_pipeline(spark, monkeypatch):
    texts = chain(random.Random(8))
    near_copies = lambda rows: corpus_pipeline.near_copies(spark, rows, "")
    assert run(spark, monkeypatch, [*texts, texts[3] + " more"], step=near_copies, value="text") == (dict(enumerate(texts)), 2)


def test_copies_of_a_table_make_nothing_meet(spark, monkeypatch):
    """Each row comes again with another key, and again as it is."""
    rng = random.Random(6)
    texts = [" ".join(words(rng, 80)) for _ in range(20)]
    found, met = run(spark, monkeypatch, texts * 4, [*range(60), *range(20)])
    assert found == {k: k % 20 for k in range(60)} and met == 0


@pytest.mark.parametrize("paired", (1, 3, 8))
def test_no_link_is_lost(spark, monkeypatch, paired):
    """Near copies in groups below and above the number of holders that make pairs, of one n-gram and of hundreds."""
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    rng = random.Random(paired)
    common, texts = words(rng, 40), [None, "", "one", "ONE", "two words", "a b c d e", "a b c d e f"]
    for size in (2, 2, 3, 4, 5, 9, 14, 30):
        for length in (9, 40, 300):
            base = [*words(rng, length), *common[: length // 4]]
            for _ in range(size):
                copy = list(base)
                for _ in range(rng.randrange(1 + length // 60)):
                    copy[rng.randrange(len(copy))] = rng.choice(common)
                texts.append(" ".join(copy[: len(copy) - rng.randrange(1 + length // 8)]))
    keys = rng.sample(range(10**6), len(texts))
    found, _ = run(spark, monkeypatch, texts, keys)
    assert found == lowest(texts, keys)


def test_sets_of_one_key_are_one_node(spark, monkeypatch):
    """A key with a short and a long text links with the copies of both."""
    rng = random.Random(9)
    short, long = words(rng, 12), words(rng, 300)
    texts = [" ".join(x) for x in (short, long, [*short, "more"], [*long, "more"], words(rng, 50))]
    found, _ = run(spark, monkeypatch, texts, [1, 1, 5, 6, 7])
    assert found == {1: 1, 5: 1, 6: 1, 7: 7}
    rows = spark.createDataFrame([(None, texts[0]), (None, "x y"), (3, texts[0])], "doc_id int, text string")
    other = ngram_join.op5_ngram_join(rows).orderBy("component_id").select("doc_id", F.col("component_id")).collect()
    assert sorted(map(tuple, other), key=str) == [(3, 3), (None, 3), (None, None)]
