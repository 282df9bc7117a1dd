"""The pipeline's stages on a small table."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_text import docs, edited, prose, sentence

from courtside.llm import queries


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(21)
    base = [prose(rng, 14) for _ in range(8)]
    passage = " ".join(sentence(rng) for _ in range(8))
    near = [edited(rng, base[0], 0.005), base[1] + " " + sentence(rng)]
    texts = [*base, *near, base[2], f"{prose(rng, 5)} {passage} {prose(rng, 3)}", f"{prose(rng, 6)} {passage} {prose(rng, 2)}", None, "", "12 34"]
    folder = tmp_path_factory.mktemp("tables")
    rows = docs(spark, texts).withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang")))
    clashing = ["score", "removed", "n_sentences", "n_lines", "line", "component", "kind"]
    rows.select("*", *[F.lit(f"own {c}").alias(c) for c in clashing]).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_stages(spark, table):
    left = spark.read.parquet(f"{table}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, table)
        if name != "packing":
            assert out.dtypes == left.dtypes
        path = f"{table}/{name}"
        out.write.parquet(path)
        left = spark.read.parquet(path)
        kept.append({r.doc_id for r in left.select("doc_id").collect()})
    assert kept[0] == {*range(13)}  # what has no letters goes
    assert 10 not in kept[1] and {*range(8), 11, 12} <= kept[2]
    assert not {8, 9} & kept[2] or kept[2] <= kept[1]
    assert kept[4] == kept[3]
    cut = {r.doc_id: r for r in spark.read.parquet(f"{table}/span_dedup").collect()}
    assert all(r.n_chars == len(r.text) and r.score == "own score" and r.removed == "own removed" for r in cut.values())
    assert len(cut[12].text) < len(cut[11].text)


def test_near_copies_once(spark):
    rng = random.Random(22)
    base = prose(rng, 20)
    rows = docs(spark, [base, edited(rng, base, 0.004), prose(rng, 5), None, ""])
    rows = rows.unionByName(rows.where("doc_id = 2")).unionByName(rows.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    found = [r.doc_id for r in corpus_pipeline.near_copies(spark, rows, "").collect()]
    assert sorted(found, key=str) == sorted([0, 2, 3, 4, None], key=str)


def test_run_and_registry(spark, table):
    pieces = corpus_pipeline.run(spark, table)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert pieces.count() > 0
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_empty_table(spark):
    left = docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, "")
        assert left.count() == 0
