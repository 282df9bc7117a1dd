"""What a task holds at once: Arrow batches, links of the component step."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from courtside.llm import common, ngram_join


def test_the_ngram_join_bounds_arrow_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, left in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (200, 200)):
            spark.conf.set(name, given)
            docs = spark.createDataFrame([(1, "one two three"), (2, "one two three"), (3, None)], "doc_id long, text string")
            found = {r.doc_id: r.component_id for r in ngram_join.op5_ngram_join(docs).collect()}
            assert found == {1: 1, 2: 1, 3: 3} and int(spark.conf.get(name)) == left
    finally:
        spark.conf.set(name, before)


def test_links_are_left_out_across_batches(monkeypatch):
    links = [(a, a - 1) for a in range(1, 60)] + [(a, 0) for a in range(1, 60)]
    batches = [pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b])], ["u", "v"]) for a, b in links]
    for most, rows in ((1 << 14, 59), (8, None)):
        monkeypatch.setattr(common, "FOREST_NODES", most)
        out = [pair for x in common._forest(iter(batches)) for pair in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]
        top = list(range(60))
        for _ in out:
            for u, v in out:
                top[u] = min(top[u], top[v])
        assert top == [0] * 60 and (rows is None or len(out) == rows)


@pytest.mark.parametrize("tasks", (5, 20))
def test_links_of_a_group_come_once_from_all_tasks(spark, monkeypatch, tasks):
    """A group of 40 nodes whose links repeat in every task, as those of near copies do with every n-gram they share."""
    forest, made = common._forest, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in forest(batches):
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(common, "_forest", counted)
    repeated = spark.range(0, 40 * tasks, 1, tasks).select((F.col("id") % 40 + 1).alias("a"), F.lit(0).cast("long").alias("b"))
    found = {r.node: r.component for r in common.components(repeated).collect()}
    assert found == dict.fromkeys(range(41), 0) and made.value == 40


def test_links_of_few_nodes_are_left_out_together(spark, monkeypatch):
    """Distinct links of 40 nodes to 20 others, dealt over tasks that know nothing of each other."""
    forest, made = common._forest, spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in forest(batches):
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(common, "_forest", counted)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        links = spark.range(0, 800, 1, 8).select((F.col("id") % 40 + 20).alias("a"), F.floor(F.col("id") / 40).alias("b"))
        found = {r.node: r.component for r in common.components(links).collect()}
    finally:
        spark.conf.set(name, before)
    assert found == dict.fromkeys(range(60), 0) and made.value == 59
