import datetime as dt
import random
import re
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from courtside.operators.keyed import newest_per_key
from courtside.operators.timeline import Timeline, current_run, trailing_mean

SCHEMA = "team string, day date, id string, win bigint, pts bigint"


def make_rows(sizes, seed=7, flip=0.5):
    """Rows of teams of the given sizes; several rows share a day, ids decide the order there."""
    rng = random.Random(seed)
    rows = []
    for team, size in sizes.items():
        win = 0
        for i in range(size):
            win = 1 - win if rng.random() < flip else win
            day = dt.date(2020, 1, 1) + dt.timedelta(days=i // 3)
            rows.append((team, day, f"{i:06d}", win, rng.randrange(200)))
    rng.shuffle(rows)
    return rows


def brute(rows, reach):
    """All values per (team, id), one team and one row at a time."""
    out = {}
    for team in {r[0] for r in rows}:
        history = sorted((r for r in rows if r[0] == team), key=lambda r: (r[1], r[2]))
        length = 0
        for i, row in enumerate(history):
            length = length + 1 if i and history[i - 1][3] == row[3] else 1
            window = [r[4] for r in history[max(0, i - reach + 1): i + 1]]
            out[(team, row[2])] = (
                sum(r[3] for r in history[: i + 1]), max(r[4] for r in history[: i + 1]), len(history),
                history[i - 1][4] if i else None, length,
                int(sum(window) / len(window) * 10 + 0.5) / 10,
            )
    return out


def computed(df, span_days, reach, at_once=False):
    timeline = replace(Timeline.of(df, ["team"], ["day", "id"]), span_days=span_days)
    running = {"wins": ("sum", F.col("win")), "best": ("max", F.col("pts"))}
    whole = {"games": ("sum", F.lit(1).cast("bigint"))}
    previous, mean = {"previous": lambda w: F.lag("pts").over(w)}, {"mean": trailing_mean("pts", reach, 1)}
    if at_once:
        full = timeline.scan(running, whole, {"length": "win"}, max(1, reach - 1), {**previous, **mean}, reads=["pts"])
    else:
        full = (
            timeline.with_running(running, whole)
            .with_windows(1, previous)
            .with_runs("win", "length")
            .with_windows(reach - 1, mean)
        )
    names = ["wins", "best", "games", "previous", "length", "mean"]
    result = {(r.team, r.id): tuple(r[n] for n in names) for r in full.rows.collect()}
    return timeline, result


@pytest.mark.parametrize("at_once", [True, False])
@pytest.mark.parametrize("span_days", [10_000, 13, 2, 1])
@pytest.mark.parametrize("flip", [0.5, 0.02])
def test_equal_to_brute_force(spark, span_days, flip, at_once):
    rows = make_rows({"A": 400, "B": 60, "C": 5, "D": 1}, flip=flip)
    _, result = computed(spark.createDataFrame(rows, SCHEMA), span_days, 10, at_once)
    assert result == brute(rows, 10)


def test_gaps_longer_than_a_span(spark):
    rng = random.Random(4)
    days = sorted(rng.sample(range(3000), 60))
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=d), f"{i:04d}", rng.randrange(2), rng.randrange(9)) for i, d in enumerate(days)]
    _, result = computed(spark.createDataFrame(rows, SCHEMA), 7, 6, at_once=True)
    assert result == brute(rows, 6)


def test_one_team_holds_most_rows(spark):
    rows = make_rows({"hot": 3000, **{f"t{i}": 20 for i in range(20)}}, flip=0.1)
    _, result = computed(spark.createDataFrame(rows, SCHEMA), 32, 5, at_once=True)
    assert result == brute(rows, 5)


def test_no_window_holds_an_entity_and_no_row_is_joined(spark):
    """Windows over rows are within a segment; only the rows that sum up segments are ordered by entity."""
    df = spark.createDataFrame(make_rows({"A": 50}), SCHEMA)
    timeline = Timeline.of(df, ["team"], ["day", "id"]).scan(
        {"wins": ("sum", F.col("win"))}, {"games": ("sum", F.lit(1))}, {"length": "win"}, 4, {"mean": trailing_mean("pts", 5, 1)}
    )
    plan = timeline.rows._jdf.queryExecution().optimizedPlan().toString()
    groups = re.findall(r"Window \[.*\], \[([^\]]*)\]", plan)
    alone = [g for g in groups if re.fullmatch(r"team#\d+", g)]
    lines = plan.split("\n")
    below = [lines[i + 1] for i, line in enumerate(lines) if re.search(r"Window .*\], \[team#\d+\]", line)]
    assert "Join" not in plan and 0 < len(alone) < len(groups)
    assert all("Aggregate [team" in line or "Project" in line or "Window" in line for line in below)


def test_nothing_runs_while_models_are_built(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    Timeline.of(spark.createDataFrame(make_rows({"A": 30}), SCHEMA), ["team"], ["day", "id"]).with_runs("win", "n")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_reach_longer_than_a_segment(spark):
    rows = make_rows({"A": 100})
    _, result = computed(spark.createDataFrame(rows, SCHEMA), 1, reach=10)
    assert result == brute(rows, 10)


def test_empty_input(spark):
    timeline, result = computed(spark.createDataFrame([], SCHEMA), 10, reach=3)
    assert result == {}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(flags=st.lists(st.integers(0, 1), min_size=1, max_size=40))
def test_run_properties(spark, flags):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), str(i), w, 0) for i, w in enumerate(flags)]
    timeline = Timeline.of(spark.createDataFrame(rows, SCHEMA), ["team"], ["day", "id"])
    lengths = [r.n for r in sorted(timeline.with_runs("win", "n").rows.collect(), key=lambda r: r.day)]
    changes = sum(a != b for a, b in zip(flags, flags[1:]))
    assert lengths.count(1) == changes + 1
    assert all(b in (1, a + 1) for a, b in zip(lengths, lengths[1:]))


@pytest.mark.parametrize("flip", [0.5, 0.0, 0.05])
def test_current_run(spark, flip):
    rows = make_rows({"A": 90, "B": 1, "C": 31}, flip=flip)
    result = {
        r.team: (r.win, r.n)
        for r in current_run(spark.createDataFrame(rows, SCHEMA), "team", ["day", "id"], "win", "n").collect()
    }
    values = brute(rows, 1)
    for team in "ABC":
        last = max((r for r in rows if r[0] == team), key=lambda r: (r[1], r[2]))
        assert result[team] == (last[3], values[(team, last[2])][4])


def test_newest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame(make_rows({"A": 50, "B": 2}), SCHEMA).repartition(4)
    newest = newest_per_key(df, ["team"], [F.col("day").desc(), F.col("id").desc()])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {(r.team, r.id) for r in newest.collect()} == {("A", "000049"), ("B", "000001")}
    kept = newest_per_key(df, ["team"], [F.col("day").desc(), F.col("id").desc()], keep=3)
    assert kept.count() == 5 and "recency" in kept.columns
