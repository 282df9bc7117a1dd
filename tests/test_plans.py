"""Shapes of the physical plans."""

import re

import pytest

import __spark_entry__ as registry
from courtside.sources.readers import read_league

FOLDER = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_session(spark):
    """No broadcast by size, as for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


HEAVY = [
    "game_scores", "team_record", "team_streaks", "team_rolling_averages", "team_performance_by_pace",
    "team_referee_record", "rest_days", "travel", "player_streaks", "player_summary", "referee_summary",
    "team_summary", "game_card", "returning_players", "crew_averages", "preview_signals",
]


@pytest.mark.parametrize("name", HEAVY)
def test_no_python_and_no_pair_products(large_session, name):
    plan = plan_of(registry.queries()[name](large_session, FOLDER))
    assert "Python" not in plan and "CartesianProduct" not in plan
    # The only nested loops are with one-row aggregates, which stay broadcast by hint.
    for line in re.findall(r"BroadcastNestedLoopJoin.*", plan):
        assert "Cross" in line or "Inner" in line
    # One task sees whole-table results only as partial aggregates without keys.
    below = re.findall(r"Exchange SinglePartition.*\n\W*(\w+\(keys=\[\])?", plan)
    assert all(below)


def test_large_lookups_are_shuffled(large_session):
    plan = plan_of(registry.queries()["game_card"](large_session, FOLDER))
    assert plan.count("SortMergeJoin") >= 8
    # The current season is one row and is broadcast at any size.
    assert all("current_season" in line for line in re.findall(r"BroadcastHashJoin.*", plan))


def test_segments_spread_one_entity(large_session):
    plan = plan_of(registry.queries()["team_record"](large_session, FOLDER))
    assert re.search(r"hashpartitioning\(team_id#\d+, _segment#\d+", plan)


def test_box_scores_are_scanned_once(spark):
    league = registry.league(spark, FOLDER)
    scans = re.findall(r"FileScan parquet.*lineitem", plan_of(league.boxes))
    joined = len(re.findall(r"FileScan parquet.*lineitem", plan_of(league.stg("team_game_stats"))))
    assert len(scans) == joined


def test_a_given_season_reaches_the_scan(spark, tmp_path):
    raw = registry.SuppliedTables(spark, "/root/testdata/sf0.001").raw()
    raw["games"].write.partitionBy("season").parquet(f"{tmp_path}/games")
    raw["team_game_stats"].write.parquet(f"{tmp_path}/team_game_stats")
    league = registry.League(read_league(spark, str(tmp_path)), season=2000)
    plan = plan_of(registry.card.season_pairs(league.boxes, league.season_now))
    assert re.search(r"FileScan parquet.*PartitionFilters: \[isnotnull\(season", plan)


def test_the_newest_season_prunes_folders_at_run_time(spark, tmp_path):
    raw = registry.SuppliedTables(spark, "/root/testdata/sf0.001").raw()
    raw["games"].write.partitionBy("season").parquet(f"{tmp_path}/games")
    raw["team_game_stats"].write.parquet(f"{tmp_path}/team_game_stats")
    league = registry.League(read_league(spark, str(tmp_path)))
    pairs = registry.card.season_pairs(league.boxes, league.season_now)
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan_of(pairs)
    whole = registry.card.season_pairs(registry.League(raw).boxes, registry.League(raw).season_now)
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, whole.collect()))


def test_only_needed_columns_are_read(spark):
    plan = plan_of(registry.queries()["head_to_head"](spark, FOLDER))
    assert "l_tax" not in plan and "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_the_card_reads_what_it_shares_once(spark, tmp_path):
    """Box scores, results and quarters are read for the written games alone, and the season is a literal."""
    raw = registry.SuppliedTables(spark, "/root/testdata/sf0.001").raw()
    league = registry.League(raw, work_folder=str(tmp_path))
    plan = plan_of(league.game_card())
    assert league.season_now == league.schedule.agg({"season": "max"}).first()[0]
    assert "lineitem" not in plan and "current_season#" not in plan
    # Side features of games are folded by one shuffle on the game id, which the join by game uses as it is.
    assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) <= 32
