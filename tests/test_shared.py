"""What queries that read a table several times write once, and what of it their tasks still shuffle."""

import datetime as dt

import pytest

import __spark_entry__ as registry
from courtside.plans import picks
from courtside.sources.commits import Commits

from helpers import frame

SUPPLIED = {
    "nation": (25, "CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name"),
    "customer": (10, "id AS c_custkey, CAST(id % 25 AS INT) AS c_nationkey"),
    "supplier": (4, "id AS s_suppkey, concat('Supplier#', lpad(id, 9, '0')) AS s_name"),
    "orders": (60, """id AS o_orderkey, id % 10 AS o_custkey, '1-URGENT' AS o_orderpriority,
        CAST(date_add(DATE '2025-01-01', CAST(id AS INT)) AS TIMESTAMP_NTZ) AS o_orderdate"""),
    "lineitem": (240, """id DIV 4 AS l_orderkey, id % 7 AS l_partkey, id % 4 AS l_suppkey, CAST(id % 4 + 1 AS INT) AS l_linenumber,
        CAST(id % 30 AS DOUBLE) AS l_quantity, if(id % 2 = 0, 'O', 'F') AS l_linestatus, TIMESTAMP_NTZ '2025-03-01 00:00:00' AS l_shipdate"""),
    "events": (700, """id AS event_id, TIMESTAMP_NTZ '2025-03-01 00:00:00' AS ts, id % 50 AS user_id, 'view' AS event_type,
        CAST(id AS DOUBLE) AS value"""),
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("supplied"))
    for name, (rows, columns) in SUPPLIED.items():
        spark.range(rows).selectExpr(f"struct({columns}) AS r").select("r.*").write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", ["player_streaks", "player_rolling_averages", "player_summary"])
def test_player_models_read_written_appearances(spark, name, folder):
    plan = plan_of(registry.queries()[name](spark, folder))
    boxes = plan.count("lineitem.parquet")
    assert boxes == (1 if name == "player_summary" else 0)  # the quarters


def test_appearances_are_not_dealt_by_player_alone(spark, folder):
    """All games of a player in one partition would make the memory of a task grow with the history."""
    plan = plan_of(registry.queries()["player_streaks"](spark, folder))
    assert "_segment" in plan
    whole = [line for line in plan.splitlines() if "hashpartitioning(player_name" in line and "_segment" not in line]
    assert all("_size" not in line for line in whole) and len(whole) <= 1  # summed segments alone


def test_sharing_changes_no_row(spark, folder, tmp_path):
    raw = registry.SuppliedTables(spark, folder).raw()
    alone, shared = registry.League(raw), registry.League(raw, work_folder=str(tmp_path))
    for name in ("player_streaks", "player_summary"):
        rows = [sorted(map(repr, getattr(x, name)().collect())) for x in (alone, shared)]
        assert rows[0] == rows[1]


def test_the_card_is_not_shuffled_by_team(spark, folder):
    plan = plan_of(registry.queries()["game_card"](spark, folder))
    assert "hashpartitioning(home_team_id" not in plan and "hashpartitioning(away_team_id" not in plan


def test_newest_versions_are_kept_by_month(spark, tmp_path):
    score = lambda day: {
        "game_date": day and dt.date(2026, 3, day), "home_team_id": "A", "away_team_id": "B",
        "inserted_at": dt.datetime(2026, 3, 1, 10), "composite_score": 0.5,
    }
    path = str(tmp_path / "latest")
    picks.update_latest_scores(frame(spark, "scored_games", [score(d) for d in (1, 2, 3, None)]), path)
    parts = Commits(spark, path).entries()["000000000001"]["parts"]
    assert sorted(parts) == ["_month=2026-03", "_month=__HIVE_DEFAULT_PARTITION__"]


def test_what_is_published_twice_is_computed_once(spark, folder, monkeypatch):
    plans = []
    replace = registry.replace_table
    monkeypatch.setattr(registry, "replace_table", lambda df, *a: (plans.append(plan_of(df)), replace(df, *a))[1])
    update = picks.update_latest_scores
    monkeypatch.setattr(picks, "update_latest_scores", lambda df, *a: (plans.append(plan_of(df)), update(df, *a))[1])
    registry.replaced_seasons(spark, folder)
    registry.merged_latest_scores(spark, folder)
    assert len(plans) == 5
    assert not any("lineitem" in plan or "events" in plan for plan in plans)
