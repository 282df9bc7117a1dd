import datetime as dt
import random

import pytest
from helpers import frame, game

from courtside import League, read_league
from courtside.operators import staging
from courtside.plans import picks
from courtside.sources import commits, sinks
from courtside.sources.commits import read_version, replace_table
from courtside.sources.projection import SuppliedTables
from courtside.sources.readers import RawTables, catalog_league, read_table
from courtside.sources.schemas import PREVIEW_COLUMNS, RAW_SCHEMAS

FOLDER = "/root/testdata/sf0.001"


def test_projection_has_the_declared_types(spark):
    raw = SuppliedTables(spark, FOLDER).raw()
    for name, schema in RAW_SCHEMAS.items():
        declared = {f.name: f.dataType for f in schema}
        assert {f.name: f.dataType for f in raw[name].schema} == declared, name


def test_read_league_from_parquet(spark, tmp_path):
    games = frame(spark, "games", [game("g1", "2025-11-01", "A", "B"), game("g2", "2025-11-02", "B", "A")])
    games.write.parquet(str(tmp_path / "games"))
    league = League(read_league(spark, str(tmp_path)))
    assert league.stg("games").where("season = 2026").count() == 2
    pushed = read_table(spark, str(tmp_path), "games").where("home_team_id = 'A'").select("game_id")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(home_team_id,A)" in plan and "tipoff_time" not in plan
    with pytest.raises(KeyError):
        read_league(spark, str(tmp_path))["players"]


def test_catalog_tables_and_layers(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    frame(spark, "games", [game("g1", "2025-11-01", "A", "B")]).write.mode("overwrite").saveAsTable("raw.games")
    league = League(catalog_league(spark))
    name = sinks.publish_table(league.stg("games"), "games_mart")
    assert name == "marts.games_mart" and spark.table(name).first().season == 2026
    assert sinks.publish_table(league.stg("games"), "games_mart") == name
    assert spark.table(name).count() == 1
    view = sinks.publish_view(league.stg("games"), "games", "staging")
    assert view == "staging_games" and spark.table(view).count() == 1
    assert sinks.publish_view(league.stg("games"), "games") == "games"


def test_facts_in_buckets_meet_without_a_shuffle(spark):
    raw = SuppliedTables(spark, FOLDER).raw()
    tables = ["games", "game_results", "team_game_stats", "team_quarter_stats"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        database = sinks.publish_facts(raw, "bucketed_facts", 4, tables)
        stored = League(catalog_league(spark, database))
        plan = stored.played._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert "Exchange" in League(raw).played._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, stored.played.collect())) == sorted(map(tuple, League(raw).played.collect()))
        assert sinks.publish_facts(raw, database, 4, ["games"]) == database  # replaces
        assert spark.table(f"{database}.games").count() == raw["games"].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_schema_names():
    assert sinks.schema_name(" marts ", "default") == "marts"
    assert sinks.schema_name(None, "default") == "default"


def test_partitioned_table_skips_folders(spark, tmp_path):
    rows = [game(f"g{i}", f"2025-11-{i + 1:02d}", "A", "B", season=f"202{i % 3}-2{i % 3 + 1}") for i in range(9)]
    df = League(RawTables.of({"games": frame(spark, "games", rows)})).stg("games")
    path = str(tmp_path / "games")
    sinks.publish_parquet(df, path, ["season"])
    sinks.publish_parquet(df, path, ["season"])
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 9
    one = back.where("season = 2022")
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(season" in one._jdf.queryExecution().executedPlan().toString()


def previews(spark, home):
    rows = [{"game_date": dt.date(2026, 3, 9), "home_team_id": home, "away_team_id": "B", "tipoff_time": "19:00:00",
             "inserted_at": dt.datetime(2026, 3, 9), "composite_score": 0.3}]
    return frame(spark, "scored_games", rows)


def test_preview_append(spark, tmp_path):
    path = str(tmp_path / "previews")
    assert sinks.read_previews(spark, path).count() == 0
    added = [sinks.append_previews(previews(spark, home), path, f"batch {home}") for home in ("A", "C", "A")]
    assert added == [True, True, False]
    back = sinks.read_previews(spark, path)
    assert back.columns == PREVIEW_COLUMNS
    assert sorted(r.home_team_id for r in back.collect()) == ["A", "C"]
    assert {(r.posted_substack, r.preview_text, r.composite_score) for r in back.collect()} == {(False, None, 0.3)}


def test_a_batch_that_was_not_committed_is_not_read(spark, tmp_path):
    """A writer that fails after its data and before its commit leaves nothing to be seen; the retry adds the batch."""
    path = str(tmp_path / "previews")
    commits._write(sinks.preview_rows(previews(spark, "A")), path, ["game_date"])
    (tmp_path / "previews" / "_commits").mkdir()
    (tmp_path / "previews" / "_commits" / "other").write_text('{"folder": "data/wri')
    assert sinks.read_previews(spark, path).count() == 0
    assert sinks.append_previews(previews(spark, "A"), path, "one")
    assert [r.home_team_id for r in sinks.read_previews(spark, path).collect()] == ["A"]


def test_of_two_writers_of_a_batch_one_is_added(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "previews")
    write = commits._write

    def slow(df, *rest):
        monkeypatch.setattr(commits, "_write", write)
        assert sinks.append_previews(previews(spark, "first"), path, "one")
        return write(df, *rest)

    monkeypatch.setattr(commits, "_write", slow)
    assert not sinks.append_previews(previews(spark, "second"), path, "one")
    assert [r.home_team_id for r in sinks.read_previews(spark, path).collect()] == ["first"]


SEASONS = "season int, team string, wins int"


def test_replacing_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table = lambda *rows: spark.createDataFrame(rows, SEASONS)
    schema = table().schema
    assert read_version(spark, path, schema).count() == 0
    assert replace_table(table((2024, "A", 1), (2025, "A", 2), (None, "N", 0)), path, "season") == 1
    old = read_version(spark, path, schema)
    assert replace_table(table((2025, "B", 3), (2026, "A", 4)), path, "season") == 2
    new = [(2024, "A", 1), (2025, "B", 3), (2026, "A", 4)]
    rows = lambda df: sorted((tuple(r) for r in df.collect() if r.season), key=str)
    assert rows(read_version(spark, path, schema)) == new
    assert rows(old) == [(2024, "A", 1), (2025, "A", 2)]  # a reader from before sees the old version
    assert read_version(spark, path, schema).where("season is null").count() == 1
    one = read_version(spark, path, schema, ["season=2025"])
    assert rows(one) == [(2025, "B", 3)] and all("season=2025" in f for f in one.inputFiles())
    assert replace_table(table(), path, "season") == 3 and rows(read_version(spark, path, schema)) == new


def test_replacing_a_table_as_a_whole(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], SEASONS).schema
    for wins in (1, 2):
        replace_table(spark.createDataFrame([(2024, "A", wins)], SEASONS), path)
    assert [r.wins for r in read_version(spark, path, schema).collect()] == [2]


def test_replacements_at_the_same_time_keep_both(spark, tmp_path, monkeypatch):
    """The second writer finds its version taken and builds on the first one's."""
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], SEASONS).schema
    replace_table(spark.createDataFrame([(2024, "A", 1)], SEASONS), path, "season")
    newest = commits._newest

    def late(log):
        monkeypatch.setattr(commits, "_newest", newest)
        found = newest(log)
        replace_table(spark.createDataFrame([(2025, "A", 2)], SEASONS), path, "season")
        return found

    monkeypatch.setattr(commits, "_newest", late)
    assert replace_table(spark.createDataFrame([(2026, "A", 3)], SEASONS), path, "season") == 3
    assert sorted(r.wins for r in read_version(spark, path, schema).collect()) == [1, 2, 3]


def test_newest_versions_from_batches_in_any_order(spark, tmp_path):
    rng = random.Random(6)
    versions = [
        {"game_date": dt.date(2026, 3, 1 + rng.randrange(4)) if i % 9 else None, "home_team_id": rng.choice("ABC"), "away_team_id": "X",
         "inserted_at": dt.datetime(2026, 3, 9, rng.randrange(24)) if i % 7 else None, "composite_score": i / 100}
        for i in range(120)
    ]
    key = lambda r: (r["game_date"], r["home_team_id"])
    age = lambda r: (r["inserted_at"] is not None, r["inserted_at"] or 0, r["composite_score"])
    newest = {}
    for row in versions:
        if key(row) not in newest or age(row) > age(newest[key(row)]):
            newest[key(row)] = row
    path = str(tmp_path / "state")
    batches = [versions[a : a + 30] for a in (60, 0, 90, 30, 0)]  # one of them twice
    for batch in batches:
        picks.update_latest_scores(frame(spark, "scored_games", batch), path)
    state = read_version(spark, path, RAW_SCHEMAS["scored_games"])
    assert {(r.game_date, r.home_team_id): r.composite_score for r in state.collect()} == {k: r["composite_score"] for k, r in newest.items()}


def test_stage(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS t")
    assert sorted(staging.stage(df, f"{tmp_path}/all").collect()) == sorted(df.collect())
    assert staging.stage(df.limit(0), f"{tmp_path}/none").dtypes == df.dtypes


def test_report_positions(spark, tmp_path):
    df = spark.createDataFrame([("b", 9, "T"), ("a", 9, "T"), ("c", 40, "T")], "player_name string, days_since_last_game int, team_id string")
    numbered = sinks.with_position(df, "returning_players", work_path=str(tmp_path / "ranges"))
    assert {r.player_name: r.position for r in numbered.collect()} == {"c": 1, "a": 2, "b": 3} and numbered.columns == [*df.columns, "position"]
    assert [r.player_name for r in sinks.in_report_order(df, "returning_players").collect()] == ["c", "a", "b"]
    with pytest.raises(ValueError):
        sinks.with_position(df, "returning_players")
    assert sinks.with_position(df.limit(0), "returning_players", work_path=str(tmp_path / "none")).count() == 0


def test_positions_of_a_long_report_need_no_single_task(spark, tmp_path):
    """Most rows are equal in the first column; positions follow the whole order, and no window is without a key."""
    rng = random.Random(2)
    rows = [(f"p{rng.randrange(10**6):06d}", 9 if rng.random() < 0.8 else rng.choice([None, 1, 30]), f"T{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "player_name string, days_since_last_game int, team_id string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = sinks.with_position(df, "returning_players", work_path=str(tmp_path / "ranges"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else -1), r[0], r[2]))
    found = {r.team_id: r.position for r in numbered.collect()}
    assert found == {row[2]: i + 1 for i, row in enumerate(order)}
    assert spark.read.parquet(str(tmp_path / "ranges")).select("_range").distinct().count() > 1
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
