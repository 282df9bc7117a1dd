"""

Every query runs the league's models on the projection of the supplied tables.
"""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle import RECAP_DAY, RETURN_DAY, SCORE_DAY, all_oracles
from courtside import League
from courtside.functions.dates import recap_monday, recap_sunday
from courtside.functions.text import normalize_name
from courtside.operators.staging import stage
from courtside.plans import card, games, officials, picks, players, teams
from courtside.sources import sinks
from courtside.sources.commits import read_version, replace_table
from courtside.sources.projection import SuppliedTables
from courtside.sources.readers import RawTables, catalog_league

try:  # the text operators are an optional part
    import corpus_pipeline
    from courtside.llm import queries as text_queries
except ImportError:
    text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

STAGING = [
    "games", "game_results", "team_game_stats", "player_game_stats", "team_quarter_stats",
    "player_quarter_stats", "referee_assignments", "broadcast_schedule", "betting_lines",
    "opening_lines", "closing_lines", "injuries",
]
MODELS = [
    "game_pace", "team_record", "team_streaks", "team_rolling_averages", "team_performance_by_pace",
    "team_referee_record", "head_to_head", "national_broadcast_flag", "rest_days", "travel",
    "timezone_lag", "altitude_fatigue", "altitude_fatigue_by_quarter", "altitude_fatigue_by_player",
    "player_rolling_averages", "player_streaks", "referee_tendencies", "player_referee_stats",
    "team_summary", "player_summary", "referee_summary", "game_card", "season_team_record",
    "pick_record", "recap_lines", "returning_players",
]
# Models that read a table of the league several times: it is written once.
SHARING = ["game_card", "player_rolling_averages", "player_streaks", "player_summary", "player_referee_stats", "returning_players"]
KEY = ["game_date", "home_team_id", "away_team_id"]
FACT_BUCKETS = 16


def work_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one only where none is configured."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="courtside-")
    return f"{shared}/courtside-{uuid.uuid4().hex}"


def league(spark: SparkSession, folder: str, **options) -> League:
    return League(SuppliedTables(spark, folder).raw(), **options)


def _model(name: str, **options) -> Query:
    days = {"returning_players": RETURN_DAY, "pick_record": RECAP_DAY, "recap_lines": RECAP_DAY}
    day = days.get(name, SCORE_DAY)

    def build(spark: SparkSession, folder: str) -> DataFrame:
        shared = {"work_folder": work_folder(spark)} if name in SHARING else {}
        return getattr(league(spark, folder, as_of_date=day, **shared, **options), name)()

    return build


def _positions(name: str, report: str, columns: list[str], *within: str) -> Query:
    """The place of each row of a model in its published order."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        path = None if within else work_folder(spark)
        return sinks.with_position(_model(name)(spark, folder), report, *within, work_path=path).select(*columns, "position")

    return build


def _with_league(build: Callable[[League], DataFrame]) -> Query:
    return lambda spark, folder: build(league(spark, folder, as_of_date=SCORE_DAY))


def current_record_and_streak(lg: League) -> DataFrame:
    """Each team's record and the streak it is on."""
    rows = games.team_rows(lg.boxes)
    return teams.record(rows).join(teams.current_streak(rows), "team_id")


def crew_averages(lg: League) -> DataFrame:
    return teams.crew_average(lg.stg("referee_assignments"), lg.referee_tendencies())


def pace_bucket_record(lg: League) -> DataFrame:
    return teams.pace_record(games.team_rows(lg.paced), lg.season_now)


def official_seasons(lg: League) -> DataFrame:
    return officials.season_summary(lg.stg("referee_assignments"), lg.paced)


def teams_by_game_day(lg: League) -> DataFrame:
    both = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return lg.stg("games").select("game_date", both).distinct()


def recap_weeks(lg: League) -> DataFrame:
    day = F.col("game_date")
    return lg.stg("games").select("game_date").distinct().select(
        "game_date", recap_sunday(day).alias("sunday"), recap_monday(day).alias("monday")
    )


def clean_names(profile: str) -> Query:
    return lambda spark, folder: spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", normalize_name("text", profile).alias("cleaned")
    )


def latest(lg: League) -> DataFrame:
    return picks.latest_scores(lg.raw["scored_games"])


def qualified_picks(lg: League) -> DataFrame:
    strengths = ["divergence_strength", "signal_strength", "ou_signal_strength"]
    return picks.qualify_picks(latest(lg)).select(*KEY, *strengths, "pick_type")


def signals(purpose: str) -> Query:
    def build(lg: League) -> DataFrame:
        levels = ["strong", "medium"] if purpose == "preview" else ["strong"]
        columns = [f"{level}_{part}" for level in levels for part in ("signals", "count")]
        return picks.extract_signals(latest(lg), purpose).select(*KEY, *columns)

    return _with_league(build)


def scored(columns: list[str], step: Callable[[DataFrame], DataFrame]) -> Query:
    """A flag step over every version of every scored game."""
    return _with_league(
        lambda lg: step(lg.raw["scored_games"]).select(*KEY, "inserted_at", *columns)
    )


def merged_picks(lg: League) -> DataFrame:
    sided = picks.qualify_picks(picks.pick_side(latest(lg)))
    spread = F.concat_ws(" ", "spread_pick_team", "spread_pick_line")
    blurb = F.when(F.col("pick_type") == "spread", spread).otherwise(F.col("total_pick"))
    return picks.merge_pick_rows(sided.withColumn("blurb", blurb))


def preview_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Append the early batch of a day, twice, then the late one, which leaves out what is published."""
    raw = SuppliedTables(spark, folder).raw()
    path = work_folder(spark)
    early = League(raw, as_of_date=SCORE_DAY).preview_batch("early")
    for _ in range(2):
        sinks.append_previews(early, path, f"{SCORE_DAY}-early")
    published = raw["game_previews"].unionByName(sinks.read_previews(spark, path).select(raw["game_previews"].columns))
    later = RawTables.of({"scored_games": raw["scored_games"], "game_previews": published})
    sinks.append_previews(League(later, as_of_date=SCORE_DAY).preview_batch("late"), path, f"{SCORE_DAY}-late")
    return sinks.read_previews(spark, path)


def merged_latest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The newest versions, kept up to date from three batches that don't come in the order of time."""
    path = work_folder(spark)
    scores = stage(league(spark, folder).raw["scored_games"], f"{path}/scored")  # read six times
    path = f"{path}/latest"
    arrived = F.pmod(F.xxhash64("inserted_at", *KEY), F.lit(3))
    for batch in range(3):
        picks.update_latest_scores(scores.where(arrived == batch), path)
    return read_version(spark, path, scores.schema)


def replaced_seasons(spark: SparkSession, folder: str) -> DataFrame:
    """Wide games published with wrong points in some seasons, which are then replaced."""
    path = work_folder(spark)
    scores = stage(league(spark, folder).game_scores, f"{path}/computed")
    path = f"{path}/scores"
    wrong = F.col("season") % 2 == 0
    replace_table(scores.withColumn("home_points", F.when(~wrong, F.col("home_points"))), path, "season")
    replace_table(scores.where(wrong), path, "season")
    return read_version(spark, path, scores.schema)


def merged_official_record(spark: SparkSession, folder: str) -> DataFrame:
    """Records of teams under officials from published season states, of which even seasons came later."""
    lg, path = league(spark, folder), work_folder(spark)
    states = stage(lg.official_states(), f"{path}/computed")
    even = F.col("season") % 2 == 0
    wrong = states.withColumn("wins", F.when(~even, F.col("wins")))
    officials.publish_states(wrong, f"{path}/states")
    officials.publish_states(states.where(even), f"{path}/states")
    return officials.effect_of_states(officials.read_states(spark, f"{path}/states"), lg.season_now)


def colocated_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Wide games from game facts that are stored in buckets of the game id."""
    tables = ["games", "team_game_stats", "team_quarter_stats"]
    database = sinks.publish_facts(
        SuppliedTables(spark, folder).raw(), f"facts_{uuid.uuid4().hex}", FACT_BUCKETS, tables
    )
    return League(catalog_league(spark, database)).game_scores


def published_view(spark: SparkSession, folder: str) -> DataFrame:
    view = sinks.publish_view(league(spark, folder).team_record(), "team_record", "intermediate")
    return spark.sql(f"SELECT * EXCEPT (game_recency) FROM {view}")


def published_table(spark: SparkSession, folder: str) -> DataFrame:
    """Wide games written in folders by season and read back."""
    scores = league(spark, folder).game_scores
    path = work_folder(spark)
    sinks.publish_parquet(scores, path, ["season"])
    return spark.read.schema(scores.schema).parquet(path).select(scores.columns)


def catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    """A model published as a managed table of the marts layer and read back by name."""
    record = league(spark, folder).team_record()
    return spark.table(sinks.publish_table(record, f"team_record_{uuid.uuid4().hex}"))


def catalog_games(spark: SparkSession, folder: str) -> DataFrame:
    """The schedule, read from a catalog database by its physical name."""
    SuppliedTables(spark, folder).raw()["games"].createOrReplaceGlobalTempView("games")
    return League(catalog_league(spark, "global_temp")).stg("games")


def published_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Views published in each layer, found by their names, with their rows."""
    lg = league(spark, folder)
    views = [
        sinks.publish_view(lg.stg("games"), "games", "staging"),
        sinks.publish_view(lg.team_record(), "team_record", "intermediate"),
        sinks.publish_view(lg.team_summary(), "team_summary", "marts"),
    ]
    counts = [spark.sql(f"SELECT '{view}' AS view_name, count(*) AS view_rows FROM {view}") for view in views]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def queries() -> dict[str, Query]:
    """One entry per model and per operator that stands on its own."""
    return {
        **{f"stg_{name}": _with_league(lambda lg, name=name: lg.stg(name)) for name in STAGING},
        "game_scores": _with_league(lambda lg: lg.game_scores),
        **{name: _model(name) for name in MODELS},
        "current_record_and_streak": _with_league(current_record_and_streak),
        "team_rows": _with_league(lambda lg: games.team_rows(lg.boxes)),
        "official_slots": _with_league(
            lambda lg: officials.official_games(lg.stg("referee_assignments"))
        ),
        "travel_any_game": _model("travel", travel_scope="all"),
        "crew_averages": _with_league(crew_averages),
        "pace_bucket_record": _with_league(pace_bucket_record),
        "home_away_splits": _with_league(
            lambda lg: teams.home_away_splits(games.team_rows(lg.boxes))
        ),
        "team_quarter_profile": _with_league(
            lambda lg: teams.team_quarters(lg.stg("team_quarter_stats"))
        ),
        "player_quarter_profile": _with_league(
            lambda lg: players.player_quarters(lg.stg("player_quarter_stats"))
        ),
        "season_baseline": _with_league(lambda lg: lg.baseline),
        "official_seasons": _with_league(official_seasons),
        "season_pair_record": _with_league(
            lambda lg: card.season_pairs(lg.boxes, lg.season_now)
        ),
        "teams_by_game_day": _with_league(teams_by_game_day),
        "recap_weeks": _with_league(recap_weeks),
        "clean_names_box_score": clean_names("box_score"),
        "clean_names_injury": clean_names("injury"),
        "latest_scores": _with_league(latest),
        "signal_strengths": scored(
            ["divergence_strength", "signal_strength", "ou_signal_strength"], picks.signal_strengths
        ),
        "qualified_picks": _with_league(qualified_picks),
        "pick_sides": scored(
            ["spread_pick_side", "spread_pick_team", "spread_pick_line", "total_pick"],
            picks.pick_side,
        ),
        "line_flags": scored(["total_flag", "spread_flag"], picks.line_flags),
        "preview_signals": signals("preview"),
        "pick_signals": signals("pick"),
        "free_games": _with_league(
            lambda lg: picks.free_game_flag(latest(lg)).select(
                *KEY, "tipoff_time", "is_national_broadcast", "is_free_game"
            )
        ),
        "unpublished_early": _with_league(lambda lg: lg.unpublished_games("early")),
        "unpublished_late": _with_league(lambda lg: lg.unpublished_games("late")),
        "published_with_scores": _with_league(
            lambda lg: picks.published_with_scores(
                lg.raw["game_previews"], lg.raw["scored_games"], SCORE_DAY, "late"
            )
        ),
        "merged_picks": _with_league(merged_picks),
        "preview_batches": preview_batches,
        "merged_latest_scores": merged_latest_scores,
        "replaced_seasons": replaced_seasons,
        "merged_official_record": merged_official_record,
        "colocated_scores": colocated_scores,
        "key_report": _with_league(lambda lg: lg.key_report()),
        "published_view": published_view,
        "published_table": published_table,
        "catalog_table": catalog_table,
        "catalog_games": catalog_games,
        "published_layers": published_layers,
        "returning_players_order": _positions("returning_players", "returning_players", ["player_name"]),
        "player_referee_order": _positions(
            "player_referee_stats", "player_referee_stats", ["player_name", "team_id", "referee_name"]
        ),
        "recap_order": _positions("recap_lines", "recap_lines", ["pick_type", *KEY], "pick_type"),
        "display_order": _with_league(
            lambda lg: sinks.with_position(picks.free_game_flag(latest(lg)), "display", "game_date").select(
                *KEY, "position"
            )
        ),
        **({**text_queries.queries(), "pipeline": corpus_pipeline.run} if text_queries else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The same results in SQL with ordinary windows, for the second engine."""
    return {**all_oracles(), **(text_queries.oracle_sql() if text_queries else {})}


def entry(spark: SparkSession) -> DataFrame:
    """Each team's record and current streak, on the smallest supplied tables."""
    return queries()["current_record_and_streak"](spark, "/root/testdata/sf0.001")
