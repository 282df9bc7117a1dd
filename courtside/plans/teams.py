"""Team form over time and at the last game."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.numeric import bucketize, flag, ratio, round_half_up, round_mean
from courtside.operators.keyed import Season, in_season, newest_per_key, with_season_age
from courtside.operators.shape import bucket_columns, quarter_profile
from courtside.operators.timeline import Timeline, current_run, trailing_mean

TEAM_ORDER = ("game_date", "game_id")

# Pace classes, games per 48 minutes.
PACE_STEPS = [(">=", 106.0, "fast"), (">=", 100.0, "average")]
SLOW = "slow"
PACE_PREFIXES = {"fast": "fast_pace", "average": "avg_pace", "slow": "slow_pace"}

# Rolling columns as (source, prefix, digits, decimals of the source).
ROLLING = [
    ("team_points", "pts", 1, 0),
    ("opp_points", "opp_pts", 1, 0),
    ("win", "win_pct", 3, 0),
    ("pace", "pace", 1, 1),
]
ROLLING_SIZES = (5, 10)
ROLLING_COLUMNS = [
    *[f"{p}_last{n}" for n in ROLLING_SIZES for p in ("pts", "opp_pts", "win_pct")],
    *[f"pace_last{n}" for n in ROLLING_SIZES],
]

# Metrics shown per period.
TEAM_QUARTERS = {
    "points": ["Q1", "Q2", "Q3", "Q4", "OT1"],
    "turnovers": ["Q1", "Q2", "Q3", "Q4"],
    "field_goals_attempted": ["Q1", "Q2", "Q3", "Q4"],
}
TEAM_QUARTER_NAMES = {"points": "pts", "turnovers": "tov", "field_goals_attempted": "fga"}


def team_timeline(rows: DataFrame) -> Timeline:
    return Timeline.of(rows, ["team_id"], TEAM_ORDER)


def running_record(timeline: Timeline, by_season: bool = False) -> DataFrame:
    """Wins and losses up to each game; ``by_season`` expects a timeline of (team, season)."""
    counted = timeline.with_running(
        {"wins": ("sum", F.col("win")), "losses": ("sum", F.lit(1) - F.col("win"))},
        whole={"_games": ("sum", F.lit(1).cast("bigint"))},
    )
    played = F.col("wins") + F.col("losses")
    columns = [
        "team_id", "game_id", "game_date", "season", "opponent_id", "home_away", "team_points",
        "opp_points", "win", "wins", "losses", played.alias("games_played"),
        round_half_up(ratio("wins", played), 3).alias("win_pct"),
    ]
    if not by_season:
        columns.append((F.col("_games") - played + 1).alias("game_recency"))
    return counted.select(*columns)


def streaks(timeline: Timeline) -> DataFrame:
    runs = timeline.with_runs("win", "streak_length")
    won, length = F.col("win") == 1, F.col("streak_length")
    none = F.lit(0).cast("bigint")
    return runs.select(
        "team_id", "game_id", "game_date", "win", "streak_length",
        F.when(won, length).otherwise(none).alias("win_streak"),
        F.when(won, none).otherwise(length).alias("loss_streak"),
        streak_label(won, length).alias("streak_label"),
    )


def streak_label(won, length):
    return F.concat(F.when(won, F.lit("W")).otherwise(F.lit("L")), length.cast("string"))


def rolling_timeline(timeline: Timeline, names: Sequence[str] = ROLLING_COLUMNS) -> Timeline:
    """Add the rolling means of the given names."""
    means = {
        f"{prefix}_last{size}": trailing_mean(source, size, digits, carries)
        for size in ROLLING_SIZES
        for source, prefix, digits, carries in ROLLING
        if f"{prefix}_last{size}" in names
    }
    return timeline.with_windows(max(ROLLING_SIZES) - 1, means, [source for source, *_ in ROLLING])


def rolling_averages(timeline: Timeline) -> DataFrame:
    return rolling_timeline(timeline).select(
        "team_id", "game_id", "game_date", "home_away", "win", *ROLLING_COLUMNS
    )


def pace_bucket(pace):
    """A missing pace falls into the slow class."""
    return bucketize(pace, PACE_STEPS, SLOW)


def crew_average(assignments: DataFrame, tendencies: DataFrame) -> DataFrame:
    """Mean tendencies over the officials of each game; every assigned game stays.

    The slots become rows, so that officials are looked up by equality; an official named in two
    slots counts once.
    """
    slots = F.array_compact(F.array("referee_1", "referee_2", "referee_3"))
    crew = assignments.select("game_id", F.explode_outer(F.array_distinct(slots)).alias("referee_id"))
    known = tendencies.select("referee_id", "avg_total_points", "avg_total_fta", "avg_total_fouls")
    return crew.join(known, "referee_id", "left").groupBy("game_id").agg(
        round_mean("avg_total_points", 1, carries=1).alias("crew_avg_total_points"),
        round_mean("avg_total_fta", 1, carries=1).alias("crew_avg_fta"),
        round_mean("avg_total_fouls", 1, carries=1).alias("crew_avg_fouls"),
    )


def performance_by_pace(timeline: Timeline, crews: DataFrame, season_now: Season) -> DataFrame:
    """Team games with pace class, crew averages and the two filter flags."""
    numbered = timeline.with_running(
        {"_place": ("sum", F.lit(1).cast("bigint"))},
        whole={"_games": ("sum", F.lit(1).cast("bigint"))},
    ).rows
    recency = F.col("_games") - F.col("_place") + 1
    rows = with_season_age(numbered.join(crews, "game_id", "left"), season_now, "_age")
    return rows.select(
        "team_id", "game_id", "game_date", "win", "home_away", "team_points", "opp_points",
        "game_pace", "overtime_periods", "season", pace_bucket("game_pace").alias("pace_bucket"),
        "crew_avg_total_points", "crew_avg_fta", "crew_avg_fouls", recency.alias("game_recency"),
        flag(F.col("_age") == 0).alias("is_current_season"),
        flag(recency <= 10).alias("is_last_10"),
    )


def _pace_columns() -> list[Column]:
    return bucket_columns(pace_bucket("game_pace"), PACE_PREFIXES)


def pace_record(rows: DataFrame, season_now: Season) -> DataFrame:
    """Current-season record per team in each pace class, as columns."""
    return in_season(rows, season_now).groupBy("team_id").agg(*_pace_columns())


def current_rolling(rows: DataFrame) -> DataFrame:
    """Last-5 and last-10 means at each team's last game: only ten rows per team are moved."""
    last = newest_per_key(
        rows, ["team_id"], [F.col(c).desc() for c in TEAM_ORDER], keep=max(ROLLING_SIZES)
    )
    means = {
        f"{prefix}_last{size}": round_mean(
            F.when(F.col("recency") <= size, F.col(source)), digits, carries
        )
        for size in ROLLING_SIZES
        for source, prefix, digits, carries in ROLLING
    }
    columns = [means[name].alias(name) for name in ROLLING_COLUMNS]
    return last.groupBy("team_id").agg(*columns)


def current_streak(rows: DataFrame) -> DataFrame:
    run = current_run(rows, "team_id", TEAM_ORDER, "win", "streak_length")
    return run.select(
        "team_id", streak_label(F.col("win") == 1, F.col("streak_length")).alias("streak_label"),
        "streak_length",
    )


def record(rows: DataFrame, *more: Column) -> DataFrame:
    """Record of each team over the given games, with more aggregates over the same rows."""
    totals = rows.groupBy("team_id").agg(
        F.sum("win").alias("wins"), F.sum(F.lit(1) - F.col("win")).alias("losses"), *more
    )
    added = [c for c in totals.columns if c not in ("team_id", "wins", "losses")]
    played = F.col("wins") + F.col("losses")
    return totals.select(
        "team_id", "wins", "losses", played.alias("games_played"),
        round_half_up(ratio("wins", played), 3).alias("win_pct"), *added,
    )


def season_profile(rows: DataFrame, season_now: Season) -> DataFrame:
    """Record in the current season only, whole and in each pace class, from one aggregate."""
    return record(in_season(rows, season_now), *_pace_columns())


def _splits() -> list[Column]:
    columns = []
    for side in ("home", "away"):
        here = F.col("home_away") == side
        pick = lambda value: F.when(here, value)
        columns += [
            round_mean(pick(F.col("team_points")), 1).alias(f"avg_points_scored_{side}"),
            round_mean(pick(F.col("opp_points")), 1).alias(f"avg_points_allowed_{side}"),
            round_mean(pick(F.col("team_points") - F.col("opp_points")), 1).alias(f"avg_margin_{side}"),
            F.nullif(F.count_if(here), F.lit(0).cast("bigint")).alias(f"{side}_games"),
        ]
    return columns


def home_away_splits(rows: DataFrame) -> DataFrame:
    """Points scored, allowed and margin at home and away; a side without games gives nulls."""
    return rows.groupBy("team_id").agg(*_splits())


def team_quarters(quarters: DataFrame) -> DataFrame:
    return quarter_profile(quarters, "team_id", TEAM_QUARTER_NAMES, TEAM_QUARTERS)


def team_summary(rows: DataFrame, quarters: DataFrame) -> DataFrame:
    """Current record, streak, form, splits and quarter profile, one row per team."""
    streak = current_streak(rows).withColumnRenamed("streak_label", "current_streak")
    return (
        record(rows, *_splits())
        .join(streak, "team_id", "left")
        .join(current_rolling(rows), "team_id", "left")
        .join(team_quarters(quarters), "team_id", "left")
    )
