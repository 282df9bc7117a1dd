"""Player form, streaks, official outliers and returns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.dates import as_date
from courtside.functions.numeric import bucketize, flag, one_if, round_half_up, round_mean
from courtside.functions.text import match_key
from courtside.operators.keyed import Season, in_season, newest_per_key
from courtside.operators.shape import quarter_profile
from courtside.operators.timeline import Timeline, current_run, trailing_mean
from courtside.plans.officials import by_official

PLAYER_ORDER = ("game_date", "game_id", "team_id")

# Season means as (source, column).
BASELINE = {
    "points": "pts_season_avg",
    "rebounds": "reb_season_avg",
    "assists": "ast_season_avg",
    "steals": "stl_season_avg",
    "blocks": "blk_season_avg",
    "turnovers": "tov_season_avg",
    "plus_minus": "plus_minus_season_avg",
}
# Rolling means as (source, prefix) over these sizes.
ROLLING = {"points": "pts", "rebounds": "reb", "assists": "ast"}
ROLLING_SIZES = (3, 5)
ROLLING_COLUMNS = [f"{prefix}_last{n}" for n in ROLLING_SIZES for prefix in ROLLING.values()]

HOT_DISTANCE = 5
MIN_STREAK_GAMES = 10
# Bounds of the official outliers and of returning players.
OUTLIER_GAMES, OUTLIER_BASELINE, OUTLIER_DISTANCE = 3, 15, 3
RETURN_BASELINE, RETURN_FROM_DAYS, RETURN_TO_DAYS = 15, 7, 45
ABSENCE_STEPS = [
    (">=", 30, "LONG_ABSENCE"),
    (">=", 15, "MEDIUM_ABSENCE"),
    (">=", 7, "SHORT_ABSENCE"),
]
RULED_OUT = ["Out", "Doubtful"]

PLAYER_QUARTERS = {m: ["Q1", "Q2", "Q3", "Q4"] for m in ("points", "assists", "plus_minus")}
PLAYER_QUARTER_NAMES = {"points": "pts", "assists": "ast", "plus_minus": "pm"}

_LAST_LINE = ["points", "rebounds", "assists", "steals", "blocks", "turnovers", "plus_minus"]


def appearances(player_stats: DataFrame, scores: DataFrame) -> DataFrame:
    """Player games with time on the court, in played games, with date and season."""
    played = scores.select("game_id", "game_date", "season")
    on_court = player_stats.where(F.col("minutes_played") > 0)
    return on_court.select("player_name", "team_id", "game_id", *_LAST_LINE, "starter").join(
        played, "game_id"
    )


def season_baseline(player_games: DataFrame, season_now: Season) -> DataFrame:
    """Means per player in one season, over all teams."""
    return in_season(player_games, season_now).groupBy("player_name").agg(
        F.count("*").alias("games_played"),
        *[round_mean(source, 1).alias(name) for source, name in BASELINE.items()],
    )


def player_timeline(player_games: DataFrame) -> Timeline:
    return Timeline.of(player_games, ["player_name"], PLAYER_ORDER)


def _with_form(timeline: Timeline, runs: dict[str, str] | None = None) -> Timeline:
    """Add rolling means, and the lengths of the given runs, in one ordered pass."""
    rolled = timeline.scan(
        runs=runs,
        reach=max(ROLLING_SIZES) - 1,
        windows={
            **{
                f"{prefix}_last{size}": trailing_mean(source, size, 1)
                for size in ROLLING_SIZES
                for source, prefix in ROLLING.items()
            },
            **{
                f"_pts{size}": lambda w, size=size: F.avg("points").over(w.rowsBetween(1 - size, 0))
                for size in ROLLING_SIZES
            },
        },
        reads=list(ROLLING),
    )
    return rolled.with_columns({
        f"pts_above_avg_last{size}": round_half_up(F.col(f"_pts{size}") - F.col("pts_season_avg"), 1)
        for size in ROLLING_SIZES
    })


def player_rolling_averages(timeline: Timeline, baseline: DataFrame) -> DataFrame:
    """Season and rolling means of players with a baseline, one row per appearance."""
    return _with_form(timeline.joined(baseline)).select(
        "player_name", "team_id", "game_id", "game_date", *_LAST_LINE, "starter", "games_played",
        *BASELINE.values(), *ROLLING_COLUMNS, *[f"pts_above_avg_last{n}" for n in ROLLING_SIZES],
    )


def heat_flags() -> dict[str, Column]:
    """Hot at 5 points or more above the season mean, cold at 5 or more below it."""
    flags = {}
    for size in ROLLING_SIZES:
        distance = F.col(f"pts_above_avg_last{size}")
        flags[f"is_pts_hot_last{size}"] = flag(distance >= HOT_DISTANCE)
        flags[f"is_pts_cold_last{size}"] = flag(distance <= -HOT_DISTANCE)
    return flags


def _hot_game() -> Column:
    return one_if(F.col("points") >= F.col("pts_season_avg") + HOT_DISTANCE)


def _streak_columns() -> list[Column]:
    none, length = F.lit(0).cast("bigint"), F.col("streak_length")
    hot = F.col("hot_game") == 1
    return [
        F.when(hot, length).otherwise(none).alias("hot_game_streak"),
        F.when(hot, none).otherwise(length).alias("below_avg_streak"),
    ]


def player_streaks(timeline: Timeline, baseline: DataFrame) -> DataFrame:
    """Hot and cold flags and runs, for players with enough games this season."""
    regulars = baseline.where(F.col("games_played") >= MIN_STREAK_GAMES)
    flagged = timeline.joined(regulars).with_columns({"hot_game": _hot_game()})
    form = _with_form(flagged, {"streak_length": "hot_game"}).with_columns(heat_flags())
    return form.select(
        "player_name", "team_id", "game_id", "game_date", "points", "rebounds", "assists",
        "pts_season_avg", "pts_last3", "pts_above_avg_last3", "pts_above_avg_last5",
        *heat_flags(), *_streak_columns(),
    )


def current_form(player_games: DataFrame, baseline: DataFrame) -> DataFrame:
    """Each player's last game and rolling means: only five rows per player are moved."""
    last = newest_per_key(
        player_games, ["player_name"], [F.col(c).desc() for c in PLAYER_ORDER],
        keep=max(ROLLING_SIZES),
    )
    newest = F.col("recency") == 1
    recent = lambda column, size: F.when(F.col("recency") <= size, F.col(column))
    form = last.groupBy("player_name").agg(
        F.max(F.when(newest, F.col("team_id"))).alias("team_id"),
        *[F.max(F.when(newest, F.col(c))).alias(f"last_game_{c}") for c in ROLLING],
        *[
            round_mean(recent(source, size), 1).alias(f"{prefix}_last{size}")
            for size in ROLLING_SIZES
            for source, prefix in ROLLING.items()
        ],
        *[F.avg(recent("points", size)).alias(f"_pts{size}") for size in ROLLING_SIZES],
    )
    return form.join(baseline, "player_name").withColumns({
        f"pts_above_avg_last{size}": round_half_up(F.col(f"_pts{size}") - F.col("pts_season_avg"), 1)
        for size in ROLLING_SIZES
    }).drop(*[f"_pts{size}" for size in ROLLING_SIZES])


def current_heat(player_games: DataFrame, baseline: DataFrame) -> DataFrame:
    """Run of hot or not hot games each regular player is in."""
    regulars = baseline.where(F.col("games_played") >= MIN_STREAK_GAMES)
    rows = player_games.select("player_name", *PLAYER_ORDER, "points").join(
        regulars.select("player_name", "pts_season_avg"), "player_name"
    ).withColumn("hot_game", _hot_game())
    run = current_run(rows, "player_name", PLAYER_ORDER, "hot_game", "streak_length")
    return run.select("player_name", *_streak_columns())


def player_quarters(quarters: DataFrame) -> DataFrame:
    return quarter_profile(quarters, "player_name", PLAYER_QUARTER_NAMES, PLAYER_QUARTERS)


def player_summary(player_games: DataFrame, baseline: DataFrame, quarters: DataFrame) -> DataFrame:
    form = current_form(player_games, baseline)
    regular = F.col("games_played") >= MIN_STREAK_GAMES
    flags = {name: F.when(regular, column) for name, column in heat_flags().items()}
    return (
        form.withColumns(flags)
        .join(current_heat(player_games, baseline), "player_name", "left")
        .join(player_quarters(quarters), "player_name", "left")
    )


def player_official_outliers(
    player_stats: DataFrame,
    games: DataFrame,
    season_now: Season,
    assignments: DataFrame,
    form: DataFrame,
    referees: DataFrame,
) -> DataFrame:
    """Players far above or below their season mean under one official this season.

    ``form`` holds each player's current team and season mean.
    """
    current = in_season(games.select("game_id", "season"), season_now)
    on_court = player_stats.where(F.col("minutes_played") > 0).select(
        "player_name", "team_id", "game_id", "points", "plus_minus"
    )
    rows = by_official(on_court.join(current.select("game_id"), "game_id"), assignments)
    under = (
        rows.groupBy("player_name", "team_id", "referee_id")
        .agg(
            F.count("*").alias("games_with_referee"),
            round_mean("points", 1).alias("avg_pts_with_ref"),
            round_mean("plus_minus", 1).alias("avg_plus_minus"),
        )
        .where(F.col("games_with_referee") >= OUTLIER_GAMES)
    )
    scorers = form.where(F.col("pts_season_avg") >= OUTLIER_BASELINE).select(
        "player_name", "team_id", "pts_season_avg"
    )
    distance = F.col("avg_pts_with_ref") - F.col("pts_season_avg")
    return (
        under.join(scorers, ["player_name", "team_id"])
        .where(F.abs(distance) >= OUTLIER_DISTANCE)
        .join(referees, "referee_id")
        .select(
            "player_name", "team_id", F.col("full_name").alias("referee_name"),
            "games_with_referee", "avg_pts_with_ref", "pts_season_avg",
            round_half_up(distance, 1).alias("pts_diff_vs_season_avg"), "avg_plus_minus",
        )
    )


def teams_playing(games: DataFrame, day: Column) -> DataFrame:
    tonight = games.where(F.col("game_date") == day)
    both = F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")
    return tonight.select(both).distinct()


def returning_players(
    games: DataFrame,
    season_now: Season,
    player_stats: DataFrame,
    player_games: DataFrame,
    baseline: DataFrame,
    injuries: DataFrame,
    as_of_date: dt.date | str | None = None,
) -> DataFrame:
    """Regular scorers whose team plays on the day after 7 to 45 days without a game.

    ``player_stats`` counts every listing for the most recent team, ``player_games`` only games
    with time on the court.
    """
    day = as_date(as_of_date)
    season_games = in_season(games.select("game_id", "game_date", "season"), season_now)
    # A player last seen longer ago isn't listed, whatever the games before.
    season_games = season_games.where(F.col("game_date") >= F.date_sub(day, RETURN_TO_DAYS))
    per_team = (
        player_stats.select("player_name", "team_id", "game_id")
        .join(season_games.select("game_id", "game_date"), "game_id")
        .groupBy("player_name", "team_id")
        .agg(F.max("game_date").alias("last_game_date"))
    )
    away = F.date_diff(day, F.col("last_game_date")).cast("bigint")
    recent = (
        newest_per_key(
            per_team, ["player_name"], [F.col("last_game_date").desc(), F.col("team_id").asc()]
        )
        .withColumn("days_since_last_game", away)
        .where(F.col("days_since_last_game").between(RETURN_FROM_DAYS, RETURN_TO_DAYS))
        .join(teams_playing(games, day), "team_id")
    )
    scorers = baseline.where(F.col("pts_season_avg") >= RETURN_BASELINE).select(
        "player_name", "pts_season_avg", "reb_season_avg", "ast_season_avg"
    )
    on_court = player_games.select(
        "player_name", "team_id", F.col("game_date").alias("last_game_date")
    ).where(F.col("last_game_date").between(
        F.date_sub(day, RETURN_TO_DAYS), F.date_sub(day, RETURN_FROM_DAYS)
    ))
    listed = recent.join(scorers, "player_name").join(
        on_court, ["player_name", "team_id", "last_game_date"]
    )
    ruled_out = injuries.where(
        (F.col("game_date") == day) & F.col("status").isin(RULED_OUT)
    ).select("team_id", match_key("player_name").alias("_key"))
    free = listed.withColumn("_key", match_key("player_name")).join(
        ruled_out, ["team_id", "_key"], "left_anti"
    )
    return free.select(
        "player_name", "team_id", "last_game_date", "days_since_last_game",
        "pts_season_avg", "reb_season_avg", "ast_season_avg",
        bucketize("days_since_last_game", ABSENCE_STEPS, None).alias("absence_tier"),
        round_half_up((F.col("pts_season_avg") - RETURN_BASELINE) / 10.0, 2).alias("impact_score"),
    )
