"""Officials: tendencies, season summaries, effect on teams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from courtside.functions.numeric import (
    as_units, bucketize, one_if, ratio, round_half_up, round_mean,
)
from courtside.operators.keyed import Season, newest_per_key, versus_population, with_season_age
from courtside.operators.shape import unpivot_slots
from courtside.sources.commits import read_version, replace_table

SLOTS = ["referee_1", "referee_2", "referee_3"]

# Two box score columns added up per game.
GAME_TOTALS = {
    "total_points": "points",
    "total_fouls": "pf",
    "total_fta": "fta",
    "total_3pa": "3pa",
    "total_tov": "tov",
}

# Labels of the official summary.
HOME_BIAS_STEPS = [
    (">=", 0.65, "strong_home_bias"),
    (">=", 0.58, "moderate_home_bias"),
    ("<=", 0.35, "strong_away_bias"),
    ("<=", 0.42, "moderate_away_bias"),
]
SAMPLE_STEPS = [(">=", 20, "sufficient"), (">=", 10, "limited")]
LABEL_DISTANCE = 2.0

# Weight of a season in hundredths, by its distance from the current one.
SEASON_WEIGHTS = {0: 100, 1: 40, 2: 15}
EVEN_CHANCE = 0.5


def by_official(game_rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """Rows of games once per official: joined by game first, so the shuffle moves each row once."""
    crewed = game_rows.join(assignments.select("game_id", *SLOTS), "game_id")
    return unpivot_slots(crewed, game_rows.columns, SLOTS, "referee_id")


def official_games(assignments: DataFrame) -> DataFrame:
    return unpivot_slots(assignments, ["game_id"], SLOTS, "referee_id")


def _game_totals(scores: DataFrame) -> list[Column]:
    totals = [
        (F.col(f"home_{short}") + F.col(f"away_{short}")).alias(name)
        for name, short in GAME_TOTALS.items()
    ]
    return [*totals, one_if(F.col("home_points") > F.col("away_points")).alias("home_win")]


def official_tendencies(assignments: DataFrame, scores: DataFrame) -> DataFrame:
    rows = by_official(scores.select("game_id", "game_date", *_game_totals(scores)), assignments)
    return rows.groupBy("referee_id").agg(
        F.count("*").alias("games_officiated"),
        *[round_mean(name, 1).alias(f"avg_{name}") for name in GAME_TOTALS],
        round_mean("home_win", 3).alias("home_win_pct"),
        F.min("game_date").alias("first_game"),
        F.max("game_date").alias("last_game"),
    )


def _seasonal_sums(assignments: DataFrame, played: DataFrame) -> DataFrame:
    """Whole-number sums per official and season; careers are sums of these few rows."""
    totals = played.select(
        "game_id", "game_date", "season", *_game_totals(played),
        as_units("game_pace", 1).alias("pace_tenths"),
    )
    rows = by_official(totals, assignments)
    return rows.groupBy("referee_id", "season").agg(
        F.count("*").alias("games"),
        *[F.sum(name).alias(name) for name in (*GAME_TOTALS, "home_win", "pace_tenths")],
        F.count("pace_tenths").alias("paced"),
        F.min("game_date").alias("first_game"),
        F.max("game_date").alias("last_game"),
    )


def _means(prefix: str) -> list[Column]:
    mean = lambda total, n, digits: round_half_up(ratio(total, n), digits)
    return [
        F.col("games").alias(f"{prefix}_games"),
        *[mean(name, "games", 1).alias(f"{prefix}_avg_{name}") for name in GAME_TOTALS],
        round_half_up(ratio("pace_tenths", "paced") / 10.0, 1).alias(f"{prefix}_avg_pace"),
        mean("home_win", "games", 3).alias(f"{prefix}_home_win_pct"),
    ]


def season_summary(assignments: DataFrame, played: DataFrame) -> DataFrame:
    return _seasonal_sums(assignments, played).select("referee_id", "season", *_means("season"))


def _distance_label(column: str, high: str, low: str, middle: str) -> Column:
    value, mean = F.col(column), F.col(f"{column}_mean")
    return (
        F.when(value >= mean + LABEL_DISTANCE, F.lit(high))
        .when(value <= mean - LABEL_DISTANCE, F.lit(low))
        .otherwise(F.lit(middle))
    )


def official_summary(assignments: DataFrame, played: DataFrame, referees: DataFrame) -> DataFrame:
    """Career, latest season, distance from the league mean and labels, one row per official."""
    sums = _seasonal_sums(assignments, played)
    added = (*GAME_TOTALS, "home_win", "pace_tenths", "games", "paced")
    career = (
        sums.groupBy("referee_id")
        .agg(
            *[F.sum(name).alias(name) for name in added],
            F.min("first_game").alias("first_game"),
            F.max("last_game").alias("last_game"),
        )
        .select("referee_id", *_means("career"), "first_game", "last_game")
    )
    latest = newest_per_key(sums, ["referee_id"], [F.col("season").desc()]).select(
        "referee_id", F.col("season").alias("current_season"), *_means("season")
    )
    both = career.join(latest, "referee_id").join(referees, "referee_id", "left")
    compared = {
        "career_avg_total_points": "pts_vs_league_avg",
        "career_avg_total_fouls": "fouls_vs_league_avg",
        "career_avg_pace": "pace_vs_league_avg",
        "season_avg_total_points": "season_pts_vs_league_avg",
        "season_avg_total_fouls": "season_fouls_vs_league_avg",
        "season_avg_pace": "season_pace_vs_league_avg",
    }
    measured = versus_population(both, list(compared), carries=1)
    return measured.withColumns({
        **{
            output: round_half_up(F.col(column) - F.col(f"{column}_mean"), 1)
            for column, output in compared.items()
        },
        "foul_tendency_label": _distance_label(
            "season_avg_total_fouls", "whistle_happy", "let_them_play", "average"
        ),
        "home_bias_label": bucketize("season_home_win_pct", HOME_BIAS_STEPS, "neutral"),
        "pace_tendency_label": _distance_label(
            "season_avg_pace", "fast_pace", "slow_pace", "average_pace"
        ),
        "sample_size_label": bucketize("season_games", SAMPLE_STEPS, "insufficient"),
    }).drop(*[f"{column}_mean" for column in compared]).withColumnRenamed("full_name", "referee_name")


def _season_weight(age: Column) -> Column:
    chain = F
    for years, weight in SEASON_WEIGHTS.items():
        chain = chain.when(age == years, F.lit(weight))
    return chain.otherwise(F.lit(0)).cast("bigint")


# What a season of a team under an official adds up to: whole numbers, so that states merge in any order.
_ADDED = (
    "games", "effect", "effect_squares", "wins", "known", "points", "allowed", "home_games", "home_wins",
)
STATE_SCHEMA = T.StructType([
    T.StructField("team_id", T.StringType()), T.StructField("referee_id", T.StringType()),
    T.StructField("season", T.LongType()), *[T.StructField(name, T.LongType()) for name in _ADDED],
])


def season_states(rolling: DataFrame, assignments: DataFrame) -> DataFrame:
    """One row per team, official and season: moments of its games, to be merged and weighted later.

    ``rolling`` holds team games with ``win_pct_last10``. The effect of a game is its win minus that
    share (which includes the game), in thousandths; ``known`` is the sum of the shares.
    """
    rows = by_official(
        rolling.select(
            "team_id", "game_id", "season", "home_away", "win", "team_points", "opp_points",
            "win_pct_last10",
        ),
        assignments,
    )
    expected = as_units(F.coalesce("win_pct_last10", F.lit(EVEN_CHANCE)), 3)
    effect, home = F.col("win") * 1000 - expected, F.col("home_away") == "home"
    return rows.groupBy("team_id", "referee_id", "season").agg(
        F.count("*").alias("games"),
        F.sum(effect).alias("effect"),
        F.sum(effect * effect).alias("effect_squares"),
        F.sum("win").alias("wins"),
        F.sum(as_units("win_pct_last10", 3)).alias("known"),
        F.sum("team_points").alias("points"),
        F.sum("opp_points").alias("allowed"),
        F.count_if(home).alias("home_games"),
        F.sum(F.when(home, F.col("win")).otherwise(F.lit(0).cast("bigint"))).alias("home_wins"),
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """The states of the games of all inputs together, which must not share a game."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy("team_id", "referee_id", "season").agg(*[F.sum(name).alias(name) for name in _ADDED])


def publish_states(states: DataFrame, path: str) -> int:
    """Publish the states of whole seasons; those of other seasons stay as they are.

    A season is replaced, not added to, so that publishing it again changes nothing.
    """
    return replace_table(states, path, "season")


def read_states(spark: SparkSession, path: str, seasons: Sequence[int] | None = None) -> DataFrame:
    """Published states; of given seasons only their folders are read."""
    parts = None if seasons is None else [f"season={season}" for season in seasons]
    return read_version(spark, path, STATE_SCHEMA, parts)


def team_official_effect(
    rolling: DataFrame, assignments: DataFrame, season_now: Season
) -> DataFrame:
    """Season-weighted record of each team under each official.

    ``rolling`` holds team games with ``win_pct_last10``. Only games of the current season and those
    before it that have a weight count.
    """
    recent = _weighted_seasons(rolling, season_now).drop("_age")
    return effect_of_states(season_states(recent, assignments), season_now)


def _weighted_seasons(rows: DataFrame, season_now: Season) -> DataFrame:
    aged = with_season_age(rows, season_now, "_age")
    return aged.where(F.col("_age").between(min(SEASON_WEIGHTS), max(SEASON_WEIGHTS)))


def effect_of_states(states: DataFrame, season_now: Season) -> DataFrame:
    """The season-weighted record of each team under each official from its season states.

    A weight belongs to a season, so sums are weighted after the games were added up. All sums are of
    whole numbers (weights in hundredths, shares in thousandths), so that they do not depend on the
    order of the rows.
    """
    weighed = _weighted_seasons(states, season_now).withColumns({
        "_weight": _season_weight(F.col("_age")),
        "_now": F.col("_age") == 0,
    })
    weighted = lambda column: F.sum(F.col(column) * F.col("_weight"))
    of_now = lambda column: F.sum(F.when(F.col("_now"), F.col(column)))
    sums = weighed.groupBy("team_id", "referee_id").agg(
        F.sum("games").alias("games_with_referee"),
        F.coalesce(of_now("games"), F.lit(0).cast("bigint")).alias("current_season_games"),
        of_now("wins").alias("_now_wins"),
        weighted("games").alias("_weight"),
        weighted("effect").alias("_effect"),
        F.sum("effect").alias("_effect_sum"),
        F.sum("effect_squares").alias("_effect_squares"),
        weighted("wins").alias("_wins"),
        weighted("known").alias("_expected"),
        weighted("points").alias("_points"),
        weighted("allowed").alias("_allowed"),
        F.sum("home_games").alias("home_games"),
        F.sum("home_wins").alias("home_wins"),
    )
    per_weight = lambda column, scale, digits: round_half_up(
        ratio(column, F.col("_weight")) / scale, digits
    )
    season_share = round_half_up(ratio("_now_wins", "current_season_games"), 3)
    exact = lambda column: F.col(column).cast("decimal(19,0)")
    spread = (
        exact("games_with_referee") * exact("_effect_squares")
        - exact("_effect_sum") * exact("_effect_sum")
    ).cast("double")
    degrees = F.col("games_with_referee") * (F.col("games_with_referee") - 1)
    deviation = F.sqrt(ratio(spread, degrees)) / 1000.0
    return sums.select(
        "team_id", "referee_id", "games_with_referee", "current_season_games",
        per_weight("_effect", 1000.0, 3).alias("weighted_ref_effect"),
        # The published name says effect; the value is the season's win share.
        season_share.alias("current_season_ref_effect"),
        round_half_up(deviation, 3).alias("ref_effect_stddev"),
        per_weight("_wins", 1.0, 3).alias("weighted_win_pct"),
        season_share.alias("current_season_win_pct"),
        per_weight("_expected", 1000.0, 3).alias("avg_expected_win_pct"),
        per_weight("_points", 1.0, 1).alias("avg_points_scored"),
        per_weight("_allowed", 1.0, 1).alias("avg_points_allowed"),
        per_weight(F.col("_points") - F.col("_allowed"), 1.0, 1).alias("avg_point_differential"),
        "home_games", "home_wins",
        round_half_up(ratio("home_wins", "home_games"), 3).alias("home_win_pct"),
    )
