"""Raw tables to clean tables: projection, casts, cleaning, newest version."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.functions.text import clock_to_minutes, normalize_name, season_end_year
from courtside.operators.keyed import newest_per_key
from courtside.sources.schemas import COUNTS, REBOUNDS, SHOOTING

_ODDS = [
    "game_date", "season", "home_team", "away_team", "over_under", "home_line",
    "home_moneyline", "away_moneyline", "odds_api_game_id", "captured_at",
]


def games(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", "game_date", season_end_year("season").alias("season"),
        "home_team_id", "away_team_id", "arena_id", "tipoff_time", "loaded_at",
    )


def game_results(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", "home_score", "away_score", "overtime_flag", "overtime_periods", "loaded_at"
    )


def team_game_stats(raw: DataFrame) -> DataFrame:
    total = F.col("offensive_rebounds") + F.col("defensive_rebounds")
    return raw.select(
        "game_id", "team_id", "home_away", *SHOOTING, *REBOUNDS, total.alias("total_rebounds"),
        *COUNTS, "points", "loaded_at",
    )


def team_quarter_stats(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", "team_id", "home_away", "quarter", *SHOOTING, *REBOUNDS, *COUNTS, "points",
        "loaded_at",
    )


def player_game_stats(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_id", normalize_name("player_name", "box_score").alias("player_name"), "team_id",
        "starter", clock_to_minutes("minutes").alias("minutes_played"),
        "points", "rebounds", *COUNTS, *SHOOTING, "plus_minus", "loaded_at",
    )


def player_quarter_stats(raw: DataFrame, clean_names: bool = False) -> DataFrame:
    """Names stay as delivered unless asked for, so accented names do not meet the box scores'."""
    name = normalize_name("player_name", "box_score") if clean_names else F.col("player_name")
    return raw.select(
        "game_id", name.alias("player_name"), "team_id", "quarter", "minutes", "points",
        *REBOUNDS, *COUNTS, *SHOOTING, "plus_minus", "loaded_at",
    )


def referee_assignments(raw: DataFrame) -> DataFrame:
    slots = [F.col(f"referee_{i}").cast("string").alias(f"referee_{i}") for i in (1, 2, 3)]
    return raw.select("game_id", *slots, "loaded_at")


def broadcast_schedule(raw: DataFrame) -> DataFrame:
    return raw.select("game_date", "game_id", "is_national_broadcast", "loaded_at")


def betting_lines(raw: DataFrame) -> DataFrame:
    return raw.select(
        "game_date", "season", "home_team", "away_team", "over_under", "home_line", "loaded_at"
    )


def opening_lines(raw: DataFrame) -> DataFrame:
    return raw.select(*_ODDS)


def closing_lines(raw: DataFrame) -> DataFrame:
    return raw.select(*_ODDS)


def injuries(raw: DataFrame) -> DataFrame:
    """Newest scrape per day, team and player; the name is cleaned afterwards."""
    newest = newest_per_key(
        raw.select(
            "game_date", "game_time", "matchup", "team_id", "player_name", "status", "reason",
            "pdf_url", "scraped_at",
        ),
        ["game_date", "team_id", "player_name"],
        [F.col("scraped_at").desc(), F.col("pdf_url").desc()],
    )
    return newest.withColumn("player_name", normalize_name("player_name", "injury"))


def dim_arenas(raw: DataFrame) -> DataFrame:
    return raw.select("arena_id", "city", "latitude", "longitude", "altitude_feet", "timezone")


def dim_referees(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("referee_id").cast("string").alias("referee_id"), "full_name")
