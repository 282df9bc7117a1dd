"""Records between two teams, whichever one was at home."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from courtside.functions.numeric import greatest_or_null, least_or_null, one_if

TIE_RULES = ("team_b", "nobody")


def with_pair_key(games: DataFrame) -> DataFrame:
    teams = ("home_team_id", "away_team_id")
    return games.withColumns(
        {"team_a": least_or_null(*teams), "team_b": greatest_or_null(*teams)}
    )


def pair_record(games: DataFrame, tie_rule: str = "team_b") -> DataFrame:
    """Games, wins of either team, first and last meeting of each pair.

    With ``tie_rule="team_b"`` every game team_a did not win counts for team_b, equal scores
    included; with ``"nobody"`` equal scores count for neither.
    """
    if tie_rule not in TIE_RULES:
        raise ValueError(f"tie_rule must be one of {TIE_RULES}")
    a_home = F.col("home_team_id") == F.col("team_a")
    home_won = F.col("home_points") > F.col("away_points")
    away_won = F.col("away_points") > F.col("home_points")
    a_won = one_if((a_home & home_won) | (~a_home & away_won))
    b_won = one_if((a_home & away_won) | (~a_home & home_won))
    played = with_pair_key(games.where(F.col("home_points") > 0))
    return (
        played.withColumns({"_a": a_won, "_b": F.lit(1) - a_won if tie_rule == "team_b" else b_won})
        .groupBy("team_a", "team_b")
        .agg(
            F.count("*").alias("games_played"),
            F.sum("_a").alias("team_a_wins"),
            F.sum("_b").alias("team_b_wins"),
            F.avg("_a").alias("team_a_share"),
            F.max("game_date").alias("last_meeting"),
            F.min("game_date").alias("first_meeting"),
        )
    )
