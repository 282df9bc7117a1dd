"""The game card: every feature of a scheduled game on one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from courtside.operators.keyed import Season, in_season, with_flag
from courtside.operators.pairs import pair_record, with_pair_key
from courtside.operators.shape import SIDES
from courtside.plans import teams
from courtside.sources.schemas import PERIODS

# Column groups of the card, in table order.
GAME = ["game_id", "game_date", "season", "arena_id", "tipoff_time", "home_team_id", "away_team_id"]
SCORES = [
    "home_points", "away_points", "point_differential", "winner_team_id", "winner_home_away",
    "total_points",
]
QUARTERS = [f"{side}_pts_{period.lower()}" for side in SIDES for period in PERIODS]
PACE = ["home_possessions", "away_possessions", "game_pace", "overtime_periods"]
REST = ["home_days_rest", "away_days_rest", "rest_advantage"]
TRAVEL = ["home_travel_miles", "away_travel_miles", "travel_advantage"]
ZONES = ["home_timezone_shift", "away_timezone_shift", "timezone_lag_advantage"]
ALTITUDE = [
    "home_arena_altitude", "away_arena_altitude", "home_altitude_change", "away_altitude_change",
    "altitude_fatigue_advantage",
]
CREW_CHIEF = {
    "games_officiated": "crew_chief_games",
    "avg_total_fouls": "crew_chief_avg_fouls",
    "avg_total_fta": "crew_chief_avg_fta",
    "avg_total_points": "crew_chief_avg_total_points",
    "home_win_pct": "crew_chief_home_win_pct",
}
PACE_RECORD = [
    f"{prefix}_{part}"
    for prefix in teams.PACE_PREFIXES.values()
    for part in ("games", "wins", "win_pct")
]


def team_profile(rows: DataFrame, season_now: Season) -> DataFrame:
    """What the card shows of a team, one narrow row per team, so that a card joins it twice."""
    season = teams.season_profile(rows, season_now).drop("games_played")
    return (
        teams.current_rolling(rows)
        .join(teams.current_streak(rows), "team_id")
        .join(season, "team_id", "left")
    )


def season_pairs(scores: DataFrame, season_now: Season) -> DataFrame:
    """Meetings of each pair in the current season; equal scores count for neither."""
    record = pair_record(in_season(scores, season_now), tie_rule="nobody")
    return record.select(
        "team_a", "team_b", F.col("games_played").alias("h2h_games"), "team_a_wins", "team_b_wins",
        F.col("last_meeting").alias("h2h_last_meeting"),
    )


def crew_chiefs(tendencies: DataFrame) -> DataFrame:
    return tendencies.select(
        F.col("referee_id").alias("referee_1"),
        *[F.col(source).alias(name) for source, name in CREW_CHIEF.items()],
    )


def game_card(
    games: DataFrame,
    played: DataFrame,
    broadcasts: DataFrame,
    features: DataFrame,
    rows: DataFrame,
    season_now: Season,
    assignments: DataFrame,
    tendencies: DataFrame,
    official_effect: DataFrame,
    shared: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """One row per scheduled game, played or not.

    Tables by game meet on the game id. Team, pair and official tables are aggregated to one row
    per key; adaptive execution broadcasts those that turn out small and splits hot keys of others.
    ``shared`` may write a table (with a name) once: profile and effect are joined twice, and the sizes
    of all four are then known before the card's wide rows would be shuffled by their keys.
    """
    profile = shared(team_profile(rows, season_now), "profile")
    pairs = shared(season_pairs(played, season_now), "pairs")
    chiefs = shared(crew_chiefs(tendencies), "chiefs")
    effect = official_effect.select("team_id", "referee_id", "games_with_referee", "weighted_ref_effect")
    effect = shared(effect, "effect")

    scored = with_flag(played, broadcasts, "game_id", "is_national_broadcast")
    results = scored.select(
        "game_id", "is_national_broadcast", *SCORES, *QUARTERS, *_derived(), *PACE
    )
    card = (
        games.select(*GAME)
        .join(results, "game_id", "left")
        .join(features.select("game_id", *REST, *ZONES, *ALTITUDE, *TRAVEL), "game_id", "left")
        .join(assignments.select("game_id", "referee_1", "referee_2", "referee_3"), "game_id", "left")
    )
    for side in SIDES:
        card = card.join(_side_profile(profile, side), f"{side}_team_id", "left")
    card = with_pair_key(card).join(pairs, ["team_a", "team_b"], "left")
    card = card.join(chiefs, "referee_1", "left")
    for side in SIDES:
        card = card.join(_side_effect(effect, side), [f"{side}_team_id", "referee_1"], "left")

    home_is_a = F.col("home_team_id") == F.col("team_a")
    wins = (F.col("team_a_wins"), F.col("team_b_wins"))
    return card.withColumns({
        "h2h_home_wins": F.when(home_is_a, wins[0]).otherwise(wins[1]),
        "h2h_away_wins": F.when(F.col("away_team_id") == F.col("team_a"), wins[0]).otherwise(wins[1]),
    }).drop("team_a", "team_b", "team_a_wins", "team_b_wins")


def _derived():
    total = lambda side: sum((F.col(f"{side}_pts_q{i}") for i in (2, 3)), F.col(f"{side}_pts_q1"))
    return [
        (F.col("home_pts_q4") - F.col("away_pts_q4")).alias("q4_margin"),
        (total("home") - total("away")).alias("margin_entering_q4"),
    ]


def _side_profile(profile: DataFrame, side: str) -> DataFrame:
    names = {
        "team_id": f"{side}_team_id",
        "wins": f"{side}_wins",
        "losses": f"{side}_losses",
        "win_pct": f"{side}_win_pct",
        "streak_label": f"{side}_streak_label",
        "streak_length": f"{side}_streak_length",
        **{c: f"{side}_{c}" for c in (*teams.ROLLING_COLUMNS, *PACE_RECORD)},
    }
    return profile.select(*[F.col(source).alias(name) for source, name in names.items()])


def _side_effect(effect: DataFrame, side: str) -> DataFrame:
    return effect.select(
        F.col("team_id").alias(f"{side}_team_id"),
        F.col("referee_id").alias("referee_1"),
        F.col("games_with_referee").alias(f"{side}_games_with_crew_chief"),
        # The published name says win share; the value is the weighted effect.
        F.col("weighted_ref_effect").alias(f"{side}_win_pct_with_crew_chief"),
    )
