"""Explicit schemas of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _struct(*columns: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


# Column names of the box scores.
SHOOTING = [
    "field_goals_made",
    "field_goals_attempted",
    "three_pointers_made",
    "three_pointers_attempted",
    "free_throws_made",
    "free_throws_attempted",
]
REBOUNDS = ["offensive_rebounds", "defensive_rebounds"]
COUNTS = ["assists", "steals", "blocks", "turnovers", "personal_fouls"]
TEAM_BOX = [*SHOOTING, *REBOUNDS, *COUNTS, "points"]

# Short names of the team box score in the wide game.
WIDE_BOX = {
    "points": "points",
    "field_goals_made": "fgm",
    "field_goals_attempted": "fga",
    "three_pointers_made": "3pm",
    "three_pointers_attempted": "3pa",
    "free_throws_made": "ftm",
    "free_throws_attempted": "fta",
    "offensive_rebounds": "oreb",
    "defensive_rebounds": "dreb",
    "assists": "ast",
    "steals": "stl",
    "blocks": "blk",
    "turnovers": "tov",
    "personal_fouls": "pf",
}

# Period labels.
PERIODS = ["Q1", "Q2", "Q3", "Q4", "OT1", "OT2"]

# Insight texts of a scored game, in display order.
PICK_INSIGHTS = [
    "home_injury_insight",
    "away_injury_insight",
    "pace_insight",
    "form_insight",
    "margin_insight",
    "quality_insight",
    "timezone_insight",
    "streak_insight",
    "home_returning_insight",
    "away_returning_insight",
    "away_form_insight",
    "rest_insight",
    "ref_bias_insight",
    "home_ref_insight",
    "away_ref_insight",
    "home_ref_ats_insight",
    "away_ref_ats_insight",
    "ou_insight",
    "utah_insight",
    "blowout_insight",
]
PREVIEW_INSIGHTS = [
    *PICK_INSIGHTS,
    "home_player_ref_boost_insight",
    "home_player_ref_suppress_insight",
    "away_player_ref_boost_insight",
    "away_player_ref_suppress_insight",
    "home_hot_insight",
    "home_cold_insight",
    "away_hot_insight",
    "away_cold_insight",
]

# Columns and types of the raw tables, in table order.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "games": _struct(
        ("game_id", "string"),
        ("game_date", "date"),
        ("season", "string"),
        ("home_team_id", "string"),
        ("away_team_id", "string"),
        ("arena_id", "long"),
        ("tipoff_time", "string"),
        ("loaded_at", "timestamp"),
    ),
    "game_results": _struct(
        ("game_id", "string"),
        ("home_score", "long"),
        ("away_score", "long"),
        ("overtime_flag", "boolean"),
        ("overtime_periods", "long"),
        ("loaded_at", "timestamp"),
    ),
    "team_game_stats": _struct(
        ("game_id", "string"),
        ("team_id", "string"),
        ("home_away", "string"),
        ("field_goals_made", "long"),
        ("field_goals_attempted", "long"),
        ("three_pointers_made", "long"),
        ("three_pointers_attempted", "long"),
        ("free_throws_made", "long"),
        ("free_throws_attempted", "long"),
        ("offensive_rebounds", "long"),
        ("defensive_rebounds", "long"),
        ("assists", "long"),
        ("steals", "long"),
        ("blocks", "long"),
        ("turnovers", "long"),
        ("personal_fouls", "long"),
        ("points", "long"),
        ("loaded_at", "timestamp"),
    ),
    "player_game_stats": _struct(
        ("game_id", "string"),
        ("player_name", "string"),
        ("team_id", "string"),
        ("starter", "boolean"),
        ("minutes", "string"),
        ("points", "long"),
        ("rebounds", "long"),
        ("assists", "long"),
        ("steals", "long"),
        ("blocks", "long"),
        ("turnovers", "long"),
        ("personal_fouls", "long"),
        ("field_goals_made", "long"),
        ("field_goals_attempted", "long"),
        ("three_pointers_made", "long"),
        ("three_pointers_attempted", "long"),
        ("free_throws_made", "long"),
        ("free_throws_attempted", "long"),
        ("plus_minus", "long"),
        ("loaded_at", "timestamp"),
    ),
    "team_quarter_stats": _struct(
        ("game_id", "string"),
        ("team_id", "string"),
        ("home_away", "string"),
        ("quarter", "string"),
        ("field_goals_made", "long"),
        ("field_goals_attempted", "long"),
        ("three_pointers_made", "long"),
        ("three_pointers_attempted", "long"),
        ("free_throws_made", "long"),
        ("free_throws_attempted", "long"),
        ("offensive_rebounds", "long"),
        ("defensive_rebounds", "long"),
        ("assists", "long"),
        ("steals", "long"),
        ("blocks", "long"),
        ("turnovers", "long"),
        ("personal_fouls", "long"),
        ("points", "long"),
        ("loaded_at", "timestamp"),
    ),
    "player_quarter_stats": _struct(
        ("game_id", "string"),
        ("player_name", "string"),
        ("team_id", "string"),
        ("quarter", "string"),
        ("minutes", "string"),
        ("points", "long"),
        ("offensive_rebounds", "long"),
        ("defensive_rebounds", "long"),
        ("assists", "long"),
        ("steals", "long"),
        ("blocks", "long"),
        ("turnovers", "long"),
        ("personal_fouls", "long"),
        ("field_goals_made", "long"),
        ("field_goals_attempted", "long"),
        ("three_pointers_made", "long"),
        ("three_pointers_attempted", "long"),
        ("free_throws_made", "long"),
        ("free_throws_attempted", "long"),
        ("plus_minus", "long"),
        ("loaded_at", "timestamp"),
    ),
    "referee_assignments": _struct(
        ("game_id", "string"),
        ("referee_1", "string"),
        ("referee_2", "string"),
        ("referee_3", "string"),
        ("loaded_at", "timestamp"),
    ),
    "broadcast_schedule": _struct(
        ("game_date", "date"),
        ("game_id", "string"),
        ("is_national_broadcast", "boolean"),
        ("loaded_at", "timestamp"),
    ),
    "betting_lines": _struct(
        ("game_date", "date"),
        ("season", "string"),
        ("home_team", "string"),
        ("away_team", "string"),
        ("over_under", "double"),
        ("home_line", "double"),
        ("loaded_at", "timestamp"),
    ),
    "opening_lines": _struct(
        ("game_date", "date"),
        ("season", "string"),
        ("home_team", "string"),
        ("away_team", "string"),
        ("over_under", "double"),
        ("home_line", "double"),
        ("home_moneyline", "double"),
        ("away_moneyline", "double"),
        ("odds_api_game_id", "string"),
        ("captured_at", "timestamp"),
    ),
    "closing_lines": _struct(
        ("game_date", "date"),
        ("season", "string"),
        ("home_team", "string"),
        ("away_team", "string"),
        ("over_under", "double"),
        ("home_line", "double"),
        ("home_moneyline", "double"),
        ("away_moneyline", "double"),
        ("odds_api_game_id", "string"),
        ("captured_at", "timestamp"),
    ),
    "injuries": _struct(
        ("game_date", "date"),
        ("game_time", "string"),
        ("matchup", "string"),
        ("team_id", "string"),
        ("player_name", "string"),
        ("status", "string"),
        ("reason", "string"),
        ("pdf_url", "string"),
        ("scraped_at", "timestamp"),
    ),
    "dim_arenas": _struct(
        ("arena_id", "long"),
        ("city", "string"),
        ("latitude", "double"),
        ("longitude", "double"),
        ("altitude_feet", "long"),
        ("timezone", "string"),
    ),
    "dim_referees": _struct(
        ("referee_id", "long"),
        ("full_name", "string"),
    ),
    "scored_games": _struct(
        ("game_date", "date"),
        ("home_team_id", "string"),
        ("away_team_id", "string"),
        ("tipoff_time", "string"),
        ("inserted_at", "timestamp"),
        ("is_national_broadcast", "boolean"),
        ("composite_score", "double"),
        ("model_vs_market", "double"),
        ("model_vs_line", "double"),
        ("model_total", "double"),
        ("overall_lean", "string"),
        ("market_divergence", "string"),
        ("total_insight", "string"),
        ("spread_home", "double"),
        ("over_under", "double"),
        ("home_record", "string"),
        ("away_record", "string"),
        ("crew_chief_name", "string"),
        ("home_injury_insight", "string"),
        ("away_injury_insight", "string"),
        ("pace_insight", "string"),
        ("form_insight", "string"),
        ("margin_insight", "string"),
        ("quality_insight", "string"),
        ("timezone_insight", "string"),
        ("streak_insight", "string"),
        ("home_returning_insight", "string"),
        ("away_returning_insight", "string"),
        ("away_form_insight", "string"),
        ("rest_insight", "string"),
        ("ref_bias_insight", "string"),
        ("home_ref_insight", "string"),
        ("away_ref_insight", "string"),
        ("home_ref_ats_insight", "string"),
        ("away_ref_ats_insight", "string"),
        ("ou_insight", "string"),
        ("utah_insight", "string"),
        ("blowout_insight", "string"),
        ("home_player_ref_boost_insight", "string"),
        ("home_player_ref_suppress_insight", "string"),
        ("away_player_ref_boost_insight", "string"),
        ("away_player_ref_suppress_insight", "string"),
        ("home_hot_insight", "string"),
        ("home_cold_insight", "string"),
        ("away_hot_insight", "string"),
        ("away_cold_insight", "string"),
    ),
    "model_tracker": _struct(
        ("game_date", "date"),
        ("home_team_id", "string"),
        ("away_team_id", "string"),
        ("scored_at", "timestamp"),
        ("divergence_strength", "string"),
        ("signal_strength", "string"),
        ("ou_signal_strength", "string"),
        ("divergence_correct", "boolean"),
        ("model_ou_correct", "boolean"),
        ("model_vs_market", "double"),
        ("model_vs_line", "double"),
        ("spread_home", "double"),
        ("over_under", "double"),
        ("actual_margin", "long"),
        ("actual_total", "long"),
    ),
    "game_previews": _struct(
        ("game_date", "date"),
        ("home_team_id", "string"),
        ("away_team_id", "string"),
        ("tipoff_time", "string"),
        ("is_free_game", "boolean"),
        ("composite_score", "double"),
        ("overall_lean", "string"),
        ("market_divergence", "string"),
        ("model_vs_market", "double"),
        ("total_insight", "string"),
        ("spread_home", "double"),
        ("over_under", "double"),
        ("preview_text", "string"),
        ("posted_substack", "boolean"),
        ("posted_reddit", "boolean"),
        ("generated_at", "timestamp"),
    ),
}

# Columns of the published previews, in table order.
PREVIEW_COLUMNS = [
    "game_date",
    "home_team_id",
    "away_team_id",
    "tipoff_time",
    "is_free_game",
    "composite_score",
    "overall_lean",
    "market_divergence",
    "model_vs_market",
    "total_insight",
    "spread_home",
    "over_under",
    "preview_text",
    "posted_substack",
    "posted_reddit",
    "generated_at",
]

#: What tells the rows of a raw table apart; joins take it for granted. Injuries and odds come in versions.
RAW_KEYS: dict[str, list[str]] = {
    "games": ["game_id"],
    "game_results": ["game_id"],
    "team_game_stats": ["game_id", "home_away"],
    "player_game_stats": ["game_id", "team_id", "player_name"],
    "team_quarter_stats": ["game_id", "home_away", "quarter"],
    "player_quarter_stats": ["game_id", "team_id", "player_name", "quarter"],
    "referee_assignments": ["game_id"],
    "broadcast_schedule": ["game_id"],
    "dim_arenas": ["arena_id"],
    "dim_referees": ["referee_id"],
    "scored_games": ["game_date", "home_team_id", "away_team_id", "inserted_at"],
}
#: Raw tables with rows by game, which meet on the game id.
GAME_FACTS = [name for name, schema in RAW_SCHEMAS.items() if "game_id" in schema.names]
