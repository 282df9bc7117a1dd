"""Fixed values of the rules, stated a second time for the comparison SQL.

Nothing here comes from the package: a mistake there shows as a difference.
"""

# Spelling rules of player names, in the order of the two feeds.
LETTERS = [
    ('ņ', 'n'),
    ('ģ', 'g'),
    ('[čć]|Ä\x87|Ä\x8d', 'c'),
    ('[šŠ]|Å¡', 's'),
    ('[žŽ]|Å¾', 'z'),
    ('[đĐ]|Ä\x91', 'd'),
    ('[şŞ]', 's'),
    ('[üÜ]', 'u'),
    ('[öÖ]', 'o'),
    ('[çÇ]', 'c'),
    ('[ğĞ]', 'g'),
    ('[ıİ]', 'i'),
    ('[àáâãäåÀÁÂÃÄÅ]', 'a'),
    ('[èéêëÈÉÊË]', 'e'),
]
BROKEN_LETTERS = [
    ('Å', 'S'),
    ('Ã¼', 'u'),
]
NAME_RULES = {
    "box_score": [*BROKEN_LETTERS, *LETTERS, (r"[^\x00-\x7F]", "")],
    "injury": [*LETTERS, *BROKEN_LETTERS, (r"[^\x00-\x7F]", "")],
}
GENERATION = r"\s+(III|II|IV|V|II)\z"

# Short names of the team box score.
SHORT_BOX = {
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
PERIOD_LABELS = [
    "Q1",
    "Q2",
    "Q3",
    "Q4",
    "OT1",
    "OT2",
]

# Insight columns, those of picks first.
PICK_TEXTS = [
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
MORE_TEXTS = [
    "home_player_ref_boost_insight",
    "home_player_ref_suppress_insight",
    "away_player_ref_boost_insight",
    "away_player_ref_suppress_insight",
    "home_hot_insight",
    "home_cold_insight",
    "away_hot_insight",
    "away_cold_insight",
]
PREVIEW_TEXTS = PICK_TEXTS + MORE_TEXTS

# Published preview columns, in table order.
PUBLISHED = [
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
