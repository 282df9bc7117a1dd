"""Comparison SQL by query name."""

from __future__ import annotations

from checks.league_sql import (
    LIBRARY, MODELS, NEWEST_VERSION, PLAYER_QUARTER_MEANS, RAW, TEAM_QUARTER_MEANS, strengths,
)
from checks.sql_tools import assemble, listed, named, one_decimal, plus_signed, rounded
from checks.rules import (
    GENERATION, NAME_RULES, PICK_TEXTS as PICK_INSIGHTS, PREVIEW_TEXTS as PREVIEW_INSIGHTS, PUBLISHED as PREVIEW_COLUMNS,
)

# Days that the smallest tables reach as well: the last day with scored games there, and the end of that week.
SCORE_DAY = "2024-01-03"
RECAP_DAY = "2024-01-07"
RETURN_DAY = "2001-07-28"


def _normalized(text: str, profile: str) -> str:
    quote = lambda value: "'" + value.replace("'", "''") + "'"
    cleaned = text
    for pattern, replacement in [*NAME_RULES[profile], (GENERATION, "")]:
        cleaned = f"regexp_replace({cleaned}, {quote(pattern)}, {quote(replacement)}, 'g')"
    breaks = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""
    tokens = f"regexp_extract_all({cleaned}, {quote(f'[{breaks}]|[^{breaks}]+')})"
    return f"array_to_string(list_transform({tokens}, lambda t: concat(upper(t[1]), lower(t[2:]))), '')"


_edge, _line = "coalesce(model_vs_market, 0)", "coalesce(model_vs_line, 0)"
_away_line = (
    f"CASE WHEN spread_home > 0 THEN concat('-', {one_decimal('abs(spread_home)')}) "
    f"WHEN spread_home < 0 THEN concat('+', {one_decimal('abs(spread_home)')}) "
    f"ELSE {one_decimal('spread_home')} END"
)


def _total_side(suffix: str) -> str:
    return (
        f"concat(CASE WHEN {_line} >= 5 THEN 'OVER' ELSE 'UNDER' END, ' (~', "
        f"{one_decimal(f'abs({_line})')}, '{suffix})')"
    )


# Raw tables and what tells their rows apart.
_ROW_KEYS = {
    "games": "game_id", "game_results": "game_id", "team_game_stats": "game_id, home_away",
    "player_game_stats": "game_id, team_id, player_name", "team_quarter_stats": "game_id, home_away, quarter",
    "player_quarter_stats": "game_id, team_id, player_name, quarter", "referee_assignments": "game_id",
    "broadcast_schedule": "game_id", "dim_arenas": "arena_id", "dim_referees": "referee_id",
    "scored_games": "game_date, home_team_id, away_team_id, inserted_at",
}
_KEY_REPORT = " UNION ALL ".join(
    f"""
SELECT '{table}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count, count(*) FILTER (WHERE known) AS key_count,
  count(*) FILTER (WHERE known AND n > 1) AS repeated_keys, CAST(coalesce(sum(n) FILTER (WHERE NOT known), 0) AS BIGINT) AS rows_without_key
FROM (SELECT count(*) AS n, {' AND '.join(f'{key} IS NOT NULL' for key in keys.split(', '))} AS known FROM x_{table} GROUP BY {keys})"""
    for table, keys in _ROW_KEYS.items()
)

_SIDES = named({
    "spread_pick_side": f"CASE WHEN {_edge} >= 1e-1 THEN 'HOME' ELSE 'AWAY' END",
    "spread_pick_team": f"CASE WHEN {_edge} >= 1e-1 THEN home_team_id ELSE away_team_id END",
    "spread_pick_line": f"CASE WHEN {_edge} >= 1e-1 THEN {plus_signed('spread_home')} ELSE {_away_line} END",
    "total_pick": _total_side(""),
})
_FLAGS = named({
    "total_flag": f"""CASE WHEN {_line} >= 5 THEN concat('OVER — total may be low by ~', {one_decimal(f'abs({_line})')}, ' points')
    WHEN {_line} <= -5 THEN concat('UNDER — total may be high by ~', {one_decimal(f'abs({_line})')}, ' points')
    WHEN {_line} >= 3 THEN concat('SLIGHT OVER lean (~', {one_decimal(f'abs({_line})')}, ' pts)')
    WHEN {_line} <= -3 THEN concat('SLIGHT UNDER lean (~', {one_decimal(f'abs({_line})')}, ' pts)') ELSE 'FAIR' END""",
    "spread_flag": f"""CASE WHEN {_edge} >= 1e-1 THEN 'HOME EDGE — analysis meaningfully favors home team vs the line'
    WHEN {_edge} <= -1e-1 THEN 'AWAY EDGE — analysis meaningfully favors away team vs the line'
    WHEN {_edge} >= 6e-2 THEN 'SLIGHT HOME EDGE' WHEN {_edge} <= -6e-2 THEN 'SLIGHT AWAY EDGE' ELSE 'FAIR' END""",
})
_SPREAD_PICK = "divergence_strength = 'STRONG' AND signal_strength IN ('STRONG', 'MEDIUM')"
_TOTAL_PICK = "ou_signal_strength = 'STRONG'"
_PICKS = f"""
SELECT *, 'spread' AS pick_type FROM m_strengths WHERE {_SPREAD_PICK}
UNION ALL SELECT *, 'ou' FROM m_strengths WHERE {_TOTAL_PICK}"""


def _signals(fields: list[str], levels: list[str]) -> str:
    head = "substr(v, 1, 15)"
    tests = {
        "STRONG": f"contains({head}, 'STRONG')",
        "MEDIUM": f"contains({head}, 'MEDIUM') AND NOT contains({head}, 'STRONG')",
    }
    columns = {}
    for level in levels:
        kept = (
            f"list_filter([{', '.join(fields)}], lambda v: v IS NOT NULL AND v <> '' "
            f"AND NOT starts_with(v, '⚪ CONTEXT') AND {tests[level]})"
        )
        columns[f"{level.lower()}_signals"] = f"array_to_string({kept}, chr(10))"
        columns[f"{level.lower()}_count"] = f"len({kept})"
    return f"""
SELECT game_date, home_team_id, away_team_id, {named(columns)} FROM m_latest_scores"""


_TIES = "composite_score DESC, model_vs_market DESC, model_vs_line DESC, spread_home DESC, over_under DESC"
_SCORE_NAMES = [
    "tipoff_time", "is_national_broadcast", "composite_score", "model_vs_market", "model_vs_line",
    "model_total", "spread_home", "over_under", "overall_lean", "market_divergence", "total_insight",
]


def _unpublished(early: bool) -> str:
    batch = " AND CAST(split_part(tipoff_time, ':', 1) AS INTEGER) < 18" if early else ""
    return f"""
SELECT * FROM (
  SELECT * FROM x_scored_games WHERE game_date = DATE '{SCORE_DAY}'{batch}
  {NEWEST_VERSION.format(stamp='inserted_at', ties=_TIES)}) s
WHERE NOT EXISTS (SELECT 1 FROM x_game_previews p WHERE p.game_date = s.game_date
  AND p.home_team_id = s.home_team_id AND p.away_team_id = s.away_team_id)"""


_FREE = """row_number() OVER (PARTITION BY game_date ORDER BY is_national_broadcast DESC, tipoff_time,
    home_team_id, away_team_id) = 1"""
_APPENDED = {
    "posted_substack": "false", "posted_reddit": "false", "preview_text": "CAST(NULL AS VARCHAR)",
    "generated_at": "CAST(NULL AS TIMESTAMP)",
}
_PREVIEW_LIST = listed(f"{_APPENDED.get(c, c)} AS {c}" for c in PREVIEW_COLUMNS)
EXTRA = {
    "m_early": f"SELECT *, {_FREE} AS is_free_game FROM ({_unpublished(True)})",
    "m_late": f"""
SELECT *, {_FREE} AS is_free_game FROM ({_unpublished(False)}) u
WHERE NOT EXISTS (SELECT 1 FROM m_early e WHERE e.home_team_id = u.home_team_id AND e.away_team_id = u.away_team_id)""",
    "m_picks": _PICKS,
    "m_graded": f"""
SELECT *, 'spread' AS pick_type, divergence_correct AS correct FROM m_latest_grades
WHERE {_SPREAD_PICK} AND divergence_correct IS NOT NULL
UNION ALL SELECT *, 'ou', model_ou_correct FROM m_latest_grades WHERE {_TOTAL_PICK} AND model_ou_correct IS NOT NULL""",
    "m_week": f"""
SELECT CAST(sunday - 6 AS DATE) AS monday, sunday
FROM (SELECT CAST(DATE '{RECAP_DAY}' - CAST(dayofweek(DATE '{RECAP_DAY}') AS INTEGER) AS DATE) AS sunday)""",
}

_share = rounded("CASE WHEN total = 0 THEN 0e0 ELSE correct * 1e2 / total END", 1)
_RECORD = f"""
SELECT period, pick_type, correct, total,
  concat(CAST(correct AS VARCHAR), '-', CAST(total - correct AS VARCHAR), ' (',
    {one_decimal('CASE WHEN total = 0 THEN 0e0 ELSE correct * 1e2 / total END')}, '%)') AS record
FROM (SELECT k.period, k.pick_type, count(*) FILTER (WHERE g.correct) AS correct, count(g.correct) AS total
      FROM (SELECT * FROM (VALUES ('week'), ('season')) p(period), (VALUES ('spread'), ('ou')) t(pick_type), m_week) k
      LEFT JOIN m_graded g ON g.pick_type = k.pick_type
        AND (k.period = 'season' OR g.game_date BETWEEN k.monday AND k.sunday)
      GROUP BY k.period, k.pick_type)"""

_result = "CASE WHEN correct THEN '✅ WIN' WHEN NOT correct THEN '❌ LOSS' ELSE '➖ PUSH' END"
_RECAP = f"""
SELECT game_date, home_team_id, away_team_id, pick_type,
  concat(away_team_id, ' @ ', home_team_id, ' — ', CAST(game_date AS VARCHAR)) AS heading,
  CASE pick_type WHEN 'spread' THEN concat('Line: ', home_team_id, ' ', coalesce({plus_signed('spread_home')}, 'N/A'), ' | Pick: ',
      CASE WHEN {_edge} >= 1e-1 THEN concat(home_team_id, ' (HOME)') ELSE concat(away_team_id, ' (AWAY)') END,
      ' | Result: ', {_result})
    ELSE concat('Total: ', coalesce({one_decimal('over_under')}, 'N/A'), ' | Pick: ', {_total_side(' pts')}, ' | Result: ', {_result}) END AS detail,
  CASE pick_type WHEN 'spread' THEN 'Final margin: ' || CASE WHEN actual_margin >= 0 THEN '+' ELSE '' END || CAST(actual_margin AS VARCHAR)
    ELSE 'Final total: ' || CAST(actual_total AS VARCHAR) END AS final
FROM m_graded JOIN m_week ON game_date BETWEEN monday AND sunday"""

_CONTEXT_KEYS = "game_id, game_date, home_team_id, away_team_id"
_REST = f"SELECT {_CONTEXT_KEYS}, home_days_rest, away_days_rest, rest_advantage FROM m_context"
_ZONES = f"SELECT {_CONTEXT_KEYS}, home_timezone_shift, away_timezone_shift, timezone_lag_advantage FROM m_context"
_ALTITUDE = f"""
SELECT {_CONTEXT_KEYS}, home_arena_altitude, home_prev_altitude, home_altitude_change, away_arena_altitude,
  away_prev_altitude, away_altitude_change, altitude_fatigue_advantage FROM m_context"""



def _letters(name: str) -> str:
    """Names of the two feeds are compared by their letters and blanks alone."""
    return f"lower(regexp_replace({name}, '[^a-zA-Z ]', '', 'g'))"


_RETURNING = f"""
SELECT l.player_name, l.team_id, l.last_day AS last_game_date, date_diff('day', l.last_day, DATE '{RETURN_DAY}') AS days_since_last_game,
  b.pts_season_avg, b.reb_season_avg, b.ast_season_avg,
  CASE WHEN date_diff('day', l.last_day, DATE '{RETURN_DAY}') >= 30 THEN 'LONG_ABSENCE'
    WHEN date_diff('day', l.last_day, DATE '{RETURN_DAY}') >= 15 THEN 'MEDIUM_ABSENCE' ELSE 'SHORT_ABSENCE' END AS absence_tier,
  {rounded('(b.pts_season_avg - 15) / 10', 2)} AS impact_score
FROM (SELECT p.player_name, p.team_id, max(g.game_date) AS last_day
      FROM x_player_game_stats p JOIN m_games g USING (game_id)
      WHERE g.season = (SELECT season FROM m_now) GROUP BY p.player_name, p.team_id
      QUALIFY row_number() OVER (PARTITION BY p.player_name ORDER BY max(g.game_date) DESC, p.team_id) = 1) l
JOIN m_baseline b USING (player_name)
JOIN m_appearances a ON a.player_name = l.player_name AND a.team_id = l.team_id AND a.game_date = l.last_day
WHERE b.pts_season_avg >= 15 AND date_diff('day', l.last_day, DATE '{RETURN_DAY}') BETWEEN 7 AND 45
  AND EXISTS (SELECT 1 FROM m_games t WHERE t.game_date = DATE '{RETURN_DAY}' AND l.team_id IN (t.home_team_id, t.away_team_id))
  AND NOT EXISTS (SELECT 1 FROM m_injuries i WHERE i.game_date = DATE '{RETURN_DAY}' AND i.status IN ('Out', 'Doubtful')
    AND i.team_id = l.team_id AND {_letters('i.player_name')} = {_letters('l.player_name')})"""

_PUBLISHED = f"""
SELECT p.*, s.inserted_hour, s.model_vs_line, s.model_total, s.is_national_broadcast, s.home_record, s.away_record,
  s.crew_chief_name, {listed(f's.{field}' for field in PREVIEW_INSIGHTS)}
FROM x_game_previews p
JOIN (SELECT *, 0 AS inserted_hour FROM x_scored_games WHERE game_date = DATE '{SCORE_DAY}'
      {NEWEST_VERSION.format(stamp='inserted_at', ties=_TIES)}) s USING (game_date, home_team_id, away_team_id)
WHERE p.game_date = DATE '{SCORE_DAY}'""".replace("s.inserted_hour, ", "").replace("*, 0 AS inserted_hour", "*")

_LINES = "game_date, season, home_team, away_team, over_under, home_line"
_ODDS = f"{_LINES}, home_moneyline, away_moneyline, odds_api_game_id"

QUERIES = {
    # staging
    "stg_games": "SELECT * FROM m_games",
    "stg_game_results": "SELECT * FROM x_game_results",
    "stg_team_game_stats": "SELECT *, offensive_rebounds + defensive_rebounds AS total_rebounds FROM x_team_game_stats",
    "stg_player_game_stats": "SELECT * FROM m_player_stats",
    "stg_team_quarter_stats": "SELECT * FROM x_team_quarter_stats",
    "stg_player_quarter_stats": "SELECT * FROM x_player_quarter_stats",
    "stg_referee_assignments": "SELECT * FROM x_referee_assignments",
    "stg_broadcast_schedule": "SELECT * FROM x_broadcast_schedule",
    "stg_betting_lines": f"SELECT {_LINES}, loaded_at FROM x_lines",
    "stg_opening_lines": f"SELECT {_ODDS}, loaded_at - INTERVAL 1 DAY AS captured_at FROM x_lines",
    "stg_closing_lines": f"SELECT {_ODDS}, loaded_at AS captured_at FROM x_lines",
    "stg_injuries": "SELECT * FROM m_injuries",
    # intermediate models
    "game_scores": "SELECT * FROM m_scores",
    "game_pace": "SELECT * FROM m_pace",
    "team_record": "SELECT * FROM m_record",
    "team_streaks": "SELECT * FROM m_streaks",
    "team_rolling_averages": "SELECT * FROM m_rolling",
    "team_performance_by_pace": "SELECT * FROM m_by_pace",
    "team_referee_record": "SELECT * FROM m_team_referee_record",
    "head_to_head": "SELECT * FROM m_head_to_head",
    "national_broadcast_flag": "SELECT * FROM m_broadcast",
    "rest_days": _REST,
    "travel": "SELECT * FROM m_travel",
    "timezone_lag": _ZONES,
    "altitude_fatigue": _ALTITUDE,
    "altitude_fatigue_by_quarter": "SELECT * FROM m_altitude_by_quarter",
    "altitude_fatigue_by_player": "SELECT * FROM m_altitude_by_player",
    "player_rolling_averages": "SELECT * FROM m_player_rolling",
    "player_streaks": "SELECT * FROM m_player_streaks",
    "returning_players": _RETURNING,
    "referee_tendencies": "SELECT * FROM m_tendencies",
    "player_referee_stats": "SELECT * FROM m_player_officials",
    # marts
    "team_summary": "SELECT * FROM m_team_summary",
    "player_summary": "SELECT * FROM m_player_summary",
    "referee_summary": "SELECT * FROM m_official_summary",
    "game_card": "SELECT * FROM m_card",
    # operators on their own
    "current_record_and_streak": """
SELECT r.team_id, r.wins, r.losses, r.games_played, r.win_pct, s.streak_label, s.streak_length
FROM m_now_record r JOIN m_now_streak s USING (team_id)""",
    "team_rows": "SELECT * FROM m_team_rows",
    "official_slots": "SELECT * FROM m_slots",
    "season_team_record": "SELECT * FROM m_season_record",
    "travel_any_game": "SELECT * FROM m_travel_all",
    "crew_averages": "SELECT * FROM m_crews",
    "pace_bucket_record": "SELECT * FROM m_pace_record",
    "home_away_splits": "SELECT * FROM m_splits",
    "team_quarter_profile": f"SELECT team_id, {TEAM_QUARTER_MEANS} FROM x_team_quarter_stats GROUP BY team_id",
    "player_quarter_profile": f"SELECT player_name, {PLAYER_QUARTER_MEANS} FROM x_player_quarter_stats GROUP BY player_name",
    "season_baseline": "SELECT * FROM m_baseline",
    "official_seasons": "SELECT * FROM m_official_seasons",
    "season_pair_record": "SELECT * FROM m_season_pairs",
    "teams_by_game_day": """
SELECT DISTINCT game_date, team_id FROM (
  SELECT game_date, home_team_id AS team_id FROM m_games UNION SELECT game_date, away_team_id FROM m_games)""",
    "recap_weeks": """
SELECT DISTINCT game_date, CAST(game_date - CAST(dayofweek(game_date) AS INTEGER) AS DATE) AS sunday,
  CAST(game_date - CAST(dayofweek(game_date) + 6 AS INTEGER) AS DATE) AS monday FROM m_games""",
    "clean_names_box_score": f"SELECT doc_id, {_normalized('text', 'box_score')} AS cleaned FROM documents",
    "clean_names_injury": f"SELECT doc_id, {_normalized('text', 'injury')} AS cleaned FROM documents",
    # scored games, picks, recap
    "latest_scores": "SELECT * FROM m_latest_scores",
    "merged_latest_scores": "SELECT * FROM m_latest_scores",
    "signal_strengths": f"""
SELECT game_date, home_team_id, away_team_id, inserted_at, {named(strengths())} FROM x_scored_games""",
    "qualified_picks": """
SELECT game_date, home_team_id, away_team_id, divergence_strength, signal_strength, ou_signal_strength, pick_type FROM m_picks""",
    "pick_sides": f"SELECT game_date, home_team_id, away_team_id, inserted_at, {_SIDES} FROM x_scored_games",
    "line_flags": f"SELECT game_date, home_team_id, away_team_id, inserted_at, {_FLAGS} FROM x_scored_games",
    "preview_signals": _signals(PREVIEW_INSIGHTS, ["STRONG", "MEDIUM"]),
    "pick_signals": _signals(PICK_INSIGHTS, ["STRONG"]),
    "free_games": "SELECT game_date, home_team_id, away_team_id, tipoff_time, is_national_broadcast, is_free_game FROM m_free_games",
    "unpublished_early": _unpublished(True),
    "unpublished_late": _unpublished(False),
    "published_with_scores": _PUBLISHED,
    "merged_picks": f"""
SELECT game_date, home_team_id, away_team_id, min(tipoff_time) AS tipoff_time, max(composite_score) AS composite_score,
  max(model_vs_market) AS model_vs_market, max(model_vs_line) AS model_vs_line, max(model_total) AS model_total,
  max(spread_home) AS spread_home, max(over_under) AS over_under,
  arg_max(blurb, tipoff_time || blurb) FILTER (WHERE pick_type = 'spread') AS picks_blurb,
  arg_max(blurb, tipoff_time || blurb) FILTER (WHERE pick_type = 'ou') AS ou_picks_blurb
FROM (SELECT *, CASE pick_type WHEN 'spread' THEN concat(spread_pick_team, ' ', spread_pick_line) ELSE total_pick END AS blurb
      FROM (SELECT *, {_SIDES} FROM m_picks))
GROUP BY game_date, home_team_id, away_team_id""",
    "preview_batches": f"""
SELECT {_PREVIEW_LIST} FROM m_early UNION ALL SELECT {_PREVIEW_LIST} FROM m_late""",
    "pick_record": _RECORD,
    "recap_lines": _RECAP,
    # sinks
    "published_view": "SELECT * EXCLUDE (game_recency) FROM m_record",
    "published_table": "SELECT * FROM m_scores",
    "replaced_seasons": "SELECT * FROM m_scores",
    "merged_official_record": "SELECT * FROM m_team_referee_record",
    "colocated_scores": "SELECT * FROM m_scores",
    "key_report": _KEY_REPORT,
    "catalog_table": "SELECT * FROM m_record",
    "catalog_games": "SELECT * FROM m_games",
    "published_layers": """
SELECT 'staging_games' AS view_name, count(*) AS view_rows FROM m_games
UNION ALL SELECT 'intermediate_team_record', count(*) FROM m_record
UNION ALL SELECT 'marts_team_summary', count(*) FROM m_team_summary""",
    # published orders, as positions
    "returning_players_order": f"""
SELECT player_name, row_number() OVER (ORDER BY days_since_last_game DESC, player_name, team_id) AS position FROM ({_RETURNING})""",
    "player_referee_order": """
SELECT player_name, team_id, referee_name,
  row_number() OVER (ORDER BY pts_diff_vs_season_avg DESC, player_name, team_id, referee_name) AS position FROM m_player_officials""",
    "recap_order": f"""
SELECT pick_type, game_date, home_team_id, away_team_id,
  row_number() OVER (PARTITION BY pick_type ORDER BY game_date, home_team_id, away_team_id) AS position FROM ({_RECAP})""",
    "display_order": """
SELECT game_date, home_team_id, away_team_id,
  row_number() OVER (PARTITION BY game_date ORDER BY is_free_game DESC, tipoff_time, home_team_id, away_team_id) AS position
FROM m_free_games""",
}


def all_oracles() -> dict[str, str]:
    library = LIBRARY | EXTRA
    return {name: assemble(sql, library) for name, sql in QUERIES.items()}


__all__ = ["MODELS", "RAW", "RECAP_DAY", "RETURN_DAY", "SCORE_DAY", "all_oracles"]
