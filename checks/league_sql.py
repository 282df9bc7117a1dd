"""League tables and models over the supplied tables, in plain SQL for the second engine.

Names starting with ``x_`` are the league's raw tables, ``m_`` its models. The SQL uses ordinary
windows over whole entities; it checks what the distributed versions compute.
"""

from __future__ import annotations

from checks.sql_tools import listed, mean, named, rounded, total, units
from checks.rules import PERIOD_LABELS as PERIODS, PREVIEW_TEXTS as PREVIEW_INSIGHTS, SHORT_BOX as WIDE_BOX

SIDES = ("home", "away")

# ---------------------------------------------------------------------------------------------
# raw tables
# ---------------------------------------------------------------------------------------------


def _side(alias: str = "") -> str:
    return f"CASE WHEN {alias}l_linestatus = 'O' THEN 'home' ELSE 'away' END"


def _team(number: str) -> str:
    return f"concat('T', lpad(CAST({number} AS VARCHAR), 2, '0'))"


def _player(digits: str) -> str:
    return f"concat('Supplier P', translate({digits}, '0123456789', 'abcdefghij'))"


_SUMS = """CAST(sum(l_quantity) AS BIGINT) AS q, CAST(sum(l_partkey) AS BIGINT) AS p,
  CAST(sum(l_suppkey) AS BIGINT) AS s, max(l_shipdate) AS loaded_at"""

_QUARTER = """CASE WHEN l_linenumber <= 4 THEN concat('Q', CAST(l_linenumber AS VARCHAR))
  ELSE concat('OT', CAST(l_linenumber - 4 AS VARCHAR)) END"""


def _team_box(points: str, attempts: str, turnovers: str) -> str:
    rules = {
        "field_goals_made": "30 + q % 15",
        "field_goals_attempted": attempts,
        "three_pointers_made": "5 + q % 12",
        "three_pointers_attempted": "20 + p % 20",
        "free_throws_made": "10 + s % 15",
        "free_throws_attempted": "15 + s % 21",
        "offensive_rebounds": "5 + s % 11",
        "defensive_rebounds": "25 + p % 16",
        "assists": "15 + q % 16",
        "steals": "4 + s % 9",
        "blocks": "2 + p % 8",
        "turnovers": turnovers,
        "personal_fouls": "14 + s % 12",
        "points": points,
    }
    return named(rules)


_PLAYER_BOX = named({
    "steals": "s % 5",
    "blocks": "p % 4",
    "turnovers": "q % 6",
    "personal_fouls": "s % 6",
    "field_goals_made": "q % 12",
    "field_goals_attempted": "12 + q % 13",
    "three_pointers_made": "p % 6",
    "three_pointers_attempted": "6 + p % 7",
    "free_throws_made": "s % 8",
    "free_throws_attempted": "8 + s % 9",
})

_MODEL = {
    "composite_score": "((event_id * 7) % 81 - 40) / 1e2",
    "model_vs_market": "((event_id * 13) % 31 - 15) / 1e2",
    "model_vs_line": "CAST((event_id * 11) % 15 - 7 AS DOUBLE)",
    "spread_home": "CAST((event_id * 3) % 25 - 12 AS DOUBLE) + 5e-1",
    "over_under": "CAST(event_id % 40 AS DOUBLE) + 200.5e0",
}
_MISSING_LINES = {
    name: f"CASE WHEN event_id % {k} <> 0 THEN {_MODEL[name]} END" for name, k in (("spread_home", 11), ("over_under", 13))
}


def _insight(position: int, field: str) -> str:
    level = f"(event_id * {position + 5} + {position}) % 6"
    return (
        f"CASE {level} WHEN 0 THEN '🔴 STRONG {field} 7-2' WHEN 1 THEN '🟡 MEDIUM {field} 5-4' "
        f"WHEN 2 THEN '⚪ CONTEXT {field} 3-3' WHEN 3 THEN 'plain words before STRONG {field}' "
        "WHEN 4 THEN '' END"
    )


def _strength(value: str, strong: str, medium: str, rest: str) -> str:
    size = f"abs(coalesce({value}, 0))"
    return f"CASE WHEN {size} >= {strong} THEN 'STRONG' WHEN {size} >= {medium} THEN 'MEDIUM' ELSE '{rest}' END"


def strengths(prefix: str = "") -> dict[str, str]:
    return {
        "divergence_strength": _strength(f"{prefix}model_vs_market", "1e-1", "6e-2", "NONE"),
        "signal_strength": _strength(f"{prefix}composite_score", "3e-1", "15e-2", "WEAK"),
        "ou_signal_strength": _strength(f"{prefix}model_vs_line", "5e0", "3e0", "NONE"),
    }


RAW = {
    "x_games": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_orderdate AS DATE) AS game_date,
  concat(CAST(year(o_orderdate) - 1 AS VARCHAR), '-', lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')) AS season,
  {_team('home_n')} AS home_team_id, {_team('away_n')} AS away_team_id,
  CASE WHEN o_orderkey % 50 = 0 THEN away_n ELSE home_n END AS arena_id,
  concat(CAST(9 + o_orderkey % 14 AS VARCHAR), ':30:00') AS tipoff_time, o_orderdate AS loaded_at
FROM (SELECT o.*, CAST(c_nationkey AS BIGINT) AS home_n,
        (CAST(c_nationkey AS BIGINT) + 1 + o_orderkey % 24) % 25 AS away_n
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)""",
    "x_team_game_stats": f"""
SELECT g.game_id, CASE home_away WHEN 'home' THEN g.home_team_id ELSE g.away_team_id END AS team_id, home_away,
  {_team_box('85 + q % 50', '75 + p % 25', '8 + q % 13')}, b.loaded_at
FROM (SELECT l_orderkey, {_side()} AS home_away, {_SUMS} FROM lineitem GROUP BY ALL) b
JOIN x_games g ON g.game_id = CAST(b.l_orderkey AS VARCHAR)""",
    "x_team_quarter_stats": f"""
SELECT g.game_id, CASE home_away WHEN 'home' THEN g.home_team_id ELSE g.away_team_id END AS team_id, home_away,
  {_QUARTER} AS quarter, {_team_box('15 + q % 25', '15 + s % 12', '1 + p % 6')}, b.loaded_at
FROM (SELECT l_orderkey, l_linenumber, {_side()} AS home_away, {_SUMS}
      FROM lineitem GROUP BY ALL) b
JOIN x_games g ON g.game_id = CAST(b.l_orderkey AS VARCHAR)""",
    "x_game_results": """
SELECT game_id, home_score, away_score, ok % 12 = 0 AS overtime_flag,
  CAST(CASE WHEN ok % 24 = 0 THEN 2 WHEN ok % 12 = 0 THEN 1 WHEN ok % 5 = 0 THEN NULL ELSE 0 END AS BIGINT) AS overtime_periods,
  loaded_at
FROM (SELECT h.game_id, h.points AS home_score, a.points AS away_score, CAST(h.game_id AS BIGINT) AS ok,
        greatest(h.loaded_at, a.loaded_at) AS loaded_at
      FROM x_team_game_stats h JOIN x_team_game_stats a USING (game_id)
      WHERE h.home_away = 'home' AND a.home_away = 'away')""",
    "x_player_game_stats": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS game_id, {_player('substr(s_name, 10)')} AS player_name, {_team('l_suppkey % 25')} AS team_id,
  first_line <= 3 AS starter,
  CASE first_line WHEN 7 THEN NULL WHEN 6 THEN ''
    ELSE concat(CAST(low_part % 40 AS VARCHAR), ':', CAST(high_part % 60 AS VARCHAR)) END AS minutes,
  q AS points, p % 16 AS rebounds, p % 13 AS assists, {_PLAYER_BOX}, p % 41 - 20 AS plus_minus, loaded_at
FROM (SELECT l_orderkey, l_suppkey, s_name, min(l_linenumber) AS first_line, min(l_partkey) AS low_part,
        max(l_partkey) AS high_part, {_SUMS}
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_orderkey, l_suppkey, s_name)""",
    "x_player_quarter_stats": f"""
SELECT CAST(l_orderkey AS VARCHAR) AS game_id, {_player('substr(s_name, 10)')} AS player_name, {_team('l_suppkey % 25')} AS team_id,
  {_QUARTER} AS quarter, CAST(p % 13 AS VARCHAR) AS minutes, q % 20 AS points, p % 3 AS offensive_rebounds,
  p % 5 AS defensive_rebounds, p % 7 AS assists, {_PLAYER_BOX}, p % 21 - 10 AS plus_minus, loaded_at
FROM (SELECT l_orderkey, l_suppkey, s_name, l_linenumber, {_SUMS}
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
      GROUP BY l_orderkey, l_suppkey, s_name, l_linenumber)""",
    "x_injuries": f"""
SELECT CAST(DATE '2001-07-03' + CAST(day(ts) - 1 AS INTEGER) AS DATE) AS game_date,
  strftime(ts, '%H:%M') AS game_time,
  concat({_team('user_id % 25')}, '@', {_team('(user_id + 1) % 25')}) AS matchup,
  {_team('user_id % 25')} AS team_id,
  {_player("lpad(CAST(user_id AS VARCHAR), 9, '0')")} AS player_name,
  CASE event_type WHEN 'error' THEN 'Out' WHEN 'signup' THEN 'Doubtful' WHEN 'click' THEN 'Questionable'
    WHEN 'view' THEN 'Probable' WHEN 'purchase' THEN 'Available' END AS status,
  event_type AS reason, concat('report-', lpad(CAST(event_id AS VARCHAR), 12, '0')) AS pdf_url, ts AS scraped_at
FROM events""",
    "x_referee_assignments": """
SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_custkey % 17 AS VARCHAR) AS referee_1,
  CAST((o_custkey + 5) % 17 AS VARCHAR) AS referee_2,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_custkey + 10) % 17 AS VARCHAR) END AS referee_3,
  o_orderdate AS loaded_at
FROM orders""",
    "x_broadcast_schedule": """
SELECT CAST(o_orderdate AS DATE) AS game_date, CAST(o_orderkey AS VARCHAR) AS game_id,
  o_orderpriority = '1-URGENT' AS is_national_broadcast, o_orderdate AS loaded_at
FROM orders""",
    "x_lines": """
SELECT game_date, season, home_team_id AS home_team, away_team_id AS away_team,
  CAST(CAST(game_id AS BIGINT) % 40 AS DOUBLE) + 200.5e0 AS over_under,
  5e-1 + CAST(game_id AS BIGINT) % 25 - 12 AS home_line,
  -110e0 - CAST(game_id AS BIGINT) % 90 AS home_moneyline, 100e0 + CAST(game_id AS BIGINT) % 90 AS away_moneyline,
  concat('odds-', game_id) AS odds_api_game_id, loaded_at
FROM x_games""",
    "x_dim_arenas": """
SELECT n AS arena_id, n_name AS city, CASE WHEN n <> 24 THEN CAST(25 + (n * 7) % 24 AS DOUBLE) END AS latitude,
  CASE WHEN n <> 24 THEN CAST(-70 - (n * 11) % 52 AS DOUBLE) END AS longitude,
  (n * n * 37) % 5300 AS altitude_feet,
  ['America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles', 'America/Phoenix'][n % 5 + 1] AS timezone
FROM (SELECT CAST(n_nationkey AS BIGINT) AS n, n_name FROM nation)""",
    "x_dim_referees": """
SELECT DISTINCT CAST(o_custkey % 17 AS VARCHAR) AS referee_id,
  concat('Official ', CAST(o_custkey % 17 AS VARCHAR)) AS full_name FROM orders""",
    "x_scored_events": """
SELECT e.*, g.home_team_id, g.away_team_id, g.tipoff_time,
  CAST(DATE '2024-01-01' + CAST(event_id // 350 AS INTEGER) AS DATE) AS game_date
FROM events e JOIN x_games g ON g.game_id = CAST(e.event_id // 25 AS VARCHAR)""",
    "x_scored_games": f"""
SELECT game_date, home_team_id, away_team_id, tipoff_time, ts AS inserted_at,
  event_id % 3 = 0 AS is_national_broadcast, {named(_MODEL)},
  ({_MODEL['over_under']}) + ({_MODEL['model_vs_line']}) AS model_total,
  concat('LEAN ', CAST(event_id % 3 AS VARCHAR)) AS overall_lean,
  concat('DIV ', CAST(event_id % 5 AS VARCHAR)) AS market_divergence,
  concat('TOTAL ', CAST(event_id % 7 AS VARCHAR)) AS total_insight,
  concat(CAST(event_id % 50 AS VARCHAR), '-', CAST(event_id % 30 AS VARCHAR)) AS home_record,
  concat(CAST(event_id % 40 AS VARCHAR), '-', CAST(event_id % 35 AS VARCHAR)) AS away_record,
  concat('Official ', CAST(event_id % 17 AS VARCHAR)) AS crew_chief_name,
  {listed(f"{_insight(i, field)} AS {field}" for i, field in enumerate(PREVIEW_INSIGHTS))}
FROM x_scored_events""",
    "x_model_tracker": f"""
SELECT game_date, home_team_id, away_team_id, scored_at, {named(strengths())},
  divergence_correct, model_ou_correct, model_vs_market, model_vs_line, spread_home, over_under,
  actual_margin, actual_total
FROM (SELECT game_date, home_team_id, away_team_id, ts AS scored_at, {named(_MODEL | _MISSING_LINES)},
        CASE WHEN event_id % 7 <> 0 THEN event_id % 2 = 0 END AS divergence_correct,
        CASE WHEN event_id % 8 <> 0 THEN event_id % 3 = 0 END AS model_ou_correct,
        CASE WHEN event_id % 9 <> 0 THEN event_id % 41 - 20 END AS actual_margin,
        CASE WHEN event_id % 9 <> 0 THEN 180 + event_id % 70 END AS actual_total
      FROM x_scored_events)""",
    "x_game_previews": f"""
SELECT game_date, home_team_id, away_team_id, tipoff_time, event_id % 5 = 0 AS is_free_game,
  {named({k: v for k, v in _MODEL.items() if k != 'model_vs_line'})},
  concat('LEAN ', CAST(event_id % 3 AS VARCHAR)) AS overall_lean,
  concat('DIV ', CAST(event_id % 5 AS VARCHAR)) AS market_divergence,
  concat('TOTAL ', CAST(event_id % 7 AS VARCHAR)) AS total_insight,
  concat('preview ', CAST(event_id AS VARCHAR)) AS preview_text, false AS posted_substack,
  false AS posted_reddit, ts AS generated_at
FROM x_scored_events WHERE event_type = 'purchase' AND value >= 100""",
}

# ---------------------------------------------------------------------------------------------
# models
# ---------------------------------------------------------------------------------------------

MINUTES = """CASE WHEN coalesce(minutes, '') = '' THEN 0e0
  WHEN minutes LIKE '%:%' THEN CAST(split_part(minutes, ':', 1) AS DOUBLE) + CAST(split_part(minutes, ':', 2) AS DOUBLE) / 60
  ELSE CAST(minutes AS DOUBLE) END"""

_box_columns = listed(
    f"{side[0]}.{column} AS {side}_{short}" for side in SIDES for column, short in WIDE_BOX.items()
)
_quarter_columns = {
    f"{side}_pts_{period.lower()}":
        f"max(points) FILTER (WHERE home_away = '{side}' AND quarter = '{period}')"
    for side in SIDES for period in PERIODS
}

_TOTALS = {
    "total_points": "home_points + away_points",
    "total_fouls": "home_pf + away_pf",
    "total_fta": "home_fta + away_fta",
    "total_3pa": "home_3pa + away_3pa",
    "total_tov": "home_tov + away_tov",
}
_OFFICIAL_MEANS = {f"avg_{name}": mean(name, 1) for name in _TOTALS}


def _rolling(size: int) -> dict[str, str]:
    over = f" OVER (PARTITION BY team_id ORDER BY game_date, game_id ROWS {size - 1} PRECEDING)"
    return {
        f"pts_last{size}": mean("team_points", 1, over=over),
        f"opp_pts_last{size}": mean("opp_points", 1, over=over),
        f"win_pct_last{size}": mean("win", 3, over=over),
        f"pace_last{size}": mean("pace", 1, 1, over=over),
    }


def player_over(size: int) -> str:
    return f" OVER (PARTITION BY player_name ORDER BY game_date, game_id, team_id ROWS {size - 1} PRECEDING)"


_player_rolling = {
    f"{short}_last{size}": mean(column, 1, over=player_over(size))
    for size in (3, 5)
    for column, short in (("points", "pts"), ("rebounds", "reb"), ("assists", "ast"))
} | {
    f"pts_above_avg_last{size}": rounded(f"avg(points){player_over(size)} - pts_season_avg", 1)
    for size in (3, 5)
}
_BASELINE = {
    "pts": "points", "reb": "rebounds", "ast": "assists", "stl": "steals", "blk": "blocks",
    "tov": "turnovers", "plus_minus": "plus_minus",
}


def quarter_means(metrics: dict[str, str], quarters: dict[str, list[str]]) -> str:
    return named({
        f"avg_{short}_{q.lower()}": rounded(f"avg({metric}) FILTER (WHERE quarter = '{q}')", 1)
        for metric, short in metrics.items() for q in quarters[metric]
    })


def _previous(column: str, entity: str = "team_id") -> str:
    return f"lag({column}) OVER (PARTITION BY {entity} ORDER BY game_date, game_id)"


_POSSESSIONS = {
    side: f"(({side}_fga - {side}_oreb + {side}_tov) + 44e-2 * {side}_fta)" for side in SIDES
}
_both = f"(({_POSSESSIONS['home']} + {_POSSESSIONS['away']}) / 2)"


def _paced(possessions: str) -> str:
    return rounded(f"{possessions} / total_minutes * 48", 1)


def _shift(previous: str, current: str) -> str:
    ranks = "['America/Los_Angeles', 'America/Denver', 'America/Chicago', 'America/New_York']"
    place = lambda zone: f"nullif(coalesce(list_position({ranks}, {zone}), 0), 0)"
    return f"CAST(coalesce({place(current)} - {place(previous)}, 0) AS BIGINT)"


_MILES = (
    "3958.8e0 * acos(greatest(-1e0, least(1e0, "
    "sin(radians(lat0)) * sin(radians(latitude)) + "
    "cos(radians(lat0)) * cos(radians(latitude)) * cos(radians(longitude - lon0)))))"
)


def travel_rows(entity: str) -> str:
    return f"""
SELECT *, CASE WHEN arena0 IS NULL OR arena0 = arena_id THEN 0e0
    WHEN lat0 IS NULL OR lon0 IS NULL OR latitude IS NULL OR longitude IS NULL THEN NULL
    ELSE {rounded(_MILES, 0)} END AS travel_miles
FROM (SELECT *, {_previous('arena_id', entity)} AS arena0, {_previous('latitude', entity)} AS lat0,
        {_previous('longitude', entity)} AS lon0 FROM m_schedule_rows)"""


def travel_games(rows: str) -> str:
    return f"""
SELECT h.game_id, h.game_date, h.home_team_id, h.away_team_id, h.travel_miles AS home_travel_miles,
  a.travel_miles AS away_travel_miles, a.travel_miles - h.travel_miles AS travel_advantage
FROM {rows} h JOIN {rows} a USING (game_id) WHERE h.home_away = 'home' AND a.home_away = 'away'"""


_ALTITUDE_PICK = named({
    name: f"CASE WHEN {{home}} THEN f.home_{column} ELSE f.away_{column} END"
    for name, column in (
        ("game_altitude", "arena_altitude"), ("altitude_change", "altitude_change"),
        ("prev_altitude", "prev_altitude"),
    )
})


def _distance_label(column: str, high: str, low: str, middle: str) -> str:
    return (
        f"CASE WHEN {column} >= {column}_m + 2 THEN '{high}' "
        f"WHEN {column} <= {column}_m - 2 THEN '{low}' ELSE '{middle}' END"
    )


_COMPARED = {
    "pts_vs_league_avg": "career_avg_total_points",
    "fouls_vs_league_avg": "career_avg_total_fouls",
    "pace_vs_league_avg": "career_avg_pace",
    "season_pts_vs_league_avg": "season_avg_total_points",
    "season_fouls_vs_league_avg": "season_avg_total_fouls",
    "season_pace_vs_league_avg": "season_avg_pace",
}


def _official_summary_means(prefix: str) -> str:
    return named(
        {f"{prefix}_games": "count(*)"}
        | {f"{prefix}_avg_{name}": mean(name, 1) for name in _TOTALS}
        | {f"{prefix}_avg_pace": mean("game_pace", 1, 1), f"{prefix}_home_win_pct": mean("home_win", 3)}
    )


def _weighted(column: str, scale: str, digits: int) -> str:
    return rounded(f"CAST(sum({column} * w) AS DOUBLE) / nullif(sum(w), 0) / {scale}", digits)


_now_share = rounded(
    "CAST(sum(win) FILTER (WHERE age = 0) AS DOUBLE) / nullif(count(*) FILTER (WHERE age = 0), 0)", 3
)

_pair_keys = "least(home_team_id, away_team_id) AS team_a, greatest(home_team_id, away_team_id) AS team_b"


def side_split(side: str) -> dict[str, str]:
    where = f" FILTER (WHERE home_away = '{side}')"
    return {
        f"avg_points_scored_{side}": rounded(f"avg(team_points){where}", 1),
        f"avg_points_allowed_{side}": rounded(f"avg(opp_points){where}", 1),
        f"avg_margin_{side}": rounded(f"avg(team_points - opp_points){where}", 1),
        f"{side}_games": f"nullif(count(*){where}, 0)",
    }


TEAM_QUARTER_MEANS = quarter_means(
    {"points": "pts", "turnovers": "tov", "field_goals_attempted": "fga"},
    {
        "points": ["Q1", "Q2", "Q3", "Q4", "OT1"],
        "turnovers": ["Q1", "Q2", "Q3", "Q4"],
        "field_goals_attempted": ["Q1", "Q2", "Q3", "Q4"],
    },
)
PLAYER_QUARTER_MEANS = quarter_means(
    {"points": "pts", "assists": "ast", "plus_minus": "pm"},
    dict.fromkeys(("points", "assists", "plus_minus"), ["Q1", "Q2", "Q3", "Q4"]),
)

NEWEST_TEAM = "QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY game_date DESC, game_id DESC) = 1"
NEWEST_PLAYER = (
    "QUALIFY row_number() OVER (PARTITION BY player_name "
    "ORDER BY game_date DESC, game_id DESC, team_id DESC) = 1"
)
NEWEST_VERSION = (
    "QUALIFY row_number() OVER (PARTITION BY game_date, home_team_id, away_team_id ORDER BY {stamp} DESC, {ties}) = 1"
)

PACE_CLASS = "CASE WHEN game_pace >= 106 THEN 'fast' WHEN game_pace >= 100 THEN 'average' ELSE 'slow' END"
PACE_NAMES = {"fast": "fast_pace", "average": "avg_pace", "slow": "slow_pace"}
_pace_columns = named({
    f"{prefix}_{name}": expression
    for value, prefix in PACE_NAMES.items()
    for name, expression in {
        "games": f"nullif(count(*) FILTER (WHERE pace_bucket = '{value}'), 0)",
        "wins": total("win", f"pace_bucket = '{value}'"),
        "win_pct": rounded(f"avg(win) FILTER (WHERE pace_bucket = '{value}')", 3),
    }.items()
})

ROLLING_NAMES = [f"{p}_last{n}" for n in (5, 10) for p in ("pts", "opp_pts", "win_pct", "pace")]
PACE_RECORD_NAMES = [f"{p}_{part}" for p in PACE_NAMES.values() for part in ("games", "wins", "win_pct")]


def _card_side(side: str) -> str:
    alias = f"{side}_"
    return listed(
        [f"{alias}r.wins AS {side}_wins", f"{alias}r.losses AS {side}_losses", f"{alias}r.win_pct AS {side}_win_pct",
         f"{alias}s.streak_label AS {side}_streak_label", f"{alias}s.streak_length AS {side}_streak_length"]
        + [f"{alias}f.{name} AS {side}_{name}" for name in ROLLING_NAMES]
        + [f"{alias}p.{name} AS {side}_{name}" for name in PACE_RECORD_NAMES]
        + [f"{alias}e.games_with_referee AS {side}_games_with_crew_chief",
           f"{alias}e.weighted_ref_effect AS {side}_win_pct_with_crew_chief"]
    )


def _card_joins(side: str) -> str:
    alias, team = f"{side}_", f"g.{side}_team_id"
    return "\n".join(
        f"LEFT JOIN {model} {alias}{letter} ON {alias}{letter}.team_id = {team}{extra}"
        for model, letter, extra in (
            ("m_season_now_record", "r", ""), ("m_now_streak", "s", ""), ("m_now_rolling", "f", ""),
            ("m_pace_record", "p", ""),
            ("m_team_referee_record", "e", f" AND {alias}e.referee_id = ra.referee_1"),
        )
    )


MODELS = {
    "m_games": """
SELECT * REPLACE (CAST(split_part(season, '-', 1) AS BIGINT) + 1 AS season) FROM x_games""",
    "m_now": "SELECT max(season) AS season FROM m_games",
    "m_scores": f"""
SELECT g.game_id, g.game_date, g.season, g.arena_id, g.tipoff_time, h.team_id AS home_team_id,
  a.team_id AS away_team_id, h.points - a.points AS point_differential,
  CASE WHEN h.points > a.points THEN h.team_id ELSE a.team_id END AS winner_team_id,
  CASE WHEN h.points > a.points THEN 'home' ELSE 'away' END AS winner_home_away,
  h.points + a.points AS total_points, {_box_columns},
  {listed(f'k.{name}' for name in _quarter_columns)}, coalesce(k.ot, 0) AS overtime_periods
FROM m_games g
JOIN x_team_game_stats h ON h.game_id = g.game_id AND h.home_away = 'home'
JOIN x_team_game_stats a ON a.game_id = g.game_id AND a.home_away = 'away'
LEFT JOIN (SELECT game_id, {named(_quarter_columns)},
             count(*) FILTER (WHERE home_away = 'home' AND quarter LIKE 'OT%') AS ot
           FROM x_team_quarter_stats GROUP BY game_id) k ON k.game_id = g.game_id""",
    "m_pace": f"""
SELECT game_id, game_date, home_team_id, away_team_id, ot AS overtime_periods, total_minutes,
  {named({
      'home_possessions': rounded(_POSSESSIONS['home'], 1),
      'away_possessions': rounded(_POSSESSIONS['away'], 1),
      'avg_possessions': rounded(_both, 1),
      'home_pace': _paced(_POSSESSIONS['home']),
      'away_pace': _paced(_POSSESSIONS['away']),
      'game_pace': _paced(_both),
  })}
FROM (SELECT s.*, coalesce(r.overtime_periods, 0) AS ot, 48 + 5 * coalesce(r.overtime_periods, 0) AS total_minutes
      FROM m_scores s LEFT JOIN x_game_results r USING (game_id))""",
    "m_team_rows": """
SELECT s.game_id, s.game_date, s.season, side.home_away, side.team_id, side.opponent_id,
  side.team_points, side.opp_points, CAST(side.team_points > side.opp_points AS BIGINT) AS win
FROM m_scores s, LATERAL (VALUES
  ('home', s.home_team_id, s.away_team_id, s.home_points, s.away_points),
  ('away', s.away_team_id, s.home_team_id, s.away_points, s.home_points)
) AS side(home_away, team_id, opponent_id, team_points, opp_points)""",
    "m_paced_rows": """
SELECT t.*, p.game_pace, p.overtime_periods,
  CASE t.home_away WHEN 'home' THEN p.home_pace ELSE p.away_pace END AS pace
FROM m_team_rows t JOIN m_pace p USING (game_id)""",
    "m_record": f"""
SELECT team_id, game_id, game_date, season, opponent_id, home_away, team_points, opp_points, win,
  wins, n - wins AS losses, n AS games_played, {rounded('wins / n', 3)} AS win_pct,
  games - n + 1 AS game_recency
FROM (SELECT *, CAST(sum(win) OVER w AS BIGINT) AS wins, row_number() OVER w AS n,
        count(*) OVER (PARTITION BY team_id) AS games
      FROM m_team_rows WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id ROWS UNBOUNDED PRECEDING))""",
    "m_season_record": f"""
SELECT team_id, game_id, game_date, season, opponent_id, home_away, team_points, opp_points, win,
  wins, n - wins AS losses, n AS games_played, {rounded('wins / n', 3)} AS win_pct
FROM (SELECT *, CAST(sum(win) OVER w AS BIGINT) AS wins, row_number() OVER w AS n
      FROM m_team_rows
      WINDOW w AS (PARTITION BY team_id, season ORDER BY game_date, game_id ROWS UNBOUNDED PRECEDING))""",
    "m_streaks": """
SELECT team_id, game_id, game_date, win, len AS streak_length, CASE win WHEN 1 THEN len ELSE 0 END AS win_streak,
  CASE win WHEN 0 THEN len ELSE 0 END AS loss_streak,
  concat(CASE win WHEN 1 THEN 'W' ELSE 'L' END, CAST(len AS VARCHAR)) AS streak_label
FROM (SELECT *, row_number() OVER (PARTITION BY team_id, win, island ORDER BY game_date, game_id) AS len
      FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY game_date, game_id)
              - row_number() OVER (PARTITION BY team_id, win ORDER BY game_date, game_id) AS island
            FROM m_team_rows))""",
    "m_rolling": f"""
SELECT team_id, game_id, game_date, home_away, win, {named(_rolling(5) | _rolling(10))} FROM m_paced_rows""",
    "m_slots": """
SELECT game_id, referee_id FROM (
  SELECT game_id, unnest([referee_1, referee_2, referee_3]) AS referee_id FROM x_referee_assignments)
WHERE referee_id IS NOT NULL""",
    "m_official_games": f"""
SELECT o.referee_id, s.game_id, s.game_date, s.season, {named(_TOTALS)}, p.game_pace,
  CAST(s.home_points > s.away_points AS BIGINT) AS home_win
FROM m_slots o JOIN m_scores s USING (game_id) JOIN m_pace p USING (game_id)""",
    "m_tendencies": f"""
SELECT referee_id, count(*) AS games_officiated, {named(_OFFICIAL_MEANS)}, {mean('home_win', 3)} AS home_win_pct,
  min(game_date) AS first_game, max(game_date) AS last_game
FROM m_official_games GROUP BY referee_id""",
    "m_crews": f"""
SELECT a.game_id, {named({
    'crew_avg_total_points': mean('avg_total_points', 1, 1),
    'crew_avg_fta': mean('avg_total_fta', 1, 1),
    'crew_avg_fouls': mean('avg_total_fouls', 1, 1),
})}
FROM x_referee_assignments a
LEFT JOIN m_tendencies t ON list_contains([a.referee_1, a.referee_2, a.referee_3], t.referee_id)
GROUP BY a.game_id""",
    "m_by_pace": f"""
SELECT r.team_id, r.game_id, r.game_date, r.win, r.home_away, r.team_points, r.opp_points, p.game_pace,
  p.overtime_periods, r.season, {PACE_CLASS} AS pace_bucket, c.crew_avg_total_points, c.crew_avg_fta,
  c.crew_avg_fouls, r.game_recency, r.season = max(r.season) OVER () AS is_current_season,
  r.game_recency <= 10 AS is_last_10
FROM m_record r JOIN m_pace p USING (game_id) LEFT JOIN m_crews c USING (game_id)""",
    "m_pace_record": f"""
SELECT team_id, {_pace_columns} FROM m_by_pace WHERE is_current_season GROUP BY team_id""",
    "m_team_referee_record": f"""
SELECT team_id, referee_id, count(*) AS games_with_referee, count(*) FILTER (WHERE age = 0) AS current_season_games,
  {named({
      'weighted_ref_effect': _weighted('effect', '1e3', 3),
      'current_season_ref_effect': _now_share,
      'ref_effect_stddev': rounded('stddev_samp(effect / 1e3)', 3),
      'weighted_win_pct': _weighted('win', '1e0', 3),
      'current_season_win_pct': _now_share,
      'avg_expected_win_pct': _weighted('expected', '1e3', 3),
      'avg_points_scored': _weighted('team_points', '1e0', 1),
      'avg_points_allowed': _weighted('opp_points', '1e0', 1),
      'avg_point_differential': _weighted('(team_points - opp_points)', '1e0', 1),
      'home_games': "count(*) FILTER (WHERE home_away = 'home')",
      'home_wins': "CAST(coalesce(sum(win) FILTER (WHERE home_away = 'home'), 0) AS BIGINT)",
      'home_win_pct': rounded("avg(win) FILTER (WHERE home_away = 'home')", 3),
  })}
FROM (SELECT t.*, o.referee_id, n.season - t.season AS age, [100, 40, 15][n.season - t.season + 1] AS w,
        {units('r.win_pct_last10', 3)} AS expected,
        t.win * 1000 - {units('coalesce(r.win_pct_last10, 5e-1)', 3)} AS effect
      FROM m_team_rows t JOIN m_rolling r USING (team_id, game_id) JOIN m_slots o USING (game_id), m_now n
      WHERE t.season >= n.season - 2)
GROUP BY team_id, referee_id""",
    "m_official_seasons": f"""
SELECT referee_id, season, {_official_summary_means('season')} FROM m_official_games GROUP BY referee_id, season""",
    "m_official_summary": f"""
SELECT * EXCLUDE ({listed(f'{c}_m' for c in dict.fromkeys(_COMPARED.values()))}),
  {named({name: rounded(f'{column} - {column}_m', 1) for name, column in _COMPARED.items()})},
  {_distance_label('season_avg_total_fouls', 'whistle_happy', 'let_them_play', 'average')} AS foul_tendency_label,
  CASE WHEN season_home_win_pct >= 65e-2 THEN 'strong_home_bias' WHEN season_home_win_pct >= 58e-2 THEN 'moderate_home_bias'
    WHEN season_home_win_pct <= 35e-2 THEN 'strong_away_bias' WHEN season_home_win_pct <= 42e-2 THEN 'moderate_away_bias'
    ELSE 'neutral' END AS home_bias_label,
  {_distance_label('season_avg_pace', 'fast_pace', 'slow_pace', 'average_pace')} AS pace_tendency_label,
  CASE WHEN season_games >= 20 THEN 'sufficient' WHEN season_games >= 10 THEN 'limited' ELSE 'insufficient' END AS sample_size_label
FROM (SELECT c.*, d.full_name AS referee_name, s.season AS current_season, s.* EXCLUDE (referee_id, season),
        {named({f'{c}_m': f'avg({units(c, 1)}) OVER () / 1e1' for c in dict.fromkeys(_COMPARED.values())})}
      FROM (SELECT referee_id, {_official_summary_means('career')}, min(game_date) AS first_game,
              max(game_date) AS last_game FROM m_official_games GROUP BY referee_id) c
      JOIN (SELECT * FROM m_official_seasons
            QUALIFY row_number() OVER (PARTITION BY referee_id ORDER BY season DESC) = 1) s USING (referee_id)
      LEFT JOIN x_dim_referees d USING (referee_id))""",
    "m_head_to_head": f"""
SELECT team_a, team_b, count(*) AS games_played, {total('a_won')} AS team_a_wins, {total('1 - a_won')} AS team_b_wins,
  {mean('a_won', 3)} AS team_a_win_pct, max(game_date) AS last_meeting, min(game_date) AS first_meeting
FROM (SELECT {_pair_keys}, game_date,
        CAST(CASE WHEN home_team_id < away_team_id THEN home_points > away_points ELSE away_points > home_points END AS BIGINT) AS a_won
      FROM m_scores WHERE home_points > 0)
GROUP BY team_a, team_b""",
    "m_season_pairs": f"""
SELECT team_a, team_b, count(*) AS h2h_games,
  {total("CASE WHEN home_points <> away_points AND winner_team_id = team_a THEN 1 ELSE 0 END")} AS team_a_wins,
  {total("CASE WHEN home_points <> away_points AND winner_team_id = team_b THEN 1 ELSE 0 END")} AS team_b_wins,
  max(game_date) AS h2h_last_meeting
FROM (SELECT *, {_pair_keys} FROM m_scores WHERE season = (SELECT season FROM m_now) AND home_points > 0)
GROUP BY team_a, team_b""",
    "m_schedule_rows": """
SELECT g.game_id, g.game_date, g.home_team_id, g.away_team_id, g.arena_id, side.home_away, side.team_id,
  a.latitude, a.longitude, a.altitude_feet, a.timezone
FROM m_games g
CROSS JOIN LATERAL (VALUES ('home', g.home_team_id), ('away', g.away_team_id)) AS side(home_away, team_id)
LEFT JOIN x_dim_arenas a USING (arena_id)""",
    "m_context_rows": f"""
SELECT *, date_diff('day', date0, game_date) - 1 AS days_rest, {_shift('zone0', 'timezone')} AS timezone_shift,
  altitude_feet - coalesce(altitude0, altitude_feet) AS altitude_change
FROM (SELECT *, {_previous('game_date')} AS date0, {_previous('timezone')} AS zone0,
        {_previous('altitude_feet')} AS altitude0 FROM m_schedule_rows)""",
    "m_context": """
SELECT h.game_id, h.game_date, h.home_team_id, h.away_team_id,
  h.days_rest AS home_days_rest, a.days_rest AS away_days_rest, a.days_rest - h.days_rest AS rest_advantage,
  h.timezone_shift AS home_timezone_shift, a.timezone_shift AS away_timezone_shift,
  a.timezone_shift AS timezone_lag_advantage,
  h.altitude_feet AS home_arena_altitude, h.altitude0 AS home_prev_altitude, h.altitude_change AS home_altitude_change,
  a.altitude_feet AS away_arena_altitude, a.altitude0 AS away_prev_altitude, a.altitude_change AS away_altitude_change,
  a.altitude_change - h.altitude_change AS altitude_fatigue_advantage
FROM m_context_rows h JOIN m_context_rows a USING (game_id)
WHERE h.home_away = 'home' AND a.home_away = 'away'""",
    "m_travel_side_rows": travel_rows("team_id, home_away"),
    "m_travel_all_rows": travel_rows("team_id"),
    "m_travel": travel_games("m_travel_side_rows"),
    "m_travel_all": travel_games("m_travel_all_rows"),
    "m_altitude_by_quarter": f"""
SELECT q.* EXCLUDE (loaded_at), {_ALTITUDE_PICK.format(home="q.home_away = 'home'")}
FROM x_team_quarter_stats q JOIN m_context f USING (game_id)""",
    "m_altitude_by_player": f"""
SELECT q.* EXCLUDE (loaded_at), s.game_date, {_ALTITUDE_PICK.format(home="q.team_id = s.home_team_id")}
FROM x_player_quarter_stats q JOIN m_scores s USING (game_id) JOIN m_context f USING (game_id)""",
    "m_player_stats": f"""
SELECT game_id, player_name, team_id, starter, {MINUTES} AS minutes_played,
  * EXCLUDE (game_id, player_name, team_id, starter, minutes)
FROM x_player_game_stats""",
    "m_appearances": """
SELECT p.player_name, p.team_id, p.game_id, s.game_date, s.season, p.points, p.rebounds, p.assists, p.steals,
  p.blocks, p.turnovers, p.plus_minus, p.starter
FROM m_player_stats p JOIN m_scores s USING (game_id) WHERE p.minutes_played > 0""",
    "m_baseline": f"""
SELECT player_name, count(*) AS games_played,
  {named({f'{short}_season_avg': mean(column, 1) for short, column in _BASELINE.items()})}
FROM m_appearances WHERE season = (SELECT season FROM m_now) GROUP BY player_name""",
    "m_player_rolling": f"""
SELECT a.* EXCLUDE (season), b.* EXCLUDE (player_name), {named(_player_rolling)}
FROM m_appearances a JOIN m_baseline b USING (player_name)""",
    "m_player_streaks": """
SELECT player_name, team_id, game_id, game_date, points, rebounds, assists, pts_season_avg, pts_last3,
  pts_above_avg_last3, pts_above_avg_last5,
  pts_above_avg_last3 >= 5 AS is_pts_hot_last3, pts_above_avg_last5 >= 5 AS is_pts_hot_last5,
  pts_above_avg_last3 <= -5 AS is_pts_cold_last3, pts_above_avg_last5 <= -5 AS is_pts_cold_last5,
  CASE WHEN hot THEN len ELSE 0 END AS hot_game_streak, CASE WHEN hot THEN 0 ELSE len END AS below_avg_streak
FROM (SELECT *, row_number() OVER (PARTITION BY player_name, hot, island ORDER BY game_date, game_id, team_id) AS len
      FROM (SELECT *, row_number() OVER (PARTITION BY player_name ORDER BY game_date, game_id, team_id)
              - row_number() OVER (PARTITION BY player_name, hot ORDER BY game_date, game_id, team_id) AS island
            FROM (SELECT *, points >= pts_season_avg + 5 AS hot FROM m_player_rolling WHERE games_played >= 10)))""",
    "m_now_form": f"SELECT * FROM m_player_rolling {NEWEST_PLAYER}",
    "m_now_heat": f"SELECT * FROM m_player_streaks {NEWEST_PLAYER}",
    "m_player_quarters": f"""
SELECT player_name, {PLAYER_QUARTER_MEANS} FROM x_player_quarter_stats GROUP BY player_name""",
    "m_player_summary": """
SELECT f.player_name, f.team_id, f.games_played, f.pts_season_avg, f.reb_season_avg, f.ast_season_avg,
  f.stl_season_avg, f.blk_season_avg, f.tov_season_avg, f.plus_minus_season_avg,
  f.points AS last_game_points, f.rebounds AS last_game_rebounds, f.assists AS last_game_assists,
  f.pts_last3, f.pts_last5, f.reb_last3, f.reb_last5, f.ast_last3, f.ast_last5,
  f.pts_above_avg_last3, f.pts_above_avg_last5, h.is_pts_hot_last3, h.is_pts_hot_last5,
  h.is_pts_cold_last3, h.is_pts_cold_last5, h.hot_game_streak, h.below_avg_streak,
  q.* EXCLUDE (player_name)
FROM m_now_form f LEFT JOIN m_now_heat h USING (player_name) LEFT JOIN m_player_quarters q USING (player_name)""",
    "m_player_officials": f"""
SELECT u.player_name, u.team_id, d.full_name AS referee_name, u.n AS games_with_referee, u.pts AS avg_pts_with_ref,
  f.pts_season_avg, {rounded('u.pts - f.pts_season_avg', 1)} AS pts_diff_vs_season_avg, u.pm AS avg_plus_minus
FROM (SELECT p.player_name, p.team_id, o.referee_id, count(*) AS n, {mean('p.points', 1)} AS pts, {mean('p.plus_minus', 1)} AS pm
      FROM m_player_stats p JOIN m_games g USING (game_id) JOIN m_slots o USING (game_id)
      WHERE p.minutes_played > 0 AND g.season = (SELECT season FROM m_now)
      GROUP BY ALL) u
JOIN m_now_form f ON f.player_name = u.player_name AND f.team_id = u.team_id
JOIN x_dim_referees d ON d.referee_id = u.referee_id
WHERE u.n >= 3 AND f.pts_season_avg >= 15 AND abs(u.pts - f.pts_season_avg) >= 3""",
    "m_injuries": """
SELECT * FROM x_injuries
QUALIFY row_number() OVER (PARTITION BY game_date, team_id, player_name ORDER BY scraped_at DESC, pdf_url DESC) = 1""",
    "m_now_record": f"SELECT team_id, wins, losses, games_played, win_pct FROM m_record {NEWEST_TEAM}",
    "m_now_rolling": f"SELECT team_id, {listed(ROLLING_NAMES)} FROM m_rolling {NEWEST_TEAM}",
    "m_now_streak": f"SELECT team_id, streak_label, streak_length FROM m_streaks {NEWEST_TEAM}",
    "m_season_now_record": f"""
SELECT team_id, wins, losses, win_pct FROM m_season_record WHERE season = (SELECT season FROM m_now) {NEWEST_TEAM}""",
    "m_splits": f"""
SELECT team_id, {named(side_split('home') | side_split('away'))} FROM m_team_rows GROUP BY team_id""",
    "m_team_quarters": f"SELECT team_id, {TEAM_QUARTER_MEANS} FROM x_team_quarter_stats GROUP BY team_id",
    "m_team_summary": """
SELECT r.*, s.streak_label AS current_streak, s.streak_length, f.* EXCLUDE (team_id), p.* EXCLUDE (team_id),
  q.* EXCLUDE (team_id)
FROM m_now_record r JOIN m_now_streak s USING (team_id) JOIN m_now_rolling f USING (team_id)
LEFT JOIN m_splits p USING (team_id) LEFT JOIN m_team_quarters q USING (team_id)""",
    "m_broadcast": """
SELECT s.game_id, s.game_date, s.home_team_id, s.away_team_id, coalesce(b.is_national_broadcast, false) AS is_national_broadcast
FROM m_scores s LEFT JOIN x_broadcast_schedule b USING (game_id)""",
    "m_card": f"""
SELECT g.game_id, g.game_date, g.season, g.arena_id, g.tipoff_time, g.home_team_id, g.away_team_id,
  n.is_national_broadcast, s.home_points, s.away_points, s.point_differential, s.winner_team_id,
  s.winner_home_away, s.total_points, {listed(f's.{name}' for name in _quarter_columns)},
  s.home_pts_q4 - s.away_pts_q4 AS q4_margin,
  (s.home_pts_q1 + s.home_pts_q2 + s.home_pts_q3) - (s.away_pts_q1 + s.away_pts_q2 + s.away_pts_q3) AS margin_entering_q4,
  p.home_possessions, p.away_possessions, p.game_pace, p.overtime_periods,
  c.home_days_rest, c.away_days_rest, c.rest_advantage, t.home_travel_miles, t.away_travel_miles,
  t.travel_advantage, c.home_timezone_shift, c.away_timezone_shift, c.timezone_lag_advantage,
  c.home_arena_altitude, c.away_arena_altitude, c.home_altitude_change, c.away_altitude_change,
  c.altitude_fatigue_advantage,
  {_card_side('home')},
  {_card_side('away')},
  x.h2h_games, CASE WHEN g.home_team_id = x.team_a THEN x.team_a_wins ELSE x.team_b_wins END AS h2h_home_wins,
  CASE WHEN g.away_team_id = x.team_a THEN x.team_a_wins ELSE x.team_b_wins END AS h2h_away_wins,
  x.h2h_last_meeting, ra.referee_1, ra.referee_2, ra.referee_3,
  o.games_officiated AS crew_chief_games, o.avg_total_fouls AS crew_chief_avg_fouls,
  o.avg_total_fta AS crew_chief_avg_fta, o.avg_total_points AS crew_chief_avg_total_points,
  o.home_win_pct AS crew_chief_home_win_pct
FROM m_games g
LEFT JOIN m_scores s USING (game_id) LEFT JOIN m_pace p USING (game_id) LEFT JOIN m_broadcast n USING (game_id)
LEFT JOIN m_context c USING (game_id) LEFT JOIN m_travel t USING (game_id)
LEFT JOIN x_referee_assignments ra USING (game_id)
LEFT JOIN m_tendencies o ON o.referee_id = ra.referee_1
LEFT JOIN m_season_pairs x ON x.team_a = least(g.home_team_id, g.away_team_id)
  AND x.team_b = greatest(g.home_team_id, g.away_team_id)
{_card_joins('home')}
{_card_joins('away')}""",
    "m_latest_scores": "SELECT * FROM x_scored_games " + NEWEST_VERSION.format(
        stamp="inserted_at",
        ties="composite_score DESC, model_vs_market DESC, model_vs_line DESC, spread_home DESC, over_under DESC",
    ),
    "m_latest_grades": "SELECT * FROM x_model_tracker " + NEWEST_VERSION.format(
        stamp="scored_at", ties="model_vs_market DESC, model_vs_line DESC, spread_home DESC, over_under DESC"
    ),
    "m_strengths": f"SELECT *, {named(strengths())} FROM m_latest_scores",
    "m_free_games": """
SELECT *, row_number() OVER (PARTITION BY game_date ORDER BY is_national_broadcast DESC, tipoff_time,
    home_team_id, away_team_id) = 1 AS is_free_game
FROM m_latest_scores""",
}

LIBRARY = RAW | MODELS
