"""The supplied star-schema tables seen as league tables.

Each league table is a deterministic projection, so that league queries can run on the supplied
data at any scale. The rules are plain arithmetic on keys; they carry no sports meaning.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtside.sources.readers import RawTables
from courtside.sources.schemas import PREVIEW_INSIGHTS

# Columns of the supplied tables that the projection reads.
SUPPLIED_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}

INJURY_DAY_ONE = "2001-07-03"
TRACKER_DAY_ONE = "2024-01-01"

_INJURY_STATUS = {
    "error": "Out",
    "signup": "Doubtful",
    "click": "Questionable",
    "view": "Probable",
    "purchase": "Available",
}
_ARENA_ZONES = [
    "America/New_York",
    "America/Chicago",
    "America/Denver",
    "America/Los_Angeles",
    "America/Phoenix",
]


def _team(number: str) -> str:
    return f"concat('T', lpad({number}, 2, '0'))"


def _player(digits: str) -> str:
    """A name of letters alone: names of the two feeds are compared by their letters."""
    return f"concat('Supplier P', translate({digits}, '0123456789', 'abcdefghij'))"


def _choice(value: str, mapping: dict[str, str]) -> str:
    branches = " ".join(f"WHEN '{key}' THEN '{result}'" for key, result in mapping.items())
    return f"CASE {value} {branches} END"


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def insight_text(level: str, field: str) -> str:
    """Tagged, late-tagged, blank and missing texts, by ``level`` 0 to 5."""
    return f"""CASE {level} WHEN 0 THEN '🔴 STRONG {field} 7-2' WHEN 1 THEN '🟡 MEDIUM {field} 5-4'
        WHEN 2 THEN '⚪ CONTEXT {field} 3-3' WHEN 3 THEN 'plain words before STRONG {field}'
        WHEN 4 THEN '' END"""


_SIDE = "CASE WHEN l_linestatus = 'O' THEN 'home' ELSE 'away' END"
_QUARTER = "concat(if(l_linenumber <= 4, 'Q', 'OT'), if(l_linenumber <= 4, l_linenumber, l_linenumber - 4))"
_SIDE_TEAM = "if(home_away = 'home', home_team_id, away_team_id)"

_PLAYER_BOX = _named({
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
    "composite_score": "((event_id * 7) % 81 - 40) / 100D",
    "model_vs_market": "((event_id * 13) % 31 - 15) / 100D",
    "model_vs_line": "CAST((event_id * 11) % 15 - 7 AS DOUBLE)",
    "spread_home": "(event_id * 3) % 25 - 12 + 0.5D",
    "over_under": "event_id % 40 + 200.5D",
}
# Lines that a feed has not delivered.
_GAPS = {
    "spread_home": "if(event_id % 11 <> 0, (event_id * 3) % 25 - 12 + 0.5D, NULL)",
    "over_under": "if(event_id % 13 <> 0, event_id % 40 + 200.5D, NULL)",
}
_LABELS = {
    "overall_lean": "concat('LEAN ', event_id % 3)",
    "market_divergence": "concat('DIV ', event_id % 5)",
    "total_insight": "concat('TOTAL ', event_id % 7)",
}


def _team_box(points: str, attempts: str, turnovers: str) -> list[str]:
    return _named({
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
    })


class SuppliedTables:
    """League tables by name over one folder of the supplied Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._makers: dict[str, Callable[[], DataFrame]] = {
            "games": lambda: self.games,
            "game_results": self.game_results,
            "team_game_stats": lambda: self.team_game_stats,
            "player_game_stats": self.player_game_stats,
            "team_quarter_stats": self.team_quarter_stats,
            "player_quarter_stats": self.player_quarter_stats,
            "referee_assignments": self.referee_assignments,
            "broadcast_schedule": self.broadcast_schedule,
            "betting_lines": self.betting_lines,
            "opening_lines": lambda: self.odds(days_before=1),
            "closing_lines": lambda: self.odds(days_before=0),
            "injuries": self.injuries,
            "dim_arenas": self.dim_arenas,
            "dim_referees": self.dim_referees,
            "scored_games": self.scored_games,
            "model_tracker": self.model_tracker,
            "game_previews": self.game_previews,
        }

    def raw(self) -> RawTables:
        return RawTables(lambda name: self._makers[name]())

    def read(self, name: str) -> DataFrame:
        schema = SUPPLIED_SCHEMAS[name]
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}.parquet")

    # -- schedule ---------------------------------------------------------------------------

    @cached_property
    def games(self) -> DataFrame:
        orders, customers = self.read("orders"), self.read("customer")
        away = "(c_nationkey + 1 + o_orderkey % 24) % 25"
        return orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
            "CAST(o_orderkey AS STRING) AS game_id",
            "CAST(o_orderdate AS DATE) AS game_date",
            "concat(year(o_orderdate) - 1, '-', lpad(year(o_orderdate) % 100, 2, '0')) AS season",
            f"{_team('c_nationkey')} AS home_team_id",
            f"{_team(away)} AS away_team_id",
            f"CAST(if(o_orderkey % 50 = 0, {away}, c_nationkey) AS BIGINT) AS arena_id",
            "concat(9 + o_orderkey % 14, ':30:00') AS tipoff_time",
            "o_orderdate AS loaded_at",
        )

    @cached_property
    def _game_teams(self) -> DataFrame:
        return self.games.select("game_id", "home_team_id", "away_team_id")

    def _summed(self, lines: DataFrame, *keys: str) -> DataFrame:
        return lines.groupBy("l_orderkey", *keys).agg(
            F.expr("CAST(sum(l_quantity) AS BIGINT) AS q"),
            F.expr("sum(l_partkey) AS p"),
            F.expr("sum(l_suppkey) AS s"),
            F.expr("max(l_shipdate) AS loaded_at"),
            F.expr("min(l_linenumber) AS first_line"),
            F.expr("min(l_partkey) AS low_part"),
            F.expr("max(l_partkey) AS high_part"),
        ).withColumn("game_id", F.expr("CAST(l_orderkey AS STRING)"))

    @cached_property
    def team_game_stats(self) -> DataFrame:
        lines = self.read("lineitem").selectExpr("*", f"{_SIDE} AS home_away")
        sides = self._summed(lines, "home_away").join(self._game_teams, "game_id")
        box = _team_box(points="85 + q % 50", attempts="75 + p % 25", turnovers="8 + q % 13")
        return sides.selectExpr("game_id", f"{_SIDE_TEAM} AS team_id", "home_away", *box, "loaded_at")

    def team_quarter_stats(self) -> DataFrame:
        lines = self.read("lineitem").selectExpr("*", f"{_SIDE} AS home_away")
        quarters = self._summed(lines, "home_away", "l_linenumber").join(self._game_teams, "game_id")
        box = _team_box(points="15 + q % 25", attempts="15 + s % 12", turnovers="1 + p % 6")
        return quarters.selectExpr(
            "game_id", f"{_SIDE_TEAM} AS team_id", "home_away", f"{_QUARTER} AS quarter", *box, "loaded_at"
        )

    def game_results(self) -> DataFrame:
        side = lambda tag: self.team_game_stats.where(F.col("home_away") == tag).selectExpr(
            "game_id", f"points AS {tag}_score", f"loaded_at AS {tag}_loaded"
        )
        return side("home").join(side("away"), "game_id").selectExpr(
            "game_id", "home_score", "away_score",
            "CAST(game_id AS BIGINT) % 12 = 0 AS overtime_flag",
            """CAST(CASE WHEN CAST(game_id AS BIGINT) % 24 = 0 THEN 2 WHEN CAST(game_id AS BIGINT) % 12 = 0 THEN 1
               WHEN CAST(game_id AS BIGINT) % 5 <> 0 THEN 0 END AS BIGINT) AS overtime_periods""",
            "greatest(home_loaded, away_loaded) AS loaded_at",
        )

    # -- players ----------------------------------------------------------------------------

    @cached_property
    def _suppliers(self) -> DataFrame:
        return self.read("supplier").selectExpr(
            "s_suppkey AS l_suppkey", f"{_player('substr(s_name, 10)')} AS player_name"
        )

    def player_game_stats(self) -> DataFrame:
        per_game = self._summed(self.read("lineitem"), "l_suppkey")
        return per_game.join(self._suppliers, "l_suppkey").selectExpr(
            "game_id", "player_name", f"{_team('l_suppkey % 25')} AS team_id", "first_line <= 3 AS starter",
            """CASE WHEN first_line = 6 THEN '' WHEN first_line <> 7
               THEN concat(low_part % 40, ':', high_part % 60) END AS minutes""",
            "q AS points", "p % 16 AS rebounds", "p % 13 AS assists", *_PLAYER_BOX,
            "p % 41 - 20 AS plus_minus", "loaded_at",
        )

    def player_quarter_stats(self) -> DataFrame:
        per_quarter = self._summed(self.read("lineitem"), "l_suppkey", "l_linenumber")
        return per_quarter.join(self._suppliers, "l_suppkey").selectExpr(
            "game_id", "player_name", f"{_team('l_suppkey % 25')} AS team_id", f"{_QUARTER} AS quarter",
            "CAST(p % 13 AS STRING) AS minutes", "q % 20 AS points", "p % 3 AS offensive_rebounds",
            "p % 5 AS defensive_rebounds", "p % 7 AS assists", *_PLAYER_BOX,
            "p % 21 - 10 AS plus_minus", "loaded_at",
        )

    def injuries(self) -> DataFrame:
        number = "user_id"
        return self.read("events").selectExpr(
            f"date_add(DATE '{INJURY_DAY_ONE}', dayofmonth(ts) - 1) AS game_date",
            "concat(lpad(hour(ts), 2, '0'), ':', lpad(minute(ts), 2, '0')) AS game_time",
            f"concat({_team(f'{number} % 25')}, '@', {_team(f'({number} + 1) % 25')}) AS matchup",
            f"{_team(f'{number} % 25')} AS team_id",
            f"{_player(f"lpad({number}, 9, '0')")} AS player_name",
            f"{_choice('event_type', _INJURY_STATUS)} AS status",
            "event_type AS reason",
            "concat('report-', lpad(event_id, 12, '0')) AS pdf_url",
            "ts AS scraped_at",
        )

    # -- officials, broadcast, lines --------------------------------------------------------

    def referee_assignments(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS game_id",
            "CAST(o_custkey % 17 AS STRING) AS referee_1",
            "CAST((o_custkey + 5) % 17 AS STRING) AS referee_2",
            "if(o_orderkey % 7 <> 0, CAST((o_custkey + 10) % 17 AS STRING), NULL) AS referee_3",
            "o_orderdate AS loaded_at",
        )

    def broadcast_schedule(self) -> DataFrame:
        return self.read("orders").selectExpr(
            "CAST(o_orderdate AS DATE) AS game_date",
            "CAST(o_orderkey AS STRING) AS game_id",
            "o_orderpriority = '1-URGENT' AS is_national_broadcast",
            "o_orderdate AS loaded_at",
        )

    def _lines(self, *more: str) -> DataFrame:
        return self.games.selectExpr(
            "game_date", "season", "home_team_id AS home_team", "away_team_id AS away_team",
            "CAST(game_id AS BIGINT) % 40 + 200.5D AS over_under",
            "CAST(game_id AS BIGINT) % 25 - 12 + 0.5D AS home_line",
            *more,
        )

    def betting_lines(self) -> DataFrame:
        return self._lines("loaded_at")

    def odds(self, days_before: int) -> DataFrame:
        return self._lines(
            "-110D - CAST(game_id AS BIGINT) % 90 AS home_moneyline",
            "100D + CAST(game_id AS BIGINT) % 90 AS away_moneyline",
            "concat('odds-', game_id) AS odds_api_game_id",
            f"loaded_at - INTERVAL {days_before} DAY AS captured_at",
        )

    # -- dimensions -------------------------------------------------------------------------

    def dim_arenas(self) -> DataFrame:
        zones = {str(i): zone for i, zone in enumerate(_ARENA_ZONES)}
        numbered = self.read("nation").selectExpr("CAST(n_nationkey AS BIGINT) AS arena_id", "n_name AS city")
        return numbered.selectExpr(
            "arena_id", "city",
            "if(arena_id <> 24, CAST(25 + (arena_id * 7) % 24 AS DOUBLE), NULL) AS latitude",
            "if(arena_id <> 24, CAST(-70 - (arena_id * 11) % 52 AS DOUBLE), NULL) AS longitude",
            "(arena_id * arena_id * 37) % 5300 AS altitude_feet",
            f"{_choice('CAST(arena_id % 5 AS STRING)', zones)} AS timezone",
        )

    def dim_referees(self) -> DataFrame:
        numbers = self.read("orders").selectExpr("o_custkey % 17 AS referee_id").distinct()
        return numbers.selectExpr("referee_id", "concat('Official ', referee_id) AS full_name")

    # -- scored games -----------------------------------------------------------------------

    @cached_property
    def _scored_events(self) -> DataFrame:
        """Each event rescores a game: 25 events in a row the same one, 14 games a day."""
        games = self.games.select("game_id", "home_team_id", "away_team_id", "tipoff_time")
        events = self.read("events").selectExpr(
            "event_id", "ts", "event_type", "value", "CAST(event_id DIV 25 AS STRING) AS game_id",
            f"date_add(DATE '{TRACKER_DAY_ONE}', CAST(event_id DIV 350 AS INT)) AS game_date",
        )
        return events.join(games, "game_id")

    def scored_games(self) -> DataFrame:
        insights = {
            field: insight_text(f"(event_id * {i + 5} + {i}) % 6", field)
            for i, field in enumerate(PREVIEW_INSIGHTS)
        }
        return self._scored_events.selectExpr(
            "game_date", "home_team_id", "away_team_id", "tipoff_time", "ts AS inserted_at",
            "event_id % 3 = 0 AS is_national_broadcast",
            *_named(_MODEL),
            f"{_MODEL['over_under']} + {_MODEL['model_vs_line']} AS model_total",
            *_named(_LABELS),
            "concat(event_id % 50, '-', event_id % 30) AS home_record",
            "concat(event_id % 40, '-', event_id % 35) AS away_record",
            "concat('Official ', event_id % 17) AS crew_chief_name",
            *_named(insights),
        )

    def model_tracker(self) -> DataFrame:
        from courtside.functions import pick_text as pt

        graded = self._scored_events.selectExpr(
            "game_date", "home_team_id", "away_team_id", "ts AS scored_at", *_named(_MODEL | _GAPS),
            "if(event_id % 7 <> 0, event_id % 2 = 0, NULL) AS divergence_correct",
            "if(event_id % 8 <> 0, event_id % 3 = 0, NULL) AS model_ou_correct",
            "if(event_id % 9 <> 0, event_id % 41 - 20, NULL) AS actual_margin",
            "if(event_id % 9 <> 0, 180 + event_id % 70, NULL) AS actual_total",
        )
        return graded.withColumns({
            "divergence_strength": pt.divergence_strength("model_vs_market"),
            "signal_strength": pt.signal_strength("composite_score"),
            "ou_signal_strength": pt.total_strength("model_vs_line"),
        }).drop("composite_score")

    def game_previews(self) -> DataFrame:
        """Previews already published: one for each purchase of a high value."""
        model = {name: rule for name, rule in _MODEL.items() if name != "model_vs_line"}
        published = "event_type = 'purchase' AND value >= 100"
        return self._scored_events.where(published).selectExpr(
            "game_date", "home_team_id", "away_team_id", "tipoff_time",
            "event_id % 5 = 0 AS is_free_game", *_named(model), *_named(_LABELS),
            "concat('preview ', event_id) AS preview_text",
            "false AS posted_substack", "false AS posted_reddit", "ts AS generated_at",
        )
