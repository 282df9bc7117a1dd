"""Rest, travel, time zones and altitude, from the schedule alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.geo import great_circle_miles, zone_shift
from courtside.operators.shape import attach_both_sides, to_team_rows
from courtside.operators.timeline import Timeline
from courtside.plans.teams import TEAM_ORDER

GAME_KEYS = ["game_id", "game_date", "home_team_id", "away_team_id"]
TRAVEL_SCOPES = ("side", "all")


def _previous(column: str):
    return lambda window: F.lag(column).over(window)


def schedule_rows(games: DataFrame, arenas: DataFrame) -> DataFrame:
    """One row per side of each scheduled game, with its arena's data."""
    team = lambda side: {"team_id": F.col(f"{side}_team_id")}
    rows = to_team_rows(games, [*GAME_KEYS, "arena_id"], team("home"), team("away"))
    return rows.join(arenas, "arena_id", "left")


def schedule_timeline(rows: DataFrame) -> Timeline:
    return Timeline.of(rows, ["team_id"], TEAM_ORDER)


def _of_sides(*names: str) -> dict[str, tuple[str, str]]:
    return {name: (f"home_{name}", f"away_{name}") for name in names}


# Columns of a side's row and their names on the game's row.
CONTEXT_SIDES = {
    **_of_sides("days_rest", "timezone_shift", "prev_altitude", "altitude_change"),
    "altitude_feet": ("home_arena_altitude", "away_arena_altitude"),
}
TRAVEL_SIDES = _of_sides("travel_miles")


def context_rows(timeline: Timeline) -> DataFrame:
    """Rest, zone shift and altitude change, one row per side.

    One ordered pass serves all three; unused columns are pruned by the optimizer.
    """
    looked_back = timeline.with_windows(
        1,
        {
            "_prev_date": _previous("game_date"),
            "_prev_zone": _previous("timezone"),
            "prev_altitude": _previous("altitude_feet"),
        },
        reads=["timezone", "altitude_feet"],
    ).rows
    altitude = F.col("altitude_feet")
    return looked_back.withColumns({
        "days_rest": (F.date_diff("game_date", "_prev_date") - 1).cast("bigint"),
        "timezone_shift": zone_shift(F.col("_prev_zone"), F.col("timezone")),
        "altitude_change": altitude - F.coalesce("prev_altitude", altitude),
    })


def _with_context_advantages(wide: DataFrame) -> DataFrame:
    return wide.withColumns({
        "rest_advantage": _away_minus_home("days_rest"),
        "timezone_lag_advantage": F.col("away_timezone_shift"),
        "altitude_fatigue_advantage": _away_minus_home("altitude_change"),
    })


def schedule_context(timeline: Timeline) -> DataFrame:
    """Rest, zone shift and altitude change of both sides, one row per game."""
    return _with_context_advantages(attach_both_sides(context_rows(timeline), GAME_KEYS, CONTEXT_SIDES))


def _away_minus_home(name: str) -> Column:
    return F.col(f"away_{name}") - F.col(f"home_{name}")


def rest_days(context: DataFrame) -> DataFrame:
    """Days without a game before this one; null for a team's first game."""
    return context.select(*GAME_KEYS, "home_days_rest", "away_days_rest", "rest_advantage")


def timezone_lag(context: DataFrame) -> DataFrame:
    """Hours moved since the last game; the advantage column is the away shift alone."""
    return context.select(
        *GAME_KEYS, "home_timezone_shift", "away_timezone_shift", "timezone_lag_advantage"
    )


def altitude_fatigue(context: DataFrame) -> DataFrame:
    return context.select(
        *GAME_KEYS,
        "home_arena_altitude", "home_prev_altitude", "home_altitude_change",
        "away_arena_altitude", "away_prev_altitude", "away_altitude_change",
        "altitude_fatigue_advantage",
    )


def travel_timeline(rows: DataFrame, scope: str = "side") -> Timeline:
    """``side`` looks back within a team's home games and its away games apart; ``all`` at any."""
    if scope not in TRAVEL_SCOPES:
        raise ValueError(f"scope must be one of {TRAVEL_SCOPES}")
    entity = ["team_id", "home_away"] if scope == "side" else ["team_id"]
    return Timeline.of(rows, entity, TEAM_ORDER)


def travel_rows(timeline: Timeline) -> DataFrame:
    """Great-circle miles from the previous arena, one row per side; 0 for the first game or the same arena."""
    here = {"lat": "latitude", "lon": "longitude"}
    rows = timeline.with_windows(
        1,
        {
            "_arena": _previous("arena_id"),
            **{f"_{short}": _previous(column) for short, column in here.items()},
        },
        reads=["arena_id", *here.values()],
    ).rows
    stayed = F.col("_arena").isNull() | F.coalesce(F.col("_arena") == F.col("arena_id"), F.lit(False))
    miles = great_circle_miles(*(F.col(c) for c in ("_lat", "_lon", "latitude", "longitude")))
    return rows.withColumn("travel_miles", F.when(stayed, F.lit(0.0)).otherwise(miles))


def _with_travel_advantage(wide: DataFrame) -> DataFrame:
    return wide.withColumn("travel_advantage", _away_minus_home("travel_miles"))


def travel_miles(timeline: Timeline) -> DataFrame:
    """Miles travelled by both sides, one row per game."""
    return _with_travel_advantage(attach_both_sides(travel_rows(timeline), GAME_KEYS, TRAVEL_SIDES))


def schedule_features(context: Timeline, travel: Timeline) -> DataFrame:
    """Context and travel of both sides by game id: their side rows are folded in one shuffle.

    The result is partitioned by game id, as a join by game needs it.
    """
    sides = [
        context_rows(context).select("game_id", "home_away", *CONTEXT_SIDES),
        travel_rows(travel).select("game_id", "home_away", *TRAVEL_SIDES),
    ]
    every = sides[0].unionByName(sides[1], allowMissingColumns=True)
    folded = attach_both_sides(every, ["game_id"], {**CONTEXT_SIDES, **TRAVEL_SIDES})
    return _with_travel_advantage(_with_context_advantages(folded))


# Context of a quarter row, as (output, home or away column).
ALTITUDE_CONTEXT = [
    ("game_altitude", "arena_altitude"),
    ("altitude_change", "altitude_change"),
    ("prev_altitude", "prev_altitude"),
]


def with_side_context(rows: DataFrame, context: DataFrame, is_home: Column) -> DataFrame:
    """Give each row the home or the away columns of its game's context."""
    names = [f"{side}_{column}" for _, column in ALTITUDE_CONTEXT for side in ("home", "away")]
    joined = rows.join(context.select("game_id", *names), "game_id")
    picked = {
        output: F.when(is_home, F.col(f"home_{column}")).otherwise(F.col(f"away_{column}"))
        for output, column in ALTITUDE_CONTEXT
    }
    return joined.withColumns({f"_{k}": v for k, v in picked.items()}).drop(*names).withColumnsRenamed(
        {f"_{k}": k for k in picked}
    )


def altitude_by_quarter(quarters: DataFrame, altitude: DataFrame) -> DataFrame:
    rows = with_side_context(quarters.drop("loaded_at"), altitude, F.col("home_away") == "home")
    return rows


def altitude_by_player(
    player_quarters: DataFrame, scores: DataFrame, altitude: DataFrame
) -> DataFrame:
    """Player quarters of played games; a player of neither team gets the away side."""
    dated = player_quarters.drop("loaded_at").join(
        scores.select("game_id", "game_date", F.col("home_team_id").alias("_home")), "game_id"
    )
    return with_side_context(dated, altitude, F.col("team_id") == F.col("_home")).drop("_home")
