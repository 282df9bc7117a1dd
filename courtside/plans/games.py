"""Played games: both box scores side by side, pace, broadcast flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.numeric import round_half_up
from courtside.operators.keyed import with_flag
from courtside.operators.pairs import pair_record
from courtside.operators.shape import SIDES, to_team_rows
from courtside.sources.schemas import PERIODS, WIDE_BOX

REGULATION_MINUTES = 48
OVERTIME_MINUTES = 5
FREE_THROW_SHARE = 0.44

_PACE_COLUMNS = [
    "game_id", "game_date", "home_team_id", "away_team_id", "overtime_periods", "total_minutes",
    "home_possessions", "away_possessions", "avg_possessions", "home_pace", "away_pace", "game_pace",
]


def _both_boxes(team_stats: DataFrame) -> DataFrame:
    """Box scores of games with both sides, one row each: one scan, one grouping by game.

    Of repeated rows of a side, each column's largest value counts.
    """
    of_side = lambda side, column: f"max(CASE WHEN home_away = '{side}' THEN {column} END)"
    columns = [
        f"{of_side(side, column)} AS {side}_{short}"
        for side in SIDES
        for column, short in {"team_id": "team_id", **WIDE_BOX}.items()
    ]
    present = [f"count_if(home_away = '{side}') AS _{side}" for side in SIDES]
    sides = team_stats.groupBy("game_id").agg(*[F.expr(c) for c in (*columns, *present)])
    return sides.where("_home > 0 AND _away > 0").drop("_home", "_away")


def quarter_points(quarters: DataFrame) -> DataFrame:
    """Points per side and period as columns, and the overtimes of the home side."""
    points = [
        f"max(CASE WHEN home_away = '{side}' AND quarter = '{period}' THEN points END) "
        f"AS {side}_pts_{period.lower()}"
        for side in SIDES
        for period in PERIODS
    ]
    overtimes = "count_if(home_away = 'home' AND startswith(quarter, 'OT')) AS quarter_overtimes"
    return quarters.groupBy("game_id").agg(*[F.expr(c) for c in (*points, overtimes)])


def box_scores(games: DataFrame, team_stats: DataFrame) -> DataFrame:
    """Games with a box score on both sides, one row each, both sides as columns.

    Every input is read and partitioned by game once.
    """
    shorts = [short for short in WIDE_BOX.values() if short != "points"]
    home_won = "home_points > away_points"
    return (
        games.select("game_id", "game_date", "season", "arena_id", "tipoff_time")
        .join(_both_boxes(team_stats), "game_id")
        .selectExpr(
            "game_id", "game_date", "season", "arena_id", "tipoff_time",
            "home_team_id", "away_team_id", "home_points", "away_points",
            "home_points - away_points AS point_differential",
            f"if({home_won}, home_team_id, away_team_id) AS winner_team_id",
            f"if({home_won}, 'home', 'away') AS winner_home_away",
            "home_points + away_points AS total_points",
            *[f"{side}_{short}" for side in SIDES for short in shorts],
        )
    )


def wide_game(boxes: DataFrame, quarters: DataFrame) -> DataFrame:
    """Box scores with the quarter points as columns and the overtimes among the quarters."""
    joined = boxes.join(quarter_points(quarters), "game_id", "left")
    return joined.withColumn(
        "overtime_periods", F.expr("coalesce(quarter_overtimes, 0L)")
    ).drop("quarter_overtimes")


def _possessions(side: str) -> Column:
    fga, oreb, tov, fta = (F.col(f"{side}_{c}") for c in ("fga", "oreb", "tov", "fta"))
    return (fga - oreb + tov) + F.lit(FREE_THROW_SHARE) * fta


def with_pace(scores: DataFrame, results: DataFrame) -> DataFrame:
    """Add possessions, pace and the overtime count of the result feed to played games."""
    overtime = results.selectExpr("game_id", "overtime_periods AS _ot")
    minutes = F.col("total_minutes")
    per_regulation = lambda possessions: round_half_up(possessions / minutes * REGULATION_MINUTES, 1)
    home, away = F.col("_home"), F.col("_away")
    return (
        scores.drop("overtime_periods")
        .join(overtime, "game_id", "left")
        .withColumns({
            "overtime_periods": F.coalesce("_ot", F.lit(0).cast("bigint")),
            "_home": _possessions("home"),
            "_away": _possessions("away"),
        })
        .withColumn("total_minutes", REGULATION_MINUTES + F.col("overtime_periods") * OVERTIME_MINUTES)
        .withColumns({
            "home_possessions": round_half_up(home, 1),
            "away_possessions": round_half_up(away, 1),
            "avg_possessions": round_half_up((home + away) / 2.0, 1),
            "home_pace": per_regulation(home),
            "away_pace": per_regulation(away),
            "game_pace": per_regulation((home + away) / 2.0),
        })
        .drop("_ot", "_home", "_away")
    )


def game_pace(scores: DataFrame, results: DataFrame) -> DataFrame:
    return with_pace(scores, results).select(*_PACE_COLUMNS)


def national_broadcast_flag(scores: DataFrame, schedule: DataFrame) -> DataFrame:
    games = scores.select("game_id", "game_date", "home_team_id", "away_team_id")
    return with_flag(games, schedule, "game_id", "is_national_broadcast")


def head_to_head(scores: DataFrame) -> DataFrame:
    record = pair_record(scores, tie_rule="team_b")
    return record.select(
        "team_a", "team_b", "games_played", "team_a_wins", "team_b_wins",
        round_half_up("team_a_share", 3).alias("team_a_win_pct"),
        "last_meeting", "first_meeting",
    )


def team_rows(played: DataFrame) -> DataFrame:
    """One row per team and played game; equal scores are a win for neither.

    ``pace`` (the team's own) comes along where the input carries it.
    """
    won = lambda a, b: F.when(F.col(a) > F.col(b), 1).otherwise(0).cast("bigint")
    paced = "home_pace" in played.columns

    def side(me: str, other: str) -> dict[str, Column]:
        columns = {
            "team_id": F.col(f"{me}_team_id"),
            "opponent_id": F.col(f"{other}_team_id"),
            "team_points": F.col(f"{me}_points"),
            "opp_points": F.col(f"{other}_points"),
            "win": won(f"{me}_points", f"{other}_points"),
        }
        return columns | ({"pace": F.col(f"{me}_pace")} if paced else {})

    shared = ["game_id", "game_date", "season"]
    if paced:
        shared += ["game_pace", "overtime_periods"]
    return to_team_rows(played, shared, side("home", "away"), side("away", "home"))
