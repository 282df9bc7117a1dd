"""Weekly and season record of graded picks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions import pick_text as pt
from courtside.functions.dates import as_date, recap_monday, recap_sunday
from courtside.plans.picks import is_spread_pick, is_total_pick, latest_scores


def _in_week(day: dt.date | str | None) -> Column:
    date = as_date(day)
    return F.col("game_date").between(recap_monday(date), recap_sunday(date))


def latest_grades(tracker: DataFrame) -> DataFrame:
    return latest_scores(tracker, stamp="scored_at")


def graded_spread() -> Column:
    return is_spread_pick() & F.col("divergence_correct").isNotNull()


def graded_total() -> Column:
    return is_total_pick() & F.col("model_ou_correct").isNotNull()


def pick_record(tracker: DataFrame, day: dt.date | str | None) -> DataFrame:
    """Wins and graded picks, for the week and the season, spread and total: four rows.

    One pass over the newest versions counts all four; the counts are then unfolded. The week is
    chosen by game date, which is part of the version key, so it may be chosen after the version.
    """
    kinds = {
        "spread": (graded_spread(), F.col("divergence_correct")),
        "ou": (graded_total(), F.col("model_ou_correct")),
    }
    counts, entries = [], []
    for period, within in (("week", _in_week(day)), ("season", F.lit(True))):
        for kind, (graded, correct) in kinds.items():
            name = f"{period}_{kind}"
            counts += [
                F.count_if(within & graded & correct).alias(f"{name}_correct"),
                F.count_if(within & graded).alias(f"{name}_total"),
            ]
            entries.append(F.struct(
                F.lit(period).alias("period"), F.lit(kind).alias("pick_type"),
                F.col(f"{name}_correct").alias("correct"), F.col(f"{name}_total").alias("total"),
            ))
    one_row = latest_grades(tracker).agg(*counts)
    rows = one_row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return rows.withColumn("record", pt.record_text(F.col("correct"), F.col("total")))


def week_picks(tracker: DataFrame, day: dt.date | str | None) -> DataFrame:
    """Newest graded picks of the week, one row per pick; only the week's rows are read."""
    latest = latest_grades(tracker.where(_in_week(day)))
    kinds = F.array_compact(F.array(
        F.when(graded_spread(), F.lit("spread")), F.when(graded_total(), F.lit("ou"))
    ))
    return latest.withColumn("pick_type", F.explode(kinds))


def recap_lines(picks: DataFrame) -> DataFrame:
    """Heading, detail and final line of each graded pick."""
    spread = F.col("pick_type") == "spread"
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    known = lambda number: F.coalesce(number, F.lit(pt.MISSING))
    home, away = F.col("home_team_id"), F.col("away_team_id")
    side = pt.spread_side("model_vs_market", home, away)
    return picks.select(
        "game_date", "home_team_id", "away_team_id", "pick_type",
        text(away, " @ ", home, " — ", F.col("game_date").cast("string")).alias("heading"),
        F.when(
            spread,
            text("Line: ", home, " ", known(pt.signed(F.col("spread_home"))), " | Pick: ", side,
                 " | Result: ", pt.result_label("divergence_correct")),
        ).otherwise(
            text("Total: ", known(pt.one_decimal(F.col("over_under"))), " | Pick: ",
                 pt.total_side("model_vs_line"), " | Result: ", pt.result_label("model_ou_correct")),
        ).alias("detail"),
        F.when(spread, text("Final margin: ", pt.margin_text(F.col("actual_margin"))))
        .otherwise(text("Final total: ", F.col("actual_total").cast("string")))
        .alias("final"),
    )
