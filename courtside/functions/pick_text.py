"""Signal strengths, sides and display texts of picks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from courtside.functions.numeric import bucketize, round_half_up

# Lower bounds of the strength classes, on absolute values.
DIVERGENCE_STEPS = [(">=", 0.10, "STRONG"), (">=", 0.06, "MEDIUM")]
SIGNAL_STEPS = [(">=", 0.30, "STRONG"), (">=", 0.15, "MEDIUM")]
TOTAL_STEPS = [(">=", 5.0, "STRONG"), (">=", 3.0, "MEDIUM")]

HOME_EDGE = 0.10
OVER_EDGE = 5.0

# Wording shown to readers.
MISSING = "N/A"
WIN, LOSS, PUSH = "✅ WIN", "❌ LOSS", "➖ PUSH"


def or_zero(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("double"), F.lit(0.0))


def divergence_strength(model_vs_market: Column | str) -> Column:
    return bucketize(F.abs(or_zero(model_vs_market)), DIVERGENCE_STEPS, "NONE")


def signal_strength(composite_score: Column | str) -> Column:
    return bucketize(F.abs(or_zero(composite_score)), SIGNAL_STEPS, "WEAK")


def total_strength(model_vs_line: Column | str) -> Column:
    return bucketize(F.abs(or_zero(model_vs_line)), TOTAL_STEPS, "NONE")


def one_decimal(value: Column) -> Column:
    """A number with exactly one decimal, as text."""
    units = F.round(round_half_up(F.abs(value), 1) * 10.0).cast("bigint")
    digits = F.concat((units / 10).cast("bigint").cast("string"), F.lit("."), (units % 10).cast("string"))
    return F.when((value < 0) & (units > 0), F.concat(F.lit("-"), digits)).otherwise(digits)


def signed(value: Column) -> Column:
    """A number with one decimal and a plus sign when it is above zero."""
    return F.when(value > 0, F.concat(F.lit("+"), one_decimal(value))).otherwise(one_decimal(value))


def margin_text(value: Column) -> Column:
    """A whole margin that always carries its sign, zero included."""
    whole = value.cast("bigint").cast("string")
    return F.when(value >= 0, F.concat(F.lit("+"), whole)).otherwise(whole)


def spread_side(model_vs_market: Column | str, home: Column | str, away: Column | str) -> Column:
    home, away = (F.col(c) if isinstance(c, str) else c for c in (home, away))
    return F.when(or_zero(model_vs_market) >= HOME_EDGE, F.concat(home, F.lit(" (HOME)"))).otherwise(
        F.concat(away, F.lit(" (AWAY)"))
    )


def total_side(model_vs_line: Column | str, suffix: str = " pts") -> Column:
    edge = or_zero(model_vs_line)
    size = F.concat(F.lit(" (~"), one_decimal(F.abs(edge)), F.lit(f"{suffix})"))
    return F.concat(F.when(edge >= OVER_EDGE, F.lit("OVER")).otherwise(F.lit("UNDER")), size)


def result_label(correct: Column | str) -> Column:
    column = F.col(correct) if isinstance(correct, str) else correct
    return F.when(column, F.lit(WIN)).when(~column, F.lit(LOSS)).otherwise(F.lit(PUSH))


def record_text(correct: Column, total: Column) -> Column:
    """``7-3 (70.0%)``."""
    pct = F.coalesce(F.try_divide(correct * 100, total), F.lit(0.0))
    return F.concat(
        correct.cast("string"), F.lit("-"), (total - correct).cast("string"),
        F.lit(" ("), one_decimal(pct), F.lit("%)"),
    )


# Wording of the flags in the two functions below.
def total_flag(model_vs_line: Column | str) -> Column:
    edge = or_zero(model_vs_line)
    size = one_decimal(F.abs(edge))
    return (
        F.when(edge >= 5, F.concat(F.lit("OVER — total may be low by ~"), size, F.lit(" points")))
        .when(edge <= -5, F.concat(F.lit("UNDER — total may be high by ~"), size, F.lit(" points")))
        .when(edge >= 3, F.concat(F.lit("SLIGHT OVER lean (~"), size, F.lit(" pts)")))
        .when(edge <= -3, F.concat(F.lit("SLIGHT UNDER lean (~"), size, F.lit(" pts)")))
        .otherwise(F.lit("FAIR"))
    )


def spread_flag(model_vs_market: Column | str) -> Column:
    edge = or_zero(model_vs_market)
    return (
        F.when(edge >= 0.10, F.lit("HOME EDGE — analysis meaningfully favors home team vs the line"))
        .when(edge <= -0.10, F.lit("AWAY EDGE — analysis meaningfully favors away team vs the line"))
        .when(edge >= 0.06, F.lit("SLIGHT HOME EDGE"))
        .when(edge <= -0.06, F.lit("SLIGHT AWAY EDGE"))
        .otherwise(F.lit("FAIR"))
    )
