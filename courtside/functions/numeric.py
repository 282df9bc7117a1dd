"""Rounding, guarded comparison and exact means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary value, as a double.

    The whole part goes through a bigint so that a negative zero never appears.
    """
    scaled = _col(value).cast("double") * float(10**digits)
    whole = F.when(scaled < 0, -F.floor(0.5 - scaled)).otherwise(F.floor(scaled + 0.5))
    return whole / float(10**digits)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null on a zero denominator instead of an ANSI error."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def mean_of(value: Column | str, digits: int = 0) -> Column:
    """Mean of a column that carries ``digits`` decimals.

    Doubles with decimals are summed as whole units: floating sums depend on the order in which
    partitions arrive, and a mean that sits on a rounding tie would then change between runs.
    """
    if digits == 0:
        return F.avg(_col(value))
    return F.avg(as_units(value, digits)) / float(10**digits)


def as_units(value: Column | str, digits: int) -> Column:
    """A rounded double as a bigint count of its last decimal (0.417, 3 -> 417)."""
    return F.round(_col(value) * float(10**digits)).cast("bigint")


def round_mean(value: Column | str, digits: int, carries: int = 0) -> Column:
    return round_half_up(mean_of(value, carries), digits)


def _all_present(columns: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def least_or_null(*values: Column | str) -> Column:
    """``least`` that gives null as soon as one input is null (Spark's skips nulls)."""
    columns = tuple(_col(v) for v in values)
    return F.when(_all_present(columns), F.least(*columns))


def greatest_or_null(*values: Column | str) -> Column:
    columns = tuple(_col(v) for v in values)
    return F.when(_all_present(columns), F.greatest(*columns))


def flag(condition: Column) -> Column:
    """A condition as a boolean that is never null."""
    return F.coalesce(condition, F.lit(False))


def one_if(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (also where it is unknown)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def bucketize(
    value: Column | str, steps: list[tuple[str, float, str]], otherwise: str | None
) -> Column:
    """First matching step wins; a step is (comparison, bound, label) with ``>=`` or ``<=``.

    A null value matches no step and gets ``otherwise``.
    """
    column = _col(value)
    tests = {">=": column.__ge__, "<=": column.__le__}
    chain = F
    for comparison, bound, label in steps:
        chain = chain.when(tests[comparison](F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(otherwise).cast("string"))
