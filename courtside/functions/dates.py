"""Calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_date(day: Column | dt.date | str | None) -> Column:
    """A day parameter as a column; None means today in New York."""
    if day is None:
        return F.to_date(F.convert_timezone(None, F.lit("America/New_York"), F.localtimestamp()))
    if isinstance(day, Column):
        return day
    return F.lit(str(day)).cast("date")


def minute_of_day(clock: Column | str) -> Column:
    """``H:MM`` or ``HH:MM``, with or without seconds, as minutes; null if it isn't a time."""
    text = F.col(clock) if isinstance(clock, str) else clock
    part = lambda i: F.split_part(text, F.lit(":"), F.lit(i)).try_cast("int")
    return part(1) * 60 + part(2)


def recap_sunday(day: Column) -> Column:
    """The day itself on a Sunday, else the Sunday before."""
    return F.date_sub(day, F.dayofweek(day) - F.lit(1))


def recap_monday(day: Column) -> Column:
    """Monday of the week that ends on ``recap_sunday``."""
    return F.date_sub(recap_sunday(day), 6)
