"""Newest rows and lookups per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The current season: a year, or one row with ``current_season``.
Season = int | DataFrame

_RANK = "_rank"


def newest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], keep: int = 1
) -> DataFrame:
    """The ``keep`` first rows of each key.

    Spark limits each group before the shuffle as well (WindowGroupLimit), so a key that holds
    most of the table still sends only ``keep`` rows per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    ranked = df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= keep)
    return ranked.drop(_RANK) if keep == 1 else ranked.withColumnRenamed(_RANK, "recency")


def newest_state(rows: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The newest row of each key as a state that merges: newest by these columns, descending, nulls last.

    One aggregate, combined before the shuffle. The newest row of a union is the newest row of the
    newest rows of its parts, so a state and the rows that came later are enough, in whatever order
    they come. Rows that are equal in ``newest_by`` are told apart by their other columns.
    """
    rest = [c for c in rows.columns if c not in keys and c not in newest_by]
    newest = F.max(F.struct(*newest_by, *rest)).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(rows.columns)


def merge_newest(state: DataFrame, batch: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The state after a batch; only the two are read."""
    return newest_state(state.unionByName(batch), keys, newest_by)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``row_count``, ``key_count``, ``repeated_keys`` (in several rows) and ``rows_without_key``.

    A key with a null column is none: joins never find it. Only keys are read; each is counted before
    the shuffle, so that one key in many rows is no burden to a task.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    whole = reduce(and_, [F.col(key).isNotNull() for key in keys])
    zero = F.lit(0).cast("bigint")
    return counts.agg(
        F.coalesce(F.sum("_rows"), zero).alias("row_count"),
        F.count_if(whole).alias("key_count"),
        F.count_if(whole & (F.col("_rows") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(~whole, F.col("_rows"))), zero).alias("rows_without_key"),
    )


def with_flag(df: DataFrame, flags: DataFrame, on: str, name: str) -> DataFrame:
    """Left-join one boolean column; a missing one is false."""
    return df.join(flags.select(on, name), on, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(False))
    )


def with_total(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach an aggregate without keys to every row.

    ``totals`` must have exactly one row: more would multiply ``df``, and only one row is always
    small enough to broadcast.
    """
    return df.crossJoin(F.broadcast(totals))


def in_season(df: DataFrame, season_now: Season) -> DataFrame:
    """Rows of one season; a given year is a literal, which reaches the scan.

    A season that is known at run time only is joined by equality, so that folders by season of other
    seasons are skipped once it is known. Dynamic pruning asks for a filter on that side; seasons are
    years, so this one drops nothing.
    """
    if isinstance(season_now, int):
        return df.where(F.col("season") == F.lit(season_now).cast("bigint"))
    current = F.broadcast(season_now.where(F.col("current_season") > 0))
    return df.join(current, F.col("season") == F.col("current_season")).drop("current_season")


def with_season_age(df: DataFrame, season_now: Season, name: str) -> DataFrame:
    """Add how many seasons before the current one a row is."""
    if isinstance(season_now, int):
        return df.withColumn(name, F.lit(season_now).cast("bigint") - F.col("season"))
    age = F.col("current_season") - F.col("season")
    return with_total(df, season_now).withColumn(name, age).drop("current_season")


def versus_population(df: DataFrame, columns: Sequence[str], carries: int) -> DataFrame:
    """Add ``<column>_mean``: the unweighted mean over all rows, as one row joined back.

    A window over the whole table would pull every row into one task.
    """
    from courtside.functions.numeric import mean_of

    means = df.agg(*[mean_of(c, carries).alias(f"{c}_mean") for c in columns])
    return with_total(df, means)
