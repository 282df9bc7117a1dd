"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from courtside.functions.numeric import round_mean

SIDES = ("home", "away")


def to_team_rows(
    games: DataFrame, shared: Sequence[str], home: Mapping[str, Column], away: Mapping[str, Column]
) -> DataFrame:
    """One row per side of each game, from a single scan.

    ``home`` and ``away`` give the same output columns; ``home_away`` tells the side.
    """
    def side(tag: str, columns: Mapping[str, Column]) -> Column:
        fields = [F.lit(tag).alias("home_away"), *(columns[c].alias(c) for c in home)]
        return F.struct(*fields)

    both = F.explode(F.array(side("home", home), side("away", away))).alias("team")
    return games.select(*shared, both).select(*shared, "team.*")


def attach_both_sides(
    team_rows: DataFrame, keys: Sequence[str], columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Back to one row per game: ``columns`` maps a source to its (home name, away name)."""
    wide = [
        F.max(F.when(F.col("home_away") == tag, F.col(source))).alias(names[i])
        for source, names in columns.items()
        for i, tag in enumerate(SIDES)
    ]
    return team_rows.groupBy(*keys).agg(*wide)


def unpivot_slots(df: DataFrame, keys: Sequence[str], slots: Sequence[str], value: str) -> DataFrame:
    """One row per filled slot; empty slots disappear."""
    long = df.unpivot(list(keys), list(slots), "slot", value)
    return long.where(F.col(value).isNotNull()).drop("slot")


def quarter_profile(
    df: DataFrame, entity: str, metrics: Mapping[str, str], quarters: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Mean of each metric per quarter as columns ``avg_<short>_<quarter>``."""
    means = [
        round_mean(F.when(F.col("quarter") == q, F.col(metric)), 1).alias(f"avg_{short}_{q.lower()}")
        for metric, short in metrics.items()
        for q in quarters[metric]
    ]
    return df.groupBy(entity).agg(*means)


def bucket_columns(bucket: Column, labels: Mapping[str, str]) -> list[Column]:
    """Aggregates of games, wins and win share of each bucket, side by side.

    ``labels`` maps a bucket value to its column prefix. A bucket without games gives nulls.
    """
    columns = []
    for value, prefix in labels.items():
        here = bucket == value
        games = F.nullif(F.count_if(here), F.lit(0).cast("bigint"))
        wins = F.sum(F.when(here, F.col("win")))
        columns += [
            games.alias(f"{prefix}_games"),
            wins.alias(f"{prefix}_wins"),
            round_mean(F.when(here, F.col("win")), 3).alias(f"{prefix}_win_pct"),
        ]
    return columns
