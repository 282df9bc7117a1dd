"""Ordered computations per entity that stay distributed when one entity holds most of the rows.

A window over ``partitionBy(entity)`` puts all rows of an entity into one task. ``Timeline`` never
does. Spans of ``span_days`` days of the first order column, a date, cut each entity's rows into
segments, and one scan serves running values, values of the whole entity, runs and windows of a
fixed reach together:

* each segment is summed up in one row that merges with others: its folds, its number of rows, the
  place of the last row with either value of a flag, and its last rows;
* those rows are folded over an entity's segments (dates bound how many there are), which gives what
  a segment has to know of all before it;
* that knowledge enters the segment as border rows in front of its own: the last rows before it, the
  oldest of which carries the folds. One window over (entity, segment) then computes everything, and
  the border rows go. No row is joined to anything.

Which segment a row is in depends on the row alone, so nothing is counted beforehand and nothing is
written. Order columns must not be null. A shorter span makes smaller segments and more border rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

#: Days of an entity's rows that one window group holds.
SPAN_DAYS = 64

SEQ = "_seq"
SEGMENT = "_segment"
BORDER = "_border"

_FOLDS = {"sum": F.sum, "max": F.max}

Fold = tuple[str, Column]
WindowColumn = Callable[[WindowSpec], Column]


@dataclass(frozen=True)
class Timeline:
    """Rows of several entities, each in ``order`` (ascending, unique per entity)."""

    rows: DataFrame
    entity: tuple[str, ...]
    order: tuple[str, ...]
    span_days: int = SPAN_DAYS

    @classmethod
    def of(cls, rows: DataFrame, entity: Sequence[str], order: Sequence[str]) -> Timeline:
        return cls(rows, tuple(entity), tuple(order))

    def select(self, *columns: str | Column) -> DataFrame:
        return self.rows.select(*columns)

    def joined(self, values: DataFrame) -> Timeline:
        """Add one row of values per entity; entities without one are left out as a whole."""
        return replace(self, rows=self.rows.join(values, list(self.entity)))

    def with_columns(self, columns: Mapping[str, Column]) -> Timeline:
        return replace(self, rows=self.rows.withColumns(dict(columns)))

    def with_running(
        self, running: Mapping[str, Fold], whole: Mapping[str, Fold] | None = None
    ) -> Timeline:
        """Add values folded from the first row up to this one, and folded over the whole entity.

        A fold is ("sum" | "max", column); sums must be of whole numbers.
        """
        return self.scan(running=running, whole=whole)

    def with_windows(
        self, reach: int, columns: Mapping[str, WindowColumn], reads: Sequence[str] | None = None
    ) -> Timeline:
        """Add window columns that look at most ``reach`` rows back; see ``scan``."""
        return self.scan(reach=reach, windows=columns, reads=reads)

    def with_runs(self, flag: str, length: str) -> Timeline:
        """Add the position inside the run of equal 0/1 ``flag`` values that a row belongs to."""
        return self.scan(runs={length: flag})

    def scan(
        self,
        running: Mapping[str, Fold] | None = None,
        whole: Mapping[str, Fold] | None = None,
        runs: Mapping[str, str] | None = None,
        reach: int = 0,
        windows: Mapping[str, WindowColumn] | None = None,
        reads: Sequence[str] | None = None,
    ) -> Timeline:
        """Add running and whole folds, lengths of runs (name: flag) and window columns in one pass.

        ``reads`` names the columns that the windows look at, all if it isn't given. In front of an
        entity's first rows a window may meet one row of nulls.
        """
        running, whole, runs, windows = dict(running or {}), dict(whole or {}), runs or {}, windows or {}
        if runs:
            running[SEQ] = ("sum", F.lit(1).cast("bigint"))
        cell = [*self.entity, SEGMENT]
        span = F.floor(F.unix_date(F.col(self.order[0]).cast("date")) / F.lit(self.span_days))
        rows = self.rows.withColumn(SEGMENT, span)
        seen = [c for c in self.rows.columns if windows and (reads is None or c in reads)]
        seen = [c for c in seen if c not in cell and c not in self.order]
        carried, borders = self._borders(rows, cell, running, whole, runs, max(reach, 1), seen)

        both = rows.withColumn(BORDER, F.lit(False)).unionByName(borders, allowMissingColumns=True)
        inside = Window.partitionBy(*cell).orderBy(*self.order)
        upto = inside.rowsBetween(Window.unboundedPreceding, 0)
        part = lambda name, column: F.when(F.col(BORDER), F.col(carried[name])).otherwise(column)
        found = both.withColumns({
            **{name: _FOLDS[kind](part(name, column)).over(upto) for name, (kind, column) in running.items()},
            **{name: F.first(carried[name], ignorenulls=True).over(upto) for name in whole},
            **{name: make(inside) for name, make in windows.items()},
        })
        lengths, places = {}, {}
        for name, flag in runs.items():
            last = [F.when(F.col(flag) == value, F.col(SEQ)) for value in (0, 1)]
            places |= {f"_{name}_{v}": F.max(part(f"{name}_{v}", last[v])).over(upto) for v in (0, 1)}
            other = F.when(F.col(flag) == 1, F.col(f"_{name}_0")).otherwise(F.col(f"_{name}_1"))
            lengths[name] = F.col(SEQ) - F.coalesce(other, F.lit(0).cast("bigint"))
        if runs:
            found = found.withColumns(places).withColumns(lengths)
        own = found.where(~F.col(BORDER)).drop(SEGMENT, BORDER, SEQ, *carried.values(), *places)
        return replace(self, rows=own)

    def _borders(
        self, rows: DataFrame, cell: list[str], running: Mapping[str, Fold], whole: Mapping[str, Fold],
        runs: Mapping[str, str], keep: int, seen: list[str],
    ) -> tuple[dict[str, str], DataFrame]:
        """Names of the carried columns, and the border rows of every segment."""
        folds = {**running, **whole}
        place = F.row_number().over(Window.partitionBy(*cell).orderBy(*self.order)).cast("bigint")
        size = F.count("*").over(Window.partitionBy(*cell))
        row = F.struct(*self.order, *seen)
        if runs or keep > 1:
            rows = rows.withColumns({"_place": place, "_size": size})
            near = F.when(F.col("_size") - F.col("_place") < keep, row)
            tail = F.sort_array(F.collect_list(near))
        else:
            tail = F.array(F.max(row))
        ends = {
            f"_end_{name}_{v}": F.max(F.when(F.col(flag) == v, F.col("_place")))
            for name, flag in runs.items() for v in (0, 1)
        }
        summed = rows.groupBy(*cell).agg(
            tail.alias("_tail"),
            *[_FOLDS[kind](column).alias(f"_all_{name}") for name, (kind, column) in folds.items()],
            *[column.alias(name) for name, column in ends.items()],
        )
        segments = Window.partitionBy(*self.entity).orderBy(SEGMENT)
        before = segments.rowsBetween(Window.unboundedPreceding, -1)
        everything = Window.partitionBy(*self.entity)
        carried = {name: f"_carry_{name}" for name in folds}
        # Every segment before has a row, so the rows wanted lie in as many segments at most.
        tails = F.flatten(F.collect_list("_tail").over(segments.rowsBetween(-keep, -1)))
        known = summed.select(
            *cell, *ends, tails.alias("_tails"),
            *[_FOLDS[kind](f"_all_{name}").over(before).alias(carried[name]) for name, (kind, _) in running.items()],
            *[_FOLDS[kind](f"_all_{name}").over(everything).alias(carried[name]) for name, (kind, _) in whole.items()],
        )
        if runs:
            start = F.coalesce(F.col(carried[SEQ]), F.lit(0).cast("bigint"))
            names = {f"{name}_{v}": f"_end_{name}_{v}" for name in runs for v in (0, 1)}
            carried |= {name: f"_carry_{name}" for name in names}
            known = known.withColumns({carried[name]: F.max(start + F.col(end)).over(before) for name, end in names.items()})
        last = F.slice("_tails", F.greatest(F.size("_tails") - keep + 1, F.lit(1)), keep)
        opened = known.select(*cell, *carried.values(), F.posexplode_outer(last).alias("_at", "_row"))
        first = F.coalesce(F.col("_at"), F.lit(0)) == 0
        borders = opened.select(
            *cell, F.lit(True).alias(BORDER), *[F.col(f"_row.{c}").alias(c) for c in (*self.order, *seen)],
            *[F.when(first, F.col(c)).alias(c) for c in carried.values()],
        )
        return carried, borders


def trailing_mean(column: str, size: int, digits: int, carries: int = 0):
    """A window column: mean of the last ``size`` rows including this one."""
    from courtside.functions.numeric import as_units, round_half_up

    def make(window: WindowSpec) -> Column:
        frame = window.rowsBetween(1 - size, 0)
        source = as_units(column, carries) if carries else F.col(column)
        return round_half_up(F.avg(source).over(frame) / float(10**carries), digits)

    return make


def current_run(
    rows: DataFrame, entity: str, order: Sequence[str], flag: str, length: str
) -> DataFrame:
    """Flag and length of the run each entity is in at its last row.

    Only aggregates: the last row of either flag per entity, then a count of the rows after the
    last row with the other flag. No ordered pass over the history is needed.
    """
    moment = F.struct(*order)
    last = rows.groupBy(entity).agg(
        F.max(F.when(F.col(flag) == 1, moment)).alias("_last_one"),
        F.max(F.when(F.col(flag) == 0, moment)).alias("_last_zero"),
    )
    now_one = F.col("_last_zero").isNull() | F.coalesce(
        F.col("_last_one") > F.col("_last_zero"), F.lit(False)
    )
    ends = last.select(
        F.col(entity),
        F.when(now_one, 1).otherwise(0).cast("bigint").alias("_now"),
        F.when(now_one, F.col("_last_zero")).otherwise(F.col("_last_one")).alias("_other"),
    )
    inside = rows.join(ends, entity).where(
        F.col("_other").isNull() | (moment > F.col("_other"))
    )
    return inside.groupBy(entity).agg(
        F.max("_now").alias(flag), F.count("*").alias(length)
    )
