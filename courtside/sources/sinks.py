"""Publishing results as views, tables and appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from courtside.operators.staging import stage
from courtside.sources.commits import append_once, read_appended
from courtside.sources.readers import RawTables
from courtside.sources.schemas import GAME_FACTS, PREVIEW_COLUMNS, RAW_SCHEMAS

LAYER_SCHEMAS = {"staging": "staging", "intermediate": "intermediate", "marts": "marts"}


def schema_name(custom: str | None, default: str) -> str:
    """The layer's own schema name where it has one, else the session's default."""
    return default if custom is None else custom.strip()


def publish_view(df: DataFrame, name: str, layer: str | None = None) -> str:
    """A temporary view ``<layer>_<name>``; nothing is computed."""
    prefix = schema_name(LAYER_SCHEMAS.get(layer) if layer else None, "")
    view = f"{prefix}_{name}" if prefix else name
    df.createOrReplaceTempView(view)
    return view


def publish_table(df: DataFrame, name: str, layer: str | None = "marts") -> str:
    """A managed table in the layer's database, replaced as a whole."""
    spark = df.sparkSession
    database = schema_name(LAYER_SCHEMAS.get(layer) if layer else None, spark.catalog.currentDatabase())
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return f"{database}.{name}"


def publish_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table; ``partition_by`` lets later reads skip whole folders.

    Rows are gathered by the partition columns first, so that no task writes to every folder; the
    rebalance hint lets adaptive execution split a folder that is too large for one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def publish_facts(
    raw: RawTables, database: str, buckets: int, tables: Sequence[str] = tuple(GAME_FACTS)
) -> str:
    """Raw tables by game as managed tables in buckets of the game id, sorted by it.

    Read from there (``catalog_league``), they meet on the game id and are grouped by it without a
    shuffle. One task reads a bucket of all of them, so ``buckets`` follows from the size of the largest
    table over what a task should hold; a game id's rows are few, so buckets are alike in size.
    """
    if not tables:
        return database
    raw[tables[0]].sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in tables:
        dealt = raw[name].repartition(buckets, "game_id")  # as buckets are dealt: one file for each
        writer = dealt.write.mode("overwrite").bucketBy(buckets, "game_id").sortBy("game_id")
        writer.saveAsTable(f"{database}.{name}")
    return database


# Final orders of published reports; ties are decided by the keys that follow.
REPORT_ORDERS = {
    "returning_players": ["days_since_last_game DESC", "player_name", "team_id"],
    "player_referee_stats": ["pts_diff_vs_season_avg DESC", "player_name", "team_id", "referee_name"],
    "recap_lines": ["game_date", "home_team_id", "away_team_id"],
    "preview_games": ["tipoff_time", "home_team_id", "away_team_id"],
    "display": ["is_free_game DESC", "tipoff_time", "home_team_id", "away_team_id"],
}


def _order(report: str) -> list[Column]:
    pairs = [name.split() for name in REPORT_ORDERS[report]]
    return [F.col(c).desc() if more else F.col(c).asc() for c, *more in pairs]


def in_report_order(df: DataFrame, report: str) -> DataFrame:
    """The rows as the report shows them."""
    return df.orderBy(*_order(report))


def with_position(df: DataFrame, report: str, *within: str, work_path: str | None = None) -> DataFrame:
    """Add the place of each row in the report, from 1, counted anew for each value of ``within``.

    With ``within`` a report is a list of a day or a kind, numbered by a window. Without it the whole
    table is one list: rows are dealt to ranges of the order and written to ``work_path``, a folder
    that all executors share, since a place is only right if a row's range doesn't change. Each range
    is numbered on its own, from where the ranges before it end; one count per range passes the driver.
    """
    order = _order(report)
    if within:
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        return df.withColumn("position", place.cast("bigint"))
    if work_path is None:
        raise ValueError("a report without groups needs a work_path")
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = stage(dealt, work_path)
    starts, total = [], 0
    for number, rows in sorted(tuple(r) for r in ranges.groupBy("_range").count().collect()):
        starts.append((number, total))
        total += rows
    offsets = df.sparkSession.createDataFrame(starts, "_range int, _start bigint")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranges.join(F.broadcast(offsets), "_range").withColumn("position", F.col("_start") + place)
    return numbered.drop("_range", "_start")


def preview_rows(flagged: DataFrame) -> DataFrame:
    """The sixteen published columns; the preview text and time may still be missing."""
    types = {f.name: f.dataType for f in RAW_SCHEMAS["game_previews"]}
    fixed = {
        "posted_substack": F.lit(False),
        "posted_reddit": F.lit(False),
    }
    columns = []
    for name in PREVIEW_COLUMNS:
        if name in fixed:
            source = fixed[name]
        elif name in flagged.columns:
            source = F.col(name)
        else:
            source = F.lit(None)
        columns.append(source.cast(types[name]).alias(name))
    return flagged.select(*columns)


PREVIEW_SCHEMA = T.StructType([RAW_SCHEMAS["game_previews"][name] for name in PREVIEW_COLUMNS])


def append_previews(flagged: DataFrame, path: str, batch: str) -> bool:
    """Append one batch, by name, in folders by game date; a batch that is there already adds nothing."""
    return append_once(preview_rows(flagged), path, batch, ["game_date"])


def read_previews(spark: SparkSession, path: str) -> DataFrame:
    """All batches appended so far."""
    return read_appended(spark, path, PREVIEW_SCHEMA)
