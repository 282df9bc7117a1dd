"""Reading the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from courtside.sources.schemas import RAW_SCHEMAS


class RawTables:
    """Raw tables by name, each opened when first asked for."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open = open_table
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_SCHEMAS:
            raise KeyError(f"unknown raw table {name!r}")
        if name not in self._tables:
            self._tables[name] = self._open(name)
        return self._tables[name]

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> RawTables:
        return cls(lambda name: tables[name])


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One raw table from Parquet with its declared schema (no inference, no footer reads)."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{path}/{name}")


def read_league(spark: SparkSession, path: str) -> RawTables:
    """All raw tables below a folder, one sub-folder each."""
    return RawTables(lambda name: read_table(spark, path, name))


def catalog_league(spark: SparkSession, database: str = "raw") -> RawTables:
    """All raw tables of a catalog database, by physical name."""
    return RawTables(lambda name: spark.table(f"{database}.{name}"))
