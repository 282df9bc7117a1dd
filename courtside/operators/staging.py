"""Writing an intermediate result once, so that later steps read it instead of redoing it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it back.

    This cuts the lineage in a way that survives lost executors, and it gives the optimizer the real
    size. The path must be in a folder that all executors share; the caller names it and clears it.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
