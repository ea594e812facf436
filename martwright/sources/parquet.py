"""Readers for the driver's parquet tables.

Every reader selects only the columns it needs, so the scan's ReadSchema is
pruned and filters written downstream reach the parquet reader as
PushedFilters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
