"""The tables of a directory, read with their own Parquet schemas (no inference over the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def utc_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The table with its zoneless timestamps read as UTC, so that ranges over them reach the scan without a cast."""
    path = f"{directory}/{name}.parquet"
    kind = lambda t: T.TimestampType() if isinstance(t, T.TimestampNTZType) else t
    return spark.read.schema(T.StructType([T.StructField(f.name, kind(f.dataType), f.nullable) for f in spark.read.parquet(path).schema])).parquet(path)
