"""Readers for the stored layers: Bronze JSON and Silver parquet.

Both are Hive-partitioned folders. Readers take an explicit schema (no
inference job) and express a one-day read as a filter on the partition
columns of the base path, which the planner turns into partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (BRONZE_COLUMNS, BRONZE_PARTITIONS, BRONZE_SCHEMA, SILVER_COLUMNS,
                       SILVER_PARTITIONS, SILVER_SCHEMA, require_columns)


class EmptyInputError(ValueError):
    """Raised when a layer read finds no rows."""


def _with_partitions(schema: T.StructType, parts: list[str]) -> T.StructType:
    have = {f.name for f in schema.fields}
    return T.StructType(list(schema.fields) + [T.StructField(p, T.StringType(), True)
                                               for p in parts if p not in have])


def read_bronze(spark: SparkSession, path: str, batch_date: str | None = None,
                require_rows: bool = False) -> DataFrame:
    """Bronze JSON lines under ``path`` (year=/month=/day=/hour= folders).

    ``batch_date='YYYY-MM-DD'`` keeps one arrival day through partition
    filters on the base path. ``require_rows`` raises on empty input using a
    one-row probe, not a full count.
    """
    df = (spark.read.schema(_with_partitions(BRONZE_SCHEMA, BRONZE_PARTITIONS))
               .option("multiLine", "false").option("basePath", path).json(path))
    if batch_date:
        y, m, d = batch_date[:4], batch_date[5:7], batch_date[8:10]
        df = df.filter((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    if require_rows and df.isEmpty():
        raise EmptyInputError(f"no records found in Bronze path {path} (batch_date={batch_date})")
    return df


def read_bronze_records(spark: SparkSession, path: str, batch_date: str | None = None) -> DataFrame:
    """The 11 Bronze fields only (partition columns dropped)."""
    return read_bronze(spark, path, batch_date).select(*BRONZE_COLUMNS)


def read_silver(spark: SparkSession, path: str, trade_dates: list[str] | None = None) -> DataFrame:
    """Silver parquet with partition values from the folder names; trade_hour
    is handed out as int. ``trade_dates`` prunes to those partitions."""
    schema = _with_partitions(SILVER_SCHEMA, SILVER_PARTITIONS)
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if trade_dates:
        df = df.filter(F.col("trade_date").isin(list(trade_dates)))
    require_columns(df, SILVER_COLUMNS, "silver")
    return df.select(*[c for c in SILVER_COLUMNS if c != "trade_hour"],
                     F.col("trade_hour").cast("int").alias("trade_hour"))
