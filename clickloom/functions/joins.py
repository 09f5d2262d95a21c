"""Joins whose keys may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hot_limit(spark: SparkSession, total: int) -> int:
    """An eighth of a shuffle partition's rows: at most eight keys for each partition have more of ``total`` rows."""
    return int(total) // (8 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def join_split(rows: DataFrame, table: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table`` on ``key`` (nulls are equal); ``n`` of a table's row is how many of the ``total`` rows have its key.

    Keys with more rows than ``hot_limit`` are broadcast (at most eight for each partition, whatever the size), so
    their rows stay where they are; all others are few rows each and are shuffled. Give a table of few rows a key.
    """
    limit = hot_limit(rows.sparkSession, total)
    table = table.withColumnRenamed(key, "_key")
    on, hot = F.col(key).eqNullSafe(F.col("_key")), F.broadcast(table.where(F.col(n) > limit))
    rest = rows.join(F.broadcast(table.where(F.col(n) > limit).select("_key")), on, "left_anti").join(table.where(F.col(n) <= limit), on)
    return rows.join(hot, on).union(rest).drop("_key")
