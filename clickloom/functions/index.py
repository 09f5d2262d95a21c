"""Consecutive numbers over a whole table without a single-task window."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that the cluster configures.

    A temporary one where none is set, but only for a local master: executors elsewhere could not read it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="clickloom-"))
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_dir(df.sparkSession, "")
    return df.checkpoint(eager=True)


def running_base(sizes: DataFrame, key: str, size: str, *more: str) -> DataFrame:
    """``key``, base: the sum of ``size`` over all smaller keys; <name>_base for each of ``more``. ``sizes`` has one row for each key.

    Keys are range-partitioned and sorted once (kept by a checkpoint, so that a second look sees the same
    ranges); sums inside a range are a window over the range, and only one total for each range is added up.
    """
    names = {size: "base"} | {x: f"{x}_base" for x in more}
    ranged = reliable(sizes.select(key, *names).repartitionByRange(key).sortWithinPartitions(key)).withColumn("_range", F.spark_partition_id())
    before = W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*(F.sum(x).alias(f"_n_{x}") for x in names))
    # one row for each partition: small, whatever the table
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_range", *(F.coalesce(F.sum(f"_n_{x}").over(earlier), F.lit(0)).alias(f"_b_{x}") for x in names))
    inner = ranged.select(key, "_range", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"_i_{x}") for x in names))
    return inner.join(F.broadcast(offsets), "_range").select(key, *((F.col(f"_b_{x}") + F.col(f"_i_{x}")).cast("long").alias(name) for x, name in names.items()))


def dense_index(keys: DataFrame, key: str, start: int, name: str) -> DataFrame:
    """Distinct ``key`` values with consecutive whole numbers (int) from ``start`` in their order; more than 2^31 - 1 are an error."""
    ones = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_one", F.lit(1))
    return running_base(ones, key, "_one").select(key, (F.col("base") + start).cast("int").alias(name))
