"""The click log, item properties and category tree derived from the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("timestamp", "visitorid", "event", "itemid", "transactionid")


def require_columns(df: DataFrame, columns=REQUIRED) -> DataFrame:
    """``df`` itself; an error before any work if a column is missing."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"Missing event columns: {missing}")
    return df


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, timestamp (ms), visitorid, event, itemid, transactionid; each 50th row stands twice."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    late = F.col("ts") >= F.lit("2024-01-26").cast("timestamp_ntz")
    rows = e.select(
        "event_id",
        (F.unix_micros(F.date_trunc("hour", F.col("ts").cast("timestamp"))) / 1000).cast("long").alias("timestamp"),
        (F.col("user_id") + F.when((F.col("user_id") % 5 == 0) & late, 100000).otherwise(0)).alias("visitorid"),
        F.when(F.col("event_type") == "click", "addtocart").when(F.col("event_type") == "purchase", "transaction").otherwise(F.col("event_type")).alias("event"),
        (F.col("k") + F.when(late & (F.col("k") < 10), 1000).otherwise(0)).alias("itemid"),
        F.when(F.col("event_type") == "purchase", F.col("user_id") * 1000 + F.dayofyear("ts")).cast("long").alias("transactionid"),
    )
    again = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return require_columns(rows.withColumn("_copy", F.explode(again)).drop("_copy"))


def property_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """itemid, property, timestamp (ms), value: availability and category updates as they come, repeats included."""
    raw = raw_events(spark, sf_dir)
    rows = F.array(
        F.when(F.col("event").isin("signup", "error") & (F.col("itemid") % 10 != 3), F.struct(F.lit("available").alias("property"), (F.col("event") == "signup").cast("long").alias("value"))),
        F.when((F.col("event") == "signup") & (F.col("itemid") % 10 != 4), F.struct(F.lit("categoryid").alias("property"), (F.col("event_id") % 40).alias("value"))),
    )
    return raw.select("itemid", "timestamp", F.explode(rows).alias("p")).where("p is not null").select("itemid", "p.property", "timestamp", "p.value")


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each item, property and time of the updates, the smallest value of ties."""
    return property_updates(spark, sf_dir).groupBy("itemid", "property", "timestamp").agg(F.min("value").alias("value"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """categoryid, parentid: nations below regions, some regions below one top node."""
    n, r = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region"))
    low = n.select(F.col("n_nationkey").cast("long").alias("categoryid"), (F.col("n_regionkey") + 1000).cast("long").alias("parentid"))
    mid = r.select((F.col("r_regionkey") + 1000).cast("long").alias("categoryid"), F.when(F.col("r_regionkey") < 3, 2000).cast("long").alias("parentid"))
    top = r.sparkSession.range(1).select(F.lit(2000).cast("long").alias("categoryid"), F.lit(None).cast("long").alias("parentid"))
    return low.union(mid).union(top)
