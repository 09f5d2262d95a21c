"""Data-quality checks: each is a row (check, violations) of one report, over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import reliable
from clickloom.functions.segments import scan
from clickloom.operators.sessions import BEHAVIOURS

LABELS = ("itemid", "target_events", "target_count", "eligible_target_count", "target_time", "split")


def report(**bad: DataFrame) -> DataFrame:
    """check, violations: the number of rows of each table of bad rows."""
    rows = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in bad.items()]
    return reduce(DataFrame.union, rows)


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")


def without(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_anti")


def events(ev: DataFrame) -> DataFrame:
    return report(
        duplicate_events=repeated(ev, "timestamp", "visitorid", "event", "itemid", "transactionid"),
        null_required=ev.where("timestamp is null or visitorid is null or event is null or itemid is null"),
        transaction_without_id=ev.where("event = 'transaction' and transactionid is null"),
        invalid_event=ev.where(~F.col("event").isin(*BEHAVIOURS)),
        session_in_splits=ev.groupBy("visitorid", "session_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b"),
    )


def queries(q: DataFrame, targets: DataFrame, ends: DataFrame) -> DataFrame:
    timed = q.crossJoin(F.broadcast(ends))  # one row
    end = F.expr("case split when 'train' then train_end when 'validation' then validation_end else observation_end end")
    return report(
        duplicate_query=repeated(q, "query_id"),
        duplicate_session_time=repeated(q, "session_id", "query_time"),
        query_without_targets=without(q, targets, "query_id"),
        target_not_later=q.where("target_time <= query_time"),
        target_after_split_end=timed.where(F.col("target_time") > end),
        boundary_query=q.where("split = 'boundary_drop'"),
    )


def targets(t: DataFrame, q: DataFrame, groups: DataFrame) -> DataFrame:
    """The event counts of a query's targets must add up to those of the next group."""
    joined = t.join(q.select("query_id", F.col("target_time").alias("_t")), "query_id")
    sums = t.groupBy("visitorid", "session_id", "target_time").agg(F.sum("target_events").alias("_s"))
    sizes = groups.select("visitorid", "session_id", F.col("query_time").alias("target_time"), "n_events")
    return report(
        duplicate_pair=repeated(t, "query_id", "itemid"),
        target_without_query=without(t, q, "query_id"),
        other_target_time=joined.where("target_time <> _t"),
        count_mismatch=sums.join(sizes, ["visitorid", "session_id", "target_time"], "left").where("not (_s <=> n_events)"),
    )


def _next_times(ev: DataFrame) -> DataFrame:
    times = ev.where("split <> 'boundary_drop'").select("visitorid", "session_id", F.col("timestamp").alias("query_time")).distinct()
    return times.withColumn("_next", F.lead("query_time").over(W.partitionBy("visitorid", "session_id").orderBy("query_time"))).where("_next is not null")


def next_group(ev: DataFrame, q: DataFrame) -> DataFrame:
    """Next times found again from the distinct times of the events."""
    both = _next_times(ev).join(q.select("visitorid", "session_id", "query_time", "target_time"), ["visitorid", "session_id", "query_time"], "full")
    return report(wrong_next_time=both.where("_next <> target_time"), step_without_query=both.where("target_time is null"), query_without_step=both.where("_next is null"))


def target_sets(ev: DataFrame, q: DataFrame, t: DataFrame) -> DataFrame:
    """(query, item) pairs found again from the events of the next time."""
    at = _next_times(ev).join(q.select("visitorid", "session_id", "query_time", "query_id"), ["visitorid", "session_id", "query_time"]).select("visitorid", "session_id", F.col("_next").alias("timestamp"), "query_id")
    again = at.join(ev, ["visitorid", "session_id", "timestamp"]).select("query_id", "itemid").distinct()
    return report(missing_target=without(again, t, "query_id", "itemid"), unexpected_target=without(t, again, "query_id", "itemid"))


def features(f: DataFrame, ev: DataFrame) -> DataFrame:
    """Stored features against the steps that the events give: no history after the query, the same queries, no label columns."""
    steps, at = _next_times(ev), ["visitorid", "session_id", "query_time"]
    times = ["history_last_time", *(f"{b}_last_time" for b in BEHAVIOURS)]
    return report(
        history_in_future=f.where(" or ".join(f"{x} > query_time" for x in times)),
        recency_in_future=f.where(" or ".join(f"{b}_recency < 0" for b in BEHAVIOURS)),
        query_without_features=without(steps, f, *at),
        features_without_query=without(f, steps, *at),
        label_columns=f.sparkSession.range(sum(c in LABELS for c in f.columns)),
    )


def prefixes(ev: DataFrame, q: DataFrame) -> DataFrame:
    """Prefix sizes, counts and recencies found again from single events.

    A range frame over the events of a session takes all events up to a time, so the work is linear in the
    session however long it is.
    """
    w = W.partitionBy("visitorid", "session_id").orderBy("timestamp").rangeBetween(W.unboundedPreceding, 0)
    is_ = lambda b: F.col("event") == b
    again = ev.select(
        "visitorid", "session_id", F.col("timestamp").alias("query_time"), F.count("*").over(w).alias("_n"),
        *(F.count_if(is_(b)).over(w).alias(f"_{b}") for b in BEHAVIOURS),
        *(((F.col("timestamp") - F.max(F.when(is_(b), F.col("timestamp"))).over(w)) / 1000).alias(f"_r_{b}") for b in BEHAVIOURS),
    ).distinct()
    both = q.join(again, ["visitorid", "session_id", "query_time"], "left")
    bad = {f"{b}_count": both.where(f"not ({b}_count <=> _{b})") for b in BEHAVIOURS} | {f"{b}_recency": both.where(f"not ({b}_recency <=> _r_{b})") for b in BEHAVIOURS}
    return report(prefix_events=both.where("not (prefix_events <=> _n)"), **bad)


def mappings(train: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    bad = {}
    for key, m in (("visitorid", users), ("itemid", items)):
        i = f"{key}_idx"
        span = m.agg(F.count("*").alias("n"), F.min(i).alias("lo"), F.max(i).alias("hi"), F.count_distinct(i).alias("d"))
        bad[f"{key}_index_not_dense"] = span.where("n > 0 and not (lo = 2 and hi = n + 1 and d = n)")
        bad[f"{key}_unmapped"] = without(train.select(key).distinct(), m, key)
        bad[f"{key}_not_in_train"] = without(m, train, key)
    return report(**bad)


def interactions(pairs: DataFrame, train: DataFrame) -> DataFrame:
    have = train.agg(*(F.count_if(F.col("event") == b).alias(b) for b in BEHAVIOURS))
    sums = pairs.agg(*(F.coalesce(F.sum(f"{b}_count"), F.lit(0)).alias(f"s_{b}") for b in BEHAVIOURS))
    both = have.crossJoin(sums)  # one row each
    return report(duplicate_interaction=repeated(pairs, "visitorid", "itemid"), **{f"{b}_total_differs": both.where(f"{b} <> s_{b}") for b in BEHAVIOURS})


def properties(props: DataFrame) -> DataFrame:
    return report(duplicate_property=repeated(props, "itemid", "property", "timestamp"))


def _latest(requests: DataFrame, props: DataFrame, prop: str, time: str) -> DataFrame:
    """Requests (itemid, ``time``, ...) with _at, _value of the last update of ``prop``: updates of an item are numbered, and a request joins the one that as many as came before have."""
    u = props.where(F.col("property") == prop).select("itemid", F.col("timestamp").alias("_t"), F.col("value").alias("_value"), F.lit(0).alias("_kind"))
    both = u.unionByName(requests.select("itemid", F.col(time).alias("_t"), F.lit(1).alias("_kind")).distinct(), allowMissingColumns=True)
    both = reliable(scan(both, ("itemid",), ("_t", "_kind"), sums={"_n": 1 - F.col("_kind")}))
    hits = both.where("_kind = 0").select("itemid", "_n", F.col("_t").alias("_at"), "_value")
    found = both.where("_kind = 1").select("itemid", "_t", "_n").join(hits, ["itemid", "_n"], "left").select(F.col("itemid").alias("_item"), "_t", "_at", "_value")
    return requests.join(found, F.col("itemid").eqNullSafe(F.col("_item")) & F.col(time).eqNullSafe(F.col("_t"))).drop("_item", "_t")


def metadata(found: DataFrame, props: DataFrame, items: DataFrame, time: str = "query_time") -> DataFrame:
    """The source times of as-of values are never later than the request; values, times and candidates are found again by another way."""
    asked = found.withColumnRenamed("known_at", "_k")
    a, c = _latest(asked, props, "available", time), _latest(asked, props, "categoryid", time)
    known = a.join(items.select("itemid", "known_at"), "itemid", "left")
    should = F.coalesce(F.col("known_at") <= F.col(time), F.lit(False)) & F.coalesce(F.col("_value") == 1, F.lit(True))
    return report(
        availability_from_future=found.where(F.col("available_time") > F.col(time)),
        category_from_future=found.where(F.col("category_time") > F.col(time)),
        other_availability=a.where("not (available <=> _value and available_time <=> _at) or availability_unknown <> (_value is null)"),
        other_category=c.where("not (category_time <=> _at) or category_missing <> (_value is null) or (not category_missing and not category_invalid and category_id <> _value)"),
        other_candidate=known.where(F.col("candidate") != should),
    )


def negatives(found: DataFrame, q: DataFrame, t: DataFrame, item_map: DataFrame, meta: DataFrame) -> DataFrame:
    """``meta``: as-of metadata of the samples."""
    return report(
        negative_is_target=found.join(t.select("query_id", "itemid"), ["query_id", "itemid"], "left_semi"),
        not_a_train_query=without(found, q.where("split = 'train'"), "query_id"),
        duplicate_negative=repeated(found, "query_id", "itemid"),
        not_in_vocabulary=without(found, item_map, "itemid"),
        not_eligible=meta.where("not candidate"),
    )
