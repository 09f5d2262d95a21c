"""Registered queries of the click-log library, over the log that the star tables give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import reliable, shared_dir
from clickloom.functions.quantile import exact_quantiles
from clickloom.operators import checks
from clickloom.operators import metadata as m
from clickloom.operators import negatives as neg
from clickloom.operators import neighbours as knn
from clickloom.operators import ranking
from clickloom.operators import sessions as s
from clickloom.sources import files, star

#: Gap of the derived log, whose visitors are sparse; the library's default is 30 minutes.
GAP = 720

#: Least similarity of items; sessions of the derived log are short, its items few.
LEAST_COSINE = 0.04

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
QUERIES_OF: dict[str, Callable[[Log], DataFrame]] = {}


class Log:
    """Tables of one input folder; each is declared once and read lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = star.raw_events(spark, sf_dir)
        self.clean = s.clean_events(self.raw)

    def __getattr__(self, name: str) -> DataFrame:
        make = {
            "props": lambda: star.properties(self.spark, self.sf_dir),
            "tree_raw": lambda: star.categories(self.spark, self.sf_dir),
            "tree": lambda: m.category_tree(self.tree_raw),
            "sessions": lambda: s.sessionize(self.clean, GAP),
            "ends": lambda: s.cutoffs(self.sessions),
            "events": lambda: s.temporal_split(self.sessions, self.ends),
            "train": lambda: self.events.where("split = 'train'"),
            "groups": lambda: s.timestamp_groups(self.events),
            "queries": lambda: s.queries_of(self.groups),
            "targets": lambda: s.next_targets(self.events),
            "items": lambda: m.catalog(s.valid_events(self.raw), self.props),  # repeats change no first time
            "ranks": lambda: neg.train_ranks(self.items, self.train),
            "negatives": lambda: reliable(neg.negatives(self.queries, self.targets, self.ranks, self.props)),
            "users_idx": lambda: m.mapping(self.train, "visitorid"),
            "items_idx": lambda: m.mapping(self.train, "itemid"),
            "interactions": lambda: m.interactions(self.train, self.users_idx, self.items_idx, self.ends.first().train_end),
            "changes": lambda: m.eligibility_changes(self.items, self.props),
            "popular_lists": lambda: reliable(ranking.candidate_lists(reliable(ranking.popularity_ranks(self.train)), self.changes)),
            "popular": lambda: reliable(ranking.popular_candidates(self.queries, self.popular_lists)),
            "matrix": lambda: reliable(knn.session_items(self.train)),
            "item_near": lambda: reliable(knn.item_knn(self.matrix, least=LEAST_COSINE)),
            "asked": lambda: reliable(self.queries.where("split in ('validation', 'test')")),
            # a session is of one split, and without a second time it has no query
            "prefix": lambda: reliable(knn.prefix_items(self.events.where("split in ('validation', 'test') and session_start < session_end"), self.asked)),
            "session_index": lambda: knn.SessionIndex(self._recent()),
            "session_sets": lambda: self.session_index.sets(self.prefix),
            "session_near": lambda: reliable(self.session_index.near(self.session_sets[1])),
            "session_lists": lambda: reliable(knn.session_lists(self.session_near, self.session_index.sessions)),
            "snapshot": lambda: self._snapshot(),
            "target_meta": lambda: m.asof_metadata(self.targets.select("query_id", "itemid", "query_time", "split"), self.props, self.items, self.tree, "query_time"),
        }.get(name)
        if make is None:
            raise AttributeError(name)
        setattr(self, name, make())
        return self.__dict__[name]

    def _recent(self) -> DataFrame:
        """session_id, itemid, session_end of the train sessions."""
        return self.train.select("session_id", "itemid", "session_end").distinct()

    def _snapshot(self) -> DataFrame:
        """Metadata at the end of train of every item known by then, and whether train holds it."""
        end = F.lit(self.ends.first().train_end).cast("long")
        known = self.items.where(F.col("known_at") <= end).select("itemid", end.alias("t"))
        got = m.asof_metadata(known, self.props, self.items, self.tree, "t")
        return got.join(self.train.select("itemid", F.lit(True).alias("_x")).distinct(), "itemid", "left").withColumn("seen_in_train", F.coalesce("_x", F.lit(False))).drop("_x")


def stored(t: Log, *names: str) -> Log:
    """``t`` with these tables materialised once, so that several checks read them instead of building them again."""
    for name in names:
        setattr(t, name, reliable(getattr(t, name)))
    return t


def query(f: Callable[[Log], DataFrame]) -> Callable[[Log], DataFrame]:
    QUERIES_OF[f.__name__] = f
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Log(spark, sf_dir))
    return f


def count_if(condition: str, name: str):
    return F.count_if(F.expr(condition)).alias(name)


def stats(df: DataFrame, *columns: str, times: tuple[str, ...] = ()) -> DataFrame:
    """metric, n, min, mean, median, p90, p95, p99, max of each column.

    ``columns`` hold counts, whose distinct values are few: counts that add up to N have less than sqrt(2 N) of
    them, so percentiles over counted values fit one buffer. ``times`` hold milliseconds of any number of
    distinct values; their quantiles come from ``exact_quantiles``.
    """
    at = (0.5, 0.9, 0.95, 0.99)
    out = None
    for c in columns:
        v = df.groupBy(F.col(c).cast("double").alias("v")).agg(F.count("*").alias("k"))
        p = F.percentile("v", F.array(*map(F.lit, at)), F.col("k"))
        one = v.agg(F.sum("k").alias("n"), F.min("v").alias("min"), (F.sum(F.col("v") * F.col("k")) / F.sum("k")).alias("mean"), p.alias("p"), F.max("v").alias("max"))
        one = one.select(F.lit(c).alias("metric"), "n", "min", F.round("mean", 6).alias("mean"), *(F.round(F.col("p")[i], 6).alias(x) for i, x in enumerate(("median", "p90", "p95", "p99"))), "max")
        out = one if out is None else out.union(one)
    for c in times:
        q = [F.lit(x).cast("double") for x in exact_quantiles(df, c, at)]
        v = F.col(c).cast("double")
        one = df.agg(F.count(c).alias("n"), F.min(v).alias("min"), F.round(F.avg(v), 6).alias("mean"), F.max(v).alias("max"))
        one = one.select(F.lit(c).alias("metric"), "n", "min", "mean", *(F.round(x, 6).alias(n) for x, n in zip(q, ("median", "p90", "p95", "p99"))), "max")
        out = one if out is None else out.union(one)
    return out


@query
def read_events(t: Log) -> DataFrame:
    return t.raw


@query
def dedup_events(t: Log) -> DataFrame:
    return t.clean


@query
def event_time(t: Log) -> DataFrame:
    return t.clean.select("event_id", F.timestamp_millis("timestamp").cast("timestamp_ntz").alias("event_time"))


@query
def sessionize(t: Log) -> DataFrame:
    return t.sessions.select("event_id", "visitorid", "session_id")


@query
def event_order(t: Log) -> DataFrame:
    return t.sessions.select("event_id", "session_id", "event_order")


@query
def time_cutoffs(t: Log) -> DataFrame:
    return s.cutoffs(reliable(t.clean.select("timestamp")))


@query
def session_bounds(t: Log) -> DataFrame:
    return t.sessions.groupBy("session_id").agg(F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"))


@query
def temporal_split(t: Log) -> DataFrame:
    return t.events.select("event_id", "session_id", "split")


@query
def timestamp_groups(t: Log) -> DataFrame:
    return t.groups.select("visitorid", "session_id", "query_time", "split", "n_events")


@query
def query_ids(t: Log) -> DataFrame:
    return t.groups.select("query_id", "session_id", "query_time")


@query
def nextstep_queries(t: Log) -> DataFrame:
    return t.queries.select("query_id", "visitorid", "session_id", "split", "query_time", "target_time", "prefix_groups", "prefix_events")


@query
def excluded_steps(t: Log) -> DataFrame:
    return s.excluded_steps(t.groups).select("query_id", "session_id", "query_time", "reason")


@query
def nextstep_targets(t: Log) -> DataFrame:
    return t.targets.select("query_id", "itemid", "target_events", "target_time", "split")


@query
def target_count(t: Log) -> DataFrame:
    n = t.targets.groupBy("query_id").agg(F.count("*").alias("n"))
    return t.queries.select("query_id").join(n, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("target_count"))


@query
def repeat_targets(t: Log) -> DataFrame:
    seen = t.events.groupBy("visitorid", "session_id", "itemid").agg(F.min("timestamp").alias("first_seen"))
    return t.targets.join(seen, ["visitorid", "session_id", "itemid"]).where("first_seen <= query_time").select("query_id", "itemid", "first_seen")


@query
def prefix_features(t: Log) -> DataFrame:
    g = t.queries
    flags = [F.col(f"{b}_recency").isNotNull().alias(f"has_{b}") for b in s.BEHAVIOURS]
    each = [f"{b}_{x}" for x in ("count", "last_time", "recency") for b in s.BEHAVIOURS]
    return g.select("query_id", "visitorid", "session_id", "query_time", "prefix_groups", "prefix_events", "history_last_time", *each, *flags)


@query
def prefix_history(t: Log) -> DataFrame:
    """The prefixes of all queries, written out; ``prefix_ranges`` is the form to keep."""
    stored(t, "events")
    return s.history_of(s.history_ranges(t.events), t.queries)


@query
def prefix_ranges(t: Log) -> DataFrame:
    return s.history_ranges(t.events)


@query
def property_history(t: Log) -> DataFrame:
    return m.property_history(t.props)


@query
def category_tree(t: Log) -> DataFrame:
    return t.tree


@query
def item_catalog(t: Log) -> DataFrame:
    return t.items


@query
def seen_in_train(t: Log) -> DataFrame:
    train = t.train.select("itemid", F.lit(True).alias("x")).distinct()
    return t.items.join(train, "itemid", "left").select("itemid", "known_at", F.coalesce("x", F.lit(False)).alias("seen_in_train"))


@query
def target_metadata(t: Log) -> DataFrame:
    return t.target_meta


@query
def eligible_target_count(t: Log) -> DataFrame:
    n = t.target_meta.groupBy("query_id").agg(F.count_if("candidate").alias("n"))
    return t.queries.select("query_id").join(n, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("eligible_target_count"))


@query
def metadata_at_event(t: Log) -> DataFrame:
    got = m.asof_metadata(t.clean.select("itemid", "event", "timestamp"), t.props, t.items, t.tree, "timestamp")
    return got.groupBy("event").agg(
        F.count("*").alias("events"), count_if("available is null", "unknown"), count_if("available = 0", "unavailable"),
        count_if("available = 1", "available"), count_if("category_missing", "no_category"), count_if("category_invalid", "bad_category"),
    )


@query
def top_categories(t: Log) -> DataFrame:
    got = m.asof_metadata(t.clean.select("itemid", "event", "timestamp"), t.props, t.items, t.tree, "timestamp")
    g = got.groupBy("category_id").agg(F.count("*").alias("events"), F.count_distinct("itemid").alias("items"), count_if("event = 'transaction'", "purchases"))
    return g.orderBy(F.desc("events"), "category_id").limit(30)


@query
def train_snapshot(t: Log) -> DataFrame:
    return t.snapshot.drop("t")


@query
def snapshot_unknown_rates(t: Log) -> DataFrame:
    """Of the train items in the snapshot: how many, and the share without category in the tree and without availability."""
    share = lambda c: F.round(100 * F.avg(F.expr(c).cast("int")), 6)
    return t.snapshot.where("seen_in_train").agg(F.count("*").alias("items"), share("category_id = -1").alias("category_unknown_pct"), share("availability_unknown").alias("availability_unknown_pct"))


@query
def candidates_at_time(t: Log) -> DataFrame:
    """All candidates at the three ends, and whether they are warm (in train)."""
    every = m.candidates_at_time(tuple(t.ends.first()), t.items, t.props, t.tree)
    warm = t.train.select("itemid", F.lit(True).alias("_x")).distinct()
    return every.join(warm, "itemid", "left").select("t", "itemid", "known_at", "available", "category_id", F.coalesce("_x", F.lit(False)).alias("warm"))


@query
def warm_candidates(t: Log) -> DataFrame:
    return m.candidates_at_time(tuple(t.ends.first()), t.items, t.props, t.tree, t.train).select("t", "itemid", "available", "root_id")


@query
def user_mapping(t: Log) -> DataFrame:
    return m.mapping(t.train, "visitorid")


@query
def item_mapping(t: Log) -> DataFrame:
    return m.mapping(t.train, "itemid")


@query
def behavior_edges(t: Log) -> DataFrame:
    return m.behavior_edges(t.train)


@query
def interactions(t: Log) -> DataFrame:
    return stored(t, "events").interactions


@query
def reserved_index(t: Log) -> DataFrame:
    got = t.targets.select("query_id", "itemid").join(m.mapping(t.train, "itemid"), "itemid", "left")
    return got.select("query_id", "itemid", F.coalesce("itemid_idx", F.lit(1)).alias("item_idx"), F.col("itemid_idx").isNull().alias("cold_item"))


@query
def cold_flags(t: Log) -> DataFrame:
    train = t.train.select("visitorid", F.lit(True).alias("x")).distinct()
    return t.queries.select("query_id", "visitorid").join(train, "visitorid", "left").select("query_id", F.col("x").isNull().alias("cold_user"))


@query
def split_summary(t: Log) -> DataFrame:
    stored(t, "events", "groups")
    users = t.train.select("visitorid", F.lit(True).alias("_u")).distinct()
    items = t.train.select("itemid", F.lit(True).alias("_i")).distinct()
    share = lambda c: F.round(100 * F.avg(F.expr(c).cast("int")), 6)
    q = t.queries.join(users, "visitorid", "left").groupBy("split").agg(
        F.count("*").alias("queries"), F.count_distinct("session_id").alias("sessions"), F.count_distinct("visitorid").alias("users"),
        F.min("query_time").alias("first_query"), F.max("query_time").alias("last_query"), share("_u is null").alias("cold_user_pct"),
    )
    pairs = t.target_meta.join(items, "itemid", "left")
    per = pairs.groupBy("split", "query_id").agg(F.count("*").alias("n"), F.count_if("candidate").alias("c"), F.count_if(F.col("_i").isNull()).alias("cold"))
    pct = lambda x: F.round(100 * F.sum(x) / F.sum("n"), 6)
    c = per.groupBy("split").agg(F.sum("n").alias("pairs"), pct("c").alias("pair_coverage_pct"), F.round(100 * F.avg(F.col("c") / F.col("n")), 6).alias("macro_ceiling_pct"), pct("cold").alias("cold_item_pct"))
    return q.join(c, "split").join(t.targets.groupBy("split").agg(F.count_distinct("itemid").alias("target_items")), "split")


@query
def prefix_length_stats(t: Log) -> DataFrame:
    stored(t, "events")
    p = F.percentile("prefix_groups", F.array(F.lit(0.5), F.lit(0.95)), F.col("k"))
    counted = t.queries.groupBy("split", "prefix_groups").agg(F.count("*").alias("k"))
    g = counted.groupBy("split").agg(F.min("prefix_groups").alias("min"), p.alias("p"), F.max("prefix_groups").alias("max"))
    many = t.targets.groupBy("split", "query_id").agg(F.count("*").alias("n")).groupBy("split").agg(count_if("n > 1", "multi_target_queries"))
    return g.join(many, "split").select("split", "min", F.col("p")[0].alias("median"), F.round(F.col("p")[1], 6).alias("p95"), "max", "multi_target_queries")


@query
def single_group_sessions(t: Log) -> DataFrame:
    g = t.groups.groupBy("session_id").agg(F.count("*").alias("k"))
    return g.agg(count_if("k = 1", "single"), F.count("*").alias("sessions"), F.round(100 * F.avg((F.col("k") == 1).cast("int")), 6).alias("pct"))


@query
def raw_profile(t: Log) -> DataFrame:
    """Repeats are rows beyond the first of equal ones (over the five raw columns)."""
    r = t.raw.groupBy(*s.COLUMNS).agg(F.count("*").alias("k"))
    times = lambda c: F.coalesce(F.sum(F.when(F.expr(c), F.col("k"))), F.lit(0)).cast("long")
    nulls = [times(f"{c} is null").alias(f"null_{c}") for c in star.REQUIRED]
    return r.agg(
        F.sum("k").alias("row_count"), *nulls, F.count_distinct("visitorid").alias("users"), F.count_distinct("itemid").alias("items"),
        F.count_distinct("transactionid").alias("orders"), F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
        times("event not in ('view', 'addtocart', 'transaction')").alias("invalid"), F.sum(F.col("k") - 1).alias("duplicates"),
        times("timestamp < 0 or visitorid < 0 or itemid < 0 or transactionid < 0").alias("negative"),
    )


@query
def behavior_counts(t: Log) -> DataFrame:
    raw = t.raw.where(F.col("event").isin(*s.BEHAVIOURS)).groupBy("event").agg(F.count("*").alias("raw"))
    clean = t.clean.groupBy("event").agg(F.count("*").alias("clean"), F.count_distinct("visitorid").alias("users"), F.count_distinct("itemid").alias("items"))
    pct = F.round(100 * F.col("clean") / F.sum("clean").over(W.partitionBy(F.lit(1))), 6)  # three rows
    return raw.join(clean, "event").withColumns({"duplicates": F.col("raw") - F.col("clean"), "clean_pct": pct})


@query
def split_counts(t: Log) -> DataFrame:
    return t.events.groupBy("split").agg(F.count("*").alias("events"))


DAY_OF = "timestamp div 86400000"


@query
def user_stats(t: Log) -> DataFrame:
    u = t.clean.groupBy("visitorid").agg(
        F.count("*").alias("events"), F.count_distinct("itemid").alias("items"), F.count_distinct(F.expr(DAY_OF)).alias("active_days"),
        F.count_distinct("transactionid").alias("orders"), (F.max("timestamp") - F.min("timestamp")).alias("span_ms"),
    )
    return stats(reliable(u), "events", "items", "active_days", "orders", times=("span_ms",))


@query
def item_stats(t: Log) -> DataFrame:
    u = t.clean.groupBy("itemid").agg(F.count("*").alias("events"), F.count_distinct("visitorid").alias("users"), count_if("event = 'transaction'", "purchases"), F.count_distinct(F.expr(DAY_OF)).alias("active_days"))
    return stats(reliable(u), "events", "users", "purchases", "active_days")


@query
def pair_stats(t: Log) -> DataFrame:
    u = t.clean.groupBy("visitorid", "itemid").agg(F.count("*").alias("events"), count_if("event = 'view'", "views"), count_if("event = 'addtocart'", "carts"), count_if("event = 'transaction'", "purchases"))
    return stats(reliable(u), "events", "views", "carts", "purchases")


@query
def session_stats(t: Log) -> DataFrame:
    """Sizes and durations of sessions, sessions a user, and flags whose mean is the share of such sessions."""
    u = t.sessions.groupBy("visitorid", "session_id").agg(
        F.count("*").alias("events"), F.count_distinct("itemid").alias("items"), (F.max("timestamp") - F.min("timestamp")).alias("duration_ms"), F.max((F.col("event") == "transaction").cast("int")).alias("has_purchase")
    )
    u = reliable(u.withColumns({"one_event": (F.col("events") == 1).cast("int"), "one_item": (F.col("items") == 1).cast("int")}))
    per = u.groupBy("visitorid").agg(F.count("*").alias("sessions_per_user"))
    return stats(u, "events", "items", "one_event", "one_item", "has_purchase", times=("duration_ms",)).union(stats(per, "sessions_per_user"))


@query
def sparsity(t: Log) -> DataFrame:
    pairs = reliable(t.clean.groupBy("visitorid", "itemid").agg(F.count("*").alias("n"), F.max((F.col("event") == "transaction").cast("int")).alias("b")))
    share = lambda c: F.round(100 * F.avg(F.expr(c).cast("int")), 6)
    u = pairs.groupBy("visitorid").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.max("b").alias("b"))
    u = u.agg(F.count("*").alias("users"), count_if("k = 1", "one_item_users"), share("k = 1").alias("one_item_users_pct"), share("n = 1").alias("one_event_users_pct"), F.sum("b").alias("buyers"))
    i = pairs.groupBy("itemid").agg(F.count("*").alias("k"), F.max("b").alias("b"))
    i = i.agg(F.count("*").alias("items"), count_if("k = 1", "one_user_items"), share("k = 1").alias("one_user_items_pct"), F.sum("k").alias("pairs"), F.sum("b").alias("purchased_items"))
    return u.crossJoin(i).withColumn("density_pct", F.round(100 * F.col("pairs") / (F.col("users") * F.col("items")), 6))  # one row each


@query
def concentration(t: Log) -> DataFrame:
    """Entities, top 1 % and 10 % shares and Gini of events and purchases by user and item.

    Gini: 2 * sum(i * x_i) / (n * sum(x)) - (n + 1) / n in ascending order; the top p are ceil(n * p) entities.
    Over counts of counts: the rows of one window are the distinct counts, less than sqrt(2 * events).
    """
    out = None
    for key, name in (("visitorid", "users"), ("itemid", "items")):
        per = t.clean.groupBy(key).agg(F.count("*").alias("events"), count_if("event = 'transaction'", "purchases"))
        both = per.select(F.explode(F.array(*(F.struct(F.lit(f"{name}_{c}").alias("measure"), F.col(c).alias("x")) for c in ("events", "purchases")))).alias("y"))
        v = both.groupBy("y.measure", "y.x").agg(F.count("*").alias("k"))
        by = W.partitionBy("measure")
        v = v.withColumns({"n": F.sum("k").over(by), "above": F.coalesce(F.sum("k").over(by.orderBy(F.desc("x")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))})
        below = F.col("n") - F.col("above") - F.col("k")
        v = v.withColumns({"ranks": F.col("k") * below + F.col("k") * (F.col("k") + 1) / 2} | {f"t{p}": F.greatest(F.lit(0), F.least(F.col("k"), F.ceil(F.col("n") * p / 100) - F.col("above"))) for p in (1, 10)})
        total = F.sum(F.col("x") * F.col("k"))
        shares = (F.round(100 * F.sum(F.col(f"t{p}") * F.col("x")) / F.nullif(total, F.lit(0)), 6).alias(f"top_{p}pct_share_pct") for p in (1, 10))
        gini = F.round(2 * F.sum(F.col("ranks") * F.col("x")) / F.nullif(F.max("n") * total, F.lit(0)) - (F.max("n") + 1) / F.max("n"), 6)
        one = v.groupBy("measure").agg(F.max("n").alias("entities"), *shares, gini.alias("gini"))
        out = one if out is None else out.union(one)
    return out


def _day() -> F.Column:
    return F.date_from_unix_date(F.expr("timestamp div 86400000").cast("int"))


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


@query
def daily_activity(t: Log) -> DataFrame:
    """busiest, quietest: the day of most and fewest events, the first of equal ones (one window over the days)."""
    counts = (count_if(f"event = '{b}'", f"{b}s") for b in s.BEHAVIOURS)
    d = t.clean.groupBy(_day().alias("day")).agg(F.count("*").alias("events"), F.count_distinct("visitorid").alias("users"), *counts)
    best = lambda order: F.row_number().over(W.partitionBy(F.lit(1)).orderBy(order, "day")) == 1
    return _day_text(d.withColumns({"busiest": best(F.desc("events")), "quietest": best(F.asc("events"))}))


@query
def zero_event_days(t: Log) -> DataFrame:
    days = t.clean.select(_day().alias("day")).distinct()
    full = days.agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return _day_text(full.join(days, "day", "left_anti"))


@query
def hour_weekday_activity(t: Log) -> DataFrame:
    return t.clean.groupBy((F.weekday(_day()) + 1).alias("weekday"), F.expr("cast(timestamp div 3600000 % 24 as int)").alias("hour")).agg(F.count("*").alias("events"), count_if("event = 'transaction'", "purchases"))


@query
def simultaneous_events(t: Log) -> DataFrame:
    g = t.clean.groupBy("visitorid", "timestamp").agg(F.count("*").alias("n"), F.count_distinct("itemid").alias("i"), F.count_distinct("event").alias("b"))
    return g.agg(F.count("*").alias("buckets"), count_if("n > 1", "several_events"), count_if("i > 1", "several_items"), count_if("b > 1", "several_behaviours"))


@query
def session_size_distribution(t: Log) -> DataFrame:
    return t.sessions.groupBy("session_id").agg(F.count("*").alias("events")).groupBy("events").agg(F.count("*").alias("sessions"))


@query
def order_stats(t: Log) -> DataFrame:
    """shared: whether several users have the order's id; its mean is their share."""
    o = t.clean.where("transactionid is not null").groupBy("transactionid").agg(F.count("*").alias("lines"), F.count_distinct("itemid").alias("items"), F.count_distinct("visitorid").alias("users"), (F.max("timestamp") - F.min("timestamp")).alias("span_ms"))
    return stats(reliable(o.withColumn("shared", (F.col("users") > 1).cast("int"))), "lines", "items", "users", "shared", times=("span_ms",))


@query
def basket_size_distribution(t: Log) -> DataFrame:
    o = t.clean.where("transactionid is not null").groupBy("transactionid").agg(F.count_distinct("itemid").alias("items"))
    return o.groupBy("items").agg(F.count("*").alias("orders"))


def _purchases(t: Log) -> DataFrame:
    """Purchase events with the pair's first view (v), cart (c) and purchase (p)."""
    first = lambda b: F.min(F.when(F.col("event") == b, F.col("timestamp"))).over(W.partitionBy("visitorid", "itemid"))
    return t.clean.withColumns({"v": first("view"), "c": first("addtocart"), "p": first("transaction")}).where("event = 'transaction'")


@query
def purchase_prior_history(t: Log) -> DataFrame:
    g = _purchases(t).groupBy(F.expr("coalesce(v < timestamp, false)").alias("viewed"), F.expr("coalesce(c < timestamp, false)").alias("carted")).agg(
        F.count("*").alias("purchases"), count_if("p < timestamp", "bought_before"), count_if("v = timestamp", "first_view_same_time"), count_if("c = timestamp", "first_cart_same_time")
    )
    return g.withColumn("pct", F.round(100 * F.col("purchases") / F.sum("purchases").over(W.partitionBy(F.lit(1))), 6))  # four rows


@query
def purchase_delay(t: Log) -> DataFrame:
    """Median hours from the pair's first earlier view and cart to a purchase."""
    p, out = reliable(_purchases(t).select("timestamp", "v", "c")), None
    for name, first in (("view", "v"), ("addtocart", "c")):
        d = p.where(F.col(first) < F.col("timestamp")).select((F.col("timestamp") - F.col(first)).alias("ms"))
        one = d.agg(F.lit(name).alias("since"), F.count("*").alias("purchases")).withColumn("median_hours", F.round(F.lit(exact_quantiles(d, "ms", (0.5,))[0]).cast("double") / 3_600_000, 6))
        out = one if out is None else out.union(one)
    return out


@query
def property_changes(t: Log) -> DataFrame:
    before = F.lag("value").over(W.partitionBy("itemid", "property").orderBy("timestamp"))
    p = t.props.withColumn("before", before)
    return p.groupBy("property").agg(F.count("*").alias("updates"), F.count_distinct("itemid").alias("items"), count_if("before <> value", "changed"), count_if("before = value", "repeated"))


@query
def event_property_overlap(t: Log) -> DataFrame:
    """Items in both tables or one, and events whose item has a property at any time, or by the event's time."""
    e = t.clean.groupBy("itemid", "timestamp").agg(F.count("*").alias("n"))
    p = t.props.groupBy("itemid").agg(F.min("timestamp").alias("p"))
    both = e.join(p, "itemid", "full")
    per = both.groupBy("itemid").agg(F.sum("n").alias("e"), F.max("p").alias("p"), F.sum(F.when(F.col("p") <= F.col("timestamp"), F.col("n"))).alias("k"))
    total = lambda x, c: F.coalesce(F.sum(F.when(F.expr(c), F.col(x))), F.lit(0)).cast("long")
    return per.agg(
        count_if("e is not null and p is not null", "both_tables"), count_if("p is null", "events_only"), count_if("e is null", "properties_only"),
        total("e", "p is not null").alias("event_rows_with_property"), total("k", "true").alias("event_rows_with_property_by_then"),
    )


@query
def category_shape(t: Log) -> DataFrame:
    """name, value: categories, repeated ids, roots, leaves, paths that name another node twice or end elsewhere, depths."""
    leaf = t.tree.join(t.tree_raw.select(F.col("parentid").alias("categoryid")).distinct(), "categoryid", "left_anti")
    steps = F.split("path", "/")
    bad = (F.size(steps) != F.col("depth") + 1) | (F.size(F.array_distinct(steps)) != F.size(steps)) | (F.element_at(steps, -1) != F.col("categoryid").cast("string")) | (F.element_at(steps, 1) != F.col("root_id").cast("string"))
    head = t.tree.agg(F.count("*").alias("categories"), count_if("depth = 0", "roots"), F.max("depth").cast("long").alias("max_depth"), F.count_if(bad).alias("invalid_paths"))
    parts = [
        head.unpivot([], head.columns, "name", "value"),
        leaf.agg(F.count("*").alias("value")).select(F.lit("leaves").alias("name"), "value"),
        t.tree_raw.agg((F.count("*") - F.count_distinct("categoryid")).alias("value")).select(F.lit("duplicate_ids").alias("name"), "value"),
        t.tree.groupBy("depth").agg(F.count("*").alias("value")).select(F.concat(F.lit("depth_"), F.col("depth").cast("string")).alias("name"), "value"),
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _top(t: Log, key: str, other: str) -> DataFrame:
    counts = (count_if(f"event = '{b}'", f"{b}s") for b in s.BEHAVIOURS)
    g = t.clean.groupBy(key).agg(
        F.count("*").alias("events"), F.count_distinct(other).alias("others"), *counts, F.count_distinct("transactionid").alias("orders"), F.count_distinct(F.expr(DAY_OF)).alias("active_days"),
        F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
    )
    return g.withColumn("span_days", F.round((F.col("last_time") - F.col("first_time")) / 86_400_000, 6)).orderBy(F.desc("events"), key).limit(20)


@query
def top_users(t: Log) -> DataFrame:
    return _top(t, "visitorid", "itemid")


@query
def top_items(t: Log) -> DataFrame:
    return _top(t, "itemid", "visitorid")


@query
def new_users_by_day(t: Log) -> DataFrame:
    first = t.clean.groupBy("visitorid").agg(F.min("timestamp").alias("timestamp"))
    return _day_text(first.groupBy(_day().alias("day")).agg(F.count("*").alias("users")))


@query
def behavior_combinations(t: Log) -> DataFrame:
    """Users, items and pairs by the behaviours they have, with their share."""
    pairs = reliable(t.clean.groupBy("visitorid", "itemid").agg(*(F.max(F.col("event") == b).alias(b) for b in s.BEHAVIOURS)))
    out = None
    for name, keys in (("users", ["visitorid"]), ("items", ["itemid"]), ("pairs", ["visitorid", "itemid"])):
        g = pairs.groupBy(*keys).agg(*(F.max(b).alias(b) for b in s.BEHAVIOURS)).groupBy(*s.BEHAVIOURS).agg(F.count("*").alias("entities"))
        one = g.select(F.lit(name).alias("kind"), *s.BEHAVIOURS, "entities", F.round(100 * F.col("entities") / F.sum("entities").over(W.partitionBy(F.lit(1))), 6).alias("pct"))  # seven rows
        out = one if out is None else out.union(one)
    return out


@query
def degree_distribution(t: Log) -> DataFrame:
    """Users by their distinct items, items by their distinct users."""
    pairs = reliable(t.clean.select("visitorid", "itemid").distinct())
    of = lambda key, kind: pairs.groupBy(key).agg(F.count("*").alias("degree")).groupBy("degree").agg(F.count("*").alias("entities")).select(F.lit(kind).alias("kind"), "degree", "entities")
    return of("visitorid", "users").union(of("itemid", "items"))


@query
def event_row_id(t: Log) -> DataFrame:
    """Clean events, with the ids that are made for them, of a CSV source that has none."""
    path = shared_dir(t.spark, "events-without-id")
    t.raw.select(*s.COLUMNS).write.option("header", True).csv(path)
    return s.reject_bad_events(reliable(s.clean_events(files.read_events(t.spark, path))))


@query
def reject_bad_events(t: Log) -> DataFrame:
    return s.reject_bad_events(reliable(t.clean)).groupBy("event").agg(F.count("*").alias("events"), F.count("transactionid").alias("with_id"))


@query
def require_columns(t: Log) -> DataFrame:
    return star.require_columns(t.raw).select(*star.REQUIRED).agg(*(F.count(c).alias(c) for c in star.REQUIRED))


@query
def read_events_csv(t: Log) -> DataFrame:
    """The raw log, written as CSV and read with its types."""
    path = shared_dir(t.spark, "events-csv")
    t.raw.write.option("header", True).csv(path)
    return files.read_events(t.spark, path, f"event_id long, {files.EVENTS}")


@query
def read_properties(t: Log) -> DataFrame:
    """The properties, written as CSV in two sets of files beside rows of other kinds, and read as one table with only the kinds kept."""
    path, p = shared_dir(t.spark, "properties-read"), t.props.select("timestamp", "itemid", "property", F.col("value").cast("string").alias("value"))
    other = p.select("timestamp", "itemid", F.lit("790").alias("property"), F.lit("n15.000").alias("value"))
    parts = [f"{path}/part={i}" for i in (1, 2)]
    for i, part in enumerate(parts):
        p.union(other).where(F.col("itemid") % 2 == i).write.option("header", True).csv(part)
    rows = files.read_properties(t.spark, parts, ("categoryid", "available"))
    return rows.select("itemid", "property", "timestamp", F.col("value").cast("long").alias("value"))


@query
def property_files(t: Log) -> DataFrame:
    """Rows, items and properties of each of two sets of CSV files that are read as one table."""
    path, p = shared_dir(t.spark, "properties-csv"), t.props.select("timestamp", "itemid", "property", F.col("value").cast("string").alias("value"))
    parts = [f"{path}/part={i}" for i in (1, 2)]
    for i, part in enumerate(parts):
        p.where(F.col("itemid") % 2 == i).write.option("header", True).csv(part)
    rows = files.read_properties(t.spark, parts)
    return files.property_files(rows.withColumn("source", F.regexp_extract("source", "part=[0-9]", 0)))


def _raw_updates(t: Log) -> DataFrame:
    """The updates as a raw CSV source has them: text values, other properties and nulls beside those kept, rows that stand twice."""
    u = star.property_updates(t.spark, t.sf_dir).select("timestamp", "itemid", "property", F.concat(F.col("value").cast("string"), F.lit(".0")).alias("value"))
    other = u.select("timestamp", "itemid", F.lit("888").alias("property"), F.lit("n277.2").alias("value"))
    empty = u.where("itemid % 7 = 0").withColumn("value", F.lit(None).cast("string"))
    path = shared_dir(t.spark, "updates-csv")
    u.union(other).union(empty).union(u.where("itemid % 5 = 0")).write.option("header", True).csv(path)
    return files.read_properties(t.spark, [path])


@query
def property_filter(t: Log) -> DataFrame:
    return m.property_filter(_raw_updates(t))


@query
def property_conflicts(t: Log) -> DataFrame:
    """Keys of the raw updates with several values; the build refuses such a source."""
    return m.property_conflicts(m.property_filter(_raw_updates(t)))


@query
def property_cast(t: Log) -> DataFrame:
    """Raw updates without the conflicting keys, cast and checked."""
    rows = m.property_filter(_raw_updates(t))
    bad = m.property_conflicts(rows).select("itemid", "property", "timestamp")
    return m.clean_properties(rows.join(bad, ["itemid", "property", "timestamp"], "left_anti"))


@query
def read_category_tree(t: Log) -> DataFrame:
    """The tree, written as CSV and read with its types."""
    path = shared_dir(t.spark, "tree-csv")
    t.tree_raw.write.option("header", True).csv(path)
    return files.read_category_tree(t.spark, path)


@query
def publish_guard(t: Log) -> DataFrame:
    """Tables of a published dataset as readers get them; before its manifest is written they are refused."""
    path = shared_dir(t.spark, "guarded")
    tables = {"items": t.items, "category_tree": t.tree}
    files.write_tables(tables, path)
    try:
        files.require_complete(t.spark, path)
        refused = False
    except FileNotFoundError:
        refused = True
    files.publish(tables, path)
    found = files.require_complete(t.spark, path)
    return found["items"].agg(F.count("*").alias("items")).crossJoin(found["category_tree"].agg(F.count("*").alias("categories"))).withColumn("refused_before", F.lit(refused))  # one row each


@query
def write_splits(t: Log) -> DataFrame:
    """Queries and targets of each split, written by split and read again."""
    path = shared_dir(t.spark, "splits")
    q = files.write_splits(t.queries.select("query_id", "query_time", "split"), path, "queries")
    g = files.write_splits(t.targets.select("query_id", "itemid", "split"), path, "targets")
    n = g.groupBy("split").agg(F.count("*").alias("pairs"))
    return q.groupBy("split").agg(F.count("*").alias("queries")).join(n, "split").select(F.col("split").cast("string").alias("split"), "queries", "pairs")


@query
def bucketed_join(t: Log) -> DataFrame:
    """Queries with the number and events of their targets, from tables bucketed by query_id, joined and grouped without a shuffle."""
    path, buckets = shared_dir(t.spark, "bucketed"), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    stored(t, "events")
    q = files.write_bucketed(t.queries.select("query_id", "query_time", "split"), path, "queries", "query_id", buckets)
    g = files.write_bucketed(t.targets.select("query_id", "itemid", "target_events"), path, "targets", "query_id", buckets)
    n = g.groupBy("query_id").agg(F.count("*").alias("targets"), F.sum("target_events").alias("events"))
    return q.join(n, "query_id").select("query_id", "query_time", "split", "targets", "events")


def _tables(t: Log) -> dict[str, DataFrame]:
    return {
        "events": t.events.select("event_id", "timestamp", "visitorid", "event", "itemid", "transactionid", "session_id", "event_order", "split"),
        "queries": t.queries.select("query_id", "visitorid", "session_id", "query_time", "target_time", "split"),
        "targets": t.targets.select("query_id", "itemid", "target_events", "query_time", "target_time", "split"),
        "properties": t.props,
        "category_tree": t.tree,
        "items": t.items,
    }


@query
def table_manifest(t: Log) -> DataFrame:
    return files.manifest(_tables(t)).select("name", "row_count", "fingerprint")


@query
def verify_manifest(t: Log) -> DataFrame:
    """Publish the tables with an audit of the events, then compare them with their manifest."""
    path = shared_dir(t.spark, "dataset")
    s.reject_bad_events(stored(t, "events").events)
    files.publish(_tables(t), path, lambda x: checks.events(x["events"]), {"gap": GAP})
    return files.verify_manifest(t.spark, path, {"gap": GAP})


@query
def verify_tampered(t: Log) -> DataFrame:
    """A published dataset in which one table has lost the rows of every 97th item and another one a row's value: what the verifier says of each."""
    path, tables = shared_dir(t.spark, "tampered"), {"properties": t.props, "category_tree": t.tree, "items": t.items}
    files.publish(tables, path)
    files.write_tables({"items": reliable(t.items).where("itemid % 97 <> 0"), "properties": reliable(t.props).withColumn("value", F.when(F.col("itemid") % 97 == 1, 1 - F.col("value")).otherwise(F.col("value")))}, path)
    return files.verify_manifest(t.spark, path)


@query
def refused_trees(t: Log) -> DataFrame:
    """Trees made from the category tree with one fault each, and whether they are refused."""
    leaf = t.tree_raw.agg(F.min("categoryid")).first()[0]
    cut = lambda parent: t.tree_raw.withColumn("parentid", F.when(F.col("categoryid") == leaf, F.lit(parent).cast("long")).otherwise(F.col("parentid")))
    cases = {"whole": t.tree_raw, "own parent": cut(leaf), "unknown parent": cut(-5), "repeated": t.tree_raw.union(t.tree_raw.where(F.col("categoryid") == leaf)), "null id": t.tree_raw.union(t.tree_raw.limit(1).select(F.lit(None).cast("long"), F.lit(None).cast("long")))}
    rows = []
    for name, tree in cases.items():
        try:
            rows.append((name, m.category_tree(tree).count(), False))
        except ValueError:
            rows.append((name, None, True))
    return t.spark.createDataFrame(rows, "name string, categories long, refused boolean")


@query
def negative_summary(t: Log) -> DataFrame:
    """name, value: counts of the negative samples, for the summary of a build that has them."""
    stored(t, "events", "groups", "targets")
    n = t.negatives
    per = n.groupBy("query_id").agg(F.count("*").alias("k")).agg(F.count("*").alias("negative_queries"), F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("negative_pairs"))
    items = n.agg(F.count_distinct("itemid").alias("negative_items"))
    short = neg.shortfall(t.queries, n).select(F.col("short_queries").alias("queries_below_k"))
    out = None
    for df in (per, items, short):
        one = df.unpivot([], df.columns, "name", "value")
        out = one if out is None else out.union(one)
    return out


@query
def known_item_limit(t: Log) -> DataFrame:
    return neg.known_item_limit(t.queries, t.ranks).select("query_id", "limit")


@query
def train_negatives(t: Log) -> DataFrame:
    return t.negatives.select("query_id", "itemid")


@query
def negative_fill(t: Log) -> DataFrame:
    """Samples of queries whose pool is smaller than what is asked for (here 45 of some 50 eligible items): all that exists."""
    stored(t, "events", "groups", "targets")
    return neg.negatives(t.queries, t.targets, t.ranks, t.props, 45).where("filled").select("query_id", "itemid")


@query
def negative_shortfall(t: Log) -> DataFrame:
    return neg.shortfall(t.queries, t.negatives)


@query
def dq_events(t: Log) -> DataFrame:
    return checks.events(stored(t, "events").events)


@query
def dq_queries(t: Log) -> DataFrame:
    stored(t, "groups", "targets")
    return checks.queries(t.queries, t.targets, t.ends)


@query
def dq_targets(t: Log) -> DataFrame:
    stored(t, "groups", "targets")
    return checks.targets(t.targets, t.queries, t.groups)


@query
def dq_next_group(t: Log) -> DataFrame:
    stored(t, "events", "groups")
    return checks.next_group(t.events, t.queries)


@query
def dq_target_sets(t: Log) -> DataFrame:
    stored(t, "events", "groups", "targets")
    return checks.target_sets(t.events, t.queries, t.targets)


@query
def dq_features(t: Log) -> DataFrame:
    """The features as written and read back, against the events."""
    stored(t, "events")
    f = files.write_tables({"features": QUERIES_OF["prefix_features"](t)}, shared_dir(t.spark, "features"))["features"]
    return checks.features(f, t.events)


@query
def dq_prefix_recompute(t: Log) -> DataFrame:
    stored(t, "events", "groups")
    return checks.prefixes(t.events, t.queries)


@query
def dq_mappings(t: Log) -> DataFrame:
    stored(t, "events")
    return checks.mappings(t.train, t.users_idx, t.items_idx)


@query
def dq_interactions(t: Log) -> DataFrame:
    stored(t, "events")
    return checks.interactions(t.interactions, t.train)


@query
def dq_properties(t: Log) -> DataFrame:
    return checks.properties(t.props)


@query
def dq_metadata(t: Log) -> DataFrame:
    """Every target's metadata found again; covers the source times and the audit of metadata."""
    return checks.metadata(stored(t, "target_meta").target_meta, t.props, t.items)


@query
def dq_negatives(t: Log) -> DataFrame:
    stored(t, "events", "groups", "targets", "items")
    meta = m.asof_metadata(t.negatives.drop("filled"), t.props, t.items, t.tree, "query_time")
    return checks.negatives(t.negatives, t.queries, t.targets, m.mapping(t.train, "itemid"), meta)


@query
def dataset_summary(t: Log) -> DataFrame:
    """name, value: counts of the whole build."""
    stored(t, "events", "groups", "targets")
    one = lambda df, **of: df.agg(*(e.alias(n) for n, e in of.items())).unpivot([], list(of), "name", "value")
    by = lambda df, key, head: df.groupBy(key).agg(F.count("*").alias("value")).select(F.concat(F.lit(head), F.col(key)).alias("name"), "value")
    many = t.targets.groupBy("query_id").agg(F.count("*").alias("n")).where("n > 1")
    parts = [
        one(t.raw, raw_events=F.count("*")),
        one(t.raw.agg(F.count("*").alias("r")).crossJoin(t.events.agg(F.count("*").alias("c"))), removed_events=F.sum(F.col("r") - F.col("c"))),  # one row each
        one(QUERIES_OF["repeat_targets"](t), repeat_target_pairs=F.count("*")),
        one(t.users_idx, user_mapping=F.count("*")),
        one(t.items_idx, item_mapping=F.count("*")),
        one(t.snapshot, train_end_items=F.count("*"), train_end_candidates=F.count_if("candidate")),
        one(t.events, clean_events=F.count("*"), sessions=F.count_distinct("session_id")),
        one(t.groups, timestamp_groups=F.count("*")),
        one(t.queries, queries=F.count("*")),
        one(t.targets, target_pairs=F.count("*")),
        one(many, multi_target_queries=F.count("*")),
        one(t.items, catalog_items=F.count("*")),
        one(t.props, property_rows=F.count("*")),
        one(t.train, train_users=F.count_distinct("visitorid"), train_items=F.count_distinct("itemid"), train_pairs=F.count_distinct("visitorid", "itemid")),
        by(t.events, "event", "events_"),
        by(t.events, "split", "split_"),
        by(s.excluded_steps(t.groups), "reason", "excluded_"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query
def property_quality(t: Log) -> DataFrame:
    """Keys of the property updates before ties are settled."""
    rows = star.property_updates(t.spark, t.sf_dir)
    nulls = F.sum(F.when(F.col("itemid").isNull() | F.col("timestamp").isNull() | F.col("value").isNull(), F.col("k")).otherwise(0))
    once = rows.groupBy("itemid", "property", "timestamp", "value").agg(F.count("*").alias("k"))
    keys = once.groupBy("itemid", "property", "timestamp").agg(F.sum("k").alias("n"), F.sum(F.col("k") - 1).alias("d"), nulls.alias("z"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return keys.agg(
        F.sum("d").alias("exact_duplicates"), F.sum("z").alias("null_rows"),
        F.sum("n").alias("row_count"), F.count("*").alias("distinct_keys"), count_if("n > 1", "repeated_keys"), count_if("lo <> hi", "conflicting_keys"),
        F.min("timestamp").alias("first_time"), F.max("timestamp").alias("last_time"),
    )


@query
def property_per_item(t: Log) -> DataFrame:
    each = reliable(t.props.groupBy("itemid", "property").agg(F.count("*").alias("updates_per_property")))
    u = each.groupBy("itemid").agg(F.sum("updates_per_property").alias("updates"), F.count("*").alias("properties"))
    return stats(u, "updates", "properties").union(stats(each, "updates_per_property"))


@query
def user_cohorts(t: Log) -> DataFrame:
    """Users by the month (UTC) of their first event: number, mean events, share of buyers."""
    u = t.clean.groupBy("visitorid").agg(F.min("timestamp").alias("timestamp"), F.count("*").alias("events"), F.max((F.col("event") == "transaction").cast("int")).alias("buyer"))
    g = u.groupBy(F.date_format(_day(), "yyyy-MM").alias("month"))
    return g.agg(F.count("*").alias("users"), F.round(F.avg("events"), 6).alias("mean_events"), F.round(100 * F.avg("buyer"), 6).alias("buyers_pct"))


@query
def popularity_topk(t: Log) -> DataFrame:
    return ranking.popularity(t.train, 20)


@query
def ranking_metrics(t: Log) -> DataFrame:
    """The popularity ranking measured on the targets of each split."""
    return ranking.metrics(ranking.popularity(t.train, 20), t.targets)


@query
def item_knn(t: Log) -> DataFrame:
    stored(t, "events")
    return t.item_near


@query
def item_knn_weighted(t: Log) -> DataFrame:
    """Neighbours where a session's item weighs 1, 3 or 5 by its strongest behaviour."""
    stored(t, "events")
    return knn.item_knn(knn.session_items(t.train, {"transaction": 5, "addtocart": 3, "view": 1}), least=LEAST_COSINE)


@query
def item_knn_ranked(t: Log) -> DataFrame:
    """The list of each validation and test query by the neighbours of its prefix."""
    stored(t, "events", "groups")
    return knn.item_knn_ranked(t.prefix, t.item_near)


@query
def session_knn(t: Log) -> DataFrame:
    stored(t, "events")
    return knn.of_queries(t.session_sets[0], t.session_near)


@query
def session_knn_reads(t: Log) -> DataFrame:
    """How much of the lists of each distinct prefix settles its neighbours; ``read`` is at most ``entries``."""
    stored(t, "events")
    return t.session_index.reads(t.session_sets[1])


@query
def session_knn_ranked(t: Log) -> DataFrame:
    """The list of each validation and test query by the sessions near to its prefix; found once a set of items."""
    stored(t, "events")
    return knn.of_queries(t.session_sets[0], t.session_lists)


@query
def eligibility_changes(t: Log) -> DataFrame:
    return t.changes


@query
def popularity_candidates(t: Log) -> DataFrame:
    """The 20 most popular train items among the candidates at each query's time."""
    stored(t, "events", "groups")
    return t.popular


@query
def ranking_metrics_by_query(t: Log) -> DataFrame:
    """Metrics of one list a query: popularity among candidates, item and session neighbours; a list is made once, for all queries of a time or set of items."""
    stored(t, "events", "props")
    t.items = reliable(m.catalog(t.events, t.props))
    held = reliable(t.targets.where("split in ('validation', 'test')").select("split", "query_id", "itemid"))
    of, members = t.session_sets  # items without train sessions have no neighbours of either kind
    of = of.withColumnRenamed("set_id", "list_id")
    near = reliable(knn.item_knn(t.session_index.matrix(), least=LEAST_COSINE))
    by_item = knn.item_knn_ranked(members.select(F.col("set_id").alias("query_id"), "itemid"), near)
    popular = t.popular_lists.where("place > 0").select(F.struct("t", "part").alias("list_id"), "itemid", F.col("place").alias("rank"))
    lists = {
        "popularity": (popular, ranking.lists_at(t.asked, t.popular_lists)),
        "item_knn": (by_item.withColumnRenamed("query_id", "list_id"), of),
        "session_knn": (t.session_lists.withColumnRenamed("set_id", "list_id"), of),
    }
    out = None
    for name, (ranked, at) in lists.items():
        one = ranking.metrics_by_list(ranked, at, held).withColumn("model", F.lit(name))
        out = one if out is None else out.union(one)
    return out
