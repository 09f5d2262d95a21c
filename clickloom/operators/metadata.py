"""Property history, category tree, catalog, as-of metadata and train aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import dense_index, reliable
from clickloom.functions.segments import scan


def property_history(props: DataFrame) -> DataFrame:
    """Adds valid_to: the time of the next update of the same item and property."""
    return props.withColumn("valid_to", F.lead("timestamp").over(W.partitionBy("itemid", "property").orderBy("timestamp")))


def clean_properties(rows: DataFrame, keep: tuple[str, ...] = ("categoryid", "available")) -> DataFrame:
    """itemid, property, timestamp, value (long) of the raw updates (strings) of the properties ``keep``.

    Rows with a null go, exact repeats over all files are one row. Errors: a value that is no whole number, an
    availability other than 0 and 1, two values of one item and property at one time.
    """
    kept = property_filter(rows, keep)
    number = F.expr("try_cast(value as decimal(38,6))")
    bad, other = kept.agg(
        F.count_if(number.isNull() | (number != F.floor(number))), F.count_if((F.col("property") == "available") & ~F.coalesce(number.isin(0, 1), F.lit(False)))
    ).first()
    if bad:
        raise ValueError(f"{bad} property values are no whole numbers")
    if other:
        raise ValueError(f"{other} availability values are neither 0 nor 1")
    out = kept.select("itemid", "property", "timestamp", number.cast("long").alias("value")).distinct()
    if n := property_conflicts(out).count():
        raise ValueError(f"{n} conflicting property values")
    return out


def property_filter(rows: DataFrame, keep: tuple[str, ...] = ("categoryid", "available")) -> DataFrame:
    """timestamp, itemid, property, value of the updates of ``keep``, without nulls and exact repeats."""
    return rows.where(F.col("property").isin(*keep)).select("timestamp", "itemid", "property", "value").dropna().distinct()


def property_conflicts(rows: DataFrame) -> DataFrame:
    """itemid, property, timestamp, n_values of the keys that have several values."""
    return rows.groupBy("itemid", "property", "timestamp").agg(F.count_distinct("value").alias("n_values")).where("n_values > 1")


def category_tree(raw: DataFrame) -> DataFrame:
    """categoryid, root_id, depth, path of every category, however deep; an error for unknown parents, repeats, nulls or cycles.

    Pointer doubling: each category knows an ancestor and the path below it; a round takes over the ancestor's own
    ancestor and path, which doubles the distance, so a tree of depth d takes log2(d) + 1 rounds.
    """
    n, distinct = raw.agg(F.count("*"), F.count_distinct("categoryid")).first()
    if n != distinct:
        raise ValueError("categories must be unique and not null")
    if raw.where("parentid is not null").join(raw.select(F.col("categoryid").alias("parentid")), "parentid", "left_anti").count():
        raise ValueError("category tree has an unknown parent")
    up = raw.select("categoryid", F.col("parentid").alias("above"), F.col("categoryid").alias("root_id"), F.col("parentid").isNotNull().cast("int").alias("depth"), F.col("categoryid").cast("string").alias("path"))
    up, rounds = reliable(up), 0
    while up.where("above is not null").count():
        if (rounds := rounds + 1) > n.bit_length() + 1:
            raise ValueError("category tree has a cycle")
        over = up.select(F.col("categoryid").alias("above"), F.col("above").alias("_above"), F.col("root_id").alias("_root"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        up = reliable(up.join(over, "above", "left").select("categoryid", F.col("_above").alias("above"), F.coalesce("_root", "root_id").alias("root_id"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.concat_ws("/", "_path", "path").alias("path")))
    return up.drop("above")


def catalog(events: DataFrame, props: DataFrame) -> DataFrame:
    """itemid, known_at: first time in events or properties."""
    return events.select("itemid", "timestamp").union(props.select("itemid", "timestamp")).groupBy("itemid").agg(F.min("timestamp").alias("known_at"))


def last_known(asked: DataFrame, updates: DataFrame, *values: str) -> DataFrame:
    """The distinct ``asked`` (itemid, t) with the last of each of ``values`` (not null) that ``updates`` (itemid, t, values) have at or before t.

    One scan of both in order of item and time, in ranges, so an item may have any share of the requests or updates.
    """
    both = asked.select("itemid", "t").distinct().withColumn("_last", F.lit(1)).unionByName(updates.select("itemid", "t", *values, F.lit(0).alias("_last")), allowMissingColumns=True)
    found = scan(both, ("itemid",), ("t", "_last"), lasts={f"_l_{v}": F.col(v) for v in values})
    return found.where("_last = 1").select("itemid", "t", *(F.col(f"_l_{v}").alias(v) for v in values))


def asof_metadata(requests: DataFrame, props: DataFrame, items: DataFrame, tree: DataFrame, time: str = "t") -> DataFrame:
    """Requests (itemid, ``time``, ...) with the latest availability and category at or before their time.

    Everything is looked up once for each distinct item and time (``last_known``) and joined back by both, so the work
    is linear in requests and updates and no item meets in one task. candidate: known by then and not seen as
    unavailable. A request with a null item or time finds what is known of neither.
    """
    value = lambda p: F.max(F.when(F.col("property") == p, F.struct("value", F.col("timestamp").alias("at"))))
    updates = props.groupBy("itemid", F.col("timestamp").alias("t")).agg(value("available").alias("_a"), value("categoryid").alias("_c"))
    # when an item is known stands before all its times
    updates = updates.unionByName(items.select("itemid", F.lit(-(2**63)).cast("long").alias("t"), F.col("known_at").alias("_known")), allowMissingColumns=True)
    seen = last_known(requests.select("itemid", F.col(time).alias("t")), updates, "_a", "_c", "_known").withColumnsRenamed({"itemid": "_item", "t": "_t"})
    full = requests.join(seen, F.col("itemid").eqNullSafe(F.col("_item")) & F.col(time).eqNullSafe(F.col("_t")))
    full = full.select(*requests.columns, F.col("_known").alias("known_at"), F.col("_a.value").alias("available"), F.col("_a.at").alias("available_time"), F.col("_c.value").alias("category"), F.col("_c.at").alias("category_time"))
    # the tree is joined as its size allows: Spark broadcasts it below its own limit only
    out = full.join(tree, F.col("category") == F.col("categoryid"), "left")
    return out.select(
        *requests.columns,
        "known_at",
        "available_time",
        F.col("available").cast("byte").alias("available"),
        "category_time",
        F.coalesce("categoryid", F.lit(-1)).cast("long").alias("category_id"),
        F.coalesce("root_id", F.lit(-1)).cast("long").alias("root_id"),
        F.coalesce("depth", F.lit(-1)).cast("short").alias("depth"),
        F.coalesce("path", F.lit("UNKNOWN")).alias("path"),
        F.col("available").isNull().alias("availability_unknown"),
        F.col("category").isNull().alias("category_missing"),
        (F.col("category").isNotNull() & F.col("categoryid").isNull()).alias("category_invalid"),
        (F.coalesce(F.col("known_at") <= F.col(time), F.lit(False)) & F.coalesce(F.col("available") == 1, F.lit(True))).alias("candidate"),
    )


def eligibility_changes(items: DataFrame, props: DataFrame) -> DataFrame:
    """itemid, t, on: when an item becomes a candidate and when it ceases to be one.

    A candidate is known (``items``: itemid, known_at) and not last seen as unavailable (``props``).
    """
    available = props.where("property = 'available'").groupBy("itemid", F.col("timestamp").alias("t")).agg(F.max("value").alias("v"))
    known = items.select("itemid", F.col("known_at").alias("t"))
    times = known.join(available, ["itemid", "t"], "left").unionByName(available.join(known, ["itemid", "t"], "left_anti"))
    seen = scan(times, ("itemid",), ("t",), lasts={"now": F.col("v")}, before={"then": F.col("v"), "any": F.lit(1)})
    on, was = F.coalesce(F.col("now") == 1, F.lit(True)), F.col("any").isNotNull() & F.coalesce(F.col("then") == 1, F.lit(True))
    return seen.select("itemid", "t", on.alias("on"), was.alias("_was")).where(F.col("on") != F.col("_was")).drop("_was")


def candidates_at_time(times: tuple[int, ...], items: DataFrame, props: DataFrame, tree: DataFrame, warm: DataFrame | None = None) -> DataFrame:
    """t, itemid and metadata of all eligible catalog items at each of a few ``times`` (ms); ``warm``: only items in its itemid.

    The catalog is repeated for each time, so give a few times, not one for each query.
    """
    known = items if warm is None else items.join(warm.select("itemid").distinct(), "itemid", "left_semi")
    asked = known.select("itemid", "known_at", F.explode(F.array(*(F.lit(t).cast("long") for t in times))).alias("t")).where("known_at <= t").select("itemid", "t")
    return asof_metadata(asked, props, items, tree, "t").where("candidate")


def mapping(train: DataFrame, key: str) -> DataFrame:
    """Train ids in order with indexes from 2 (0 pads, 1 is unknown)."""
    return dense_index(train, key, 2, f"{key}_idx")


def behavior_edges(train: DataFrame) -> DataFrame:
    return train.groupBy("visitorid", "itemid", "event").agg(F.count("*").alias("n"), F.max("timestamp").alias("last_time"))


def interactions(train: DataFrame, users: DataFrame, items: DataFrame, train_end: int, weights=(("view", 1.0), ("addtocart", 3.0), ("transaction", 5.0))) -> DataFrame:
    """One row for each visitor and item: indexes, counts, last time and hours before ``train_end`` by behaviour, weighted score.

    ``users`` and ``items`` are the mappings. A behaviour that did not occur has count 0 and null times.
    """
    is_ = lambda b: F.col("event") == b
    g = train.groupBy("visitorid", "itemid").agg(
        *(F.count_if(is_(b)).alias(f"{b}_count") for b, _ in weights), *(F.max(F.when(is_(b), F.col("timestamp"))).alias(f"{b}_last_time") for b, _ in weights), F.max("timestamp").alias("last_time")
    )
    score = sum((F.lit(w) * F.log1p(f"{b}_count") for b, w in weights), F.lit(0.0))
    hours = {f"{b}_recency_hours": F.round((F.lit(train_end).cast("long") - F.col(f"{b}_last_time")) / 3_600_000, 6) for b, _ in weights}
    return g.withColumns({"score": F.round(score, 6), **hours}).join(users, "visitorid").join(items, "itemid")
