"""Cleaning, sessions, time splits and next-step samples of a click log."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.index import reliable, running_base
from clickloom.functions.quantile import exact_quantiles

BEHAVIOURS = ("view", "addtocart", "transaction")
COLUMNS = ("timestamp", "visitorid", "event", "itemid", "transactionid")


def valid_events(raw: DataFrame) -> DataFrame:
    """Rows of the three behaviours whose other required columns are not null, repeats included."""
    return raw.where(F.col("event").isin(*BEHAVIOURS)).dropna(subset=["timestamp", "visitorid", "event", "itemid"])


def clean_events(raw: DataFrame) -> DataFrame:
    """Valid rows without exact repeats; of equal rows (nulls equal) the smallest event_id stays.

    A source without event_id gets one: the number of the row, from 0, among the distinct rows in order of all
    columns (nulls first). It only breaks ties, and is the same whenever the rows are.
    """
    valid = valid_events(raw)
    if "event_id" in raw.columns:
        return valid.groupBy(*COLUMNS).agg(F.min("event_id").alias("event_id"))
    rows = valid.select(*COLUMNS).distinct().select(F.struct(*COLUMNS).alias("_k"), F.lit(1).alias("_one"))
    return running_base(rows, "_k", "_one").select("_k.*", F.col("base").alias("event_id"))


def reject_bad_events(clean: DataFrame) -> DataFrame:
    """``clean`` itself; an error if it is empty or a transaction has no id."""
    n, bad = clean.agg(F.count("*"), F.count_if((F.col("event") == "transaction") & F.col("transactionid").isNull())).first()
    if not n:
        raise ValueError("No valid events")
    if bad:
        raise ValueError("Transactions require transactionid")
    return clean


#: What ``sessionize`` adds to an event, as of its place in its session.
STATE = (
    ["event_order int", "session_start long", "session_end long", "session_group int", "previous_time long", "next_time long"]
    + [f"{b}_count int" for b in BEHAVIOURS]
    + [f"{b}_last_time long" for b in BEHAVIOURS]
)


def sessionize(clean: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Adds session_id (number over all, in order of visitor and time), group_id and the columns of ``STATE``.

    A session ends where the next event is more than ``gap_minutes`` later. group_id numbers the distinct
    (visitor, time) pairs, that is the timestamp groups, in the same order; session_group numbers them in a session
    from 1, and previous_time and next_time are the times of the groups before and after in it, or null. The counts and
    last times of each behaviour are those of the session up to the event.

    Events are dealt once, by ranges of visitor and time, so a visitor or a session may have any share of them; each
    range is numbered by itself and kept by a checkpoint. One row a range then tells what a session brings from
    the ranges before and what follows in those after.
    """
    columns = clean.columns
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in clean.schema] + ["_range int", "_seq long", "_group long", *STATE]
    order = ("visitorid", "timestamp", "event_id")
    rows = reliable(clean.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(partial(_number, gap=gap_minutes * 60_000), ", ".join(schema)))
    names = [x.split()[0] for x in STATE]
    state = F.struct("visitorid", "timestamp", *names)
    place = F.struct("timestamp", "event_id")  # of one visitor; the first and last rows of a range are those of its first and last visitor
    ends = rows.groupBy("_range").agg(F.min_by(state, F.struct("visitorid", place)).alias("a"), F.max_by(state, F.struct("visitorid", place)).alias("z"), F.max("_seq").alias("sessions"), F.max("_group").alias("groups"))
    table = _carried([r.asDict(True) for r in ends.collect()], gap_minutes * 60_000)  # one row for each partition
    carried = clean.sparkSession.createDataFrame(table, CARRIED)
    out = rows.join(F.broadcast(carried), "_range")  # one row for each partition
    on, same = F.col("c_on") & (F.col("_seq") == 1), F.col("c_same") & (F.col("_group") == 1)
    last_run, last_group = F.col("_seq") == F.col("c_sessions"), F.col("_group") == F.col("c_groups")
    fixed = {
        "session_id": F.col("c_seq") + F.col("_seq"),
        "group_id": F.col("c_group") + F.col("_group"),
        "event_order": F.col("event_order") + F.when(on, F.col("c_event_order")).otherwise(0),
        "session_start": F.when(on, F.col("c_session_start")).otherwise(F.col("session_start")),
        "session_end": F.when(last_run, F.coalesce("c_session_end", "session_end")).otherwise(F.col("session_end")),
        "session_group": F.col("session_group") + F.when(on, F.col("c_session_group")).otherwise(0),
        "previous_time": F.when(on & (F.col("_group") == 1), F.col("c_previous_time")).otherwise(F.col("previous_time")),
        "next_time": F.when(last_group, F.col("c_next_time")).otherwise(F.col("next_time")),
    }
    fixed |= {f"{b}_count": F.col(f"{b}_count") + F.when(on, F.col(f"c_{b}_count")).otherwise(0) for b in BEHAVIOURS}
    fixed |= {f"{b}_last_time": F.coalesce(f"{b}_last_time", F.when(on, F.col(f"c_{b}_last_time"))) for b in BEHAVIOURS}
    return out.select(*columns, *(c.alias(n) for n, c in fixed.items()))


def _number(batches: Iterator[pa.RecordBatch], gap: int) -> Iterator[pa.RecordBatch]:
    """One sorted range, by itself: its first row begins a session."""
    table = pa.Table.from_batches(whole).combine_chunks() if (whole := list(batches)) else None
    if table is None or not table.num_rows:
        return
    n = table.num_rows
    visitor, time = table.column("visitorid").to_numpy(), table.column("timestamp").to_numpy()
    kind = pc.fill_null(pc.index_in(table.column("event"), pa.array(BEHAVIOURS)), -1).to_numpy()
    at, other = np.arange(n), visitor[1:] != visitor[:-1]
    fresh = np.concatenate([[True], other | (time[1:] - time[:-1] > gap)])  # begins a session
    turn = np.concatenate([[True], other | (time[1:] != time[:-1])])  # begins a group
    seq, group = fresh.cumsum(), turn.cumsum()
    first = np.maximum.accumulate(np.where(fresh, at, 0))
    last = np.append(np.flatnonzero(fresh)[1:], n)[seq - 1] - 1
    heads = np.flatnonzero(turn)
    before = np.ma.array(time[heads - 1], mask=fresh[heads])
    after = np.ma.array(np.append(time[heads[1:]], 0), mask=np.append(fresh[heads[1:]], True))
    columns = {"event_order": at - first, "session_start": time[first], "session_end": time[last], "session_group": group - group[first] + 1, "previous_time": before[group - 1], "next_time": after[group - 1]}
    for i, b in enumerate(BEHAVIOURS):
        is_ = kind == i
        count, latest = is_.cumsum(), np.maximum.accumulate(np.where(is_, at, -1))
        columns[f"{b}_count"] = count - count[first] + is_[first]
        columns[f"{b}_last_time"] = np.ma.array(time[latest], mask=latest < first)
    kinds = {x.split()[0]: pa.int32() if x.endswith("int") else pa.int64() for x in STATE}
    made = {"_range": pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), "_seq": pa.array(seq.astype(np.int64)), "_group": pa.array(group.astype(np.int64))}
    made |= {c: pa.array(np.ma.getdata(columns[c]), mask=np.ma.getmaskarray(columns[c])).cast(t) for c, t in kinds.items()}
    for name, column in made.items():
        table = table.append_column(name, column)
    yield from table.to_batches(max_chunksize=10_000)


CARRIED = "_range int, c_on boolean, c_same boolean, c_seq long, c_group long, c_sessions long, c_groups long, c_session_end long, c_next_time long, " + ", ".join(f"c_{x}" for x in STATE if x.split()[0] not in ("session_end", "next_time"))


def _carried(ends: list[dict], gap: int) -> list[tuple]:
    """For each range what it continues: from its first and last rows (a, z) and its numbers of sessions and groups."""
    ends.sort(key=lambda r: r["_range"])
    names = [x.split()[0] for x in STATE]
    sums = ["event_order", "session_group", *(f"{b}_count" for b in BEHAVIOURS)]
    out, before, sessions, groups = [], None, 0, 0
    for r in ends:
        a, z = r["a"], dict(r["z"])
        on = before is not None and before["visitorid"] == a["visitorid"] and a["timestamp"] - before["timestamp"] <= gap
        same = before is not None and before["visitorid"] == a["visitorid"] and before["timestamp"] == a["timestamp"]
        c = {x: 0 for x in names}
        if on:
            c = {x: before[x] for x in names}
            c["event_order"] += 1
            c["session_group"] -= same
            c["previous_time"] = before["previous_time"] if same else before["timestamp"]
        r |= {"on": on, "same": same, "carry": c, "seq": sessions - on, "group": groups - same}
        sessions, groups = r["seq"] + r["sessions"], r["group"] + r["groups"]
        if on and r["sessions"] == 1:  # the last row belongs to what came from before
            z |= {x: z[x] + c[x] for x in sums} | {"session_start": c["session_start"]}
            z |= {f"{b}_last_time": c[f"{b}_last_time"] if z[f"{b}_last_time"] is None else z[f"{b}_last_time"] for b in BEHAVIOURS}
            if r["groups"] == 1:
                z["previous_time"] = c["previous_time"]
        before = z
    later = None  # the range after: does it go on, when does its first session end, which time follows its first group
    for r in reversed(ends):
        end = later["end"] if later and later["on"] else None
        nxt = None
        if later and later["on"]:
            nxt = later["next"] if later["same"] else later["a"]["timestamp"]
        r |= {"fix_end": end, "fix_next": nxt}
        first_end = end if r["sessions"] == 1 and end is not None else r["a"]["session_end"]
        first_next = nxt if r["groups"] == 1 else r["a"]["next_time"]
        later = r | {"end": first_end, "next": first_next}
    kept = [x for x in names if x not in ("session_end", "next_time")]
    return [(r["_range"], r["on"], r["same"], r["seq"], r["group"], r["sessions"], r["groups"], r["fix_end"], r["fix_next"], *(r["carry"][x] for x in kept)) for r in ends]


def cutoffs(events: DataFrame, train: float = 0.8, validation: float = 0.9) -> DataFrame:
    """train_end, validation_end (interpolated quantiles, rounded half to even) and observation_end in ms; one row.

    Exact, whatever the number of distinct times; three numbers come to the driver. Nulls for no events.
    """
    spark = events.sparkSession
    t, v, last = exact_quantiles(events, "timestamp", (train, validation, 1.0), 3_600_000)
    row = (None,) * 3 if last is None else (round(t), round(v), int(last))
    return spark.createDataFrame([row], "train_end long, validation_end long, observation_end long")


def temporal_split(events: DataFrame, ends: DataFrame) -> DataFrame:
    """Adds split: a session (session_start, session_end) lies wholly in train, validation or test, else it is boundary_drop."""
    lo, hi = F.col("session_start"), F.col("session_end")
    t, v = (F.lit(x).cast("long") for x in ends.select("train_end", "validation_end").first())
    split = F.when(hi <= t, "train").when((lo > t) & (hi <= v), "validation").when(lo > v, "test").otherwise("boundary_drop")
    return events.withColumn("split", split)


def timestamp_groups(events: DataFrame) -> DataFrame:
    """One row for each session and time: counts and last times by behaviour so far, the next group's time, query_id.

    Events carry the state of their session (``sessionize``), so a group is an aggregation of its own events, with
    partial sums and without a window. history_last_time is the time of the last event counted, and a behaviour not
    yet seen has null times.
    """
    g = events.groupBy("visitorid", "session_id", "timestamp", "split", "group_id").agg(
        F.count("*").alias("n_events"), F.max("next_time").alias("target_time"), F.max("session_group").alias("prefix_groups"), (F.max("event_order") + 1).cast("long").alias("prefix_events"), F.max("timestamp").alias("history_last_time"),
        *(F.max(f"{b}_count").cast("long").alias(f"{b}_count") for b in BEHAVIOURS), *(F.max(f"{b}_last_time").alias(f"{b}_last_time") for b in BEHAVIOURS),
    ).withColumnsRenamed({"timestamp": "query_time", "group_id": "query_id"})
    return g.withColumns({f"{b}_recency": (F.col("query_time") - F.col(f"{b}_last_time")) / 1000 for b in BEHAVIOURS})


def queries_of(groups: DataFrame) -> DataFrame:
    """Groups with a next group, outside boundary sessions."""
    return groups.where("target_time is not null and split <> 'boundary_drop'")


def excluded_steps(groups: DataFrame) -> DataFrame:
    """The other groups; boundary comes before the missing next group as a reason."""
    out = groups.where("target_time is null or split = 'boundary_drop'")
    return out.withColumn("reason", F.when(F.col("split") == "boundary_drop", "boundary_session").otherwise("no_next_group"))


def next_targets(events: DataFrame) -> DataFrame:
    """query_id, itemid, target_events, query_time, target_time, split, session_id, visitorid: distinct items of the group after each query.

    Without a join or a window: groups are numbered on through a session, so the items of a group are the targets of
    the group before it, if the session has one (previous_time).
    """
    items = events.where("split <> 'boundary_drop' and previous_time is not null")
    t = items.groupBy("visitorid", "session_id", "timestamp", "group_id", "split", "itemid", "previous_time").agg(F.count("*").alias("target_events"))
    return t.select((F.col("group_id") - 1).alias("query_id"), "itemid", "target_events", F.col("previous_time").alias("query_time"), F.col("timestamp").alias("target_time"), "split", "session_id", "visitorid")


def history_ranges(events: DataFrame) -> DataFrame:
    """session_id, event_id, itemid, event, first_query of every event that some query's prefix holds.

    The prefix of a query is what its session has with first_query <= query_id. One row an event, so a session of
    n events has n rows, where the prefixes written out have n^2 / 2.
    """
    held = events.where("split <> 'boundary_drop' and next_time is not null")
    return held.select("session_id", "event_id", "itemid", "event", F.col("group_id").alias("first_query"))


def history_of(ranges: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, event_id, itemid, event: the prefixes of the given ``queries`` (query_id, session_id), written out."""
    return ranges.join(queries.select("query_id", "session_id"), "session_id").where("first_query <= query_id").select("query_id", "event_id", "itemid", "event")
