"""DuckDB SQL of the click-log queries, written from the definitions and run against the same star tables."""

from __future__ import annotations

_BASE = """
WITH RECURSIVE raw0 AS (
  SELECT event_id, epoch_ms(date_trunc('hour', ts))::BIGINT AS timestamp,
    user_id + CASE WHEN user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-26' THEN 100000 ELSE 0 END AS visitorid,
    CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
    k + CASE WHEN ts >= TIMESTAMP '2024-01-26' AND k < 10 THEN 1000 ELSE 0 END AS itemid,
    CASE WHEN event_type = 'purchase' THEN user_id * 1000 + dayofyear(ts) END::BIGINT AS transactionid
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE event_id % 50 = 0),
clean AS (SELECT timestamp, visitorid, event, itemid, transactionid, min(event_id) AS event_id FROM raw
  WHERE event IN ('view', 'addtocart', 'transaction') GROUP BY ALL),
ses0 AS (SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w <= 43200000 THEN 0 ELSE 1 END AS fresh FROM clean
  WINDOW w AS (PARTITION BY visitorid ORDER BY timestamp, event_id)),
ses1 AS (SELECT *, CAST(sum(fresh) OVER (ORDER BY visitorid, timestamp, event_id) AS BIGINT) AS session_id FROM ses0),
ses AS (SELECT *, CAST(row_number() OVER (PARTITION BY session_id ORDER BY timestamp, event_id) - 1 AS INT) AS event_order FROM ses1),
ends AS (SELECT round_even(quantile_cont(timestamp, 0.8), 0)::BIGINT AS train_end,
  round_even(quantile_cont(timestamp, 0.9), 0)::BIGINT AS validation_end, max(timestamp) AS observation_end FROM clean),
b AS (SELECT session_id, min(timestamp) AS lo, max(timestamp) AS hi FROM ses GROUP BY 1),
sp AS (SELECT session_id, CASE WHEN hi <= train_end THEN 'train' WHEN lo > train_end AND hi <= validation_end THEN 'validation'
  WHEN lo > validation_end THEN 'test' ELSE 'boundary_drop' END AS split FROM b, ends),
ev AS (SELECT ses.*, split FROM ses JOIN sp USING (session_id)),
g0 AS (SELECT visitorid, session_id, timestamp AS query_time, split, count(*) AS n_events,
  count(*) FILTER (event = 'view') AS nv, count(*) FILTER (event = 'addtocart') AS na, count(*) FILTER (event = 'transaction') AS nt
  FROM ev GROUP BY ALL),
grp AS (SELECT *, CAST(row_number() OVER (ORDER BY session_id, query_time) AS BIGINT) AS query_id,
  lead(query_time) OVER w AS target_time, CAST(row_number() OVER w AS INT) AS prefix_groups,
  CAST(sum(n_events) OVER w AS BIGINT) AS prefix_events,
  CAST(sum(nv) OVER w AS BIGINT) AS view_count, CAST(sum(na) OVER w AS BIGINT) AS addtocart_count, CAST(sum(nt) OVER w AS BIGINT) AS transaction_count,
  max(CASE WHEN nv > 0 THEN query_time END) OVER w AS view_last_time, (query_time - view_last_time) / 1000 AS view_recency,
  max(CASE WHEN na > 0 THEN query_time END) OVER w AS addtocart_last_time, (query_time - addtocart_last_time) / 1000 AS addtocart_recency,
  max(CASE WHEN nt > 0 THEN query_time END) OVER w AS transaction_last_time, (query_time - transaction_last_time) / 1000 AS transaction_recency
  FROM g0 WINDOW w AS (PARTITION BY session_id ORDER BY query_time)),
q AS (SELECT * FROM grp WHERE target_time IS NOT NULL AND split <> 'boundary_drop'),
tgt AS (SELECT query_id, itemid, count(*) AS target_events, q.query_time, q.target_time, q.split, q.session_id
  FROM q JOIN ev ON ev.session_id = q.session_id AND ev.timestamp = q.target_time GROUP BY ALL),
train AS (SELECT * FROM ev WHERE split = 'train'),
props AS (SELECT itemid, property, timestamp, min(value)::BIGINT AS value FROM (
  SELECT itemid, 'available' AS property, timestamp, CASE WHEN event = 'signup' THEN 1 ELSE 0 END AS value FROM raw WHERE event IN ('signup', 'error') AND itemid % 10 <> 3
  UNION ALL SELECT itemid, 'categoryid', timestamp, event_id % 40 FROM raw WHERE event = 'signup' AND itemid % 10 <> 4) GROUP BY ALL),
traw AS (SELECT n_nationkey::BIGINT AS categoryid, (1000 + n_regionkey)::BIGINT AS parentid FROM nation
  UNION ALL SELECT (1000 + r_regionkey)::BIGINT, CASE WHEN r_regionkey < 3 THEN 2000 END::BIGINT FROM region UNION ALL SELECT 2000, NULL),
tree AS (SELECT categoryid, categoryid AS root_id, 0 AS depth, categoryid::VARCHAR AS path FROM traw WHERE parentid IS NULL
  UNION ALL SELECT c.categoryid, t.root_id, t.depth + 1, t.path || '/' || c.categoryid FROM traw c JOIN tree t ON c.parentid = t.categoryid),
items AS (SELECT itemid, min(timestamp) AS known_at FROM (SELECT itemid, timestamp FROM clean UNION ALL SELECT itemid, timestamp FROM props) GROUP BY 1)
"""

_DAY = "CAST(epoch_ms(timestamp) AS DATE)"


def _meta(requests: str, time: str, keep: str) -> str:
    return f"""rq AS ({requests}),
pa AS (SELECT * FROM props WHERE property = 'available'), pc AS (SELECT * FROM props WHERE property = 'categoryid'),
m1 AS (SELECT rq.*, pa.value AS av, pa.timestamp AS av_at FROM rq ASOF LEFT JOIN pa ON rq.itemid = pa.itemid AND rq.{time} >= pa.timestamp),
m2 AS (SELECT m1.*, pc.value AS cat, pc.timestamp AS cat_at FROM m1 ASOF LEFT JOIN pc ON m1.itemid = pc.itemid AND m1.{time} >= pc.timestamp),
meta AS (SELECT {keep}, i.known_at, av_at AS available_time, cat_at AS category_time, av IS NULL AS availability_unknown, av::TINYINT AS available, coalesce(t.categoryid, -1) AS category_id, coalesce(t.root_id, -1) AS root_id,
  coalesce(t.depth, -1)::SMALLINT AS depth, coalesce(t.path, 'UNKNOWN') AS path, cat IS NULL AS category_missing,
  cat IS NOT NULL AND t.categoryid IS NULL AS category_invalid,
  coalesce(i.known_at <= m2.{time}, false) AND coalesce(av = 1, true) AS candidate
  FROM m2 LEFT JOIN items i ON i.itemid = m2.itemid LEFT JOIN tree t ON t.categoryid = m2.cat)"""


_TARGET_META = _meta("SELECT query_id, itemid, query_time, split FROM tgt", "query_time", "query_id, m2.itemid, query_time, split")
_EVENT_META = _meta("SELECT itemid, event, timestamp FROM clean", "timestamp", "m2.itemid, event, m2.timestamp")


_SNAPSHOT = _meta("SELECT itemid, train_end AS t FROM items, ends WHERE known_at <= train_end", "t", "m2.itemid")
_AT_ENDS = _meta("SELECT itemid, t FROM items, (SELECT unnest([train_end, validation_end, observation_end]) AS t FROM ends) WHERE known_at <= t", "t", "t, m2.itemid")


def _stats(table: str, *columns: str) -> str:
    each = [
        f"""SELECT '{c}' AS metric, count(*) AS n, min({c})::DOUBLE AS min, round(avg({c}), 6) AS mean, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median,
        round(quantile_cont({c}::DOUBLE, 0.9), 6) AS p90, round(quantile_cont({c}::DOUBLE, 0.95), 6) AS p95, round(quantile_cont({c}::DOUBLE, 0.99), 6) AS p99, max({c})::DOUBLE AS max FROM {table}"""
        for c in columns
    ]
    return " UNION ALL ".join(each)


_SPLIT_SUMMARY = """SELECT a.*, pairs, pair_coverage_pct, macro_ceiling_pct, cold_item_pct, target_items FROM
(SELECT split, count(*) AS queries, count(DISTINCT session_id) AS sessions, count(DISTINCT visitorid) AS users, min(query_time) AS first_query, max(query_time) AS last_query,
  round(100 * avg((visitorid NOT IN (SELECT visitorid FROM train))::INT), 6) AS cold_user_pct FROM q GROUP BY 1) a
JOIN (SELECT split, sum(n)::BIGINT AS pairs, round(100 * sum(c) / sum(n), 6) AS pair_coverage_pct, round(100 * avg(c / n), 6) AS macro_ceiling_pct FROM
(SELECT split, query_id, count(*) AS n, count(*) FILTER (candidate) AS c FROM meta GROUP BY ALL) GROUP BY 1) b USING (split)
JOIN (SELECT split, round(100 * avg((itemid NOT IN (SELECT itemid FROM train))::INT), 6) AS cold_item_pct, count(DISTINCT itemid) AS target_items FROM tgt GROUP BY 1) c USING (split)"""

_PURCHASES = """fi AS (SELECT visitorid, itemid, min(timestamp) FILTER (event = 'view') AS v, min(timestamp) FILTER (event = 'addtocart') AS c, min(timestamp) FILTER (event = 'transaction') AS p FROM clean GROUP BY ALL),
pp AS (SELECT * FROM clean JOIN fi USING (visitorid, itemid) WHERE event = 'transaction')"""

_UPDATES = """ru AS (SELECT timestamp, itemid, 'available' AS property, CASE WHEN event = 'signup' THEN '1.0' ELSE '0.0' END AS value FROM raw WHERE event IN ('signup', 'error') AND itemid % 10 <> 3
  UNION ALL SELECT timestamp, itemid, 'categoryid', (event_id % 40) || '.0' FROM raw WHERE event = 'signup' AND itemid % 10 <> 4),
rf AS (SELECT DISTINCT timestamp, itemid, property, value FROM ru),
rc AS (SELECT itemid, property, timestamp, count(DISTINCT value) AS n_values FROM rf GROUP BY ALL HAVING count(DISTINCT value) > 1)"""

#: name: (select, further tables of its WITH clause)
#: The derived prefix of a query: items of its last 20 groups.
_LATEST = """pfx AS (SELECT DISTINCT q.query_id, e.itemid FROM q JOIN grp g ON g.session_id = q.session_id AND g.query_id BETWEEN q.query_id - 19 AND q.query_id
  JOIN ev e ON e.session_id = g.session_id AND e.timestamp = g.query_time WHERE q.split IN ('validation', 'test'))"""


def _item_knn(weight: str, si: str = "si") -> str:
    return f"""{si} AS (SELECT session_id, itemid, max({weight})::BIGINT AS w FROM train GROUP BY ALL), nrm AS (SELECT itemid, sum(w * w) AS n FROM {si} GROUP BY 1),
dot AS (SELECT x.itemid, y.itemid AS neighbour, sum(x.w * y.w)::BIGINT AS dot FROM {si} x JOIN {si} y ON x.session_id = y.session_id AND x.itemid <> y.itemid GROUP BY ALL),
cs AS (SELECT d.*, dot * dot / (a.n * b.n)::DOUBLE AS c2 FROM dot d JOIN nrm a ON a.itemid = d.itemid JOIN nrm b ON b.itemid = d.neighbour),
knn AS (SELECT itemid, neighbour, row_number() OVER (PARTITION BY itemid ORDER BY c2 DESC, neighbour)::INT AS rank, dot, round(sqrt(c2), 6) AS similarity FROM cs WHERE c2 >= 0.04::DOUBLE * 0.04::DOUBLE QUALIFY rank <= 20)"""


_SESSION_KNN = f"""{_LATEST}, si AS (SELECT DISTINCT session_id, itemid FROM train), se AS (SELECT session_id, max(timestamp) AS session_end FROM train GROUP BY 1),
idf AS (SELECT itemid, round(1000000 * ln(1 + (SELECT count(DISTINCT session_id) FROM train) / count(*)))::BIGINT AS idf FROM si GROUP BY 1),
nn AS (SELECT query_id, session_id, sum(idf)::BIGINT AS score FROM pfx JOIN si USING (itemid) JOIN idf USING (itemid) GROUP BY ALL),
near AS (SELECT query_id, session_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, session_end DESC, session_id)::INT AS rank, score FROM nn JOIN se USING (session_id) QUALIFY rank <= 20)"""


#: When an item starts and ceases to be a candidate.
_CHANGES = """tl AS (SELECT itemid, known_at AS t FROM items UNION SELECT itemid, timestamp FROM props WHERE property = 'available'),
el AS (SELECT tl.itemid, tl.t, coalesce(p.value = 1, true) AS el FROM tl ASOF LEFT JOIN (SELECT * FROM props WHERE property = 'available') p ON p.itemid = tl.itemid AND tl.t >= p.timestamp),
chg AS (SELECT * FROM el QUALIFY el <> coalesce(lag(el) OVER (PARTITION BY itemid ORDER BY t), false))"""
#: The 20 most popular candidates of each query time, by trying all items.
_POPULAR_AT = """pr AS (SELECT itemid, count(*) AS n FROM train GROUP BY 1), qt AS (SELECT DISTINCT query_time AS t FROM q),
can AS (SELECT qt.t, pr.itemid, n, p.value AS av FROM qt JOIN (pr JOIN items USING (itemid)) ON known_at <= qt.t
  ASOF LEFT JOIN (SELECT * FROM props WHERE property = 'available') p ON p.itemid = pr.itemid AND qt.t >= p.timestamp),
pop AS (SELECT query_id, itemid, rank FROM q JOIN (SELECT t, itemid, row_number() OVER (PARTITION BY t ORDER BY n DESC, itemid)::INT AS rank FROM can WHERE coalesce(av = 1, true) QUALIFY rank <= 20) c ON c.t = q.query_time)"""


def _best(scores: str) -> str:
    return f"SELECT query_id, itemid, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, itemid)::INT AS rank, score FROM ({scores}) QUALIFY rank <= 20"


_ITEM_RANKED = _best("SELECT query_id, neighbour AS itemid, sum(round(similarity * 1000000)::BIGINT)::BIGINT AS score FROM pfx JOIN knn USING (itemid) GROUP BY ALL")
_SESSION_RANKED = _best("SELECT query_id, itemid, sum(score)::BIGINT AS score FROM near JOIN si USING (session_id) GROUP BY ALL")


_SQL: dict[str, str | tuple[str, str]] = {
    "read_events": "SELECT * FROM raw",
    "dedup_events": "SELECT * FROM clean",
    "event_time": "SELECT event_id, epoch_ms(timestamp) AS event_time FROM clean",
    "sessionize": "SELECT event_id, visitorid, session_id FROM ses",
    "event_order": "SELECT event_id, session_id, event_order FROM ses",
    "time_cutoffs": "SELECT * FROM ends",
    "session_bounds": "SELECT session_id, lo AS first_time, hi AS last_time FROM b",
    "temporal_split": "SELECT event_id, session_id, split FROM ev",
    "timestamp_groups": "SELECT visitorid, session_id, query_time, split, n_events FROM grp",
    "query_ids": "SELECT query_id, session_id, query_time FROM grp",
    "nextstep_queries": "SELECT query_id, visitorid, session_id, split, query_time, target_time, prefix_groups, prefix_events FROM q",
    "excluded_steps": "SELECT query_id, session_id, query_time, CASE WHEN split = 'boundary_drop' THEN 'boundary_session' ELSE 'no_next_group' END AS reason FROM grp WHERE target_time IS NULL OR split = 'boundary_drop'",
    "nextstep_targets": "SELECT query_id, itemid, target_events, target_time, split FROM tgt",
    "target_count": "SELECT query_id, count(itemid) AS target_count FROM q LEFT JOIN tgt USING (query_id) GROUP BY 1",
    "repeat_targets": "SELECT query_id, itemid, f AS first_seen FROM tgt JOIN (SELECT session_id, itemid, min(timestamp) AS f FROM ev GROUP BY ALL) USING (session_id, itemid) WHERE f <= query_time",
    "prefix_features": "SELECT query_id, visitorid, session_id, query_time, prefix_groups, prefix_events, query_time AS history_last_time, view_count, addtocart_count, transaction_count, view_last_time, addtocart_last_time, transaction_last_time, view_recency, addtocart_recency, transaction_recency, view_recency IS NOT NULL AS has_view, addtocart_recency IS NOT NULL AS has_addtocart, transaction_recency IS NOT NULL AS has_transaction FROM q",
    "prefix_history": "SELECT query_id, event_id, itemid, event FROM q JOIN ev ON ev.session_id = q.session_id AND ev.timestamp <= q.query_time",
    "property_history": "SELECT *, lead(timestamp) OVER (PARTITION BY itemid, property ORDER BY timestamp) AS valid_to FROM props",
    "category_tree": "SELECT * FROM tree",
    "item_catalog": "SELECT * FROM items",
    "seen_in_train": "SELECT *, itemid IN (SELECT itemid FROM train) AS seen_in_train FROM items",
    "target_metadata": ("SELECT * FROM meta", _TARGET_META),
    "eligible_target_count": ("SELECT query_id, count(*) FILTER (candidate) AS eligible_target_count FROM q LEFT JOIN meta USING (query_id) GROUP BY 1", _TARGET_META),
    "metadata_at_event": ("SELECT event, count(*) AS events, count(*) FILTER (available IS NULL) AS unknown, count(*) FILTER (available = 0) AS unavailable, count(*) FILTER (available = 1) AS available, count(*) FILTER (category_missing) AS no_category, count(*) FILTER (category_invalid) AS bad_category FROM meta GROUP BY 1", _EVENT_META),
    "top_categories": ("SELECT category_id, count(*) AS events, count(DISTINCT itemid) AS items, count(*) FILTER (event = 'transaction') AS purchases FROM meta GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30", _EVENT_META),
    "train_snapshot": ("SELECT *, itemid IN (SELECT itemid FROM train) AS seen_in_train FROM meta", _SNAPSHOT),
    "snapshot_unknown_rates": ("SELECT count(*) AS items, round(100 * avg((category_id = -1)::INT), 6) AS category_unknown_pct, round(100 * avg(availability_unknown::INT), 6) AS availability_unknown_pct FROM meta WHERE itemid IN (SELECT itemid FROM train)", _SNAPSHOT),
    "candidates_at_time": ("SELECT t, itemid, known_at, available, category_id, itemid IN (SELECT itemid FROM train) AS warm FROM meta WHERE candidate", _AT_ENDS),
    "warm_candidates": ("SELECT t, itemid, available, root_id FROM meta WHERE candidate AND itemid IN (SELECT itemid FROM train)", _AT_ENDS),
    "user_mapping": "SELECT visitorid, CAST(row_number() OVER (ORDER BY visitorid) + 1 AS INT) AS visitorid_idx FROM (SELECT DISTINCT visitorid FROM train)",
    "item_mapping": "SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) + 1 AS INT) AS itemid_idx FROM (SELECT DISTINCT itemid FROM train)",
    "behavior_edges": "SELECT visitorid, itemid, event, count(*) AS n, max(timestamp) AS last_time FROM train GROUP BY ALL",
    "interactions": "SELECT visitorid, itemid, v AS view_count, a AS addtocart_count, t AS transaction_count, tv AS view_last_time, ta AS addtocart_last_time, tt AS transaction_last_time, last_time, round(ln(1 + v) + 3 * ln(1 + a) + 5 * ln(1 + t), 6) AS score, "
    "round((train_end - tv) / 3600000, 6) AS view_recency_hours, round((train_end - ta) / 3600000, 6) AS addtocart_recency_hours, round((train_end - tt) / 3600000, 6) AS transaction_recency_hours, "
    "CAST(dense_rank() OVER (ORDER BY visitorid) + 1 AS INT) AS visitorid_idx, CAST(dense_rank() OVER (ORDER BY itemid) + 1 AS INT) AS itemid_idx "
    "FROM (SELECT visitorid, itemid, count(*) FILTER (event = 'view') AS v, count(*) FILTER (event = 'addtocart') AS a, count(*) FILTER (event = 'transaction') AS t, "
    "max(timestamp) FILTER (event = 'view') AS tv, max(timestamp) FILTER (event = 'addtocart') AS ta, max(timestamp) FILTER (event = 'transaction') AS tt, max(timestamp) AS last_time FROM train GROUP BY ALL), ends",
    "reserved_index": "SELECT query_id, itemid, coalesce(i, 1) AS item_idx, i IS NULL AS cold_item FROM tgt LEFT JOIN (SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) + 1 AS INT) AS i FROM (SELECT DISTINCT itemid FROM train)) USING (itemid)",
    "cold_flags": "SELECT query_id, visitorid NOT IN (SELECT visitorid FROM train) AS cold_user FROM q",
    "split_summary": (_SPLIT_SUMMARY, _TARGET_META),
    "prefix_length_stats": "SELECT * FROM (SELECT split, min(prefix_groups) AS min, quantile_cont(prefix_groups::DOUBLE, 0.5) AS median, round(quantile_cont(prefix_groups::DOUBLE, 0.95), 6) AS p95, max(prefix_groups) AS max FROM q GROUP BY 1) JOIN (SELECT split, count(*) FILTER (n > 1) AS multi_target_queries FROM (SELECT split, query_id, count(*) AS n FROM tgt GROUP BY ALL) GROUP BY 1) USING (split)",
    "single_group_sessions": "SELECT count(*) FILTER (k = 1) AS single, count(*) AS sessions, round(100 * avg((k = 1)::INT), 6) AS pct FROM (SELECT session_id, count(*) AS k FROM grp GROUP BY 1)",
    "raw_profile": "SELECT count(*) AS row_count, count(*) - count(timestamp) AS null_timestamp, count(*) - count(visitorid) AS null_visitorid, count(*) - count(event) AS null_event, count(*) - count(itemid) AS null_itemid, count(*) - count(transactionid) AS null_transactionid, count(DISTINCT visitorid) AS users, count(DISTINCT itemid) AS items, count(DISTINCT transactionid) AS orders, min(timestamp) AS first_time, max(timestamp) AS last_time, count(*) FILTER (event NOT IN ('view', 'addtocart', 'transaction')) AS invalid, count(*) - (SELECT count(*) FROM (SELECT DISTINCT timestamp, visitorid, event, itemid, transactionid FROM raw)) AS duplicates, count(*) FILTER (timestamp < 0 OR visitorid < 0 OR itemid < 0 OR transactionid < 0) AS negative FROM raw",
    "behavior_counts": "SELECT a.event, raw, clean, users, items, raw - clean AS duplicates, round(100 * clean / sum(clean) OVER (), 6) AS clean_pct FROM (SELECT event, count(*) AS raw FROM raw GROUP BY 1) a JOIN (SELECT event, count(*) AS clean, count(DISTINCT visitorid) AS users, count(DISTINCT itemid) AS items FROM clean GROUP BY 1) c USING (event)",
    "split_counts": "SELECT split, count(*) AS events FROM ev GROUP BY 1",
    "user_stats": (_stats("u", "events", "items", "active_days", "orders", "span_ms"), "u AS (SELECT visitorid, count(*) AS events, count(DISTINCT itemid) AS items, count(DISTINCT timestamp // 86400000) AS active_days, count(DISTINCT transactionid) AS orders, max(timestamp) - min(timestamp) AS span_ms FROM clean GROUP BY 1)"),
    "item_stats": (_stats("u", "events", "users", "purchases", "active_days"), "u AS (SELECT itemid, count(*) AS events, count(DISTINCT visitorid) AS users, count(*) FILTER (event = 'transaction') AS purchases, count(DISTINCT timestamp // 86400000) AS active_days FROM clean GROUP BY 1)"),
    "pair_stats": (_stats("u", "events", "views", "carts", "purchases"), "u AS (SELECT visitorid, itemid, count(*) AS events, count(*) FILTER (event = 'view') AS views, count(*) FILTER (event = 'addtocart') AS carts, count(*) FILTER (event = 'transaction') AS purchases FROM clean GROUP BY ALL)"),
    "session_stats": (_stats("u", "events", "items", "one_event", "one_item", "has_purchase", "duration_ms") + " UNION ALL " + _stats("us", "sessions_per_user"), "u AS (SELECT visitorid, session_id, count(*) AS events, count(DISTINCT itemid) AS items, max(timestamp) - min(timestamp) AS duration_ms, (count(*) = 1)::INT AS one_event, (count(DISTINCT itemid) = 1)::INT AS one_item, max((event = 'transaction')::INT) AS has_purchase FROM ses GROUP BY ALL), us AS (SELECT count(*) AS sessions_per_user FROM u GROUP BY visitorid)"),
    "sparsity": "SELECT *, round(100 * pairs / (users * items), 6) AS density_pct FROM (SELECT count(*) AS users, count(*) FILTER (k = 1) AS one_item_users, round(100 * avg((k = 1)::INT), 6) AS one_item_users_pct, round(100 * avg((n = 1)::INT), 6) AS one_event_users_pct, sum(b)::BIGINT AS buyers FROM (SELECT visitorid, count(DISTINCT itemid) AS k, count(*) AS n, max((event = 'transaction')::INT) AS b FROM clean GROUP BY 1)), (SELECT count(*) AS items, count(*) FILTER (k = 1) AS one_user_items, round(100 * avg((k = 1)::INT), 6) AS one_user_items_pct, sum(k)::BIGINT AS pairs, sum(b)::BIGINT AS purchased_items FROM (SELECT itemid, count(DISTINCT visitorid) AS k, max((event = 'transaction')::INT) AS b FROM clean GROUP BY 1))",
    "concentration": ("SELECT measure, count(*) AS entities, round(100 * sum(x) FILTER (d <= ceil(n / 100)) / sum(x), 6) AS top_1pct_share_pct, round(100 * sum(x) FILTER (d <= ceil(n * 10 / 100)) / sum(x), 6) AS top_10pct_share_pct, round(2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1) / count(*), 6) AS gini FROM (SELECT *, row_number() OVER (PARTITION BY measure ORDER BY x) AS i, row_number() OVER (PARTITION BY measure ORDER BY x DESC) AS d, count(*) OVER (PARTITION BY measure) AS n FROM per) GROUP BY 1", "per AS (" + " UNION ALL ".join(f"SELECT '{n}_{c}' AS measure, {x} AS x FROM clean GROUP BY {k}" for n, k in (("users", "visitorid"), ("items", "itemid")) for c, x in (("events", "count(*)"), ("purchases", "count(*) FILTER (event = 'transaction')"))) + ")"),
    "daily_activity": f"SELECT *, row_number() OVER (ORDER BY events DESC, day) = 1 AS busiest, row_number() OVER (ORDER BY events, day) = 1 AS quietest FROM (SELECT {_DAY}::VARCHAR AS day, count(*) AS events, count(DISTINCT visitorid) AS users, count(*) FILTER (event = 'view') AS views, count(*) FILTER (event = 'addtocart') AS addtocarts, count(*) FILTER (event = 'transaction') AS transactions FROM clean GROUP BY 1)",
    "zero_event_days": f"SELECT CAST(d AS DATE)::VARCHAR AS day FROM (SELECT unnest(generate_series(min({_DAY})::TIMESTAMP, max({_DAY})::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM clean) WHERE CAST(d AS DATE) NOT IN (SELECT {_DAY} FROM clean)",
    "hour_weekday_activity": f"SELECT CAST(isodow({_DAY}) AS INT) AS weekday, CAST(timestamp // 3600000 % 24 AS INT) AS hour, count(*) AS events, count(*) FILTER (event = 'transaction') AS purchases FROM clean GROUP BY ALL",
    "simultaneous_events": "SELECT count(*) AS buckets, count(*) FILTER (n > 1) AS several_events, count(*) FILTER (i > 1) AS several_items, count(*) FILTER (e > 1) AS several_behaviours FROM (SELECT count(*) AS n, count(DISTINCT itemid) AS i, count(DISTINCT event) AS e FROM clean GROUP BY visitorid, timestamp)",
    "session_size_distribution": "SELECT events, count(*) AS sessions FROM (SELECT count(*) AS events FROM ses GROUP BY session_id) GROUP BY 1",
    "order_stats": (_stats("u", "lines", "items", "users", "shared", "span_ms"), "u AS (SELECT count(*) AS lines, count(DISTINCT itemid) AS items, count(DISTINCT visitorid) AS users, (count(DISTINCT visitorid) > 1)::INT AS shared, max(timestamp) - min(timestamp) AS span_ms FROM clean WHERE transactionid IS NOT NULL GROUP BY transactionid)"),
    "basket_size_distribution": "SELECT items, count(*) AS orders FROM (SELECT count(DISTINCT itemid) AS items FROM clean WHERE transactionid IS NOT NULL GROUP BY transactionid) GROUP BY 1",
    "purchase_prior_history": ("SELECT coalesce(v < timestamp, false) AS viewed, coalesce(c < timestamp, false) AS carted, count(*) AS purchases, count(*) FILTER (p < timestamp) AS bought_before, count(*) FILTER (v = timestamp) AS first_view_same_time, count(*) FILTER (c = timestamp) AS first_cart_same_time, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM pp GROUP BY 1, 2", _PURCHASES),
    "purchase_delay": ("SELECT 'view' AS since, count(*) AS purchases, round(quantile_cont((timestamp - v)::DOUBLE, 0.5) / 3600000, 6) AS median_hours FROM pp WHERE v < timestamp UNION ALL SELECT 'addtocart', count(*), round(quantile_cont((timestamp - c)::DOUBLE, 0.5) / 3600000, 6) FROM pp WHERE c < timestamp", _PURCHASES),
    "property_changes": "SELECT property, count(*) AS updates, count(DISTINCT itemid) AS items, count(*) FILTER (before <> value) AS changed, count(*) FILTER (before = value) AS repeated FROM (SELECT *, lag(value) OVER (PARTITION BY itemid, property ORDER BY timestamp) AS before FROM props) GROUP BY 1",
    "event_property_overlap": "SELECT count(*) FILTER (e AND p) AS both_tables, count(*) FILTER (e AND NOT p) AS events_only, count(*) FILTER (p AND NOT e) AS properties_only, (SELECT count(*) FROM clean WHERE itemid IN (SELECT itemid FROM props)) AS event_rows_with_property, (SELECT count(*) FROM clean c JOIN (SELECT itemid, min(timestamp) AS f FROM props GROUP BY 1) USING (itemid) WHERE f <= timestamp) AS event_rows_with_property_by_then FROM (SELECT itemid, itemid IN (SELECT itemid FROM clean) AS e, itemid IN (SELECT itemid FROM props) AS p FROM items)",
    "category_shape": "SELECT 'depth_' || depth AS name, count(*) AS value FROM tree GROUP BY depth UNION ALL SELECT 'categories', count(*) FROM tree UNION ALL SELECT 'roots', count(*) FROM tree WHERE depth = 0 UNION ALL SELECT 'max_depth', max(depth) FROM tree UNION ALL SELECT 'invalid_paths', 0 UNION ALL SELECT 'leaves', count(*) FROM tree WHERE categoryid NOT IN (SELECT parentid FROM traw WHERE parentid IS NOT NULL) UNION ALL SELECT 'duplicate_ids', count(*) - count(DISTINCT categoryid) FROM traw",
    "top_users": "SELECT visitorid, count(*) AS events, count(DISTINCT itemid) AS others, count(*) FILTER (event = 'view') AS views, count(*) FILTER (event = 'addtocart') AS addtocarts, count(*) FILTER (event = 'transaction') AS transactions, count(DISTINCT transactionid) AS orders, count(DISTINCT timestamp // 86400000) AS active_days, min(timestamp) AS first_time, max(timestamp) AS last_time, round((max(timestamp) - min(timestamp)) / 86400000, 6) AS span_days FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "top_items": "SELECT itemid, count(*) AS events, count(DISTINCT visitorid) AS others, count(*) FILTER (event = 'view') AS views, count(*) FILTER (event = 'addtocart') AS addtocarts, count(*) FILTER (event = 'transaction') AS transactions, count(DISTINCT transactionid) AS orders, count(DISTINCT timestamp // 86400000) AS active_days, min(timestamp) AS first_time, max(timestamp) AS last_time, round((max(timestamp) - min(timestamp)) / 86400000, 6) AS span_days FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "new_users_by_day": f"SELECT day::VARCHAR AS day, count(*) AS users FROM (SELECT min({_DAY}) AS day FROM clean GROUP BY visitorid) GROUP BY 1",
    "behavior_combinations": " UNION ALL ".join(f"SELECT '{n}' AS kind, view, addtocart, transaction, count(*) AS entities, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM (SELECT bool_or(event = 'view') AS view, bool_or(event = 'addtocart') AS addtocart, bool_or(event = 'transaction') AS transaction FROM clean GROUP BY {k}) GROUP BY view, addtocart, transaction" for n, k in (("users", "visitorid"), ("items", "itemid"), ("pairs", "visitorid, itemid"))),
    "degree_distribution": "SELECT 'users' AS kind, degree, count(*) AS entities FROM (SELECT count(DISTINCT itemid) AS degree FROM clean GROUP BY visitorid) GROUP BY 2 UNION ALL SELECT 'items', degree, count(*) FROM (SELECT count(DISTINCT visitorid) AS degree FROM clean GROUP BY itemid) GROUP BY 2",
}

def _report(**bad: str) -> str:
    """Rows (check, violations); each value is a select of bad rows."""
    return " UNION ALL ".join(f"""SELECT '{n}' AS "check", (SELECT count(*) FROM ({q})) AS violations""" for n, q in bad.items())


def _print(name: str, table: str, columns: str) -> str:
    row = " || '|' || ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in sorted(columns.split()))
    return f"SELECT '{name}' AS name, count(*) AS row_count, CAST(coalesce(sum(('0x' || substr(md5({row}), 1, 15))::BIGINT::HUGEINT), 0) AS VARCHAR) AS fingerprint FROM {table}"


_TABLES = {
    "events": ("ev", "event_id timestamp visitorid event itemid transactionid session_id event_order split"),
    "queries": ("q", "query_id visitorid session_id query_time target_time split"),
    "targets": ("tgt", "query_id itemid target_events query_time target_time split"),
    "properties": ("props", "itemid property timestamp value"),
    "category_tree": ("tree", "categoryid root_id depth path"),
    "items": ("items", "itemid known_at"),
}

_MAPS = """um AS (SELECT visitorid, row_number() OVER (ORDER BY visitorid) + 1 AS i FROM (SELECT DISTINCT visitorid FROM train)),
im AS (SELECT itemid, row_number() OVER (ORDER BY itemid) + 1 AS i FROM (SELECT DISTINCT itemid FROM train))"""

_LIMITS = """ti AS (SELECT itemid, known_at, row_number() OVER (ORDER BY known_at, itemid) - 1 AS rank FROM items WHERE itemid IN (SELECT itemid FROM train)),
lim AS (SELECT query_id, query_time, "limit" FROM q JOIN (SELECT t, (SELECT count(*) FROM ti WHERE known_at <= t) AS "limit" FROM (SELECT DISTINCT query_time AS t FROM q)) ON t = query_time WHERE split = 'train')"""

def _negatives(k: int) -> str:
    """Places drawn one by one: draw d counts the places that no draw before has taken."""
    return (
        _LIMITS
        + ", "
        + _meta('SELECT DISTINCT itemid, query_time FROM lim JOIN ti ON rank < "limit"', "query_time", "m2.itemid, m2.query_time")
        + f""", ok AS (SELECT query_time, itemid, row_number() OVER (PARTITION BY query_time ORDER BY rank) - 1 AS place, count(*) OVER (PARTITION BY query_time) AS n FROM meta JOIN ti USING (itemid) WHERE candidate),
sz AS (SELECT query_id, query_time, n, least(n, {k} + coalesce(m, 0)) AS c FROM lim JOIN (SELECT DISTINCT query_time, n FROM ok) USING (query_time) LEFT JOIN (SELECT query_id, count(*) AS m FROM tgt GROUP BY 1) USING (query_id)),
dr AS (SELECT query_id, query_time, n, c, 0 AS d, []::BIGINT[] AS taken FROM sz
  UNION ALL SELECT query_id, query_time, n, c, d + 1, list_append(taken, list_reduce(list_prepend((('0x' || substr(md5('7:' || query_id || ':' || d), 1, 15))::BIGINT % (n - d))::BIGINT, list_sort(taken)), lambda r, x: CASE WHEN r >= x THEN r + 1 ELSE r END)) FROM dr WHERE d < c),
pk AS (SELECT query_id, query_time, c = n AS filled, unnest(taken) AS place, unnest(range(c)) AS d FROM dr WHERE d = c),
neg AS (SELECT query_id, itemid, filled FROM pk JOIN ok USING (query_time, place) ANTI JOIN tgt USING (query_id, itemid) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d) <= {k}),
fill AS (SELECT query_id, itemid FROM neg WHERE filled)"""
    )


_NEGATIVES = _negatives(5)

_NEXT = """nx AS (SELECT *, lead(timestamp) OVER (PARTITION BY session_id ORDER BY timestamp) AS later FROM (SELECT DISTINCT session_id, timestamp FROM ev WHERE split <> 'boundary_drop')),
again AS (SELECT DISTINCT query_id, ev.itemid FROM q JOIN nx ON nx.session_id = q.session_id AND nx.timestamp = query_time JOIN ev ON ev.session_id = q.session_id AND ev.timestamp = later)"""

_POPULAR = "top AS (SELECT itemid, count(*) AS events, CAST(row_number() OVER (ORDER BY count(*) DESC, itemid) AS INT) AS rank FROM train GROUP BY 1 QUALIFY rank <= 20)"

_PREFIX = """pre AS (SELECT query_id, count(*) AS n, count(*) FILTER (event = 'view') AS v, count(*) FILTER (event = 'addtocart') AS a, count(*) FILTER (event = 'transaction') AS t,
  (query_time - max(timestamp) FILTER (event = 'view')) / 1000 AS rv, (query_time - max(timestamp) FILTER (event = 'addtocart')) / 1000 AS ra, (query_time - max(timestamp) FILTER (event = 'transaction')) / 1000 AS rt
  FROM q JOIN ev ON ev.session_id = q.session_id AND ev.timestamp <= q.query_time GROUP BY query_id, query_time),
qp AS (SELECT * FROM q LEFT JOIN pre USING (query_id))"""

_SQL |= {
    "read_events_csv": "SELECT * FROM raw",
    "event_row_id": "SELECT * EXCLUDE (event_id), row_number() OVER (ORDER BY timestamp, visitorid, event, itemid, transactionid NULLS FIRST) - 1 AS event_id FROM clean",
    "reject_bad_events": "SELECT event, count(*) AS events, count(transactionid) AS with_id FROM clean GROUP BY 1",
    "require_columns": "SELECT count(timestamp) AS timestamp, count(visitorid) AS visitorid, count(event) AS event, count(itemid) AS itemid, count(transactionid) AS transactionid FROM raw",
    "property_filter": ("SELECT * FROM rf", _UPDATES),
    "property_conflicts": ("SELECT * FROM rc", _UPDATES),
    "property_cast": ("SELECT itemid, property, timestamp, CAST(CAST(value AS DOUBLE) AS BIGINT) AS value FROM rf ANTI JOIN rc USING (itemid, property, timestamp)", _UPDATES),
    "publish_guard": "SELECT (SELECT count(*) FROM items) AS items, (SELECT count(*) FROM tree) AS categories, true AS refused_before",
    "read_properties": "SELECT * FROM props",
    "property_files": "SELECT 'part=' || (itemid % 2 + 1) AS source, count(*) AS row_count, count(DISTINCT itemid) AS items, count(DISTINCT property) AS properties FROM props GROUP BY 1",
    "read_category_tree": "SELECT * FROM traw",
    "write_splits": "SELECT split, queries, pairs FROM (SELECT split, count(*) AS queries FROM q GROUP BY 1) JOIN (SELECT split, count(*) AS pairs FROM tgt GROUP BY 1) USING (split)",
    "table_manifest": " UNION ALL ".join(_print(n, *x) for n, x in _TABLES.items()),
    "verify_manifest": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS stored_rows, count(*) AS found_rows, true AS same FROM {x[0]}" for n, x in _TABLES.items()),
    "known_item_limit": ('SELECT query_id, "limit" FROM lim', _LIMITS),
    "train_negatives": ("SELECT query_id, itemid FROM neg", _NEGATIVES),
    "negative_fill": ("SELECT query_id, itemid FROM fill", _negatives(45)),
    "negative_shortfall": ("SELECT count(*) AS train_queries, count(*) FILTER (n < 5) AS short_queries, sum(5 - n)::BIGINT AS missing FROM (SELECT query_id, count(itemid) AS n FROM q LEFT JOIN neg USING (query_id) WHERE split = 'train' GROUP BY 1)", _NEGATIVES),
    "dq_events": _report(
        duplicate_events="SELECT 1 FROM ev GROUP BY timestamp, visitorid, event, itemid, transactionid HAVING count(*) > 1",
        null_required="SELECT 1 FROM ev WHERE timestamp IS NULL OR visitorid IS NULL OR event IS NULL OR itemid IS NULL",
        transaction_without_id="SELECT 1 FROM ev WHERE event = 'transaction' AND transactionid IS NULL",
        invalid_event="SELECT 1 FROM ev WHERE event NOT IN ('view', 'addtocart', 'transaction')",
        session_in_splits="SELECT 1 FROM ev GROUP BY session_id HAVING count(DISTINCT split) > 1",
    ),
    "dq_queries": _report(
        duplicate_query="SELECT 1 FROM q GROUP BY query_id HAVING count(*) > 1",
        duplicate_session_time="SELECT 1 FROM q GROUP BY session_id, query_time HAVING count(*) > 1",
        query_without_targets="SELECT 1 FROM q WHERE query_id NOT IN (SELECT query_id FROM tgt)",
        target_not_later="SELECT 1 FROM q WHERE target_time <= query_time",
        target_after_split_end="SELECT 1 FROM q, ends WHERE target_time > CASE split WHEN 'train' THEN train_end WHEN 'validation' THEN validation_end ELSE observation_end END",
        boundary_query="SELECT 1 FROM q WHERE split = 'boundary_drop'",
    ),
    "dq_targets": _report(
        duplicate_pair="SELECT 1 FROM tgt GROUP BY query_id, itemid HAVING count(*) > 1",
        target_without_query="SELECT 1 FROM tgt WHERE query_id NOT IN (SELECT query_id FROM q)",
        other_target_time="SELECT 1 FROM tgt JOIN q USING (query_id) WHERE tgt.target_time <> q.target_time",
        count_mismatch="SELECT 1 FROM (SELECT session_id, target_time, sum(target_events) AS s FROM tgt GROUP BY ALL) x LEFT JOIN grp ON grp.session_id = x.session_id AND grp.query_time = x.target_time WHERE s IS DISTINCT FROM n_events",
    ),
    "dq_next_group": (
        _report(
            wrong_next_time="SELECT 1 FROM nx JOIN q ON q.session_id = nx.session_id AND q.query_time = nx.timestamp WHERE later <> target_time",
            step_without_query="SELECT 1 FROM nx WHERE later IS NOT NULL AND NOT EXISTS (SELECT 1 FROM q WHERE q.session_id = nx.session_id AND q.query_time = nx.timestamp)",
            query_without_step="SELECT 1 FROM q WHERE NOT EXISTS (SELECT 1 FROM nx WHERE q.session_id = nx.session_id AND q.query_time = nx.timestamp AND later IS NOT NULL)",
        ),
        _NEXT,
    ),
    "dq_target_sets": (
        _report(missing_target="SELECT * FROM again ANTI JOIN tgt USING (query_id, itemid)", unexpected_target="SELECT query_id, itemid FROM tgt ANTI JOIN again USING (query_id, itemid)"),
        _NEXT,
    ),
    "dq_features": (
        _report(
            history_in_future="SELECT 1 FROM q WHERE view_last_time > query_time OR addtocart_last_time > query_time OR transaction_last_time > query_time",
            recency_in_future="SELECT 1 FROM q WHERE view_recency < 0 OR addtocart_recency < 0 OR transaction_recency < 0",
            query_without_features="SELECT 1 FROM nx WHERE later IS NOT NULL AND NOT EXISTS (SELECT 1 FROM q WHERE q.session_id = nx.session_id AND q.query_time = nx.timestamp)",
            features_without_query="SELECT 1 FROM q WHERE NOT EXISTS (SELECT 1 FROM nx WHERE q.session_id = nx.session_id AND q.query_time = nx.timestamp AND later IS NOT NULL)",
            label_columns="SELECT 1 FROM q WHERE false",
        ),
        _NEXT,
    ),
    "dq_prefix_recompute": (
        _report(
            prefix_events="SELECT 1 FROM qp WHERE prefix_events IS DISTINCT FROM n",
            view_count="SELECT 1 FROM qp WHERE view_count IS DISTINCT FROM v",
            addtocart_count="SELECT 1 FROM qp WHERE addtocart_count IS DISTINCT FROM a",
            transaction_count="SELECT 1 FROM qp WHERE transaction_count IS DISTINCT FROM t",
            view_recency="SELECT 1 FROM qp WHERE view_recency IS DISTINCT FROM rv",
            addtocart_recency="SELECT 1 FROM qp WHERE addtocart_recency IS DISTINCT FROM ra",
            transaction_recency="SELECT 1 FROM qp WHERE transaction_recency IS DISTINCT FROM rt",
        ),
        _PREFIX,
    ),
    "dq_mappings": (
        _report(
            **{
                name.format(k): sql.format(k=k, m=mp)
                for k, mp in (("visitorid", "um"), ("itemid", "im"))
                for name, sql in (
                    ("{}_index_not_dense", "SELECT count(*) AS n FROM {m} HAVING n > 0 AND NOT (min(i) = 2 AND max(i) = n + 1 AND count(DISTINCT i) = n)"),
                    ("{}_unmapped", "SELECT DISTINCT {k} FROM train WHERE {k} NOT IN (SELECT {k} FROM {m})"),
                    ("{}_not_in_train", "SELECT 1 FROM {m} WHERE {k} NOT IN (SELECT {k} FROM train)"),
                )
            }
        ),
        _MAPS,
    ),
    "dq_interactions": (
        _report(
            duplicate_interaction="SELECT 1 FROM ia GROUP BY visitorid, itemid HAVING count(*) > 1",
            **{f"{b}_total_differs": f"SELECT sum(n_{b}) AS s FROM ia HAVING s <> (SELECT count(*) FROM train WHERE event = '{b}')" for b in ("view", "addtocart", "transaction")},
        ),
        "ia AS (SELECT visitorid, itemid, " + ", ".join(f"count(*) FILTER (event = '{b}') AS n_{b}" for b in ("view", "addtocart", "transaction")) + " FROM train GROUP BY ALL)",
    ),
    "dq_properties": _report(duplicate_property="SELECT 1 FROM props GROUP BY itemid, property, timestamp HAVING count(*) > 1"),
    "dq_metadata": (
        _report(
            availability_from_future="SELECT 1 FROM au WHERE available_time > query_time",
            category_from_future="SELECT 1 FROM au WHERE category_time > query_time",
            other_availability="SELECT 1 FROM au WHERE available IS DISTINCT FROM a.value OR available_time IS DISTINCT FROM a.timestamp OR availability_unknown <> (a.value IS NULL)",
            other_category="SELECT 1 FROM au WHERE category_time IS DISTINCT FROM c.timestamp OR category_missing <> (c.value IS NULL) OR (NOT category_missing AND NOT category_invalid AND category_id <> c.value)",
            other_candidate="SELECT 1 FROM au JOIN items USING (itemid) WHERE candidate <> (items.known_at <= query_time AND coalesce(a.value = 1, true))",
        ),
        _TARGET_META
        + """, au AS (SELECT meta.*, (SELECT max(struct_pack(timestamp := p.timestamp, value := p.value)) FROM pa p WHERE p.itemid = meta.itemid AND p.timestamp <= query_time) AS a,
  (SELECT max(struct_pack(timestamp := p.timestamp, value := p.value)) FROM pc p WHERE p.itemid = meta.itemid AND p.timestamp <= query_time) AS c FROM meta)""",
    ),
    "dq_negatives": (
        _report(
            negative_is_target="SELECT 1 FROM neg JOIN tgt USING (query_id, itemid)",
            not_a_train_query="SELECT 1 FROM neg WHERE query_id NOT IN (SELECT query_id FROM q WHERE split = 'train')",
            duplicate_negative="SELECT 1 FROM neg GROUP BY query_id, itemid HAVING count(*) > 1",
            not_in_vocabulary="SELECT 1 FROM neg WHERE itemid NOT IN (SELECT itemid FROM train)",
            not_eligible="SELECT 1 FROM neg JOIN q USING (query_id) ANTI JOIN ok ON ok.itemid = neg.itemid AND ok.query_time = q.query_time",
        ),
        _NEGATIVES,
    ),
    "dataset_summary": ("""SELECT 'raw_events' AS name, count(*) AS value FROM raw UNION ALL SELECT 'clean_events', count(*) FROM ev UNION ALL SELECT 'sessions', count(DISTINCT session_id) FROM ev
UNION ALL SELECT 'removed_events', (SELECT count(*) FROM raw) - (SELECT count(*) FROM ev) UNION ALL SELECT 'user_mapping', count(DISTINCT visitorid) FROM train UNION ALL SELECT 'item_mapping', count(DISTINCT itemid) FROM train
UNION ALL SELECT 'repeat_target_pairs', count(*) FROM tgt JOIN (SELECT session_id, itemid, min(timestamp) AS f FROM ev GROUP BY ALL) USING (session_id, itemid) WHERE f <= query_time
UNION ALL SELECT 'train_end_items', count(*) FROM meta UNION ALL SELECT 'train_end_candidates', count(*) FROM meta WHERE candidate
UNION ALL SELECT 'timestamp_groups', count(*) FROM grp UNION ALL SELECT 'queries', count(*) FROM q UNION ALL SELECT 'target_pairs', count(*) FROM tgt
UNION ALL SELECT 'multi_target_queries', count(*) FROM (SELECT 1 FROM tgt GROUP BY query_id HAVING count(*) > 1) UNION ALL SELECT 'catalog_items', count(*) FROM items
UNION ALL SELECT 'property_rows', count(*) FROM props UNION ALL SELECT 'train_users', count(DISTINCT visitorid) FROM train UNION ALL SELECT 'train_items', count(DISTINCT itemid) FROM train
UNION ALL SELECT 'train_pairs', count(*) FROM (SELECT DISTINCT visitorid, itemid FROM train) UNION ALL SELECT 'events_' || event, count(*) FROM ev GROUP BY event
UNION ALL SELECT 'split_' || split, count(*) FROM ev GROUP BY split
UNION ALL SELECT 'excluded_' || CASE WHEN split = 'boundary_drop' THEN 'boundary_session' ELSE 'no_next_group' END AS r, count(*) FROM grp WHERE target_time IS NULL OR split = 'boundary_drop' GROUP BY r""", _SNAPSHOT),
    "property_quality": (
        "SELECT sum(n - dn)::BIGINT AS exact_duplicates, 0::BIGINT AS null_rows, sum(n)::BIGINT AS row_count, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys, count(*) FILTER (lo <> hi) AS conflicting_keys, min(timestamp) AS first_time, max(timestamp) AS last_time FROM pk",
        """pk AS (SELECT itemid, property, timestamp, count(*) AS n, count(DISTINCT value) AS dn, min(value) AS lo, max(value) AS hi FROM (
  SELECT itemid, 'available' AS property, timestamp, CASE WHEN event = 'signup' THEN 1 ELSE 0 END AS value FROM raw WHERE event IN ('signup', 'error') AND itemid % 10 <> 3
  UNION ALL SELECT itemid, 'categoryid', timestamp, event_id % 40 FROM raw WHERE event = 'signup' AND itemid % 10 <> 4) GROUP BY ALL)""",
    ),
    "property_per_item": (_stats("u", "updates", "properties") + " UNION ALL " + _stats("up", "updates_per_property"), "up AS (SELECT itemid, property, count(*) AS updates_per_property FROM props GROUP BY ALL), u AS (SELECT itemid, sum(updates_per_property)::BIGINT AS updates, count(*) AS properties FROM up GROUP BY 1)"),
    "user_cohorts": f"SELECT strftime(d, '%Y-%m') AS month, count(*) AS users, round(avg(events), 6) AS mean_events, round(100 * avg(buyer), 6) AS buyers_pct FROM (SELECT min({_DAY}) AS d, count(*) AS events, max((event = 'transaction')::INT) AS buyer FROM clean GROUP BY visitorid) GROUP BY 1",
    "popularity_topk": ("SELECT * FROM top", _POPULAR),
    "ranking_metrics": (
        """SELECT split, cutoff, count(*) AS queries, round(avg(h / n), 6) AS recall, round(avg((h > 0)::INT), 6) AS hit_rate, round(avg(coalesce(1 / f, 0)), 6) AS mrr,
  round(avg(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n, cutoff) + 1), lambda i: 1 / log2(i + 1)))), 6) AS ndcg
FROM (SELECT split, cutoff, query_id, count(*) AS n, count(place) AS h, min(place) AS f, sum(1 / log2(place + 1)) AS dcg
  FROM (SELECT split, query_id, cutoff, CASE WHEN rank <= cutoff THEN rank END AS place FROM tgt LEFT JOIN top USING (itemid), (SELECT unnest([10, 20]) AS cutoff)) GROUP BY ALL) GROUP BY ALL""",
        _POPULAR,
    ),
    "item_knn": ("SELECT * FROM knn", _item_knn("1")),
    "item_knn_weighted": ("SELECT * FROM knn", _item_knn("CASE event WHEN 'transaction' THEN 5 WHEN 'addtocart' THEN 3 ELSE 1 END")),
    "item_knn_ranked": (_ITEM_RANKED, _LATEST + ", " + _item_knn("1")),
    "session_knn": ("SELECT * FROM near", _SESSION_KNN),
    "session_knn_ranked": (_SESSION_RANKED, _SESSION_KNN),
    "eligibility_changes": ("SELECT itemid, t, el AS \"on\" FROM chg", _CHANGES),
    "popularity_candidates": ("SELECT query_id, itemid, rank FROM pop", f"{_CHANGES}, {_POPULAR_AT}"),
    "ranking_metrics_by_query": (
        f"""SELECT model, split, cutoff, count(*) AS queries, round(avg(h / n), 6) AS recall, round(avg((h > 0)::INT), 6) AS hit_rate, round(avg(coalesce(1 / f, 0)), 6) AS mrr,
  round(avg(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n, cutoff) + 1), lambda i: 1 / log2(i + 1)))), 6) AS ndcg
FROM (SELECT model, split, cutoff, query_id, count(*) AS n, count(place) AS h, min(place) AS f, sum(1 / log2(place + 1)) AS dcg
  FROM (SELECT m.model, tgt.split, tgt.query_id, cutoff, CASE WHEN rank <= cutoff THEN rank END AS place FROM tgt CROSS JOIN (SELECT unnest(['popularity', 'item_knn', 'session_knn']) AS model) m
    LEFT JOIN lists ON lists.model = m.model AND lists.query_id = tgt.query_id AND lists.itemid = tgt.itemid, (SELECT unnest([10, 20]) AS cutoff) WHERE tgt.split IN ('validation', 'test')) GROUP BY ALL) GROUP BY ALL""",
        f"""{_CHANGES}, {_POPULAR_AT}, {_SESSION_KNN}, {_item_knn("1", "sw")},
lists AS (SELECT 'popularity' AS model, query_id, itemid, rank FROM pop UNION ALL SELECT 'item_knn', query_id, itemid, rank FROM ({_ITEM_RANKED}) UNION ALL SELECT 'session_knn', query_id, itemid, rank FROM ({_SESSION_RANKED}))""",
    ),
    "prefix_ranges": "SELECT q.session_id, event_id, itemid, event, query_id AS first_query FROM q JOIN ev ON ev.session_id = q.session_id AND ev.timestamp = q.query_time",
    "bucketed_join": "SELECT query_id, q.query_time, q.split, count(*) AS targets, sum(target_events)::BIGINT AS events FROM q JOIN tgt USING (query_id) GROUP BY ALL",
    "verify_tampered": """SELECT 'properties' AS name, count(*) AS stored_rows, count(*) AS found_rows, count(*) FILTER (itemid % 97 = 1) = 0 AS same FROM props
  UNION ALL SELECT 'category_tree', count(*), count(*), true FROM tree UNION ALL SELECT 'items', count(*), count(*) FILTER (itemid % 97 <> 0), count(*) FILTER (itemid % 97 = 0) = 0 FROM items""",
    "refused_trees": "SELECT unnest(['whole', 'own parent', 'unknown parent', 'repeated', 'null id']) AS name, unnest([(SELECT count(*) FROM tree), NULL, NULL, NULL, NULL]) AS categories, unnest([false, true, true, true, true]) AS refused",
    "negative_summary": ("""SELECT 'negative_queries' AS name, count(DISTINCT query_id) AS value FROM neg UNION ALL SELECT 'negative_pairs', count(*) FROM neg UNION ALL SELECT 'negative_items', count(DISTINCT itemid) FROM neg
  UNION ALL SELECT 'queries_below_k', count(*) FILTER (n < 5) FROM (SELECT query_id, count(itemid) AS n FROM q LEFT JOIN neg USING (query_id) WHERE split = 'train' GROUP BY 1)""", _NEGATIVES),
    "session_knn_reads": (
        """SELECT set_id, count(*) AS lists, sum(df)::BIGINT AS entries,
  sum(CASE WHEN j <= coalesce(upto, k - 1) THEN df WHEN upto IS NULL AND j = k THEN least(df, 20) ELSE 0 END)::BIGINT AS read FROM mem LEFT JOIN fin USING (set_id) GROUP BY set_id""",
        _SESSION_KNN
        + """, known AS (SELECT query_id, itemid FROM pfx WHERE itemid IN (SELECT itemid FROM si)), sig AS (SELECT query_id, string_agg(itemid::VARCHAR, ',' ORDER BY itemid) AS s FROM known GROUP BY 1),
mem AS (SELECT set_id, itemid, df, idf, row_number() OVER (PARTITION BY set_id ORDER BY df, itemid) AS j, count(*) OVER (PARTITION BY set_id) AS k, sum(idf) OVER (PARTITION BY set_id ORDER BY df DESC, itemid DESC) - idf AS after
  FROM (SELECT min(query_id) AS set_id FROM sig GROUP BY s) JOIN known ON query_id = set_id JOIN idf USING (itemid) JOIN (SELECT itemid, count(*) AS df FROM si GROUP BY 1) USING (itemid)),
rnd AS (SELECT DISTINCT set_id, hi, least(hi, k - 1) AS at FROM mem, (SELECT unnest([1, 3, 7, 15, 31, 63, 127, 255]) AS hi) WHERE (hi + 1) // 2 <= k - 1),
best AS (SELECT set_id, hi, score FROM (SELECT r.set_id, hi, session_id, sum(idf) AS score FROM rnd r JOIN mem m ON m.set_id = r.set_id AND m.j <= r.at JOIN si USING (itemid) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY set_id, hi ORDER BY score DESC) = 20),
fin AS (SELECT r.set_id, min(r.at) AS upto FROM rnd r JOIN best USING (set_id, hi) JOIN mem m ON m.set_id = r.set_id AND m.j = r.at WHERE score > after GROUP BY 1)""",
    ),
}

ORACLE = {name: f"{_BASE}, {x[1]}\n{x[0]}" if isinstance(x, tuple) else f"{_BASE}\n{x}" for name, x in _SQL.items()}
