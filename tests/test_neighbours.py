"""Item and session neighbours against brute force, with a session and an item that hold a third of all rows."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.operators import neighbours as knn


def matrix_rows(rng, hot):
    rows = {(s, rng.randrange(60) if rng.random() < 0.7 else rng.randrange(4)): rng.choice([1, 3, 5]) for s in range(300) for _ in range(rng.randrange(1, 5))}
    if hot:  # one session of a third of all rows
        rows |= {(999, 1000 + i if i > 60 else i): 1 for i in range(len(rows) // 2)}
    return [(s, i, w) for (s, i), w in rows.items()]


def brute_pairs(rows, least):
    by, norm, dot = defaultdict(dict), defaultdict(int), defaultdict(int)
    for s, i, w in rows:
        by[s][i] = w
        norm[i] += w * w
    for items in by.values():
        for a in items:
            for b in items:
                if a < b:
                    dot[a, b] += items[a] * items[b]
    return {p: d for p, d in dot.items() if d * d / float(norm[p[0]] * norm[p[1]]) >= least * least}, norm


@pytest.mark.parametrize(("hot", "least", "cell"), [(False, 0.1, 1000), (True, 0.2, 40)])
def test_item_knn(spark, hot, least, cell):
    rows = matrix_rows(random.Random(4), hot)
    matrix = spark.createDataFrame(rows, "session_id long, itemid long, w long")
    want, norm = brute_pairs(rows, least)
    assert {(r.a, r.b): r.dot for r in knn.item_pairs(matrix, least, cell).collect()} == want and len(want) > 50
    best = defaultdict(list)
    for (a, b), d in want.items():
        c = d * d / float(norm[a] * norm[b])
        best[a].append((-c, b, d))
        best[b].append((-c, a, d))
    lists = {(i, r): (b, d, round(math.sqrt(-c), 6)) for i, x in best.items() for r, (c, b, d) in enumerate(sorted(x)[:5], 1)}
    assert {(r.itemid, r["rank"]): (r.neighbour, r.dot, r.similarity) for r in knn.item_knn(matrix, 5, least, cell).collect()} == lists


def test_large_sessions_are_left_out_or_split(spark):
    """Items with enough other sessions leave the largest one out; the rest of it is dealt in cells of bounded size."""
    rows = [(s, i, 1) for s in range(400) for i in range(50) if (s + i) % 9 == 0] + [(999, i, 1) for i in range(600)]
    matrix = spark.createDataFrame(rows, "session_id long, itemid long, w long")
    _, kept = knn.prefix_filtered(matrix, 0.3)
    left = {r.itemid for r in kept.where("session_id = 999").collect()}
    assert left == set(range(50, 600))  # these have no other session
    cells = kept.where("session_id = 999").withColumn("b", F.pmod(F.xxhash64("itemid"), F.lit(6))).groupBy("b").count()
    assert cells.count() == 6 and max(r["count"] for r in cells.collect()) < 150
    assert {(r.a, r.b, r.part) for r in knn.session_pairs(kept, 100).where("a >= 50").collect()} >= {(a, b, 1) for a in range(50, 600) for b in range(a + 1, 600)}


def test_item_knn_of_no_rows(spark):
    none = spark.createDataFrame([], "session_id long, itemid long, w long")
    assert knn.item_knn(none).collect() == []


def brute_sessions(rows, prefix, m):
    of, df, end = defaultdict(set), defaultdict(int), {}
    for s, i, e in rows:
        of[s].add(i)
        df[i] += 1
        end[s] = e
    idf = {i: round(1_000_000 * math.log1p(len(of) / k)) for i, k in df.items()}
    asked, out = defaultdict(set), {}
    for q, i in prefix:
        asked[q].add(i)
    for q, items in asked.items():
        scored = sorted((-sum(idf[i] for i in items & of[s]), -end[s], s) for s in of if items & of[s])
        out |= {(q, r): (s, -x) for r, (x, _, s) in enumerate(scored[:m], 1)}
    return out


@pytest.mark.parametrize("m", [1, 6])
def test_session_knn(spark, m):
    """Items 0 to 2 stand in a third or more of the sessions; many queries share one set; some know no item."""
    rng = random.Random(9)
    rows = []
    for s in range(400):
        items = {i for i in range(3) if rng.random() < 0.4} | {rng.randrange(3, 40) for _ in range(rng.randrange(3))} | {rng.randrange(40, 300)}
        rows += [(s, i, 1000 - s // 7) for i in items]
    prefix = [(q, i) for q in range(60) for i in {rng.randrange(3) if rng.random() < 0.5 else rng.randrange(60) for _ in range(rng.randrange(1, 7))}]
    prefix += [(100 + q, 0) for q in range(30)] + [(200, 5555), (201, 5555), (201, 1)]
    known, reads = knn.session_knn(spark.createDataFrame(rows, "session_id long, itemid long, session_end long"), spark.createDataFrame(prefix, "query_id long, itemid long"), m)
    got = {(r.query_id, r["rank"]): (r.session_id, r.score) for r in known.collect()}
    assert got == brute_sessions(rows, prefix, m)
    counts = reads.collect()
    assert all(r.read <= r.entries for r in counts) and sum(r.read for r in counts) < 0.6 * sum(r.entries for r in counts)
    assert any(r.lists == 1 and r.read == m < r.entries for r in counts)


def test_prefix_items_and_lists(spark):
    events = spark.createDataFrame([(1, i % 3, g, "v") for i, g in enumerate(range(1, 9))] + [(2, 7, 9, "v")], "session_id long, itemid long, group_id long, event string")
    queries = spark.createDataFrame([(g, 1) for g in range(1, 8)], "query_id long, session_id long")
    got = {(r.query_id, r.itemid) for r in knn.prefix_items(events, queries, 2).collect()}
    assert got == {(g, (g - 1 - d) % 3) for g in range(1, 8) for d in range(2) if g - d >= 1}
    near = spark.createDataFrame([(0, 1, 0.5), (1, 0, 0.5), (0, 2, 0.25)], "itemid long, neighbour long, similarity double")
    ranked = knn.item_knn_ranked(spark.createDataFrame([(1, 0), (2, 0), (2, 1), (3, 9)], "query_id long, itemid long"), near, 2)
    assert sorted(map(tuple, ranked.collect())) == [(1, 1, 1, 500000), (1, 2, 2, 250000), (2, 0, 1, 500000), (2, 1, 2, 500000)]


def common_sessions(rng, copies=1):
    """Few items, so that more than a few sets of items hold any pair or triple of them; each session stands ``copies`` times."""
    sets = [{i for i in range(9) if rng.random() < p} | {rng.randrange(9)} for p in (0.1, 0.3, 0.6) for _ in range(150)]
    return [(c * 1000 + s, i, 1000 - s // 7) for c in range(copies) for s, items in enumerate(sets) for i in items]


def indexed(spark, rows, prefix, m, most=12):
    index = knn.SessionIndex(spark.createDataFrame(rows, "session_id long, itemid long, session_end long"), m, most)
    return index, *index.sets(spark.createDataFrame(prefix, "query_id long, itemid long"))


@pytest.mark.parametrize("most", [12, 3])
def test_session_index_with_common_patterns(spark, most):
    """Patterns grow to four items and more; with most = 3, large sets and sessions are compared with all that share an item."""
    rng = random.Random(3)
    rows = common_sessions(rng)
    prefix = [(q, i) for q in range(40) for i in rng.sample(range(11), rng.randrange(1, 8))]
    index, of, members = indexed(spark, rows, prefix, 4, most)
    got = {(r.query_id, r["rank"]): (r.session_id, r.score) for r in knn.of_queries(of, index.near(members)).collect()}
    assert got == brute_sessions(rows, prefix, 4)


def test_session_knn_does_not_read_whole_lists(spark):
    """Sessions compared with a set neither grow with copies of sessions nor with the length of the items' lists."""
    prefix = [(1, 0), (2, 0), (2, 1), (3, 2), (3, 4), (3, 5)]
    found = []
    for copies in (1, 12):
        rows = common_sessions(random.Random(3), copies)
        index, of, members = indexed(spark, rows, prefix, 4)
        found.append({r.set_id: r["count"] for r in index.candidates(members).groupBy("set_id").count().collect()})
        assert {(r.query_id, r["rank"]): (r.session_id, r.score) for r in knn.of_queries(of, index.near(members)).collect()} == brute_sessions(rows, prefix, 4)
    assert found[0] == found[1] and found[1][1] == 4 and found[1][2] <= 3 * 4 and found[1][3] <= 7 * 4  # m for each pattern


def brute_reads(rows, sets, m):
    """set_id: (lists, entries, read) by reading the lists of each set in rounds, as the SQL does."""
    of, df = defaultdict(set), defaultdict(int)
    for s, i, _ in rows:
        of[s].add(i)
        df[i] += 1
    idf = {i: round(1_000_000 * math.log1p(len(of) / n)) for i, n in df.items()}
    out = {}
    for q, items in sets.items():
        lists = sorted((i for i in items if i in df), key=lambda i: (df[i], i))
        k, hi, upto = len(lists), 1, None
        while (hi + 1) // 2 <= k - 1 and upto is None:
            at = min(hi, k - 1)
            best = sorted((sum(idf[i] for i in of[s].intersection(lists[:at])) for s in of if of[s].intersection(lists[:at])), reverse=True)
            upto = at if len(best) >= m and best[m - 1] > sum(idf[i] for i in lists[at:]) else None
            hi = 2 * hi + 1
        read = [df[i] for i in lists[: k - 1 if upto is None else upto]] + [min(df[lists[-1]], m)] * (upto is None)
        out[q] = (k, sum(df[i] for i in lists), sum(read))
    return out


def test_reads_are_told_without_reading_lists(spark, monkeypatch):
    """Numbers of a reading in rounds; candidates of all parts of the sets stay few while the lists are long."""
    rng = random.Random(5)
    rows = [r for r in common_sessions(rng, 3)] + [(9000 + s, 50 + rng.randrange(12), 5) for s in range(30)]
    sets = {q: set(rng.sample(range(9), rng.randrange(1, 6))) | {50 + rng.randrange(14) for _ in range(q % 3)} for q in range(20)}
    index, _, members = indexed(spark, rows, [(q, i) for q, x in sets.items() for i in x], 4)
    seen = []
    candidates = index.candidates
    monkeypatch.setattr(index, "candidates", lambda x: seen.append(candidates(x)) or seen[-1])
    want = brute_reads(rows, sets, 4)
    got = {r.set_id: (r.lists, r.entries, r.read) for r in index.reads(members).collect()}
    assert got == {q: want[q] for q in got} and len(got) == len({frozenset(i for i in x if i < 62 and any(i == y for _, y, _ in rows)) for x in sets.values()} - {frozenset()})
    assert any(r < e for _, e, r in got.values())
    assert seen[0].count() < 0.2 * sum(r for _, _, r in got.values())


def test_session_lists_are_made_once_a_set(spark):
    """The list of a set is ranked once, whatever the number of its queries, and is that of each of them."""
    rng = random.Random(6)
    rows = common_sessions(rng)
    sets = [set(rng.sample(range(9), rng.randrange(1, 5))) for _ in range(6)]
    prefix = [(q, i) for q in range(60) for i in sets[q % 6]]
    index, of, members = indexed(spark, rows, prefix, 5)
    near = index.near(members)
    lists = knn.session_lists(near, index.sessions, 3)
    held, score = defaultdict(set), defaultdict(int)
    for s, i, _ in rows:
        held[s].add(i)
    for (q, _), (s, x) in brute_sessions(rows, prefix, 5).items():
        for i in held[s]:
            score[q, i] += x
    want = {(q, r): (i, -x) for q in range(60) for r, (x, i) in enumerate(sorted((-x, i) for (p, i), x in score.items() if p == q)[:3], 1)}
    assert {(r.query_id, r["rank"]): (r.itemid, r.score) for r in knn.of_queries(of, lists).collect()} == want
    assert lists.count() == 3 * len(set(map(frozenset, sets)))


def test_item_knn_of_classes(spark):
    """Equal sessions as one row with their number give the neighbours of all sessions, from few rows."""
    rows = common_sessions(random.Random(8), 7) + [(50_000 + i, 3, 5) for i in range(200)]
    index, *_ = indexed(spark, rows, [(1, 1)], 4)
    matrix = index.matrix()
    assert matrix.count() * 7 <= len(rows) and matrix.agg(F.sum("n")).first()[0] == len(rows)
    want, _ = brute_pairs([(s, i, 1) for s, i, _ in rows], 0.3)
    assert {(r.a, r.b): r.dot for r in knn.item_pairs(matrix, 0.3).collect()} == want and len(want) > 10
