"""Vector codes against plain Lloyd rounds in Python's whole numbers, and the bounds against full scans."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from clickloom.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=vc.ENTRIES):
    f32 = lambda v: float(np.float32(v))
    kept = [(i, [math.floor(f32(x) * 1024) for x in v], la) for i, v, la in rows if v and len(v) % 4 == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    m = len(kept[0][1]) // 4
    parts = [[r[1][p * m:(p + 1) * m] for r in kept] for p in range(4)]
    books = [[list(x) for x in part[:entries]] for part in parts]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(book))
    for _ in range(4):
        for p, book in enumerate(books):
            of = defaultdict(list)
            for x in parts[p]:
                of[near(x, book)[1]].append(x)
            for i, xs in of.items():
                book[i] = [sum(v) // len(xs) for v in zip(*xs)]
    found = [[near(parts[p][r], books[p]) for p in range(4)] for r in range(len(kept))]
    by = defaultdict(int)
    for (_, _, la), f in zip(kept, found):
        by[la] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), by[la], digest) for (i, _, la), f in zip(kept, found))


def check(spark, rows):
    got = vc.vector_codes(spark.createDataFrame(rows, SCHEMA))
    assert sorted((str(r[0]), *r[1:]) for r in map(tuple, got.collect())) == brute(rows)


def test_random_vectors(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(40)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.choice([None, 1, 1, 1, 2])) for i in range(700)]
    rng.shuffle(rows)
    check(spark, rows)


def test_ties_repeats_and_odd_vectors(spark):
    """Grid values tie often; copies of one vector hold a third of the rows; odd vectors are left out; a null id is coded."""
    rng = random.Random(6)
    rows = [(i, [rng.randrange(3) / 512 for _ in range(4)], i % 3) for i in range(400)] + [(1000 + i, [0.5] * 4, None) for i in range(200)]
    rows += [(7, [0.001] * 4, 1), (7, [0.001] * 4, 1), (None, [1.0] * 4, 1), (2000, None, 1), (2001, [1.0, None, 1.0, 1.0], 1), (2002, [float("nan")] * 4, 1), (2003, [float("inf")] * 4, 1), (2004, [], 1), (2005, [1.0] * 3, 1)]
    check(spark, rows)


def test_few_and_huge_vectors(spark):
    """Fewer rows than entries; components whose squares no double or long holds exactly (errors end at the largest long)."""
    rows = [(i, [1e6 * i, -3e5, 0.5, 7.0 + i], 1) for i in range(20)]
    check(spark, rows)
    huge = vc.vector_codes(spark.createDataFrame([(i, [3e38 * (-1) ** i, 1.0, 2.0, 3.0], 1) for i in range(300)], SCHEMA)).collect()
    assert len(huge) == 300 and all(0 <= r.error <= 2**63 - 1 for r in huge)
    mixed = vc.vector_codes(spark.createDataFrame([(0, [1.0] * 4, 1), (1, [1.0] * 8, 1)], SCHEMA)).collect()
    assert [r.vec_id for r in mixed] == [0]
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("grid", [1, 64])
def test_bounds_spare_scans_and_keep_results(grid):
    rng = np.random.default_rng(1)
    centres = rng.integers(-2000, 2000, (16, 8)) // grid * grid
    x = (centres[rng.integers(0, 16, 3000)] + rng.integers(-200, 200, (3000, 8)) // grid * grid).astype(np.float64)
    book = vc.Book(x[:16].copy())
    at, upper, lower = book.scan(x)
    scanned = []
    for _ in range(6):
        means = [np.floor(x[at == e].mean(0)) if (at == e).any() else book.entries[e] for e in range(16)]
        book = vc.Book(np.array(means), book.entries)
        at, upper, lower, n = book.again(x, at, upper, lower)
        scanned.append(n)
        assert (at == vc.squared(x, book.entries).argmin(1)).all()
        true = np.sqrt(vc.squared(x, book.entries))
        assert (upper >= true[np.arange(3000), at]).all()
        true[np.arange(3000), at] = np.inf
        assert (lower <= true.min(1)).all()
    assert scanned[-1] < 1500
