"""The prefix trie against a brute-force one."""

import hashlib
import random
import zlib

import pytest

from clickloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), role, digest(role, text), text))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = own.get(donor, [])[:h] + turns[h:]
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    size = lambda p: len(p[-1][1].encode()) if p else 0
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * size(p)
        if p:
            for of, add in ((children, 1), (leaves, leaves[p]), (saved, saved[p])):
                of[p[:-1]] += add
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


def check(spark, rows, **options):
    got = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), **options)
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == sorted(brute(rows), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("least_local", [8, 256])
def test_random_conversations(spark, least_local):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("aéx") * rng.randrange(3)) for c in range(-20, 120) for t in range(rng.randrange(9))]
    rng.shuffle(rows)
    check(spark, rows, least_local=least_local)


def test_hot_turns_copies_and_long_conversations(spark):
    """Many copies, a first turn that most share, a conversation of a third of all rows and deep shared paths."""
    rows = [(5 * c, t, "user", f"copy {t}") for c in range(60) for t in range(9)]
    rows += [(1000 + c, t, "user", "hello" if t == 0 else f"{c % 7} {t}") for c in range(80) for t in range(4)]
    rows += [(2001, t, "user", str(t)) for t in range(700)]
    rows += [(c, t, "bot", f"deep {t}") for c in (3000, 3005, 3010) for t in range(22)]
    check(spark, rows, least_local=25)


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, ties, ends in the middle, turnless conversations; no rows."""
    rows = [(None, 1, "a", "b"), (1, None, None, None), (1, None, "", ""), (1, 2, "u", "x"), (1, 2, "u", "x"), (1, 2, "u", "w"), (0, 0, "u", "x" * 50_000), (10, 0, "u", "x" * 50_000), (10, 1, "v", None)]
    rows += [(c, 0, "u", "one") for c in range(20, 60)] + [(-(2**62), 5, "u", "far"), (7, -3, "u", "early"), (7, 0, "u", "late")]
    check(spark, rows)
    check(spark, rows, least_local=4)
    check(spark, [])


def test_quicksort_of_one_bucket():
    nodes = trie.bucket_nodes(2, 4, [(9, [1, 2], [5, 5]), (8, [1], [5]), (7, [1, 2, 3], [5, 5, 1])])
    assert [(n[0], n[1], n[2], n[3], n[4], n[5], n[6], n[8]) for n in nodes] == [(7, 3, 4, 3, 1, 1, 15, True), (7, 4, 7, 2, 1, 1, 5, False), (7, 5, 7, 1, 0, 1, 0, False)]
