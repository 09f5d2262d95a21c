"""URL verdicts against a plain naive Bayes and Viterbi, vector links and components against all pairs."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickloom.llm import lattice, url_filter


def cut_cost(pieces, counts, total):
    return sum(math.log(counts[p] / total) if p in counts else -math.log(total) - len(p) * math.log(10) for p in pieces)


def test_viterbi_equals_all_cuts():
    rng = random.Random(1)
    for _ in range(300):
        counts = {"".join(rng.choices("ab", k=rng.randint(1, 5))): rng.randint(1, 50) for _ in range(6)}
        total, name = sum(counts.values()) + rng.randint(0, 50), "".join(rng.choices("abc", k=rng.randint(1, 9)))
        cuts = []
        for k in range(len(name)):
            for at in itertools.combinations(range(1, len(name)), k):
                cuts.append([name[a:b] for a, b in zip([0, *at], [*at, len(name)])])
        got = url_filter.viterbi(name, counts, total)
        assert "".join(got) == name
        assert math.isclose(cut_cost(got, counts, total), max(cut_cost(c, counts, total) for c in cuts), rel_tol=1e-12), (name, counts)
    assert url_filter.viterbi("x" * 4000 + "red", {"red": 1}, 10) == ["x" * 4000, "red"]


def brute(pages, rules=url_filter.RULES):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    dictionary = Counter(w for _, _, html in pages for w in re.split(r"[^a-z]+", re.sub(r"<[^>]*>|&\w+;", " ", html or "").lower()) if w)
    total, rows = sum(dictionary.values()) or 1, []
    for page, url, _ in pages:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (low(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), says, h + p) for says, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, None))
        tokens = [f"{place}:{w}" for place, text in (("h", host), ("p", path)) for name in re.split(r"[^a-z]+", text.lower()) if name for w in url_filter.viterbi(name, {k: n for k, n in dictionary.items() if k in name}, total)]
        rows.append((page, host, path, best[2], best[1], tokens))
    seen = defaultdict(Counter)
    for r in rows:
        for t in r[5]:
            seen[r[4]][t] += 1
    size = len({t for r in rows for t in r[5]})
    a, b = sum(seen["allow"].values()), sum(seen["block"].values())
    prior = math.log((sum(r[4] == "block" for r in rows) + 1) / (sum(r[4] == "allow" for r in rows) + 1))
    out = []
    for page, host, path, rule, says, tokens in rows:
        score = None
        if says is None:
            score = round(prior + sum(math.log((seen["block"][t] + 1) / (b + size)) - math.log((seen["allow"][t] + 1) / (a + size)) for t in tokens), 6)
            says = "block" if score > 0 else "allow"
        out.append((page, host, path, rule, says, score))
    return sorted(out)


def test_judge_equals_plain_naive_bayes(spark):
    rng = random.Random(2)
    words = "red house cheap pills news blog sport garden".split()
    name = lambda: "".join(rng.choices(words, k=rng.randint(1, 3)))
    tops = ["org", "com", "net", "example.org", "example.net"]
    path = lambda: rng.choice(["/", "", "/es/", "/fr/", "/de/", "/en/1"]) + name()
    pages = [(i, f"http://{rng.choice(['', 'WWW.'])}{name()}.{rng.choice(tops)}{path()}?q={i}", "<p>" + " ".join(rng.choices(words, k=5)) + "</p>") for i in range(150)]
    pages += [(500, None, None), (501, "no url", "x"), (502, "http://" + "cheappills" * 30 + ".net/", "supercalifragilisticexpialidocious"), (503, "http://a.net/supercalifragilisticexpialidocioushouse", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for most in (200_000, 0):
        got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict, None if r.score is None else round(r.score, 6)) for r in url_filter.judge(df, most_broadcast=most).collect())
        assert got == brute(pages)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    n, size = 1200, 64
    a = rng.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(n, size))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = 0.9301
    b = c * a + math.sqrt(1 - c * c) * side
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in lattice.near_duplicates(df).collect()}
    assert sum(got[i].n_links for i in range(n)) >= 0.98 * n
    x = np.concatenate([a, b])
    true = (x @ x.T >= 0.93).sum(1) - 1
    assert all(got[i].n_links <= true[i] for i in range(2 * n))


def test_links_and_components_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 16))
    x = np.concatenate([centre + s * rng.normal(size=centre.shape) for s in (0, 0, 0.05, 0.1, 0.15, 0.2)]).astype(np.float32)
    label = [i % 3 if i % 7 else None for i in range(len(x))]
    rows = [(1000 - i, [float(v) for v in r], label[i]) for i, r in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = [[j for j in range(len(x)) if j != i and label[i] is not None and label[i] == label[j] and u[i] @ u[j] >= 0.93] for i in range(len(x))]
    root = list(range(len(x)))
    for _ in x:
        root = [max([root[i], *(root[j] for j in link[i])]) for i in range(len(x))]
    assert got == {1000 - i: (len(link[i]), 1000 - root[i], root[i] == i) for i in range(len(x))}


def test_an_id_with_two_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
