"""Statistics counted by hand, rules of trees walked row by row, the lasso's optimality, and what reaches the driver."""

import math
import random

import numpy as np
import pytest

from clickloom.llm import rule_quality as rq


def by_hand(text):
    data = (text or "").encode()
    if not data.strip(b" \t\n\r\x0b\x0c"):
        return [0.0] * 16
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = [w for w in low.replace(b"\n", b" ").split() if w]
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda f: sum(map(f, data)) / len(data)
    marks = set(b"#$%&*+=<>@^_`|~\\/[]{}!\"")
    has_letter = lambda w: any(97 <= b <= 122 or b >= 128 for b in w)
    return [
        len(data), len(words), sum(len(w) for w in words) / len(words), share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in marks),
        share(lambda b: b in b".,;:?'()-"), share(lambda b: b >= 128), share(lambda b: b in b" \t\r\n"), len(set(words)) / len(words), sum(map(has_letter, set(words))) / len(set(words)),
        len(lines), len(words) / len(lines), 1 - len(set(lines)) / len(lines), sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
        1 - len({(a, b) for a, b in zip(words, words[1:])}) / max(1, len(words) - 1),
    ]


@pytest.mark.parametrize("text", [None, "", " \n ", "One two.\nOne two.\nthree é 42 ##", "x", "a a a a", "Ende gut!\n\n  Alles (gut)? "])
def test_statistics(text):
    assert rq.statistics(text) == pytest.approx(by_hand(text))


def data(seed, n=400):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(rq.STATISTICS)))
    y = ((x[:, 0] > 0.4) & (x[:, 3] <= 0.7) | (x[:, 9] > 0.9)).astype(float)
    flip = rng.random(n) < 0.05
    return x, np.where(flip, 1 - y, y)


def holds(rule, x):
    return np.array([all((row[rq.STATISTICS.index(c)] > at) == up for c, up, at in rule.conditions) for row in x], float)


def test_weights_are_the_lasso_optimum():
    """Where a weight is not zero the gradient of the loss balances the penalty; the bias has none."""
    x, y = data(1)
    penalty = 0.004
    model = rq.fit(x, y, trees=12, penalty=penalty, steps=6000)
    h = np.stack([holds(r, x) for r in model.rules], 1)
    w = np.array([r.weight for r in model.rules])
    p = 1 / (1 + np.exp(-(model.bias + h @ w)))
    grad = ((h - h.mean(0)) / h.std(0)).T @ (p - y) / len(y)
    assert np.allclose(grad, -penalty * np.sign(w), atol=2e-4) and abs((p - y).mean()) < 1e-4
    assert 3 <= len(model.rules) < 100 and ((p >= 0.5) == y).mean() > 0.93


def test_paths_are_conjunctions_that_lead_to_their_node():
    tree = [2, 0.5, [0, 0.1, -1.0, 2.0], 3.0]
    assert set(rq._paths(tree)) == {((2, False, 0.5),), ((2, True, 0.5),), ((2, False, 0.5), (0, False, 0.1)), ((2, False, 0.5), (0, True, 0.1))}
    x = np.zeros((4, 3))
    x[:, 2], x[:, 0] = [0.4, 0.5, 0.6, 0.4], [0.1, 0.2, 0.9, 0.0]
    assert rq._predict(tree, x).tolist() == [-1.0, 2.0, 3.0, -1.0]


def test_the_column_is_the_model(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab C.1#\n") for _ in range(rng.randrange(0, 90))) for _ in range(120)]
    x = np.array([rq.statistics(t) for t in texts])
    model = rq.fit(x, (x[:, 5] > 0.12).astype(float), trees=6)
    got = {r.doc_id: r.score for r in rq.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, row in enumerate(x):
        z = model.bias + sum(r.weight for r in model.rules if holds(r, [row])[0])
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), rel_tol=1e-9)
    assert model.rules


def test_one_row_an_id_reaches_the_driver(spark):
    """An id that stands on 5,000 rows, with two texts, is one row of the sample; results do not depend on row order."""
    docs = spark.range(5000).selectExpr("7L as doc_id", "if(id % 2 = 0, 'some text.', 'other text') as text").union(spark.createDataFrame([(8, None), (9, "x")], "doc_id long, text string"))
    wanted = spark.createDataFrame([(7, 1), (8, 0), (10, 1)], "doc_id long, _y int")
    rows = {r.doc_id: r for r in rq.sample(docs, wanted).collect()}
    assert set(rows) == {7, 8} and rows[8].chars == 0 and rows[7].words == 2
    assert rq.sample(docs.orderBy("text"), wanted).where("doc_id = 7").first() == rows[7]
