"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import LOWER_TABLE, columns_of, unused

#: The statistics of a text, in order. Language, source and ids are not among them.
STATISTICS = (
    "chars", "words", "word_length", "upper", "digits", "marks", "stops", "wide", "spaces",
    "distinct", "lone", "lines", "line_words", "repeats", "ended", "doubled",
)

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*+=<>@^_`|~\\/[]{}!\"", b".,;:?'()-", bytes(range(128, 256)), b" \t\r\n"), 1):
    _CLASS[list(_chars)] = _i
_LETTERS = bytes(b for b in range(256) if not (97 <= b <= 122 or b >= 128))


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one whole text; a null text counts as empty, all zero."""
    data = (text or "").encode()
    if not data.strip():
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(_CLASS, np.bincount(np.frombuffer(data, np.uint8), minlength=256), minlength=7)
    size = len(data)
    words = data.translate(LOWER_TABLE).split()
    distinct = set(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    bare = [w.translate(None, _LETTERS) for w in distinct]
    pairs = len(set(zip(words, words[1:])))
    return [
        float(size),
        float(len(words)),
        sum(map(len, words)) / len(words),
        *(kinds[1:7] / size).tolist(),
        len(distinct) / len(words),
        sum(map(bool, bare)) / len(distinct),
        float(len(lines)),
        len(words) / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
        1 - pairs / max(1, len(words) - 1),
    ]


@F.pandas_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))
def _statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=STATISTICS)


def with_statistics(docs: DataFrame, name: str = "_stats") -> DataFrame:
    """``docs`` with a struct of STATISTICS of its text."""
    return docs.withColumn(name, _statistics("text"))


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, is_above, threshold), all of which must hold, and the rule's weight."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    bias: float

    def column(self, stats: str = "_stats") -> Column:
        """The probability of quality as one expression of built-in functions."""
        total = F.lit(self.bias)
        for r in self.rules:
            holds = F.lit(True)
            for name, above, at in r.conditions:
                x = F.col(f"{stats}.{name}")
                holds = holds & ((x > at) if above else (x <= at))
            total = total + F.when(holds, r.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, least: int) -> list | float:
    """A regression tree on gradients: [statistic, threshold, below, above] or a leaf's value."""
    leaf = -g[rows].sum() / (h[rows].sum() + 1.0)
    if depth == 0 or len(rows) < 2 * least:
        return leaf
    best, total_g, total_h = (1e-6, 0, 0.0), g[rows].sum(), h[rows].sum()
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        at = np.searchsorted(c, x[rows, j], side="left")  # value <= c[i] falls at or left of i
        sg, sh, n = (np.cumsum(np.bincount(at, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
        gain = sg**2 / (sh + 1) + (total_g - sg) ** 2 / (total_h - sh + 1) - total_g**2 / (total_h + 1)
        gain[(n < least) | (len(rows) - n < least)] = 0
        if gain.max() > best[0]:
            best = (gain.max(), j, float(c[gain.argmax()]))
    if best[0] <= 1e-6:
        return leaf
    below = x[rows, best[1]] <= best[2]
    return [best[1], best[2], *(_tree(x, cuts, g, h, rows[m], depth - 1, least) for m in (below, ~below))]


def _predict(tree: list | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, list):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _predict(tree[2], x), _predict(tree[3], x))


def _paths(tree: list | float, so_far: tuple = ()) -> list[tuple]:
    """Every path from the root to an inner node or a leaf, as conditions."""
    own = [so_far] if so_far else []
    if isinstance(tree, list):
        for above in (False, True):
            own += _paths(tree[2 + above], (*so_far, (tree[0], above, tree[1])))
    return own


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, steps: int = 600, seed: int = 7) -> RuleModel:
    """Boost shallow trees, take their paths as rules, and fit lasso logistic weights for the rules.

    Without both classes the model is a constant: the share of label 1, or a half without rows.
    """
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else (y.sum() + 0.5) / (len(y) + 1)
        return RuleModel((), float(np.log(share / (1 - share))))
    rng, least = np.random.default_rng(seed), max(2, len(y) // 500)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) for j in range(x.shape[1])]
    margin, found = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), set()
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.sort(rng.choice(len(y), max(1, int(len(y) * 0.7)), replace=False))
        tree = _tree(x, cuts, p - y, p * (1 - p), rows, depth, least)
        margin += 0.3 * _predict(tree, x)
        found.update(_paths(tree))
    rules = sorted(found)
    holds = np.stack([np.logical_and.reduce([(x[:, j] > t) if up else (x[:, j] <= t) for j, up, t in r]) for r in rules], 1)
    _, first = np.unique(holds, axis=1, return_index=True)  # rules that hold on the same rows are one rule
    rules, holds = [rules[i] for i in sorted(first)], holds[:, sorted(first)]
    mean = holds.mean(0)
    rules, holds = [r for r, m in zip(rules, mean) if 0 < m < 1], holds[:, (mean > 0) & (mean < 1)].astype(np.float64)
    mean, spread = holds.mean(0), holds.std(0)
    z = (holds - mean) / spread
    w, v, bias, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), float(np.log(y.mean() / (1 - y.mean()))), 1.0
    vb = bias
    vec = rng.normal(size=z.shape[1])
    for _ in range(30):  # largest curvature, for the step length
        vec = z.T @ (z @ vec)
        vec /= np.linalg.norm(vec)
    step = 4 * len(y) / (np.linalg.norm(z.T @ (z @ vec)) + len(y))
    for _ in range(steps):  # accelerated proximal gradient
        r = 1 / (1 + np.exp(-(z @ v + vb))) - y
        new = v - step * (z.T @ r) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_bias, nt = vb - step * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / nt * (new - w), new_bias + (t - 1) / nt * (new_bias - bias)
        w, bias, t = new, new_bias, nt
    scaled = w / spread
    kept = [Rule(tuple((STATISTICS[j], bool(up), float(c)) for j, up, c in r), float(k)) for r, k in zip(rules, scaled) if k]
    return RuleModel(tuple(kept), float(bias - (scaled * mean).sum()))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 1 on division by 3 (false for a null id)."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, _y and STATISTICS of one text of each id of ``wanted`` (doc_id, _y; few rows) that ``docs`` has."""
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "_y"), F.xxhash64("text")).alias("d")).select("doc_id", "d.*")
    return with_statistics(one).select("doc_id", "_y", "_stats.*")


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, **options) -> RuleModel:
    """Fit on at most ``most_rows`` labelled documents, those of the smallest hash of the id.

    ``labels``: doc_id, quality. Null labels and ids are left out; a document with several labels has their
    mean, rounded up at a half. Of several texts of one id, that of the smallest hash is taken, before anything leaves
    Spark: the driver sees the statistics of ``most_rows`` texts at most, whatever repeats. Null texts count as empty;
    without labels or documents the model is a constant.
    """
    wanted = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("_y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    rows = sample(docs, wanted).toPandas().sort_values("doc_id", kind="stable")
    return fit(rows[list(STATISTICS)].to_numpy(np.float64), rows["_y"].to_numpy(np.float64), **options)


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    Null texts count as empty; repeated rows and null ids are scored one by one; an empty table gives no rows; other
    columns are not read.
    """
    return (
        with_statistics(docs.select("doc_id", "text"))
        .select("doc_id", held_out().alias("held_out"), model.column().alias("score"))
        .select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def keep_good(docs: DataFrame, model: RuleModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least`` (stage of the corpus pipeline), with all columns as they are.

    Null texts count as empty; rows that repeat an id or text are judged one by one; an empty table gives none.
    """
    name = unused(docs, "_stats")
    return with_statistics(docs, name).where(model.column(name) >= least).select(*columns_of(docs))
