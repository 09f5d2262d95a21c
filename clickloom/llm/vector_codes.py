"""Vector codes: each vector is cut into parts, each part is coded by its nearest entry of a codebook (whole numbers).

Codebooks are fitted on all rows by Lloyd rounds with Hamerly's bounds: every part keeps an upper bound of the
distance to its own entry and one lower bound of the distance to any other entry. Entries move by known distances,
which loosens the bounds; only where they do not prove strictly that the own entry is the nearest, all entries are
scanned, in whole numbers, ties to the lower index. Bounds are rounded outwards, so they prove what they say.

A round is one pass over the vectors, which stay where they are: tasks get the codebooks (entries x dimensions whole
numbers, whatever the table) and give back a sum for each entry and partition. Codes and bounds are written as a
table in the shared folder with each round, so a lost executor costs a part of one round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import join_split, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Relative slack of bounds, far above the rounding of the few operations that make one.
SLACK = 1e-12
#: Whole numbers are exact in doubles below this; larger ones are computed as Python's.
EXACT = 2**53
STATE = "vec_id long, label {}, embedding {}, codes array<int>, upper array<double>, lower array<double>"
ROWS = 2048
SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.string()))])


def usable(embedding: Column) -> Column:
    """Whether a vector can be cut: not null or empty, a length of whole parts, no null or non-finite component."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & (F.size(embedding) % PARTS == 0) & ~odd, F.lit(False))


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x), exact: doubles where the squares of distances stay exact, else Python's whole numbers."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() * SCALE < math.sqrt(EXACT / x.shape[1]) / 2 - 1:
        return np.floor(x * SCALE)
    # a component too large to multiply is a whole number itself
    return np.array([[math.floor(v * SCALE) if abs(v) < EXACT else int(v) * SCALE for v in row] for row in x.tolist()], dtype=object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to the rows of ``c``."""
    if x.dtype != object and c.dtype != object:
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    x, c = (np.array([[int(v) for v in row] for row in m], dtype=object) for m in (x, c))
    return np.array([[sum((a - b) ** 2 for a, b in zip(p, q)) for q in c] for p in x], dtype=object)


def own_squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of ``x`` to the same row of ``c``."""
    if x.dtype != object and c.dtype != object:
        return ((x - c) ** 2).sum(1)
    return np.array([sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for p, q in zip(x, c)], dtype=object)


def root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.array([float(v) for v in x]) if x.dtype == object else x)


class Book:
    """The codebook of one part, with how far entries moved from the one before and half their distance to the next entry."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries, k = entries, len(entries)
        d = squared(entries, entries)
        apart = np.array([root(np.delete(row, i)).min() if k > 1 else np.inf for i, row in enumerate(d)])
        self.half = apart / 2 * (1 - SLACK)
        self.moved = np.zeros(k) if before is None else root(own_squared(entries, before)) * (1 + SLACK)
        most = np.argsort(self.moved)[::-1]
        #: For each entry, the longest way of any other.
        self.others = np.full(k, self.moved[most[0]])
        self.others[most[0]] = self.moved[most[1]] if k > 1 else 0.0

    def scan(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry (the lower index of ties) of each row, the upper and the lower bound."""
        d = squared(x, self.entries)
        at, rows = d.argmin(1).astype(np.int64), np.arange(len(x))
        upper = root(d[rows, at]) * (1 + SLACK)
        if d.shape[1] == 1:
            return at, upper, np.full(len(x), np.inf)
        d[rows, at] = d.max(1) + 1
        return at, upper, root(d.min(1)) * (1 - SLACK)

    def again(self, x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """As ``scan``, from the bounds of the round before; and how many rows were scanned."""
        at, upper = at.copy(), (upper + self.moved[at]) * (1 + SLACK)
        lower = lower - self.others[at]
        lower = lower - np.where(np.isinf(lower), 0, np.abs(lower)) * SLACK
        safe = np.maximum(lower, self.half[at])
        open_ = np.flatnonzero(~(upper < safe))
        if len(open_):
            upper[open_] = root(own_squared(x[open_], self.entries[at[open_]])) * (1 + SLACK)
            open_ = open_[~(upper[open_] < safe[open_])]
        if len(open_):
            at[open_], upper[open_], lower[open_] = self.scan(x[open_])
        return at, upper, lower, len(open_)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of at most ROWS rows, with their parts as whole numbers."""
    for whole in batches:
        for i in range(0, whole.num_rows, ROWS):
            b = whole.slice(i, ROWS)
            x = np.asarray(b.column("embedding").flatten(), np.float64).reshape(b.num_rows, -1)
            yield b, np.split(whole_numbers(x), PARTS, axis=1)


def _grid(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, PARTS)


def _assign(batches: Iterator[pa.RecordBatch], books: list[Book], first: bool) -> Iterator[pa.RecordBatch]:
    for b, parts in _slices(batches):
        if first:
            got = [book.scan(x) for book, x in zip(books, parts)]
        else:
            at, upper, lower = (_grid(b.column(c), b.num_rows) for c in ("codes", "upper", "lower"))
            got = [book.again(x, at[:, p], upper[:, p], lower[:, p]) for p, (book, x) in enumerate(zip(books, parts))]
        offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * PARTS)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.stack([g[i] for g in got], 1).ravel().astype(t))) for i, t in enumerate((np.int32, np.float64, np.float64))]
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("vec_id", "label", "embedding")] + lists, names=["vec_id", "label", "embedding", "codes", "upper", "lower"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, entry, n, total (of each component, decimal text) over a partition: at most PARTS x ENTRIES rows."""
    totals: dict[tuple[int, int], list] = {}
    for b, parts in _slices(batches):
        codes = _grid(b.column("codes"), b.num_rows)
        for p, x in enumerate(parts):
            for e in np.unique(codes[:, p]).tolist():
                rows = x[codes[:, p] == e]
                t = totals.setdefault((p, e), [0, [0] * x.shape[1]])
                t[0] += len(rows)
                t[1] = [a + int(v) for a, v in zip(t[1], rows.sum(0).tolist())]
    if totals:
        yield pa.RecordBatch.from_pydict({"part": [p for p, _ in totals], "entry": [e for _, e in totals], "n": [t[0] for t in totals.values()], "total": [[str(v) for v in t[1]] for t in totals.values()]}, schema=SUMS)


def _added(rows: pa.Table) -> pa.Table:
    """The sums of one entry over all partitions, of which each gave one row; whole numbers of any size."""
    total = [str(sum(map(int, v))) for v in zip(*rows.column("total").to_pylist())]
    return pa.table({"part": rows.column("part")[:1], "entry": rows.column("entry")[:1], "n": [sum(rows.column("n").to_pylist())], "total": [total]}, schema=SUMS)


def _codes(batches: Iterator[pa.RecordBatch], books: list[Book]) -> Iterator[pa.RecordBatch]:
    for b, parts in _slices(batches):
        codes = _grid(b.column("codes"), b.num_rows)
        error = sum(own_squared(x, book.entries[codes[:, p]]) for p, (x, book) in enumerate(zip(parts, books)))
        yield pa.RecordBatch.from_pydict({
            "vec_id": b.column("vec_id"), "label": b.column("label"), "code": ["".join(f"{c:02x}" for c in row) for row in codes.tolist()],
            "error": pa.array([min(int(e), 2**63 - 1) for e in error.tolist()], pa.int64()),
        })


def fit_and_code(embeddings: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error of each kept row; the final codebooks) of ``embeddings`` (vec_id, embedding, label).

    Left out: vectors that are not ``usable`` or of another length than the kept one of the smallest vec_id. Repeated
    rows count as often as they stand. Codebooks start from the ENTRIES smallest vec_ids (nulls last, then in order of
    the vector; fewer rows make fewer entries). Errors beyond 2^63 - 1 are given as that.
    """
    rows = embeddings.where(usable(F.col("embedding"))).select("vec_id", "label", "embedding")
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(1).select(F.size("embedding")).first()
    kind = dict(rows.dtypes)
    spark = rows.sparkSession
    if start is None:
        return spark.createDataFrame([], f"vec_id long, label {kind['label']}, code string, error long"), []
    rows = rows.where(F.size("embedding") == start[0])
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(ENTRIES).select("embedding").collect()
    entries = np.split(whole_numbers(np.array([r[0] for r in seeds], np.float64)), PARTS, axis=1)
    books, state = [Book(e) for e in entries], rows
    schema = STATE.format(kind["label"], kind["embedding"])
    for i in range(ROUNDS + 1):
        state = written(state.mapInArrow(partial(_assign, books=books, first=i == 0), schema))
        if i < ROUNDS:
            books = _updated(books, state)
    coded = state.mapInArrow(partial(_codes, books=books), f"vec_id long, label {kind['label']}, code string, error long")
    return written(coded), [b.entries for b in books]


def _updated(books: list[Book], state: DataFrame) -> list[Book]:
    """Each entry becomes the floor of the mean of its parts; unused ones stay. The driver sees one row an entry."""
    sums = state.mapInArrow(_sums, "part int, entry int, n long, total array<string>")
    exact = sums.groupBy("part", "entry").applyInArrow(_added, "part int, entry int, n long, total array<string>")
    new = [b.entries.astype(object) for b in books]
    for p, e, n, total in exact.collect():  # PARTS x ENTRIES rows
        new[p][e] = [int(v) // n for v in total]
    largest = max((abs(int(v)) for m in new for row in m for v in row), default=0)
    small = largest < math.sqrt(EXACT / (PARTS * new[0].shape[1])) / 2 - 1
    return [Book(m.astype(np.float64) if small else np.array([[int(v) for v in row] for row in m], dtype=object), b.entries) for m, b in zip(new, books)]


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components of the codebooks as decimal whole numbers, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for m in books for row in m for v in row).encode()).hexdigest()


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of each kept row (see ``fit_and_code``).

    label_error is the error summed over rows of one label, nulls together, whatever share of the rows it has.
    """
    coded, books = fit_and_code(embeddings)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    labels = written(coded.groupBy("label").agg(F.count("*").alias("n"), total.alias("label_error")))
    return join_split(coded, labels, "label", "n", coded.count()).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
