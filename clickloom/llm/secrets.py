"""Secret scans: three fixed kinds of spans, and strings that look random by the entropy of a sliding window.

A candidate is a run of at least WINDOW characters that tokens are made of. For each character class (``CLASSES``) a
window slides over the candidate's runs of that class. Counts of its characters, the sum over them that the entropy
needs and the number of turns (places where digits, small letters and capitals meet) change by the character that
enters and the one that leaves, so a candidate costs its length. Windows that reach the class's entropy and have
enough turns make spans; an allow-list takes back what is known to be no secret. Everything is in whole numbers, so results do not
depend on the order of sums.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

#: Base kinds in their order, as the contract fixes them: pattern, group and least length of it.
BASE = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
ENTROPY = "entropy"


@dataclass(frozen=True)
class Class:
    """Characters of one kind of token; a window of ``window`` must reach ``bits`` of entropy a character and ``turns`` turns."""

    pattern: str
    window: int
    bits: float
    turns: int


#: Random strings of a class have some 0.3 bits and half as many turns more on average; words, numbers and names have fewer.
CLASSES = (
    Class(r"[0-9a-f]+", 24, 3.0, 4),
    Class(r"[0-9A-F]+", 24, 3.0, 4),
    Class(r"[0-9a-z]+", 20, 3.3, 3),
    Class(r"[0-9A-Z]+", 20, 3.3, 3),
    Class(r"[A-Za-z0-9+/_-]+", 20, 3.7, 8),
)
WINDOW = min(c.window for c in CLASSES)
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{WINDOW},}}")

#: Strings that are no secrets: ids made to be public, digests that name a file, and stand-ins.
ALLOWED = (
    re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE),
    re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-_/]", re.IGNORECASE),
    re.compile(r"example|sample|dummy|placeholder|changeme|redacted|x{6}", re.IGNORECASE),
)
#: A stand-in counts up: at least this share of neighbours follow each other in code order.
RISING = 0.5

#: n * log2(n) in whole numbers of 2 ** -32.
SCALE = 1 << 32


def weight(n: int) -> int:
    return round(n * math.log2(n) * SCALE) if n else 0


def _weights(window: int) -> list[int]:
    return [weight(n) for n in range(window + 1)]


def random_windows(text: str, kind: Class) -> list[tuple[int, int]]:
    """Spans of ``text`` covered by windows of one class that look random, overlapping ones as one."""
    w, table, out = kind.window, _weights(kind.window), []
    most = weight(w) - math.ceil(kind.bits * w * SCALE)  # entropy is (w log w - sum of n log n) / w
    for m in re.finditer(kind.pattern, text):
        lo, hi = m.span()
        if hi - lo < w:
            continue
        counts: dict[str, int] = {}
        total = turns = 0
        for i in range(lo, hi):
            c = text[i]
            n = counts.get(c, 0)
            total += table[n + 1] - table[n] if n < w else 0
            counts[c] = n + 1
            turns += i > lo and _turn(text[i - 1], c)
            if i - lo >= w:
                old = text[i - w]
                n = counts[old]
                total += table[n - 1] - table[n] if n <= w else 0
                counts[old] = n - 1
                turns -= _turn(old, text[i - w + 1])
            if i - lo >= w - 1 and total <= most and turns >= kind.turns:
                at = i - w + 1
                if out and at <= out[-1][1]:
                    out[-1][1] = i + 1
                else:
                    out.append([at, i + 1])
    return [tuple(x) for x in out]


def _turn(a: str, b: str) -> bool:
    """Whether two neighbours are of different kinds: digits, small letters, capitals, others."""
    return a.isdigit() != b.isdigit() or a.islower() != b.islower() or a.isupper() != b.isupper()


def allowed(text: str) -> bool:
    """Whether a candidate is known to be no secret; words and numbers with signs between them are a path or a name."""
    if all(p.isalpha() or p.isdigit() for p in re.split("[-_/+]+", text) if p):
        return True
    rising = sum(ord(b) - ord(a) == 1 for a, b in zip(text, text[1:]))
    return any(p.search(text) for p in ALLOWED) or rising >= RISING * (len(text) - 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in BASE) of the base kinds; a match whose value is too short is passed over."""
    return sorted((m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(BASE) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Spans of random-looking strings; those of several classes that overlap are one."""
    out: list[list[int]] = []
    for m in CANDIDATE.finditer(text):
        found = sorted(s for kind in CLASSES for s in random_windows(m[0], kind)) if any(c.isdigit() for c in m[0]) else []
        if not found or allowed(m[0]):
            continue
        first = len(out)
        for a, z in found:
            a, z = a + m.start(), z + m.start()
            if len(out) > first and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], z)
            else:
                out.append([a, z])
    return [tuple(x) for x in out]


def scan_text(text: str) -> tuple[list[int], str, str]:
    """(number of spans of each kind, base spans, all spans) of one text, spans as kind:start:end."""
    base = base_spans(text)
    counts = [sum(k == i for _, k, _ in base) for i in range(len(BASE))]
    more, covered = [], 0
    cover = iter(base)
    ahead = next(cover, None)
    for a, z in entropy_spans(text):  # in order, as the base spans are
        while ahead and ahead[0] <= a:
            covered, ahead = max(covered, ahead[2]), next(cover, None)
        if z > covered:
            more.append((a, len(BASE), z))
    names = [b[0] for b in BASE] + [ENTROPY]
    line = lambda spans: ",".join(f"{names[k]}:{a}:{z}" for a, k, z in spans)
    return counts + [len(more)], line(base), line(sorted(base + more))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy of each row of ``docs`` (doc_id, text).

    Whole texts; null and empty ones have no spans (the hash is that of an empty string). Rows are judged one by
    one, so repeated ones and null ids have their own; an empty table gives none; other columns are not read.
    Places are code points. An entropy span inside one base span is not repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan_text(t.as_py() or "") for t in b.column("text")]  # one text at a time
            counts = list(zip(*(f[0] for f in found))) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array([hashlib.sha256(f[1].encode()).hexdigest() for f in found], pa.string()), pa.array([f[2] for f in found], pa.string()), pa.array(counts[3], pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"],
            )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")
