"""License scan: exact phrases, and fuzzy search for short notices (exact seeds, then bounded-error regex)."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from clickloom.llm.common import map_columns

#: Fixed values of the scan: phrases that count exactly.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Fixed values of the scan: names of licences, with their labels, that stand in each of the frames.
NAMES = tuple((n, n) for n in "mit bsd isc apache gpl lgpl agpl mpl epl zlib unlicense".split())
FRAMES = ("released under the {%s} license", "licensed under the {%s} license", "distributed under the terms of the {%s} license")
#: Fixed values of the scan: further short notices; braces hold the words that name the licence.
NOTICES = (
    *((frame % name, label) for frame in FRAMES for name, label in NAMES),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the {apache} license version 2 0", "apache"),
    ("gnu {general} public license", "gpl"),
    ("gnu {lesser general} public license", "lgpl"),
    ("gnu {affero general} public license", "agpl"),
    ("{mozilla} public license", "mpl"),
    ("{eclipse} public license", "epl"),
    *((f"licensed under {{{name}}} 4 0", name.replace(" ", "-")) for name in ("cc by", "cc by sa", "cc by nd", "cc by nc", "cc by nc sa", "cc by nc nd")),
    ("creative commons {attribution}", "cc-by"),
    ("creative commons {attribution sharealike}", "cc-by-sa"),
    ("creative commons {attribution noderivatives}", "cc-by-nd"),
    ("creative commons {attribution noncommercial}", "cc-by-nc"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

#: A word that names a licence may differ by an edit from this many letters on; shorter ones are too near to each other.
LONG_NAME = 6

#: Every byte that is no word byte becomes a space; A-Z becomes a-z.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def errors_allowed(notice: str) -> int:
    """One edit for each ten characters of a notice."""
    return max(1, len(notice) // 10)


def seeds(notice: bytes, errors: int) -> list[tuple[int, bytes]]:
    """The notice cut into errors + 1 parts, with their offsets: at most ``errors`` edits leave one part intact."""
    n, k = len(notice), errors + 1
    return [(n * i // k, notice[n * i // k : n * (i + 1) // k]) for i in range(k)]


@dataclass(frozen=True)
class Notice:
    """A notice to search: its words, how many edits it allows, the name words that must stand as they are, its pattern."""

    text: str
    label: str
    errors: int
    exact: tuple[bytes, ...]
    pattern: regex.Pattern

    @staticmethod
    def of(given: str, label: str) -> Notice:
        before, name, after = re.fullmatch(r"([^{]*)(?:\{([^}]*)\})?([^{]*)", given).groups()
        text, names = given.replace("{", "").replace("}", ""), (name or "").split()
        errors = errors_allowed(text)
        loose = lambda part: b"(?:%b){e<=%d}" % (regex.escape(part.encode(), literal_spaces=True), errors) if part else b""
        middle = b" ".join(b"(?:%b){e<=1}" % w.encode() if len(w) >= LONG_NAME else w.encode() for w in names)
        # each part has the edits of the whole, and the sum is checked for each match
        # names stand as whole words, so what is before and after them cannot run into them
        pattern = regex.compile(b"(?b)(?<![^ ])%b%b%b(?![^ ])" % (loose(before), middle, loose(after)))
        return Notice(text, label, errors, tuple(w.encode() for w in names if len(w) < LONG_NAME), pattern)


@lru_cache(8)
def _compiled(notices: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    """All seeds of all notices in one automaton, over text in which each byte is one character."""
    places: dict[bytes, list[tuple[int, Notice]]] = {}
    for given, label in notices:
        notice = Notice.of(given, label)
        for offset, part in seeds(notice.text.encode(), notice.errors):
            places.setdefault(part, []).append((offset, notice))
    found = ahocorasick.Automaton()
    for part, at in places.items():
        found.add_word(part.decode("latin-1"), (len(part), at))
    found.make_automaton()
    return found


def fuzzy_spans(line: bytes, notices: tuple[tuple[str, str], ...] = NOTICES) -> list[tuple[str, str, int, int, int]]:
    """label, notice, first and last word, errors of each place where a notice stands with few enough edits.

    ``line``: lower-case words joined by single spaces. Edits are counted on UTF-8 bytes. Words that name a licence
    must stand as they are, or within one edit if they are long. Of places that overlap only the nearest stays: that
    of the smallest share of edits, and of equal ones the longest.
    """
    tried: set[tuple[str, int, int]] = set()
    found: dict[tuple[int, int, str], tuple[float, int, Notice]] = {}
    for end, (size, at) in _compiled(notices).iter(line.decode("latin-1")):
        for offset, notice in at:
            start = end + 1 - size - offset
            lo, hi = max(0, start - notice.errors), min(len(line), start + len(notice.text) + notice.errors)
            lo = line.rfind(b" ", 0, lo) + 1 if lo else 0
            stop = line.find(b" ", hi)
            hi = len(line) if stop < 0 else stop
            if (notice.text, lo, hi) in tried:
                continue
            tried.add((notice.text, lo, hi))
            if any(b" %b " % w not in b" %b " % line[lo:hi] for w in notice.exact):
                continue
            m = notice.pattern.search(line, lo, hi)
            if m and (cost := sum(m.fuzzy_counts)) <= notice.errors:
                key = (m.start(), m.end(), notice.label)
                found[key] = min(found.get(key, (2.0, 0, notice)), (cost / len(notice.text), cost, notice), key=lambda x: x[:2])
    kept: list[tuple[int, int, str]] = []
    for a, b, label in sorted(found, key=lambda k: (found[k][0], k[0] - k[1], k)):
        i = bisect_left(kept, (a, b, label))
        # kept places do not overlap, so only the neighbours can
        if (i == len(kept) or kept[i][0] >= b) and (i == 0 or kept[i - 1][1] <= a):
            kept.insert(i, (a, b, label))
    before = spaces_before(line, (a for a, _, _ in kept))
    return [(label, found[a, b, label][2].text, before[a], before[a] + line.count(b" ", a, b), found[a, b, label][1]) for a, b, label in kept]


def spaces_before(line: bytes, places: Iterable[int]) -> dict[int, int]:
    """Number of spaces before each place; the line is passed over once, however many places there are."""
    out, at, n = {}, 0, 0
    for place in sorted(set(places)):
        n += line.count(b" ", at, place)
        out[place], at = n, place
    return out


def phrase_places(line: bytes, phrases: tuple[tuple[str, str], ...] = PHRASES) -> list[tuple[int, str]]:
    """Word index and label of each place where a phrase's words stand consecutively."""
    found, padded = [], b" %b " % line
    for phrase, label in phrases:
        needle = b" %b " % phrase.encode()
        at = padded.find(needle)
        while at >= 0:
            found.append((at, label))
            at = padded.find(needle, at + 1)
    before = spaces_before(padded, (at for at, _ in found))
    return sorted((before[at], label) for at, label in found)


def scan(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base places are exact phrases; labels add those of notices found with up to ``errors_allowed`` edits; spans
    lists the fuzzy places. score: 1 with a base place, else the best 1 - errors / length of a span, else 0.
    Null and empty texts have no words, empty labels and score 0; the word indexes are then null. Repeated rows are
    repeated, an empty table gives no rows, other columns are not read.
    """

    def step(ids: list, texts: list) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
        for text in texts:
            words = (text or "").encode().translate(_WORDS).split()
            line = b" ".join(words)
            base, spans = phrase_places(line, phrases), fuzzy_spans(line, notices)
            labels = {x for _, x in base}
            out["n_words"].append(len(words))
            out["n_base"].append(len(base))
            out["first_word"].append(base[0][0] if base else None)
            out["last_word"].append(base[-1][0] if base else None)
            out["base_labels"].append(",".join(sorted(labels)))
            out["labels"].append(",".join(sorted(labels | {s[0] for s in spans})))
            out["score"].append(1.0 if base else max((1 - s[4] / len(s[1]) for s in spans), default=0.0))
            out["spans"].append([dict(zip(("label", "notice", "first_word", "last_word", "errors"), s)) for s in spans])
        return {"doc_id": ids, **out}

    return map_columns(
        docs.select("doc_id", "text"),
        step,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, notice: string, first_word: long, last_word: long, errors: int>>",
    )
