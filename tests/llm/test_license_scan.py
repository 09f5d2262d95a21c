"""Notices against a plain edit-distance scan, base columns against a plain walk over words, labels against each other."""

import random
import re

import pytest

from clickloom.llm import license_scan as scan

NAMED = ["mit", "bsd", "isc", "apache", "gpl", "lgpl", "agpl", "mpl", "epl", "zlib", "unlicense"]


def labels(text):
    return {s[0] for s in scan.fuzzy_spans(b" ".join(text.encode().translate(scan._WORDS).split()))}


@pytest.mark.parametrize("name", NAMED)
@pytest.mark.parametrize("frame", ["Released under the %s license", "licensed under the %s licence", "relased under teh %s License.", "distributed under the terms of the %s-license"])
def test_each_name_gives_its_own_label(frame, name):
    assert labels(f"some words {frame % name} and more") == {name}


@pytest.mark.parametrize("name", ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"])
def test_creative_commons(name):
    assert labels(f"Licensed under CC-{name.upper()} 4.0") == {f"cc-{name}"}


def test_every_notice_gives_only_its_label():
    for notice, label in scan.NOTICES:
        assert labels(notice.replace("{", "").replace("}", "")) == {label}, notice
    for other in ["released under the foo license", "licensed under cc xx 4 0", "released under the met license", "the gnu project", "a public license", "creative commons"]:
        assert labels(other) == set(), other


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(line, before, name, after, errors):
    """Smallest cost of a place: the name as a whole word, the rest within ``errors`` edits, from word start to word end."""
    best = errors + 1
    starts, ends = [0, *(m.end() for m in re.finditer(" ", line))], [*(m.start() for m in re.finditer(" ", line)), len(line)]
    for m in re.finditer(rf"(?<![^ ]){name}(?![^ ])", line):
        left = min((distance(line[a : m.start()], before) for a in starts if a <= m.start()), default=best)
        right = min((distance(line[m.end() : b], after) for b in ends if b >= m.end()), default=best)
        best = min(best, left + right)
    return best if best <= errors else None


def mutated(rng, text, edits):
    x = list(text)
    for _ in range(edits):
        i = rng.randrange(len(x))
        x[i : i + 1] = rng.choice([[], [x[i], rng.choice("abz ")], [rng.choice("abz ")]])
    return " ".join("".join(x).split())


def test_fuzzy_search_equals_a_plain_scan():
    rng, hits = random.Random(8), 0
    for _ in range(400):
        name = rng.choice(["mit", "bsd", "isc"])
        line = "a text " + mutated(rng, f"released under the {name} license", rng.randrange(6)) + " of words"
        want = brute(line, "released under the ", name, " license", 3)
        got = scan.fuzzy_spans(line.encode(), (("released under the {%s} license" % name, name),))
        assert (min((s[4] for s in got), default=None)) == want, line
        hits += want is not None
    assert hits > 150


def test_base_columns_equal_a_plain_walk(spark):
    rng = random.Random(9)
    words = ["mit", "license", "apache", "general", "public", "x", "MIT", "License,", "permit", "é"]
    docs = [(i, rng.choice([" ", "\n", "--"]).join(rng.choices(words, k=rng.randrange(30)))) for i in range(200)] + [(900, None), (901, "")]
    got = {r.doc_id: r for r in scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for d, text in docs:
        w = [x for x in re.split("[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
        at = [(i, label) for phrase, label in scan.PHRASES for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
        r = got[d]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        for s in r.spans:
            assert 0 <= s.first_word <= s.last_word < r.n_words
