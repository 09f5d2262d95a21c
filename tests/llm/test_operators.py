"""Training-data operators against brute force, on small tables with nulls, repeats and ties."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe, common, decontaminate, html_text, lattice, license_scan, line_dedup, rule_quality, simhash, url_filter
from clickloom.llm.common import components

DOCS = "doc_id long, text string"


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (300, 200), (7, 7)]
    got = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[100] == got[200] == got[300] == 100
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_html():
    page = '<body><nav>menu</nav><div class="ad">x</div><article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<div class="comments">no</div></article><footer>f</footer>'
    assert html_text.main_text(page) == "A & B\n\none two three\n\nfour"
    assert html_text.main_text(None) == html_text.main_text("") == ""


def test_html_templates_go_by_host(spark):
    rows = [(i, f"http://a.b/{i}", f"<body><div>same words on each page</div><p>own text {i}</p>") for i in range(8)] + [(9, None, None)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "own text 3" and got[9] == ""


def test_html_copies_and_wrappers_are_no_templates(spark):
    page = lambda i: f"<body><div class=page><article><p>own text {i}</p><p>more of {i}</p></article></div></body>"
    plain = lambda i: f"<body><div>bar</div><p>own text {i}</p></body>"
    rows = [(i, f"http://a.b/{i}", page(i if i > 6 else 0)) for i in range(12)]
    rows += [(100 + i, f"http://c.d/{i}", plain(i if i > 6 else 0)) for i in range(12)]
    # one block stands on 60 of 1000 pages of a host with many pages
    rows += [(1000 + i, f"http://e.f/{i}", f"<body>{'<div>offer</div>' if i < 60 else ''}<p>own text {i}</p></body>") for i in range(1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[2] == "own text 0\n\nmore of 0" and got[9] == "own text 9\n\nmore of 9"
    assert got[102] == "own text 0" and got[109] == "own text 9" and got[1005] == "offer\n\nown text 5"
    known = {r.host: len(r.hashes) for r in html_text.templates(pages, middle=100).collect()}
    assert known["e.f"] == 1 and "a.b" not in known


def test_html_templates_within_articles(spark):
    body = lambda i: f"<body><article><h1>same title</h1><div class=x17>read this, too</div><div><p>own text {i}</p></div><p>bye</p></article></body>"
    pages = spark.createDataFrame([(i, f"http://a.b/{i}", body(i)) for i in range(8)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got[3] == "same title\n\nown text 3\n\nbye"


def test_near_lines_match_brute_force(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdé ") for _ in range(40)) for _ in range(12)]
    lines = []
    for b in base:
        for _ in range(4):
            x = list(b)
            for _ in range(rng.randrange(3)):
                x[rng.randrange(1, 39)] = rng.choice(["", "z", "zz"])
            lines.append("".join(x).strip())
    docs = [(i, "\n".join(lines[i * 4 : i * 4 + 4])) for i in range(12)] + [(50, docs_line := lines[0]), (51, None), (52, "")]
    assert docs_line
    for edits in (1, 2):
        _, links = line_dedup.links(spark.createDataFrame(docs, DOCS), edits=edits, least_chars=24)
        texts = sorted(set(lines))
        named = {(r.h1, r.h2): r.line for r in line_dedup.occurrences(spark.createDataFrame(docs, DOCS), 24).collect()}
        got = {tuple(sorted((named[r.h1, r.h2], named[r.o1, r.o2]))) for r in links.collect()}
        pairs = spark.createDataFrame([(a, b) for i, a in enumerate(texts) for b in texts[i + 1 :]], "a string, b string")
        assert got == {tuple(sorted(r)) for r in pairs.where(F.levenshtein("a", "b") <= edits).collect()}
    kept = {r.doc_id: r.text for r in line_dedup.drop_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert kept[50] == "" and kept[51] is None and kept[52] == "" and kept[0].startswith(lines[0])


def test_near_lines_of_any_length_and_short_copies(spark):
    rng = random.Random(7)
    lines = []
    for n in (30, 60, 62, 64, 66, 95, 97, 130, 158, 161, 190, 193, 222, 226, 254, 258, 300, 700):
        base = "".join(rng.choice("abcdé ") for _ in range(n))
        for edits in (0, 1, 2, 3, 4, 5, 6, 7, 8, 9):
            x = list(base)
            for at in rng.sample(range(1, n - 1), edits):
                x[at] = rng.choice(["", "z", "zz"])
            lines.append("".join(x).strip(" "))
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], DOCS)
    named = {(r.h1, r.h2): r.line for r in line_dedup.occurrences(docs, 24).collect()}
    got = {tuple(sorted((named[r.h1, r.h2], named[r.o1, r.o2]))) for r in line_dedup.links(docs)[1].collect()}
    texts = sorted({x for x in lines if len(x) >= 24})
    pairs = spark.createDataFrame([(a, b, min(8, max(1, max(len(a), len(b)) // 32))) for i, a in enumerate(texts) for b in texts[i + 1 :]], "a string, b string, most int")
    want = {(r.a, r.b) for r in pairs.where(F.levenshtein("a", "b") <= F.col("most")).collect()}
    assert got == want and len(want) > 100
    short = spark.createDataFrame([(1, "Les.\n\nold"), (2, "new\n\n Les."), (3, "Les")], DOCS)
    assert {r.doc_id: r.text for r in line_dedup.drop_lines(short).collect()} == {1: "Les.\n\nold", 2: "new\n", 3: "Les"}


def test_report_equals_brute_force(spark):
    """Counts and dropped lines of the report, with null ids, white space at line ends, repeated rows and short lines."""
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice((10, 25, 40, 70, 100)))) for _ in range(25)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 3))):
            x[rng.randrange(1, len(x) - 1)] = rng.choice(["", "z", "zz"])
        return rng.choice(["", "", "\t", " "]) + "".join(x) + rng.choice(["", "", "\r", "  "])

    docs = [(rng.choice((None, i, i)), "\n".join(line() for _ in range(rng.randrange(1, 7)))) for i in range(60)]
    docs += [docs[3], docs[3], (700, None), (701, ""), (702, "\n \n")]
    for edits, least in ((None, 24), (1, 24), (2, 20), (3, 20)):
        clean = lambda x: x.strip(" \t\r\x0b\x0c")
        order = lambda d: (d[0] is not None, d[0] or 0)
        distinct = sorted(set((d, t) for d, t in docs if t is not None), key=lambda x: (order(x), x[1]))
        first = {}
        for d, t in distinct:
            for at, raw in enumerate(t.split("\n")):
                if (x := clean(raw)) and (x not in first or (order((d,)), at) < first[x]):
                    first[x] = (order((d,)), at)
        long = sorted(x for x in first if len(x) >= least)
        pairs = spark.createDataFrame([(a, b) for i, a in enumerate(long) for b in long[i + 1 :]], "a string, b string")
        most = F.lit(edits) if edits else F.greatest(F.lit(1), F.least(F.lit(8), F.floor(F.greatest(F.length("a"), F.length("b")) / 32)))
        linked = {}
        for a, b in pairs.where(F.levenshtein("a", "b") <= most).collect():
            linked.setdefault(a, set()).add(b)
            linked.setdefault(b, set()).add(a)
        assert len(linked) > 20
        want = []
        for d, t in docs:
            n_exact = n_near = n_links = 0
            dropped = []
            for at, raw in enumerate((t or "").split("\n") if t else []):
                x = clean(raw)
                if not x:
                    continue
                if first[x] != (order((d,)), at):
                    n_exact += 1
                    dropped.append(at)
                else:
                    n_links += len(linked.get(x, ()))
                    if any(first[y] < first[x] for y in linked.get(x, ())):
                        n_near += 1
                        dropped.append(at)
            want.append((d, len(t.split("\n")) if t else 0, n_exact, n_near, n_links, ",".join(map(str, dropped))))
        ids = [d for d, _ in distinct]
        got = line_dedup.report(spark.createDataFrame(docs, DOCS), edits, least).collect()
        # rows of one null id and line number cannot be told apart as first places, so they are compared where ids differ
        unique = lambda rows: sorted(tuple(r) for r in rows if r[0] is not None and ids.count(r[0]) == 1)
        assert unique(got) == unique(want) and len(got) == len(docs), edits


def test_near_lines_with_null_ids_and_far_edits(spark):
    line = "a line of text that is long enough"
    docs = spark.createDataFrame([(None, line), (1, line), (2, line + "s")], DOCS)
    assert line_dedup.links(docs)[1].count() == 2


def test_lines_that_only_share_a_part_give_no_pairs(spark):
    """Copies of one line with several other words meet in its segments, but are no candidates; those with one other word are linked."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    base = [word() for _ in range(70)]

    def copy(others):
        x = list(base)
        for at in rng.sample(range(len(x)), others):
            x[at] = word()
        return " ".join(x)

    far, near = [copy(8) for _ in range(60)], [copy(1) for _ in range(2)]
    table = lambda lines: spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, n int")
    assert line_dedup.candidates(table(far), None).count() < 10
    found = line_dedup.links(spark.createDataFrame(list(enumerate([*far, *near, " ".join(base)])), DOCS))[1]
    assert found.count() >= 4
    # no Python on the executors
    assert "Arrow" not in line_dedup.segment_keys(table(far), None)._jdf.queryExecution().toString()


def test_lines_near_one_line_are_linked_to_it(spark, monkeypatch):
    """A group of near copies is as many links as lines, not as pairs; classes and dropped lines are those of all links."""
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)).strip() or "x"

    def change(line, edits):
        x = list(line)
        for at in rng.sample(range(1, len(x) - 1), edits):
            x[at] = rng.choice(["", "z", "zz", "y"])
        return "".join(x)

    base = word(300)
    group = [change(base, 3) for _ in range(50)]
    # chains, and lines far from the most frequent one or before its first place
    odd = [word(n) for n in (30, 64, 100, 260)]
    for x in list(odd):
        for _ in range(6):
            x = change(x, rng.choice((1, 1, 2, max(1, len(x) // 40))))
            odd.append(x)
    odd += [change(base, rng.choice((6, 7, 9))) for _ in range(12)]
    rng.shuffle(odd)
    docs = [(i, x) for i, x in enumerate([*odd[:20], base, *group, *odd[20:]])] + [(500 + i, base + "\n" + odd[3]) for i in range(9)] + [(900, None), (900, None), (700, odd[5]), (700, odd[5])]
    table = spark.createDataFrame(docs, DOCS)
    linked = line_dedup.links(table)[1].select("h1", "o1").collect()
    seen = []
    every = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, *a: seen.append(pairs.count()) or every(pairs, *a))
    found = line_dedup.spanning_links(line_dedup._distinct_lines(table, 24), None)
    assert len(linked) // 2 > 1000 and found.count() < 300 and sum(seen) < 800
    # classes by brute force: the smallest place that links reach
    first = {}
    for r in line_dedup.occurrences(table, 1).collect():
        first[r.h1] = min(first.get(r.h1, (r.doc_id, r.pos)), (r.doc_id, r.pos))
    least = {h: first[h] for r in linked for h in r}
    for _ in range(len(least)):
        for a, b in linked:
            least[a] = min(least[a], least[b])
    want = {first[h]: "{}:{}".format(*at) for h, at in least.items()}
    got = line_dedup.report(table, marks="classes").collect()
    assert {(r.doc_id, int(x.partition("=")[0])): x.partition("=")[2] for r in got for x in r.classes.split(",") if x} == want
    rest = lambda rows: sorted((r.doc_id, r.n_lines, r.n_exact, r.n_near, r.dropped) for r in rows)
    assert rest(got) == rest(line_dedup.report(table).collect()) and len(got) == len(docs)


def test_stage_lines_lists_no_pairs_of_a_group(spark, monkeypatch):
    """The pipeline's stage drops near lines without all links, as the list of all links says."""
    import corpus_pipeline

    base = "one line of words that is long enough to have near copies, which differ from it at one place each, and so from one another at two"
    group = [base[:at] + "#" + base[at:] for at in range(5, 125, 12)]
    docs = spark.createDataFrame([(1, "first\n" + base), (2, None), *((3 + i, f"own {i}\n{x}") for i, x in enumerate(group))], DOCS)
    assert line_dedup.links(docs)[1].count() == len(group) * (len(group) + 1)
    monkeypatch.setattr(line_dedup, "links", None)
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert kept == {1: "first\n" + base, 2: None} | {3 + i: f"own {i}" for i in range(len(group))}


def test_lattice_recall_and_groups(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(200, 32))
    b = a + 0.25 * rng.normal(size=a.shape)
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(a)] + [(1000 + i, [float(x) for x in v], i % 3) for i, v in enumerate(b)]
    rows += [(5000, rows[0][1], 0), (5001, None, 0), (5002, [0.0] * 32, 0), (5003, [float("nan")] * 32, 0), (5004, rows[0][1], None)]
    got = {r.vec_id: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    x = np.array([r[1] for r in rows[:401]], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[:401]])
    true = ((x @ x.T >= 0.93) & (label[:, None] == label[None])).sum(1) - 1
    links = np.array([got[r[0]].n_links for r in rows[:401]])
    assert (links <= true).all() and links.sum() >= 0.95 * true.sum() and true.sum() > 100
    assert all(got[i].n_links == 0 and got[i].kept for i in (5001, 5002, 5003, 5004)) and got[5000].component_id == 0


def test_bpe_equals_tiktoken(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "Hello  world's 123\n\n", "<|endoftext|> <unk>", "é漢字🙂 ▁", "a" * 5000]
    rng = random.Random(3)
    pieces = [" ", "  ", "\n", "\t", "'s", "'LL", "0123", "the", "ing", "tion", "Ünï", "漢", "🙂", "\u0301", "\u00a0", "\x00", "\x7f", "<|x|>", "▁", "é", "...", "--", "ﬁ", "\U0001F468\u200d\U0001F469"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["".join(chr(rng.choice((rng.randrange(1, 128), rng.randrange(128, 0x3000), rng.randrange(0xE000, 0x20000)))) for _ in range(80)) for _ in range(100)]
    got = {r.doc_id: r for r in byte_bpe.digests(byte_bpe.round_trip(spark.createDataFrame(list(enumerate(texts)), DOCS), path, public_tokenizers.PATTERN)).collect()}
    for i, t in enumerate(texts):
        ids = plain.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_contamination_matches_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice("the of and ü1 a b c d e f".split())
    items = [(1, " ".join(word() for _ in range(14))), (2, "Short ITEM of five words"), (3, None), (4, "..."), (10, " ".join(word() for _ in range(30)))]
    docs = []
    for i in range(30):
        text = " ".join(word() for _ in range(rng.randrange(40)))
        part = items[rng.choice((0, 1, 4))][1].split()
        cut = rng.randrange(len(part))
        docs.append((i, text + " " + " ".join(part[cut:] if i % 2 else part) + ", " + text.upper()))
    docs += [(90, None), (91, ""), docs[0]]
    split = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c if c.isdigit() and c < "\x80" or "a" <= c <= "z" or c >= "\x80" else " " for c in t or "").split(" ")
    words = lambda t: [w for w in split(t) if w]
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    joined = decontaminate.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), most_broadcast=0).collect()
    assert sorted(map(tuple, joined)) == sorted(map(tuple, got))
    by = {r.doc_id: r for r in got}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            x = words(it)
            n = min(10, len(x))
            wins = {tuple(x[j : j + n]) for j in range(len(x) - n + 1)} if n else set()
            for j in range(len(w) - n + 1):
                if n and tuple(w[j : j + n]) in wins:
                    hit.update(range(j, j + n))
                    found.add(str(item))
        assert (by[i].n_words, by[i].n_hit, by[i]["items"]) == (len(w), len(hit), sorted(found)), i


def test_licenses(spark):
    docs = [(1, "x Released under the MIT License. y"), (2, "Relased under the MIT Licence"), (3, None), (4, "permit licenses apache")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(docs, DOCS)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].base_labels, got[1].score) == (1, 4, "mit", 1.0)
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels) == (0, None, "", "mit") and 0 < got[2].score < 1
    assert (got[3].n_words, got[3].labels, got[3].score) == (0, "", 0.0) and got[4].labels == ""


def test_quality_learns_and_compiles(spark):
    rng = random.Random(3)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(40)) + "."
    rows = [(i, good() if i % 2 else "### " * 30 + str(i)) for i in range(300)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(5, None), (None, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, DOCS)
    model = rule_quality.train(docs, labels)
    got = rule_quality.scored(docs, model).collect()
    assert len(got) == 302 and all(r.predicted == r.doc_id % 2 for r in got if r.doc_id < 300)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert rule_quality.train(docs, labels.limit(0)).rules == ()


def test_url_rules_and_words(spark):
    rows = [(1, "https://A.example.org/es/1?x", ""), (2, "http://x.org/", ""), (3, "http://x.com/de/1", ""), (4, None, None), (5, "nothing", ""), (6, "http://y.net/redhouse", "<p>red house red house</p>")]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (got[2].rule, got[2].verdict, got[3].rule) == ("org/", "allow", "com/de/") and (got[4].host, got[5].path, got[6].rule) == ("", "", None)
    assert url_filter.viterbi("redhouse", {"red": 5, "house": 5}, 20) == ["red", "house"]


def test_keep_one_tells_texts_of_one_id_apart(spark):
    copy, other = "some words that stand in two documents", "quite another text of the same number"
    docs = spark.createDataFrame([(1, copy), (5, copy), (5, other)], DOCS)
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(1, copy), (5, other)]


def test_simhash_links_connect_what_brute_force_does(spark):
    rng = random.Random(4)
    fps = {rng.getrandbits(63) for _ in range(200)}
    for f in list(fps)[:100]:
        for _ in range(rng.randrange(1, 6)):
            f ^= 1 << rng.randrange(63)
        fps.add(f)
    centre = rng.getrandbits(63)
    group = {centre ^ sum(1 << i for i in rng.sample(range(63), rng.randrange(6))) for _ in range(300)}  # near copies, most within four bits
    fps = sorted(fps | group)
    root = {f: f for f in fps}

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4]
    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    want = {f: top(f) for f in fps}
    for blocks in (5, 6, 7, 9):
        found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), blocks=blocks)
        rows = {(r.fp_a, r.fp_b) for r in found.collect()}
        assert rows <= set(pairs) and found.count() == len(rows)
        got = {r.node: r.component_id for r in common.components(found.selectExpr("fp_a as src", "fp_b as dst")).collect()}
        assert {f: got.get(f, f) for f in fps} == want
    assert [simhash.blocks_for(n) for n in (0, 30_000, 1_000_000, 10**9, 10**10)] == [5, 5, 6, 7, 8]


@pytest.mark.parametrize("text", ["a b c", "One two THREE four five one two three four", "x"])
def test_simhash_fingerprint(text):
    w = text.lower().split()
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert simhash.fingerprint(text) % (1 << 64) == want and simhash.fingerprint(None) == 0
