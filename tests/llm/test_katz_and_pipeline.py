"""The language model and the whole pipeline against brute-force versions."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from clickloom.llm import katz, rule_quality, simhash
from clickloom.llm.katz import Discounts


def _texts(rng, n):
    words = ["w%d" % i for i in range(40)] + ["ÄB", "Cd"]
    weight = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words + [f"rare{i}"], [*weight, 0.3], k=rng.randrange(1, 60)))) for i in range(n)] + [(1000, None), (1001, ""), (1002, " \n")]


def _model(docs, order):
    """P(word | context) from the definitions, over dictionaries; a context is a tuple whose None is the start of a text."""
    split = lambda t: [*"".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split(), ""]
    train = [split(t) for d, t in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    uni = Counter(w for t in train for w in t)
    grams = defaultdict(Counter)
    for t in train:
        s = [None, *t]
        for i in range(1, len(s)):
            for k in range(1, min(order - 1, i) + 1):
                grams[tuple(s[i - k : i])][s[i]] += 1
    n = sum(uni.values())
    factors = [Discounts.of([sum(c == r for c in uni.values()) for r in range(1, 7)]).factors]
    factors += [Discounts.of([sum(c == r for h, g in grams.items() if len(h) == k for c in g.values()) for r in range(1, 7)]).factors for k in range(1, order)]
    less = lambda k, c: c * factors[k][c - 1] if c <= 5 else c
    low = {w: less(0, c) / n for w, c in uni.items()}
    unknown = 1 - sum(low.values())

    def p(context, word):
        if not context:
            return low.get(word, unknown)
        g, base = grams.get(context), p(context[1:], word)
        if g is None:
            return base
        own = {w: (c - 0.5 if all(x > 5 for x in g.values()) else less(len(context), c)) / sum(g.values()) for w, c in g.items()}
        return own[word] if word in own else base * (1 - sum(own.values())) / (1 - sum(p(context[1:], w) for w in g))

    return split, uni, n, unknown, p


def test_katz_equals_brute_force_whatever_the_order_and_blocks(spark):
    docs = _texts(random.Random(5), 120)
    for order, size in ((2, 150), (3, 150), (3, 3_000_000), (4, 400)):
        split, uni, n, unknown, p = _model(docs, order)
        assert unknown > 0
        for context in [(None,), ("w0",), ("w3", "w0"), ("never", "w1"), (None, "w2"), ("w0", "w0", "w1")]:
            context = context[-(order - 1) :]
            assert math.isclose(sum(p(context, w) for w in [*uni, "<other>"]), 1, abs_tol=1e-12)
        got = {r.doc_id: r for r in katz.score(spark.createDataFrame(docs, "doc_id long, text string"), order, size).collect()}
        assert len(got) == len(docs)
        for d, t in docs:
            w, r = split(t), got[d]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(d).encode()) % 5 == 1, len(w), sum(x in uni for x in w), n)
            assert math.isclose(r.base_score, sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (len(uni) + 1))) for x in w), rel_tol=1e-9)
            s = [None, *w]
            want = sum(math.log10(p(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in range(1, len(s)))
            assert math.isclose(r.score, want, rel_tol=1e-9), (order, d, size)
    assert katz.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_katz_takes_every_id(spark):
    docs = [(-(1 << 63), "a b"), (None, "a b"), (0, "c")]
    got = {r.doc_id: r.n_tokens for r in katz.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {-(1 << 63): 3, None: 3, 0: 2}


def test_katz_deals_a_frequent_context_to_many_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(katz, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    docs = spark.createDataFrame([(i, f"w{i} x") for i in range(4000)], "doc_id long, text string").repartition(4)
    assert katz.score(docs, 3, 500).count() == 4000
    sizes = [len(katz._unzip(r.columns[0], "u8", True)) for r in spark.read.parquet(f"{tmp_path}/katz/ngrams").where("kind = 'grams'").collect()]
    assert len(sizes) >= 16 and sum(sizes) > 6000 and max(sizes) < 4 * sum(sizes) / len(sizes)


def _one_edit(a, b):
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    k = next((i for i in range(len(b)) if a[i] != b[i]), len(b))
    return a[k + 1 :] == b[k + (len(a) == len(b)) :]


def _tables(rng):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    line = lambda: " ".join(word() for _ in range(rng.randrange(6, 12))) + "."
    bench = [(i, " ".join(word() for _ in range(25))) for i in range(4)]
    docs = [(i, "\n".join(line() for _ in range(rng.randrange(3, 8)))) for i in range(60)]
    docs += [(100 + i, docs[i][1]) for i in range(6)]  # copies
    docs += [(110 + i, docs[i][1][:30] + "x" + docs[i][1][31:]) for i in range(6)]  # copies but for a letter
    docs += [(120 + i, docs[20 + i][1] + "\n" + docs[40][1].split("\n")[0]) for i in range(4)]  # a shared line, too
    docs += [(130 + i, line() + "\nso " + bench[i][1] + " there\n" + line()) for i in range(3)]
    docs += [(140 + i, "### 99 $$ " * 12 + f"\n%% {i} ##") for i in range(40)]
    docs += [(200, None), (201, ""), (202, "short\n" + docs[50][1].split("\n")[0])]
    labels = [(d, 0 if 140 <= d < 200 else 1) for d, t in docs if t]
    return docs, bench, labels


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs, bench, labels = _tables(random.Random(6))
    full = [(d, t, "en", "web", len(t or "")) for d, t in docs]
    table = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(d, q, 0) for d, q in labels], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    model = rule_quality.train(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = []
    for d, t in docs:
        s = dict(zip(rule_quality.STATISTICS, rule_quality.statistics(t)))
        z = model.bias + sum(r.weight for r in model.rules if all((s[c] > at) == up for c, up, at in r.conditions))
        if 1 / (1 + math.exp(-z)) >= 0.5:
            kept.append((d, t))
    assert not any(140 <= d < 200 for d, _ in kept) and {d for d, _ in kept} >= set(range(60))

    first, places = {}, []
    for d, t in sorted(kept):
        for at, x in enumerate(t.split("\n") if t is not None else []):
            if len(x.strip(" ")) >= 24:
                places.append((x.strip(" "), d, at))
                first.setdefault(x.strip(" "), (d, at))
    near = {x: any(first[y] < first[x] and _one_edit(x, y) for y in first) for x in first}
    gone = {(d, at) for x, d, at in places if first[x] != (d, at) or near[x]}
    kept = [(d, t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)) for d, t in kept]

    fps = {d: simhash.fingerprint(t) % (1 << 64) for d, t in kept}
    root = {d: d for d in fps}
    for _ in range(len(fps)):
        before = dict(root)
        for a in fps:
            root[a] = min(root[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4)
        if root == before:
            break
    kept = [(d, t) for d, t in kept if root[d] == d]

    windows = {tuple(w[i : i + 10]) for w in (x.split() for _, x in bench) for i in range(len(w) - 9)}
    words = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    leaks = {d for d, t in kept if any(tuple(words(t)[i : i + 10]) in windows for i in range(len(words(t)) - 9))}
    assert leaks == {130, 131, 132}
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: (plain.encode_ordinary(t or ""), t or "") for d, t in kept if d not in leaks}
    assert set(got) == set(want) and set(range(60)) <= set(got) and not set(range(100, 116)) & set(got) - {100}
    for d, (ids, t) in want.items():
        assert (got[d].n_tokens, got[d].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_take_empty_tables_and_other_columns(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, None, "a", 1, 1), (2, "", "b", 2, 2), (2, "", "b", 2, 2), (None, "some text", None, None, None)]
    schema = "doc_id long, text string, line string, n long, component_id long"
    for data in (rows, []):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, spark.createDataFrame(data, schema), str(tmp_path))
            assert out.columns == ["doc_id", "text", "line", "n", "component_id"], name
            # the empty texts are one group, of which the smallest id stays
            assert out.count() == (0 if not data else 2 if name == "near_duplicates" else len(data)), name


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Names that stages use inside, a name with a dot and one with a backtick: values come out as they went in."""
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    names = ["_stats", "_dropped", "_D_doc", "_d_th", "_g_doc", "_g_th", "a.b", "c`d", "th", "fp", "pos", "dropped"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = [(i, t, *(f"{i} {n}" for n in names)) for i, t in enumerate(["a plain text of a few words here", "another text, quite unlike the first", None])]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, spark.createDataFrame(rows, schema), str(tmp_path))
        assert out.columns == ["doc_id", "text", *names] and sorted(map(tuple, out.collect())) == rows, name
