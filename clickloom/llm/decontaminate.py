"""Benchmark decontamination by winnowing: shared fingerprints are joined and extended, all in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import LOWER, UPPER, checkpointed, columns_of, let, unused

#: Words in a window whose every occurrence is found.
WINDOW = 10
#: Words hashed together. A window holds WINDOW - GRAM + 1 grams, and its smallest is a fingerprint.
GRAM = 5
#: Documents with a meeting up to which their ids (16 bytes each) are broadcast to find their texts.
MOST_IDS = 500_000


def words_of(text: str) -> Column:
    """Runs of a-z, 0-9 and code points from 128 on, A-Z lower-cased; none for a null text."""
    given = F.coalesce(F.col(text), F.lit(""))
    plain = F.octet_length(given) == F.length(given)  # without other letters lower() is the same and faster
    low = F.when(plain, F.lower(given)).otherwise(F.translate(given, UPPER, LOWER))
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def gram_hashes(words: Column, size: int) -> Column:
    """Hash of each run of ``size`` words; empty for fewer words."""

    def grams(h: Column) -> Column:
        starts = F.when(F.size(h) >= size, F.sequence(F.lit(0), F.size(h) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))

    # bound once: a plain expression would be computed again for every element
    return let(F.transform(words, lambda w: F.xxhash64(w)), grams)


def winnow(grams: Column, width: int) -> Column:
    """Distinct smallest hashes of all runs of ``width`` grams: any shared run of grams that long shares one of them."""
    if width == 1:
        return F.array_distinct(grams)
    starts = F.when(F.size(grams) >= width, F.sequence(F.lit(0), F.size(grams) - width)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.least(*[F.get(grams, i + j) for j in range(width)])))


def places(words: Column, fingerprint: Column, size: int) -> Column:
    """Starts of the grams with this hash."""
    return let(gram_hashes(words, size), lambda g: F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda p: F.get(g, p) == fingerprint))


def _index(items: DataFrame, gram: int, window: int) -> DataFrame:
    """fp, item_id, q, ctx: each place of an item's fingerprints, with the words up to window - gram around it (q: place in ctx)."""
    around = window - gram
    fps = items.select("item_id", "words", F.explode_outer(let(gram_hashes(F.col("words"), gram), lambda g: winnow(g, around + 1))).alias("fp"))
    at = fps.where("fp is not null").select("item_id", "words", "fp", F.explode(places(F.col("words"), F.col("fp"), gram)).alias("p"))
    lo = F.greatest(F.col("p") - around, F.lit(0))
    return at.select("fp", "item_id", (F.col("p") - lo).alias("q"), F.slice("words", lo + 1, F.lit(gram + 2 * around)).alias("ctx")).distinct()


def _hits(docs: DataFrame, index: DataFrame, gram: int, window: int, small: bool) -> DataFrame:
    """doc_id, th, n_words, lo, hi, item_id: for each row of ``docs`` one row without item, and one for each run of shared words."""
    around = window - gram
    prints = let(words_of("text"), lambda w: F.struct(F.size(w).alias("n"), let(gram_hashes(w, gram), lambda g: winnow(g, around + 1)).alias("f")))
    # n_words travels as the first entry, so that every document has a row and its words are cut once
    entries = let(prints, lambda x: F.concat(F.array(F.struct(F.lit(True).alias("head"), x["n"].cast("long").alias("v"))), F.transform(x["f"], lambda f: F.struct(F.lit(False).alias("head"), f.alias("v")))))
    whole = F.struct("text", "fp", "q", "ctx")
    if small:
        each = docs.select("doc_id", "text", F.explode_outer(entries).alias("e")).select("doc_id", "text", "e.head", "e.v")
        met = each.join(F.broadcast(index), (F.col("v") == F.col("fp")) & ~F.col("head"), "left").where("head or fp is not null")
        found = met.select("doc_id", F.xxhash64("text").alias("th"), F.when(F.col("head"), F.col("v")).alias("n_words"), "item_id", F.when(~F.col("head"), whole).alias("m"))
    else:
        found = _met_by_key(docs, index, prints, whole)

    def extend(w: Column, m: Column, p: Column) -> Column:
        same = lambda j: F.coalesce(F.get(w, p + j) == F.get(m["ctx"], m["q"] + j), F.lit(False))
        whole = F.lit(True)
        for j in range(gram):
            whole = whole & same(j)
        left, right = F.lit(0), F.lit(0)
        for k in range(around, 0, -1):  # nested, the nearest word outermost
            left = F.when(same(-k), 1 + left).otherwise(0)
            right = F.when(same(gram - 1 + k), 1 + right).otherwise(0)
        run = F.struct(left.alias("l"), right.alias("r"))
        return let(run, lambda x: F.when(whole & (x["l"] + x["r"] >= around), F.struct((p - x["l"]).alias("lo"), (p + gram + x["r"]).alias("hi"))))

    m = F.col("m")
    spans = let(words_of("m.text"), lambda w: F.transform(places(w, m["fp"], gram), lambda p: extend(w, m, p)))
    spans = F.when(m.isNotNull(), F.filter(spans, lambda s: s.isNotNull()))
    rows = found.select("doc_id", "th", "n_words", "item_id", F.explode_outer(spans).alias("s"))
    return rows.where("n_words is not null or s is not null").select("doc_id", "th", "n_words", "item_id", "s.lo", "s.hi")


def _met_by_key(docs: DataFrame, index: DataFrame, prints: Column, whole: Column) -> DataFrame:
    """What ``_hits`` extends, for an index that is joined: fingerprints travel with the document's id and hash, and only texts that meet an item travel, once."""
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    heads = named.select("doc_id", "th", F.size(words_of("text")).cast("long").alias("n_words"))
    met = checkpointed(named.select("doc_id", "th", F.explode(prints["f"]).alias("v")).join(index, F.col("v") == F.col("fp")).select("doc_id", "th", "fp", "item_id", "q", "ctx").distinct())
    ids = met.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).distinct()
    few = ids.count() <= MOST_IDS
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))
    texts = named.join(F.broadcast(ids) if few else ids, same, "left_semi").groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th")).agg(F.first("text").alias("text"))
    ends = met.join(texts, same).select("doc_id", "th", F.lit(None).cast("long").alias("n_words"), "item_id", whole.alias("m"))
    return heads.select("*", F.lit(None).cast("string").alias("item_id"), F.lit(None).cast(ends.schema["m"].dataType).alias("m")).union(ends)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, most_broadcast: int = 200_000) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, th, n_words, n_hit, items (sorted item_ids as text).

    A document word is hit inside any occurrence of ``window`` consecutive words of an item of ``benchmark``
    (item_id, text), or of the whole item if it has fewer. Winnowing keeps the smallest gram hash of every
    window on both sides, so every shared window shares a fingerprint; each meeting is compared word by word
    and extended to both sides. Items shorter than a window get grams of their own length, all kept.
    The index is broadcast up to ``most_broadcast`` fingerprints, else joined by fingerprint. Null texts have
    no words; null or empty items have no windows; items that repeat an id are one item. Rows that repeat a
    doc_id and text get one result each.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of("text").alias("words")).where(F.size("words") > 0)
    items = checkpointed(items.where("item_id is not null"))
    lengths = [(window, gram)] + [(r[0], r[0]) for r in items.where(F.size("words") < window).select(F.size("words")).distinct().collect()]
    hits = None
    for size, part in lengths:
        chosen = items.where(F.size("words") >= window) if size == window else items.where(F.size("words") == size)
        index = checkpointed(_index(chosen, part, size))
        rows = _hits(docs.select("doc_id", "text"), index, part, size, index.count() <= most_broadcast)
        hits = rows if hits is None else hits.union(rows.where("n_words is null"))
    ranges = hits.groupBy("doc_id", "th").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("copies"),
        F.collect_set(F.when(F.col("lo").isNotNull(), F.struct("lo", "hi"))).alias("spans"),
        F.collect_set(F.when(F.col("lo").isNotNull(), F.col("item_id"))).alias("items"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["lo"], s["hi"] - 1)))))
    out = ranges.select("doc_id", "th", F.greatest("n_words", F.lit(0)).alias("n_words"), covered.cast("long").alias("n_hit"), F.array_sort("items").alias("items"), "copies")
    return out.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("copies", "_copy")


def clean(docs: DataFrame, benchmark: DataFrame, least_share: float = 0.0) -> DataFrame:
    """``docs`` without the documents whose share of hit words is above ``least_share`` (stage of the corpus pipeline).

    Null texts have no words and stay; null ids are judged as others; repeated rows go or stay together; an empty
    table gives no rows; other columns are handed on as they are.
    """
    doc, th = unused(docs, "_g_doc"), unused(docs, "_g_th")
    found = contamination(docs, benchmark).where("n_hit > 0").where(F.col("n_hit") > least_share * F.col("n_words"))
    gone = found.select(F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left_anti").select(*columns_of(docs))
