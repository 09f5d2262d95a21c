"""URL filter: rules on host and path, then naive Bayes over words cut out of host and path names."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.common import LOWER, UPPER, checkpointed

#: Fixed values of the query: verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every row of ``pages``; both empty for a null url or one without ``://``."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_of(rules=RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is tried first, so it comes last
        fits = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def names(host: str = "host", path: str = "path") -> Column:
    """Array of structs (place, name): lower-case runs of letters of host and path."""

    def runs(column: str, place: str) -> Column:
        found = F.filter(F.split(F.lower(F.col(column)), r"[^\p{L}]+"), lambda x: x != "")
        return F.transform(found, lambda x: F.struct(F.lit(place).alias("place"), x.alias("name")))

    return F.concat(runs(host, "h"), runs(path, "p"))


def unigrams(pages: DataFrame) -> DataFrame:
    """word, n: how often each word stands in the pages' text (markup taken out), over all pages."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"<[^>]*>|&\w+;", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word") > 0).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable cut of ``name`` into words; an unknown piece of k letters has probability 10^-k / total.

    Of equal cuts the one with the longer last piece. The work is the name's length times the different lengths of
    the words in ``counts``.
    """
    sizes, one, ten = sorted({len(w) for w in counts}, reverse=True), math.log(total), math.log(10)
    best, fresh = [(0.0, 0)], 0  # fresh: the start of the best unknown piece that ends here
    for end in range(1, len(name) + 1):
        unknown = lambda start: best[start][0] - one - (end - start) * ten  # noqa: B023, E731
        if unknown(end - 1) > unknown(fresh):
            fresh = end - 1
        found = (unknown(fresh), fresh)
        for size in sizes:
            if size <= end and (n := counts.get(name[end - size : end])):
                log = best[end - size][0] + math.log(n / total)
                if log > found[0] or log == found[0] and end - size < found[1]:
                    found = (log, end - size)
        best.append(found)
    out, end = [], len(name)
    while end:
        out.append(name[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def segmented(distinct: DataFrame, words: DataFrame) -> DataFrame:
    """name, words for each row of ``distinct`` (name), with the unigram counts ``words`` (word, n).

    All substrings of a name that are as long as any word are joined with the counts, so no dictionary is held
    anywhere; a name has at most its length times the number of different word lengths of them.
    """
    total = words.agg(F.sum("n")).first()[0] or 1
    longest = distinct.agg(F.max(F.length("name"))).first()[0] or 0
    # word lengths up to the longest name: few, as texts of different long words are long
    sizes = sorted(r[0] for r in words.select(F.length("word").alias("k")).where(F.col("k") <= longest).distinct().collect())
    parts = distinct.select("name", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("k")).where(F.col("k") <= F.length("name"))
    parts = parts.select("name", "k", F.explode(F.sequence(F.lit(1), F.length("name") - F.col("k") + 1)).alias("at"))
    parts = parts.select("name", F.expr("substring(name, at, k)").alias("word")).distinct()
    known = parts.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(name: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(a, {x["word"]: x["n"] for x in ([] if b is None else b)}, total) for a, b in zip(name, known)])

    return distinct.join(known, "name", "left").select("name", cut("name", "known").alias("words"))


def judge(pages: DataFrame, rules=RULES, most_broadcast: int = 200_000, places: tuple[str, ...] = ("h", "p")) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of ``pages`` (page_id, url, html).

    The pages on which a rule decides are the training rows of the classifier; all others get its verdict:
    block where the log odds are above 0, else allow (also where no rule decides anywhere). score: the log
    odds, null where a rule decided. Null urls have no tokens and get the prior's verdict. Repeated rows are
    repeated, and count as often as they stand; null html has no words; an empty table gives no rows; other columns
    are not read. ``places``: tokens of hosts (h), paths (p) or both. Names and token weights are broadcast up to
    ``most_broadcast`` rows each, else joined by key.
    """

    def small(df: DataFrame) -> DataFrame:
        df = checkpointed(df)
        return F.broadcast(df) if df.count() <= most_broadcast else df

    name, verdict = rule_of(rules)
    split = split_url(pages).select("*", name.alias("rule"), verdict.alias("by_rule"))
    kinds = checkpointed(split.groupBy("host", "path", "by_rule").agg(F.count("*").alias("n")))
    named = kinds.select("*", F.explode(F.filter(names(), lambda x: x["place"].isin(*places))).alias("x")).select("host", "path", "by_rule", "n", "x.place", "x.name")
    cuts = small(segmented(named.select("name").distinct(), checkpointed(unigrams(pages))))
    tokens = named.join(cuts, "name").select("host", "path", "by_rule", "n", F.explode("words").alias("w"), "place")
    tokens = tokens.select("host", "path", "by_rule", "n", F.concat("place", F.lit(":"), "w").alias("token"))
    of = lambda says: F.sum(F.when(F.col("by_rule") == says, F.col("n")).otherwise(0))
    counts = checkpointed(tokens.groupBy("token").agg(of("allow").alias("a"), of("block").alias("b")))
    size, a, b = counts.agg(F.count("*"), F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))).first()
    prior_a, prior_b = kinds.agg(F.coalesce(of("allow"), F.lit(0)), F.coalesce(of("block"), F.lit(0))).first()
    prior = math.log((prior_b + 1) / (prior_a + 1))
    weights = small(counts.select("token", (F.log((F.col("b") + 1) / F.lit(float(b + size))) - F.log((F.col("a") + 1) / F.lit(float(a + size)))).alias("w")))
    odds = tokens.where("by_rule is null").join(weights, "token").groupBy("host", "path").agg(F.sum("w").alias("w"))
    # urls without host and path, of which there may be any number, have no tokens and need no join
    bare = (F.col("host") == "") & (F.col("path") == "")
    undecided = split.where("by_rule is null")
    open_ = undecided.where(~bare).join(odds, ["host", "path"], "left").unionByName(undecided.where(bare).withColumn("w", F.lit(None).cast("double")))
    score = F.round(F.coalesce("w", F.lit(0.0)) + prior, 9)  # sums may differ in their last digits
    judged = open_.select("page_id", "host", "path", "rule", F.when(score > 0, "block").otherwise("allow").alias("verdict"), score.alias("score"))
    ruled = split.where("by_rule is not null").select("page_id", "host", "path", "rule", F.col("by_rule").alias("verdict"), F.lit(None).cast("double").alias("score"))
    return ruled.unionByName(judged)
