"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe, decontaminate, html_text, katz, lattice, license_scan, line_dedup, rule_quality, secrets, simhash, trie, url_filter, vector_codes
from clickloom.llm.common import table


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null and empty pages give an empty text, repeated rows are repeated. An empty table gives no rows."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that stand, or nearly stand, earlier, and the classes of near lines; null and empty texts have none. An empty table gives no rows."""
    return line_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"), least_chars=24, marks="classes")


def op3_lattice_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.93 within labels and their components; odd vectors link with nothing, copies are one vector. An empty table gives no rows."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), 0.93)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text and their round trip; null texts count as empty. An empty table gives no rows."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    trip = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.digests(trip)


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text by a trigram model of the others; null texts count as empty. An empty table gives no rows."""
    return katz.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item; null texts have no words. An empty table gives no rows."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    items = F.size("items").cast("long")
    return found.select("doc_id", "n_words", "n_hit", items.alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every text; null texts count as empty. An empty table gives no rows."""
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text")).withColumn("spans", F.to_json("spans"))


def op8_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by rules learned from labelled ones; null texts count as empty. An empty table gives no rows."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = rule_quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rule_quality.scored(docs, model)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url; null and odd urls have empty host and path. An empty table gives no rows."""
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; null and empty texts have fingerprint zero. An empty table gives no rows."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    # conv gives the unsigned value of a negative long
    return found.select("doc_id", F.lower(F.lpad(F.conv(F.col("fp").cast("string"), 10, 16), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations; rows without conv_id are left out. An empty table gives no rows."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of every vector that can be cut; others are left out. An empty table gives no rows."""
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets of every text; null texts count as empty. An empty table gives no rows."""
    return secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_html_text, op2_line_dedup, op3_lattice_near_dup, op4_byte_bpe, op5_katz, op6_winnowing, op7_license_scan, op8_rule_quality, op9_url_filter, op10_simhash, op11_prefix_trie, op12_vector_codes, op13_secrets)}

_WORDS = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: crc32 of a text of ASCII characters, bit by bit.
_CRC32 = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda x: ord(x)::BIGINT)), lambda a, x: "
    "list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, y: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))))"
)



def _lloyd(rounds: int) -> str:
    """SQL of the fitted vector codes: one assignment and one update for each round, as the contract has them, without bounds."""
    near = "list_inner_product(y, y) - 2 * list_inner_product(y, c) + list_inner_product(c, c)"  # whole numbers in doubles: exact
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, p.part, min((({near})::BIGINT, entry)) AS best FROM p JOIN c{i} USING (part) GROUP BY r, p.part)")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
  SELECT part, entry, list(v ORDER BY i) AS c FROM (SELECT part, best[2] AS entry, i, floor(sum(y[i]) / count(*)) AS v
    FROM (SELECT a.part, a.best, y, unnest(range(1, len(y) + 1)) AS i FROM a{i} a JOIN p USING (r, part)) GROUP BY ALL) GROUP BY part, entry) n ON n.part = o.part AND n.entry = o.entry)""")
    return ",\n".join(steps)


#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op6_winnowing": f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format("text")} AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM s)),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT d.*, z.size, unnest(range(1, len(w) - z.size + 2)) AS i FROM d, (SELECT DISTINCT size FROM s) z)),
h AS (SELECT doc_id, item_id, i, dw.size FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
""",
    "op11_prefix_trie": f"""
WITH o AS (SELECT conv_id AS c, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS g, strlen(coalesce(text, '')) AS b,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT DISTINCT c, {_CRC32.format("CAST(c AS VARCHAR)")} % 9 AS h, c - c % 5 AS d FROM o),
m AS (SELECT k.c, i, g, b FROM k JOIN o ON o.c = k.d AND i < h UNION ALL SELECT k.c, i, g, b FROM k JOIN o ON o.c = k.c AND i >= h),
s AS (SELECT c, b, row_number() OVER (PARTITION BY c ORDER BY i) AS depth, string_agg(g, '') OVER (PARTITION BY c ORDER BY i) AS prefix, count(*) OVER (PARTITION BY c) AS size FROM m),
p AS (SELECT c, depth, sha256(prefix) AS node, b, size FROM s
      UNION ALL SELECT c, 0, '', 0, coalesce(size, 0) FROM k LEFT JOIN (SELECT DISTINCT c, size FROM s) USING (c)),
n AS (SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(b) AS b, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = depth), '') AS ends
      FROM p GROUP BY node, depth),
a AS (SELECT n.node, n.depth, n.conv_id, n.n_convs, n.ends, q.conv_id AS parent_conv_id
      FROM n LEFT JOIN p ON p.c = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n q ON q.node = p.node AND q.depth = p.depth),
ch AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM a WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (conv_id, depth)),
t AS (SELECT p.node, p.depth, count(*) FILTER (f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.b) AS saved_tokens
      FROM f JOIN p ON p.c = f.conv_id AND p.depth <= f.depth GROUP BY ALL)
SELECT CAST(f.conv_id AS BIGINT) AS conv_id, CAST(f.depth AS BIGINT) AS depth, CAST(parent_conv_id AS BIGINT) AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN a USING (node, depth) JOIN t USING (node, depth)
""",
    "op12_vector_codes": f"""
WITH g AS (SELECT vec_id, label, embedding FROM embeddings WHERE len(embedding) > 0 AND len(embedding) % 4 = 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r
     FROM g WHERE len(embedding) = (SELECT len(embedding) FROM g ORDER BY vec_id NULLS LAST, embedding LIMIT 1)),
p AS MATERIALIZED (SELECT r, part, q[part * len(q) // 4 + 1:(part + 1) * len(q) // 4] AS y FROM (SELECT *, unnest(range(4)) AS part FROM v)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, y AS c FROM p WHERE r <= 256),
{_lloyd(4)},
e AS (SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1]) AS error FROM a4 GROUP BY r),
s AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry)) AS h FROM c4)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN e USING (r), s
""",
}
