"""SimHash near-duplicates: fingerprints, pigeonhole block join, connected groups."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import LOWER_TABLE, checkpointed, columns_of, components, map_columns, unused


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of the word shingles (repeats included) of a whole text; 0 without words.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. Fewer words than a shingle: their
    sequence is the only shingle. A bit is set where more than half of the XXH64 values (seed 42) have it.
    """
    words = (text or "").encode().translate(LOWER_TABLE).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        values = [xxhash.xxh64_intdigest(line, 42)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        start, view, digest = end - size, memoryview(line), xxhash.xxh64_intdigest
        values = [digest(view[a:b], 42) for a, b in zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist())]
    count = np.zeros(64, np.int64)
    hashes = np.array(values, np.uint64).view(np.uint8).reshape(-1, 8)
    for at in range(0, len(hashes), 65536):  # keeps the unpacked bits of a very long text small
        count += np.unpackbits(hashes[at : at + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, th, fp (longs) for every row of ``docs`` (doc_id, text); th: hash of the text. Null and empty texts get fp 0."""
    return map_columns(
        docs.select("doc_id", F.xxhash64("text").alias("th"), "text"),
        lambda ids, hashes, texts: {"doc_id": ids, "th": hashes, "fp": [fingerprint(t, shingle) for t in texts]},
        "doc_id long, th long, fp long",
    )


def _mask(block: int, blocks: int) -> int:
    lo, hi = 64 * block // blocks, 64 * (block + 1) // blocks
    value = (1 << hi) - (1 << lo)
    return value - (1 << 64) if value >= 1 << 63 else value


#: Keys shared by several values up to which they are broadcast (32 bytes each).
MOST_KEYS = 200_000


def links(fps: DataFrame, bits: int = 4, blocks: int = 7) -> DataFrame:
    """fp_a < fp_b of distinct values ``fp`` that differ in at most ``bits`` bits: enough links to connect all such pairs, each once.

    Pigeonhole: the 64 bits are cut into ``blocks`` blocks; two values at most ``bits`` apart agree on at least
    ``blocks - bits`` of them, so each choice of that many blocks is a table whose key is the bits of the chosen
    blocks. More blocks mean more tables of longer keys (7: 35 tables, 27 bits) and so fewer chance meetings;
    ``blocks_for`` finds what a number of values needs. Of the values of one key, all near the smallest are linked to
    it and thereby to each other; only those that are not near it are compared with the others. So a large group of
    near copies gives a link for each value and not for each pair.
    """
    if not bits < blocks <= 16:
        raise ValueError("blocks must exceed bits")
    masks = [[_mask(b, blocks) for b in c] for c in combinations(range(blocks), blocks - bits)]
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_or(m))).alias("key")) for t, m in enumerate(masks)))
    keyed = fps.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    shared = checkpointed(keyed.groupBy("t", "key").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = checkpointed(keyed.join(F.broadcast(shared) if shared.count() <= MOST_KEYS else shared, ["t", "key"]))
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= bits
    to_least = rows.where(near("least", "fp") & (F.col("fp") != F.col("least"))).select(F.col("least").alias("fp_a"), F.col("fp").alias("fp_b"))
    rest = rows.where(~near("least", "fp")).select("t", "key", F.col("fp").alias("far"))
    others = rest.join(rows.select("t", "key", "fp"), ["t", "key"]).where(near("far", "fp") & (F.col("far") != F.col("fp")))
    return to_least.union(others.select(F.least("far", "fp"), F.greatest("far", "fp"))).distinct()


def blocks_for(values: int, bits: int = 4) -> int:
    """The fewest blocks whose keys are shared by about eight of ``values`` values at most by chance (all give the same pairs)."""
    blocks = bits + 1
    while blocks < 16 and values >> (64 // blocks * (blocks - bits)) > 8:
        blocks += 1
    return blocks


def _or(masks: list[int]) -> int:
    out = 0
    for m in masks:
        out |= m
    return out


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, blocks: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, th, fp, component_id (smallest doc_id reachable by links).

    Only distinct fingerprints enter the block join, so any number of exact copies costs one row there. A null
    doc_id keeps its row and never names a group; a group of only null ids has component_id null. Repeated rows
    are returned repeatedly with one result. An empty table gives no rows. The number of ``blocks`` follows that of
    the distinct fingerprints, if not given.
    """
    fps = checkpointed(fingerprints(docs, shingle))  # read twice below, computed once
    classes = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    pairs = links(classes.select("fp"), bits, blocks or blocks_for(classes.count(), bits))
    linked = components(pairs.select(F.col("fp_a").alias("src"), F.col("fp_b").alias("dst")))
    of = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component_id", "fp").alias("root")
    )
    lowest = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    return fps.join(of.join(lowest, "root").select("fp", "component_id"), "fp").select("doc_id", "th", "fp", "component_id")


def keep_one(docs: DataFrame, bits: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` without those whose group holds a smaller doc_id (stage of the corpus pipeline).

    Rows with a null doc_id stay. Rows are told apart by doc_id and text, so other texts of a dropped doc_id stay.
    Null and empty texts are one group; repeated rows of the smallest id all stay; an empty table gives none.
    """
    doc, th = unused(docs, "_g_doc"), unused(docs, "_g_th")
    found = near_duplicates(docs.select("doc_id", "text"), shingle, bits).where("doc_id <> component_id")
    gone = found.select(F.col("doc_id").alias(doc), F.col("th").alias(th)).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left_anti").select(*columns_of(docs))
