"""Near-duplicate lines within a few edits: segment partition join, bit-parallel filter, banded distances.

All in DataFrame functions. Where each line has many keys, they are exploded rows with plain expressions, which Spark
compiles; functions over nested arrays would be interpreted (over five times the processor time, see the README).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import checkpointed, columns_of, components, let, shared_dir, unused


def stripped(line: str | Column) -> Column:
    """A line without ASCII white space at its ends."""
    return F.trim(line, F.lit(" \t\r\x0b\x0c"))


def occurrences(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, th, pos, n, h1, h2, line of each line of at least ``least_chars`` code points.

    Lines are split at newlines and taken without ASCII white space at their ends. th: hash of the whole text;
    h1, h2: 128 bits that stand for the line. Null texts have no lines.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = lines.select("doc_id", "th", "pos", stripped("raw").alias("line")).select("*", F.length("line").alias("n"))
    return lines.where(F.col("n") >= least_chars).select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


#: Without a fixed number of edits, one is allowed for each SPAN characters of the longer line, from 1 to MOST.
SPAN, MOST = 32, 8


def allowed(length: Column, edits: int | None) -> Column:
    """Edits allowed for a pair whose longer line has ``length`` characters: ``edits``, or a number that grows with it."""
    if edits is not None:
        return F.lit(edits)
    return F.greatest(F.lit(1), F.least(F.lit(MOST), F.floor(length / SPAN).cast("int")))


def _places(edits: int, probe: bool) -> list[tuple[int, int, int]]:
    """(side, segment from that side, shift) of a line's own segments, or of the substrings that it probes."""
    own = [(side, i) for side in (0, 1) for i in range((edits + 2 - side) // 2)]
    return [(side, i, s) for side, i in own for s in (range(-i, i + 1) if probe else (0,))]


def _places_of(edits: int, probe: bool) -> Column:
    """``_places`` as an array of structs."""
    return F.array(*(F.struct(F.lit(side).alias("side"), F.lit(i).alias("i"), F.lit(s).alias("s")) for side, i, s in _places(edits, probe)))


def _chars(line: str) -> Column:
    """Four bytes for each code point of a line, so that parts are cut without a walk from its start."""
    return F.encode(line, "UTF-32").alias("chars")


def segment_keys(lines: DataFrame, edits: int | None) -> DataFrame:
    """key, id, n, kind, k0, k1 of the segments of ``lines`` (id, line); kind: 1 a line's own segment, 2 a substring that it probes, 3 both.

    k0, k1: keys of the line's first and last segment in the band.

    Lines meet in bands of length, in which e edits are allowed. e + 1 segments of one width, as many from the start
    of a line as from its end (one more at the start), are disjoint in each line of the band and in those at most e
    shorter, which have segments there, too. Of two lines at most e edits apart, the edits are fewer than the segments
    on one of the sides; there, the first segment before which no more edits than segments stand is whole, and is
    shifted by as many at most. So segment i is probed at i places to each side, whatever the other line's length.
    A key hashes band, side, segment number and characters; equal keys by chance are verified away.
    """
    rows = lines.select("id", _chars("line")).select("*", (F.octet_length("chars") / 4).cast("int").alias("n"))
    # the width of a band of lengths: four bands an octave, none narrower than the edits allowed
    wide = F.greatest(F.lit((edits or 1).bit_length()), F.length(F.bin("n")) - 3)
    rows = rows.select("*", F.call_function("shiftleft", F.lit(1), wide).alias("step")).select("*", (F.col("n") - F.col("n") % F.col("step")).alias("band"))
    above = F.col("band") + F.col("step")  # the next band, of which a line is the shorter partner if it is near enough
    in_band = lambda band, probe: F.struct(band.alias("band"), F.lit(probe).alias("probe"))
    own, next_one = in_band(F.col("band"), True), in_band(above, False)
    bands = F.when(F.col("n") >= above - allowed(above, edits), F.array(own, next_one)).otherwise(F.array(own))
    rows = rows.select("id", "chars", "n", F.inline(bands)).select("*", allowed(F.col("band"), edits).alias("e"))
    rows = rows.select("*", F.floor((F.col("band") - F.col("e")) / (F.col("e") + 1)).cast("int").alias("width"))
    ends = [F.xxhash64(F.substring("chars", at * 4 + 1, F.col("width") * 4), F.col("band"), F.lit(side), F.lit(0)).alias(f"k{side}") for side, at in ((0, F.lit(0)), (1, F.col("n") - F.col("width")))]
    rows = rows.select("*", *ends)
    # the segments of fewer edits are among those of the most
    rows = rows.select("*", F.inline(_places_of(MOST if edits is None else edits, True))).where((F.col("probe") | (F.col("s") == 0)) & (F.col("i") < F.floor((F.col("e") + 2 - F.col("side")) / 2)))
    first = F.when(F.col("side") == 0, F.col("i") * F.col("width")).otherwise(F.col("n") - (F.col("i") + 1) * F.col("width")) + F.col("s")
    rows = rows.select("*", first.alias("first")).where((F.col("first") >= 0) & (F.col("first") + F.col("width") <= F.col("n")))
    key = F.xxhash64(F.substring("chars", F.col("first") * 4 + 1, F.col("width") * 4), F.col("band"), F.col("side"), F.col("i"))
    kind = F.when(~F.col("probe"), 1).when(F.col("s") == 0, 3).otherwise(2)
    return rows.select(key.alias("key"), "id", "n", kind.alias("kind"), "k0", "k1")


#: Longs of a line's bit vector.
LONGS = 8


def bit_vectors(lines: DataFrame) -> DataFrame:
    """id, v0, v1, ... of ``lines`` (id, line): 64 * LONGS bits, each the parity of the number of a line's bigrams that hash to it.

    An edit takes two bigrams away and adds two at most, so it flips at most four bits.
    """
    rows = lines.select("id", _chars("line")).select("id", "chars", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.octet_length("chars") / 4).cast("int") - 2))).alias("at"))
    rows = rows.select("id", F.pmod(F.xxhash64(F.substring("chars", F.col("at") * 4 + 1, F.lit(8))), F.lit(64 * LONGS)).cast("int").alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % 64)
    return rows.groupBy("id").agg(*(F.bit_xor(F.when(F.floor(F.col("bit") / 64) == k, one).otherwise(F.lit(0).cast("long"))).alias(f"v{k}") for k in range(LONGS)))


def _met(lines: DataFrame, edits: int | None, most_broadcast: int) -> DataFrame:
    """The ``segment_keys`` of ``lines`` (id, line) whose key stands twice at least.

    Keys are counted first, alone; only rows of a key that stands twice are then joined. Those keys are broadcast up
    to ``most_broadcast``, else joined.
    """
    shared = checkpointed(segment_keys(lines, edits).groupBy("key").count().where("count > 1").select("key"))
    return checkpointed(segment_keys(lines, edits).join(_small(shared, shared.count(), most_broadcast), "key", "left_semi"))


def _bits_of(lines: DataFrame, met: DataFrame, most_broadcast: int) -> DataFrame:
    """``bit_vectors`` of the ids of ``met``, to be joined by id."""
    ids = checkpointed(met.select("id").distinct())
    bits = checkpointed(bit_vectors(lines.join(_small(ids, ids.count(), most_broadcast), "id", "left_semi")))
    return _small(bits, bits.count(), most_broadcast // 4)


def _meetings(met: DataFrame, edits: int | None, also: Column | None = None) -> DataFrame:
    """a < b (ids): pairs of ``met`` (with bits) in which one line's own segment is probed by another, no shorter line and that may be near by their bits, each once."""
    a, b = met.where("kind <> 2").alias("a"), met.where("kind <> 1").alias("b")
    most = allowed(F.col("b.n"), edits)
    near = (F.col("b.n") - F.col("a.n")).between(0, most)  # the longer line probes
    flips = sum((F.bit_count(F.col(f"a.v{k}").bitwiseXOR(F.col(f"b.v{k}"))) for k in range(LONGS)), F.lit(0))
    meets = (F.col("a.key") == F.col("b.key")) & near & ((F.col("a.n") < F.col("b.n")) | (F.col("a.id") < F.col("b.id")))
    # lines of one start, or else of one end, meet there only
    meets &= (F.col("a.key") == F.col("a.k0")) | ((F.col("a.k0") != F.col("b.k0")) & ((F.col("a.key") == F.col("a.k1")) | (F.col("a.k1") != F.col("b.k1"))))
    both = a.join(b, meets & (flips <= most * 4) if also is None else meets & also & (flips <= most * 4))
    return both.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def candidates(lines: DataFrame, edits: int | None, most_broadcast: int = 2_000_000) -> DataFrame:
    """a < b (ids): pairs of ``lines`` (id, line; all different) that share a segment and may be near by their bits, each once.

    Lines that share much but are too far apart, as the copies of one line with several other words, differ in too
    many bits and give no row. Adaptive execution splits a key that very many lines share.
    """
    met = _met(lines, edits, most_broadcast)
    return _meetings(met.join(_bits_of(lines, met, most_broadcast), "id"), edits)


#: Lengths tried, one after the other, for the common start and end of two lines; what is left of those stays.
TRIED = (1024, 512, 256, 128, 64, 32, 16, 8)


def _distances(pairs: DataFrame, edits: int | None) -> DataFrame:
    """``pairs`` with ``apart``, the edits between a_line and b_line or -1 beyond the limit: banded distance of what most of their common start and end leave."""
    rows = pairs.withColumns({"_a": _chars("a_line"), "_b": _chars("b_line")})
    rows = rows.withColumns({"_n": (F.octet_length("_a") / 4).cast("int"), "_m": (F.octet_length("_b") / 4).cast("int"), "_start": F.lit(0), "_end": F.lit(0)})
    least, taken = F.least("_n", "_m"), F.col("_start") + F.col("_end")
    for of in ("_start", "_end"):
        for size in TRIED:
            part = lambda c, n: F.substring(c, (F.col("_start") if of == "_start" else F.col(n) - F.col("_end") - size) * 4 + 1, F.lit(4 * size))  # noqa: E731, B023
            same = (taken + size <= least) & (part("_a", "_n") == part("_b", "_m"))
            rows = rows.withColumn(of, F.col(of) + F.when(same, size).otherwise(0))
    left = lambda c, n: F.substring(c, F.col("_start") + 1, F.col(n) - taken)
    return rows.withColumn("apart", F.call_function("levenshtein", left("a_line", "_n"), left("b_line", "_m"), allowed(F.greatest("_n", "_m"), edits)))


def _small(df: DataFrame, rows: int, most: int) -> DataFrame:
    return F.broadcast(df) if rows <= most else df


def _distinct_lines(docs: DataFrame, least_chars: int, most_broadcast: int = 2_000_000) -> DataFrame:
    """id, h1, h2, copies, doc_id, pos (first place), line (null if under ``least_chars``) of the different lines, written to the shared folder.

    An id begins with the order of magnitude of the copies, downwards: the smallest of some ids is a line of the most.
    """
    spark = docs.sparkSession
    found = occurrences(docs, 1)
    # texts stay where they are: only those that stand twice at their first place, by repeated rows, are shuffled
    at = found.groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "pos")).alias("at")).where("copies > 1")
    at = checkpointed(at.select("h1", "h2", "copies", F.col("at.doc_id").alias("f_doc"), F.col("at.pos").alias("f_pos")))
    rows = found.join(_small(at, at.count(), most_broadcast), ["h1", "h2"], "left").na.fill(1, ["copies"])
    rows = rows.where((F.col("copies") == 1) | F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("pos") == F.col("f_pos")))
    few = F.call_function("shiftleft", (F.lit(63) - F.length(F.bin("copies"))).cast("long"), F.lit(57))
    line = F.when(F.col("n") >= least_chars, F.col("line")).alias("line")
    rows = rows.select((few + F.monotonically_increasing_id()).alias("id"), "h1", "h2", "copies", "doc_id", "pos", line)
    path, once = shared_dir(spark, "lines"), shared_dir(spark, "lines-once")
    rows.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    rows.where("copies > 1").groupBy("h1", "h2").agg(F.min(F.struct(*rows.columns)).alias("x")).select("x.*").write.option("compression", "zstd").parquet(once)
    return rows.where("copies = 1").union(spark.read.schema(rows.schema).parquet(once))


def _verified(pairs: DataFrame, lines: DataFrame, edits: int | None, most_broadcast: int) -> DataFrame:
    """Those of ``pairs`` (a, b: ids of ``lines``) that are near: a, b, h1, h2, o1, o2, doc_id, pos, o_doc, o_pos (the first places of a and b).

    Lines in pairs are broadcast up to ``most_broadcast`` ids to fetch their texts, else joined.
    """
    ids = checkpointed(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    texts = checkpointed(lines.select("id", "h1", "h2", "doc_id", "pos", "line").join(_small(ids, ids.count(), most_broadcast), "id", "left_semi"))
    a = texts.toDF("a", "h1", "h2", "doc_id", "pos", "a_line")
    b = texts.toDF("b", "o1", "o2", "o_doc", "o_pos", "b_line")
    # as many partitions as the pairs need: verifying them is more than their bytes show
    parts = pairs.count() // 5000 + 1
    if ids.count() <= most_broadcast // 40:  # texts of few lines go to the pairs, which then travel without
        rows = pairs.repartition(parts, "a", "b").join(F.broadcast(a), "a").join(F.broadcast(b), "b")
    else:
        rows = pairs.join(a, "a").repartition(parts, "b").join(b, "b")
    n, m = F.length("a_line"), F.length("b_line")
    rows = rows.where(F.abs(n - m) <= allowed(F.greatest(n, m), edits))
    # the checkpoint keeps the filter from being pushed into the steps of the distance
    return checkpointed(_distances(rows, edits).select("a", "b", "h1", "h2", "o1", "o2", "doc_id", "pos", "o_doc", "o_pos", "apart")).where("apart >= 0").drop("apart")


def _checked(edits: int | None, least_chars: int) -> None:
    if edits is not None and least_chars < 4 * edits + 4:
        raise ValueError("least_chars must be 4 * edits + 4 at least, so that segments are not empty")


def links(docs: DataFrame, edits: int | None = None, least_chars: int = 24, most_broadcast: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """(classes, links): distinct lines with their first place and number of copies, and all links between them.

    Classes are of all lines but empty ones, links only of those of at least ``least_chars`` code points.
    classes: h1, h2, copies, doc_id, pos (first place in order of doc_id and line number, null ids first).
    links: h1, h2, o1, o2 both ways round, for each pair of different lines at most ``edits`` edits apart
    (None: as many as ``allowed`` gives for the longer one). These are as many as the pairs of a group of near copies;
    ``spanning_links`` are not.
    Equal lines are grouped first, so a line that stands on a third of all rows takes part once; the distinct lines
    are written to the shared folder. Distances are computed in a band of as many diagonals as edits allowed.
    """
    _checked(edits, least_chars)
    distinct = _distinct_lines(docs, least_chars)
    lines = distinct.where("line is not null")
    pairs = checkpointed(candidates(lines.select("id", "line"), edits, most_broadcast))
    close = _verified(pairs, lines, edits, most_broadcast).select("h1", "h2", "o1", "o2")
    return distinct.select("h1", "h2", "copies", "doc_id", "pos"), close.union(close.select("o1", "o2", "h1", "h2"))


def _later() -> Column:
    """Whether the first place of a stands after that of b, for rows of ``_verified``."""
    return F.struct(F.col("o_doc").alias("d"), F.col("o_pos").alias("p")) < F.struct(F.col("doc_id").alias("d"), F.col("pos").alias("p"))


def spanning_links(distinct: DataFrame, edits: int | None, most_broadcast: int = 2_000_000) -> DataFrame:
    """Links of the ``_distinct_lines`` (columns of ``_verified``) that connect the same lines as all links, and have an earlier partner for each line that has one.

    The lines of a key are verified against one of them, that of the most copies. Two lines that are both near it are
    connected by it, so they are compared only if it stands after both; all other pairs of the key are compared as
    in ``candidates``. The copies of a line with single changes are thus as many links as lines, not as pairs.
    """
    lines = distinct.where("line is not null")
    met = _met(lines.select("id", "line"), edits, most_broadcast)
    rows = met.join(met.groupBy("key").agg(F.min("id").alias("b")), "key").where("id <> b")
    rows = checkpointed(rows.withColumnRenamed("id", "a"))
    star = _verified(checkpointed(rows.select("a", "b").distinct()), lines, edits, most_broadcast)
    near = star.select("a", "b", F.lit(True).alias("near"), (~_later()).alias("before"))
    rows = rows.join(_small(near, near.count(), most_broadcast), ["a", "b"], "left").na.fill(False, ["near", "before"])
    rows = checkpointed(rows.select("key", F.col("a").alias("id"), "n", "kind", "k0", "k1", "near", "before"))
    still = rows.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.max(~F.col("near") | F.col("before")).alias("open")).where("open and x <> y").select("key")
    rows = checkpointed(rows.join(still, "key", "left_semi"))
    known = F.col("a.near") & F.col("b.near") & ~(F.col("a.before") & F.col("b.before"))
    rest = checkpointed(_meetings(rows.join(_bits_of(lines.select("id", "line"), rows, most_broadcast), "id"), edits, ~known))
    return star.union(_verified(rest, lines, edits, most_broadcast)).distinct()


def _marks(docs: DataFrame, edits: int | None, least_chars: int, marks: str | None) -> tuple[DataFrame, DataFrame]:
    """(classes, marks): the classes of ``links``; of the lines with links: h1, h2, near (an earlier line is linked) and what ``marks`` names: n_links or class."""
    if marks == "n_links":
        classes, linked = links(docs, edits, least_chars)
        place = lambda h1, h2, doc, pos: classes.select(F.col("h1").alias(h1), F.col("h2").alias(h2), F.col("doc_id").alias(doc), F.col("pos").alias(pos))
        ends = linked.join(place("h1", "h2", "doc_id", "pos"), ["h1", "h2"]).join(place("o1", "o2", "o_doc", "o_pos"), ["o1", "o2"])
        return classes, ends.groupBy("h1", "h2").agg(F.max(_later()).alias("near"), F.count("*").alias("n_links"))
    _checked(edits, least_chars)
    distinct = _distinct_lines(docs, least_chars)
    found = checkpointed(spanning_links(distinct, edits))
    other = found.select("b", "a", "o1", "o2", "h1", "h2", "o_doc", "o_pos", "doc_id", "pos").toDF(*found.columns)
    ends = found.union(other).groupBy("a", "h1", "h2", "doc_id", "pos").agg(F.max(_later()).alias("near"))
    return distinct.select("h1", "h2", "copies", "doc_id", "pos"), _class_places(found, checkpointed(ends)) if marks else ends.select("h1", "h2", "near")


def _class_places(found: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` (a, h1, h2, doc_id, pos, near) as h1, h2, near, class: the first place of all lines that links connect with the line, as doc_id:pos."""
    of = ends.join(components(found.select(F.col("a").alias("src"), F.col("b").alias("dst"))), F.col("a") == F.col("node"))
    first = of.groupBy("component_id").agg(F.min(F.struct("doc_id", "pos")).alias("at"))
    name = F.concat(F.coalesce(F.col("at.doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("at.pos").cast("string"))
    return of.join(first, "component_id").select("h1", "h2", "near", name.alias("class"))


def decisions(docs: DataFrame, edits: int | None = None, least_chars: int = 24, marks: str | None = None, most_broadcast: int = 2_000_000) -> DataFrame:
    """doc_id, th, dropped (line numbers), n_exact, n_near for the documents that share a line with any place.

    A line is dropped if it stands earlier (in order of doc_id, line number), or if its first place has an
    earlier line at most ``edits`` edits away (see ``links``). Rows that repeat a doc_id and text are one document.
    marks: None, or a further column about the lines that stand first in the document: "n_links", their links, or
    "classes", comma-joined number=class of those with links (class: doc_id:pos, the first place of all connected lines).
    """
    classes, near = _marks(docs, edits, least_chars, marks)
    near = checkpointed(near)
    info = classes.join(_small(near, near.count(), most_broadcast), ["h1", "h2"], "left").where("copies > 1 or near is not null")
    mark = F.coalesce("n_links", F.lit(0)) if marks == "n_links" else F.col("class") if marks == "classes" else F.lit(None).cast("string")
    info = checkpointed(info.select("h1", "h2", F.col("doc_id").alias("f_doc"), F.col("pos").alias("f_pos"), F.coalesce("near", F.lit(False)).alias("near"), mark.alias("mark")))
    occ = occurrences(docs, 1).select("doc_id", "th", "pos", "h1", "h2").join(_small(info, info.count(), most_broadcast), ["h1", "h2"])
    first = F.col("doc_id").eqNullSafe(F.col("f_doc")) & (F.col("pos") == F.col("f_pos"))
    each = occ.select("doc_id", "th", "pos", F.when(~first, "exact").when(F.col("near"), "near").otherwise("kept").alias("kind"), F.when(first, F.col("mark")).alias("mark"))
    lines = each.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("pos", "kind", "mark"))).alias("x"))
    of = lambda kind: F.filter("x", lambda y: y["kind"] == kind)
    further = {
        None: [],
        "n_links": [F.aggregate("x", F.lit(0).cast("long"), lambda s, y: s + F.coalesce(y["mark"], F.lit(0))).alias("n_links")],
        "classes": [F.array_join(F.transform(F.filter("x", lambda y: y["mark"].isNotNull()), lambda y: F.concat(y["pos"].cast("string"), F.lit("="), y["mark"].cast("string"))), ",").alias("classes")],
    }[marks]
    dropped = F.transform(F.filter("x", lambda y: y["kind"] != "kept"), lambda y: y["pos"])
    return lines.select("doc_id", "th", dropped.alias("dropped"), F.size(of("exact")).alias("n_exact"), F.size(of("near")).alias("n_near"), *further)


def report(docs: DataFrame, edits: int | None = None, least_chars: int = 24, marks: str = "n_links") -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_lines, n_exact, n_near, n_links or classes, dropped (comma-joined line numbers from 0).

    n_exact, n_near: lines dropped as a copy, or within ``edits`` edits, of an earlier line; ``marks``: n_links, links of
    the lines that stand first in this document, for which all links are enumerated, or classes (see ``decisions``),
    for which they are not. Lines under ``least_chars`` code points go only as copies, empty
    lines never. Null and empty texts have no lines and drop none.
    """
    d = decisions(docs, edits, least_chars, marks).withColumnRenamed("doc_id", "d_doc").withColumnRenamed("th", "d_th")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0).cast("long").alias("n_lines"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    mark = zero("n_links") if marks == "n_links" else F.coalesce("classes", F.lit("")).alias("classes")
    return rows.join(d, F.col("doc_id").eqNullSafe(F.col("d_doc")) & (F.col("th") == F.col("d_th")), "left").select(
        "doc_id", "n_lines", zero("n_exact"), zero("n_near"), mark, F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped")
    )


def drop_lines(docs: DataFrame, edits: int | None = None, least_chars: int = 24) -> DataFrame:
    """``docs`` without the dropped lines (stage of the corpus pipeline); n_chars, if there, follows the text.

    All rows stay, a document whose every line is dropped with an empty text; other texts and columns are unchanged.
    Null texts stay null; repeated rows of one id and text have one result; an empty table gives no rows.
    """
    doc, th, dropped = (unused(docs, x) for x in ("_d_doc", "_d_th", "_dropped"))
    d = decisions(docs.select("doc_id", "text"), edits, least_chars).select(F.col("doc_id").alias(doc), F.col("th").alias(th), F.col("dropped").alias(dropped))
    joined = docs.join(d, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(th)), "left")
    lines = F.split("text", "\n")
    left = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col(dropped)), lambda i: F.get(x, i)), "\n"))
    out = joined.withColumn("text", F.when(F.coalesce(F.size(dropped), F.lit(0)) > 0, left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns_of(docs))
