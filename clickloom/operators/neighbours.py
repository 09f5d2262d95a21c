"""Nearest neighbours from the train sessions: items by the sessions they share, sessions by the items they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickloom.functions.index import reliable
from clickloom.functions.joins import hot_limit, join_split
from clickloom.functions.segments import scan


def session_items(train: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """session_id, itemid, w of the items of each session: 1, or the largest whole ``weights`` of its behaviours there."""
    w = F.lit(1)
    if weights:
        w = F.max(F.coalesce(*(F.when(F.col("event") == b, F.lit(x)) for b, x in weights.items()), F.lit(0)))
    else:
        w = F.max(F.lit(1))
    return train.groupBy("session_id", "itemid").agg(w.cast("long").alias("w")).where("w > 0")


def _counted(matrix: DataFrame) -> DataFrame:
    return matrix if "n" in matrix.columns else matrix.withColumn("n", F.lit(1).cast("long"))


def prefix_filtered(matrix: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(itemid, norm, k, rest of each item; the rows of ``matrix`` that pairs of cosine ``least`` are looked for in, with size and n).

    norm: sum of squares; k: sessions; n: how many equal sessions a row stands for (1 if ``matrix`` has none). An item's sessions go in order of size, the largest first. As long as the
    squares that have passed are below least^2 of the norm (``rest``), the rows are left out: two items that share
    sessions only where one of them is left out have a product below least, by Cauchy-Schwarz. So the largest
    sessions, which have the most pairs, go first. ``size``: the session's items.
    """
    matrix = reliable(_counted(matrix))
    total = matrix.count()
    sizes = matrix.groupBy("session_id").agg(F.count("*").alias("size"))
    norms = matrix.groupBy("itemid").agg(F.sum(F.col("n") * F.col("w") * F.col("w")).alias("norm"), F.count("*").alias("k"))
    rows = join_split(join_split(matrix, sizes, "session_id", "size", total), norms, "itemid", "k", total)
    rows = rows.select("session_id", "itemid", "w", "n", "size", "norm", "k", (-F.col("size")).alias("_order"))
    rows = scan(rows, ("itemid",), ("_order", "session_id"), sums={"passed": F.col("n") * F.col("w") * F.col("w")}).drop("_order", "_range")
    kept = F.col("passed") >= F.lit(least * least * (1 - 1e-9)) * F.col("norm")
    rows = reliable(rows.withColumn("kept", kept))
    out = rows.groupBy("itemid", "norm", "k").agg(F.coalesce(F.sum(F.when(~F.col("kept"), F.col("n") * F.col("w") * F.col("w"))), F.lit(0)).alias("rest"))
    return reliable(out), rows.where("kept").select("session_id", "itemid", "w", "n", "size")


def session_pairs(rows: DataFrame, cell: int = 1000) -> DataFrame:
    """a < b, part of the items that meet in a session of ``rows`` (session_id, itemid, w, n, size): the sum of their products, n times each.

    A session of more than ``cell`` items is split into blocks of items, and each pair of blocks is a cell that is
    joined by itself: no task has more than about cell^2 pairs of one session, and a row is repeated once a block.
    """
    blocks = F.ceil(F.col("size") / cell).cast("int")
    at = rows.withColumns({"_n": blocks, "_b": F.pmod(F.xxhash64("itemid"), blocks).cast("int")})
    left = at.select("session_id", F.col("itemid").alias("_x"), (F.col("n") * F.col("w")).alias("_wx"), F.col("_b").alias("_i"), F.explode(F.expr("sequence(_b, _n - 1)")).alias("_j"))
    right = at.select("session_id", F.col("itemid").alias("_y"), F.col("w").alias("_wy"), F.explode(F.expr("sequence(0, _b)")).alias("_i"), F.col("_b").alias("_j"))
    met = left.join(right, ["session_id", "_i", "_j"]).where("_i < _j or _x < _y")
    return met.groupBy(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).agg(F.sum(F.col("_wx") * F.col("_wy")).alias("part"))


def item_pairs(matrix: DataFrame, least: float = 0.1, cell: int = 1000) -> DataFrame:
    """a < b, dot, cosine2 (squared cosine) of all pairs of items whose cosine over the sessions is at least ``least``.

    Exact: pairs are found in what ``prefix_filtered`` keeps, those that the rest cannot lift to ``least`` go, and the
    whole product of the others is summed from the item with fewer sessions, in whole numbers.
    """
    matrix = reliable(_counted(matrix))
    items, kept = prefix_filtered(matrix, least)
    one = lambda x: items.select(F.col("itemid").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("norm", "k", "rest")))
    found = session_pairs(kept, cell).join(one("a"), "a").join(one("b"), "b")
    most = F.col("part") / F.sqrt(F.col("norm_a") * F.col("norm_b")) + F.sqrt(F.greatest(F.col("rest_a") / F.col("norm_a"), F.col("rest_b") / F.col("norm_b")))
    found = found.where(most >= least * (1 - 1e-9))
    fewer = F.col("k_a") <= F.col("k_b")
    asked = found.select("a", "b", F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("_from"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("_to"), F.least("k_a", "k_b").alias("_k"), (F.col("norm_a") * F.col("norm_b")).alias("norms"))
    # an item of many sessions is dealt in parts, and each of its pairs to all of them
    limit = max(1, hot_limit(matrix.sparkSession, matrix.count()))
    asked = asked.withColumn("_p", F.explode(F.expr(f"sequence(0L, (_k - 1) div {limit}L)")))
    rows = join_split(matrix, items.select("itemid", "k"), "itemid", "k", matrix.count())
    rows = rows.select(F.col("itemid").alias("_from"), "session_id", (F.col("n") * F.col("w")).alias("_w"), F.pmod(F.xxhash64("session_id"), F.expr(f"(k - 1) div {limit}L + 1")).alias("_p"))
    both = asked.join(rows, ["_from", "_p"]).join(matrix.select(F.col("itemid").alias("_to"), "session_id", "w"), ["_to", "session_id"])
    dots = both.groupBy("a", "b", "norms").agg(F.sum(F.col("_w") * F.col("w")).alias("dot"))
    dots = dots.withColumn("cosine2", F.col("dot") * F.col("dot") / F.col("norms").cast("double"))
    return dots.where(F.col("cosine2") >= F.lit(least * least)).select("a", "b", "dot", "cosine2")


def item_knn(matrix: DataFrame, n: int = 20, least: float = 0.1, cell: int = 1000) -> DataFrame:
    """itemid, neighbour, rank, dot, similarity: the ``n`` nearest items of each item, by cosine of at least ``least``, then by id.

    ``matrix``: session_id, itemid, w (whole numbers), and n if a session stands for n equal ones. Items without a neighbour have no row.
    """
    pairs = reliable(item_pairs(matrix, least, cell))
    both = pairs.select(F.col("a").alias("itemid"), F.col("b").alias("neighbour"), "dot", "cosine2").union(pairs.select("b", "a", "dot", "cosine2"))
    place = F.row_number().over(W.partitionBy("itemid").orderBy(F.desc("cosine2"), "neighbour"))
    return both.withColumn("rank", place).where(F.col("rank") <= n).select("itemid", "neighbour", "rank", "dot", F.round(F.sqrt("cosine2"), 6).alias("similarity"))


def prefix_items(events: DataFrame, queries: DataFrame, groups: int = 20) -> DataFrame:
    """query_id, itemid of the distinct items in the last ``groups`` timestamp groups of each query's prefix, its own group included.

    Groups are numbered on through a session, so an event counts for its own group and the next ones: the rows grow
    with the events, not with the square of a session.
    """
    each = events.select("session_id", "itemid", "group_id").distinct()
    later = each.select("session_id", "itemid", F.explode(F.sequence("group_id", F.col("group_id") + groups - 1)).alias("query_id"))
    return later.join(queries.select("query_id", "session_id"), ["query_id", "session_id"]).select("query_id", "itemid").distinct()


def _best(scores: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "itemid"))
    return scores.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "itemid", "rank", "score")


def item_knn_ranked(prefix: DataFrame, neighbours: DataFrame, k: int = 20) -> DataFrame:
    """query_id, itemid, rank, score: the ``k`` items nearest to each query's prefix (query_id, itemid).

    The score adds the similarities of ``neighbours``, in millionths, over the items of the prefix. An item that
    many prefixes hold has ``n`` neighbours, which are broadcast; its rows stay where they are.
    """
    prefix = reliable(prefix)
    often = prefix.groupBy("itemid").agg(F.count("*").alias("_n"))
    near = neighbours.join(often, "itemid").select("itemid", F.col("neighbour"), F.round(F.col("similarity") * 1_000_000).cast("long").alias("score"), "_n")
    rows = join_split(prefix, near, "itemid", "_n", prefix.count())
    return _best(rows.groupBy("query_id", F.col("neighbour").alias("itemid")).agg(F.sum("score").alias("score")), k)


def item_sets(rows: DataFrame, key: str, name: str, *more: Column) -> tuple[DataFrame, DataFrame]:
    """(``key``, ``name``, size, ``more`` of each key of ``rows`` (key, itemid); ``name``, itemid, size of each distinct set of items).

    ``name`` is the smallest key with the set; ``more`` are further aggregates of a key's rows.
    """
    mark = reliable(rows.groupBy(key).agg(F.count("*").alias("size"), *(F.bit_xor(F.xxhash64("itemid", F.lit(s))).alias(f"_h{s}") for s in (1, 2)), *more))
    same = F.struct("size", "_h1", "_h2").alias("_k")
    first = mark.groupBy(same).agg(F.min(key).alias(name), F.count("*").alias("_n"))
    of = reliable(join_split(mark.withColumn("_k", same), first, "_k", "_n", mark.count()).drop("_k", "_h1", "_h2", "_n"))
    return of, rows.join(of.where(F.col(key) == F.col(name)).select(key, "size"), key).select(F.col(key).alias(name), "itemid", "size")


def of_queries(of: DataFrame, rows: DataFrame) -> DataFrame:
    """query_id and the other columns of ``rows`` (set_id, few rows each) for each query of a set; ``of``: query_id, set_id."""
    of = of.select("query_id", "set_id")
    often = of.groupBy("set_id").agg(F.count("*").alias("_n"))
    return join_split(of, rows.join(often, "set_id"), "set_id", "_n", of.count()).select("query_id", *(c for c in rows.columns if c != "set_id"))


def _longer(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """Patterns (head, tail) of each ``key`` with one item more: two that differ in their last item are put together."""
    other = rows.select(key, "head", F.col("tail").alias("_last"))
    return rows.join(other, [key, "head"]).where("tail < _last").select(key, F.array_append("head", F.col("tail")).alias("head"), F.col("_last").alias("tail"), *more)


class SessionIndex:
    """Train sessions (session_id, itemid, session_end), to find the ``m`` nearest to sets of items exactly.

    The score of a session adds idf = round(10^6 ln(1 + sessions / sessions with the item)) over the items that it
    shares with the set; equal scores go by recency (session_end, the latest first), then session_id.

    Sessions of equal items are one class, of which the ``m`` latest can count. If a session shares just the items P
    with a set, all classes that hold P score as much at least; so its class is one of the ``m`` latest that
    hold P, or it is not among the best. Patterns P are grown an item at a time: from items to pairs, triples, ...,
    and only while more than ``m`` classes hold them, for the classes of others are all taken. No list of an item is
    read through. A set or class of more than ``most`` items, of which patterns could be too many, is not grown: it is
    compared with all classes or sets that share an item.
    """

    def __init__(self, sessions: DataFrame, m: int = 20, most: int = 12):
        self.m, self.most = m, most
        self.sessions = sessions = reliable(sessions)
        of, items = item_sets(sessions.select("session_id", "itemid", "session_end"), "session_id", "class_id", F.max("session_end").alias("session_end"))
        by = W.partitionBy("class_id").orderBy(F.desc("session_end"), "session_id")
        self.latest = reliable(of.withColumn("place", F.row_number().over(by)).where(F.col("place") <= m).select("class_id", "session_id", "session_end", "place"))
        head = self.latest.where("place = 1").select("class_id", "session_end", F.col("session_id").alias("first"))
        self.classes = reliable(items.join(head, "class_id").join(of.groupBy("class_id").agg(F.count("*").alias("n")), "class_id"))
        idf = F.round(1_000_000 * F.log1p(F.lit(of.count()) / F.col("df"))).cast("long")
        self.items = reliable(sessions.groupBy("itemid").agg(F.count("*").alias("df")).withColumn("idf", idf))

    def matrix(self) -> DataFrame:
        """session_id, itemid, w, n: one session of each class, which stands for its ``n``; for ``item_knn``."""
        return self.classes.select(F.col("class_id").alias("session_id"), "itemid", F.lit(1).cast("long").alias("w"), "n")

    def sets(self, prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(query_id, set_id; set_id, itemid, size of each distinct set) of the items of ``prefix`` (query_id, itemid) that train holds."""
        of, members = item_sets(reliable(prefix.join(self.items.select("itemid"), "itemid", "left_semi")), "query_id", "set_id")
        return of.select("query_id", "set_id"), reliable(members)

    def candidates(self, members: DataFrame) -> DataFrame:
        """set_id, class_id of the classes that can hold one of the ``m`` nearest sessions of each set."""
        large, columns = F.col("size") > self.most, ["set_id", "class_id"]
        wide = self.classes.select("class_id", "itemid", large.alias("_wide"))
        found = members.select("set_id", "itemid", large.alias("_all")).join(wide, "itemid").where("_all or _wide").select(columns)
        pattern = (F.expr("cast(array() as array<bigint>)").alias("head"), F.col("itemid").alias("tail"))
        asked = reliable(members.where(~large).select("set_id", *pattern))
        held = self.classes.where(~large).select("class_id", *pattern, "session_end", "first")
        by = W.partitionBy("head", "tail").orderBy(F.desc("session_end"), "first")
        while not asked.isEmpty():
            often = asked.groupBy("head", "tail").agg(F.count("*").alias("_n"))
            held = reliable(held.join(often.select("head", "tail"), ["head", "tail"], "left_semi"))
            tops = held.withColumn("_i", F.row_number().over(by)).where(F.col("_i") <= self.m + 1)
            tops = reliable(tops.join(often, ["head", "tail"]).select(F.struct("head", "tail").alias("_k"), "class_id", "_i", "_n"))
            met = join_split(asked.select("set_id", F.struct("head", "tail").alias("_k")), tops.where(F.col("_i") <= self.m), "_k", "_n", asked.count())
            found = found.union(met.select(columns))
            more = tops.where(F.col("_i") == self.m + 1).select("_k.head", "_k.tail")
            asked = reliable(_longer(asked.join(more, ["head", "tail"], "left_semi"), "set_id"))
            held = _longer(held.join(more, ["head", "tail"], "left_semi"), "class_id", "session_end", "first")
        return found.distinct()

    def near(self, members: DataFrame) -> DataFrame:
        """set_id, session_id, rank, score of the ``m`` nearest sessions of each set (set_id, itemid, size)."""
        asked = members.join(self.items.select("itemid", "idf"), "itemid").select("set_id", "itemid", "idf")
        shared = self.candidates(members).join(asked, "set_id").join(self.classes.drop("size", "n"), ["class_id", "itemid"])
        scores = shared.groupBy("set_id", "class_id", "session_end", "first").agg(F.sum("idf").alias("score"))
        by = W.partitionBy("set_id")
        best = scores.withColumn("_i", F.row_number().over(by.orderBy(F.desc("score"), F.desc("session_end"), "first"))).where(F.col("_i") <= self.m)
        each = best.select("set_id", "class_id", "score").join(self.latest, "class_id")
        place = F.row_number().over(by.orderBy(F.desc("score"), F.desc("session_end"), "session_id"))
        return each.withColumn("rank", place).where(F.col("rank") <= self.m).select("set_id", "session_id", "rank", "score")

    def reads(self, members: DataFrame) -> DataFrame:
        """set_id, lists, entries, read: of the lists of sessions by item, how many a set has, their entries, and how many settle its neighbours.

        Lists are taken from the rarest item on, one, two, four ... in a round, until the ``m``-th best score by them
        exceeds what all others give together, so no unseen session can enter. Without that, all but the longest
        are needed, and its first ``m`` entries: sessions after them, if unseen, share that item alone and are older.
        The scores after a round are those of the set's items so far, so they come from ``near``; the lists
        themselves are not read.
        """
        of_set = W.partitionBy("set_id")
        rows = members.select("set_id", "itemid").join(self.items, "itemid").withColumns({
            "j": F.row_number().over(of_set.orderBy("df", "itemid")), "k": F.count("*").over(of_set),
            "after": F.sum("idf").over(of_set.orderBy(F.desc("df"), F.desc("itemid"))) - F.col("idf"),
        })
        rows = reliable(rows)
        rounds = F.expr("transform(filter(sequence(0, 31), i -> shiftleft(1L, i) < k), i -> least(shiftleft(2L, i) - 1, k - 1))")
        ends = rows.where("j = 1").select("set_id", F.explode(rounds).alias("at"))
        part = rows.join(ends, "set_id").where("j <= at").select(F.struct("set_id", "at").alias("_part"), "itemid")
        of, parts = item_sets(part, "_part", "set_id")
        bar = self.near(reliable(parts)).where(F.col("rank") == self.m).select("set_id", F.col("score").alias("bar"))
        met = of.join(bar, "set_id").select("_part.set_id", "_part.at", "bar").join(rows.select("set_id", F.col("j").alias("at"), "after"), ["set_id", "at"])
        upto = met.where("bar > after").groupBy("set_id").agg(F.min("at").alias("upto"))
        read = F.when(F.col("j") <= F.coalesce("upto", F.col("k") - 1), F.col("df")).when(F.col("upto").isNull() & (F.col("j") == F.col("k")), F.least("df", F.lit(self.m).cast("long"))).otherwise(F.lit(0))
        return rows.join(upto, "set_id", "left").groupBy("set_id").agg(F.count("*").alias("lists"), F.sum("df").alias("entries"), F.sum(read).alias("read"))


def session_knn(sessions: DataFrame, prefix: DataFrame, m: int = 20) -> tuple[DataFrame, DataFrame]:
    """(query_id, session_id, rank, score: the ``m`` train sessions nearest to each query; set_id, lists, entries, read).

    ``sessions``: session_id, itemid, session_end of each item of each train session; ``prefix``: query_id, itemid.
    See ``SessionIndex``; queries of one set of items are answered once, and those that share no item with train have
    no row.
    """
    index = SessionIndex(sessions, m)
    of, members = index.sets(prefix)
    return of_queries(of, reliable(index.near(members))), index.reads(members)


def session_knn_ranked(neighbours: DataFrame, sessions: DataFrame, k: int = 20) -> DataFrame:
    """query_id, itemid, rank, score: the ``k`` items that most of a query's ``neighbours`` hold, weighted by their scores.

    ``sessions``: session_id, itemid. A session near to very many queries, or of very many items, is split by the engine's skew handling.
    """
    near = neighbours.select("query_id", "session_id", "score").join(sessions.select("session_id", "itemid").distinct(), "session_id")
    return _best(near.groupBy("query_id", "itemid").agg(F.sum("score").alias("score")), k)


def session_lists(near: DataFrame, sessions: DataFrame, k: int = 20) -> DataFrame:
    """set_id, itemid, rank, score: ``session_knn_ranked`` of the sessions near to each set (set_id, session_id, score), for ``of_queries``."""
    return session_knn_ranked(near.withColumnRenamed("set_id", "query_id"), sessions, k).withColumnRenamed("query_id", "set_id")
