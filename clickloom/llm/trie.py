"""Prefix trie of conversations: distributed MSD radix partitioning, multikey quicksort for what is small.

1. Turns get whole numbers (a dictionary over role and text). Numbers, places in a conversation and depths after
   the rebuild are all taken from rows in ranges (``numbered``), so that one turn or conversation may hold any
   share of the rows.
2. The radix partition starts at the root. A round deals the conversations of each large bucket by their next
   turn. Buckets with more turns left than an eighth of a partition go on to the next round; there are at most
   eight for each partition, so their list may be broadcast. All others are small and end their partition there.
3. Small buckets are dealt to tasks, where a multikey quicksort over their turn numbers splits them further and
   its recursion emits the nodes. A large bucket of one conversation is a chain, whose nodes need no sorting.
4. Sums over subtrees of the few large nodes come from what the small buckets report, by one aggregation.

A round takes one turn, so a path of more than that many turns that several conversations share takes as many
rounds as it is deep; in ordinary tables a few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.segments import ranged
from clickloom.llm.common import checkpointed, written

#: Turns of one row of a conversation's turn table.
BLOCK = 16
#: Conversations are rebuilt from at most so many turns of another one.
MOST_TAKEN = 8
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def numbered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` with _at (number of the row in order of ``key`` and ``order``, from 0) and _start (that of the key's first row).

    A key may span any number of ranges. The driver sees one row for each range.
    """
    rows = ranged(df, key, *order).drop("_place")
    inside = rows.mapInArrow(partial(_runs, key=key), f"{_ddl(rows)}, _place long, _first long")
    ends = inside.groupBy("_range").agg(F.count("*").alias("n"), F.min_by(key, "_place").alias("a"), F.max_by(key, "_place").alias("z"), F.max("_first").alias("f"))
    table, offset, last, start = [], 0, None, 0
    for r, n, a, z, f in sorted(ends.collect(), key=lambda x: x[0]):  # one row for each partition
        first = start if (last,) == (a,) and table else offset
        table.append((r, offset, first))
        start, last, offset = (first if f == 0 else offset + f), z, offset + n
    carried = df.sparkSession.createDataFrame(table, "_range int, _offset long, _carried long")
    at = inside.join(F.broadcast(carried), "_range")  # one row for each partition
    return at.withColumns({"_at": F.col("_offset") + F.col("_place"), "_start": F.when(F.col("_first") == 0, F.col("_carried")).otherwise(F.col("_offset") + F.col("_first"))}).drop("_range", "_offset", "_carried", "_place", "_first")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Place of each row and of the first row with its key, in a sorted partition."""
    place, first, last = 0, 0, None
    for b in batches:
        if not b.num_rows:
            continue
        k, at = b.column(key), np.arange(place, place + b.num_rows)
        new = np.ones(b.num_rows, bool)
        new[1:] = pc.not_equal(k.slice(1), k.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        new[0] = place == 0 or k[0].as_py() != last
        starts = np.maximum.accumulate(np.where(new, at, first))
        place, first, last = place + b.num_rows, int(starts[-1]), k[b.num_rows - 1].as_py()
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array(starts)], names=[*b.schema.names, "_place", "_first"])


def turn_table(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn_id, size (UTF-8 bytes of the text) of every turn; rows without conv_id are left out.

    In order of turn, nulls first; rows of one turn in order of role and of the SHA-256 of role and text. Null role
    or text is empty. turn_id is the same for equal role and text only (a number that follows their SHA-256).
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    coded = numbered(rows, "digest", "conv_id", "turn").select("conv_id", "turn", "role", F.col("_start").alias("turn_id"), "size")
    placed = numbered(coded, "conv_id", "turn", "role", "turn_id")
    return placed.select("conv_id", (F.col("_at") - F.col("_start")).alias("place"), "turn_id", "size")


def taken(conv_id: str = "conv_id") -> Column:
    """How many turns conversation ``conv_id`` takes from the one it is rebuilt from: crc32 of the decimal id, mod 9."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % (MOST_TAKEN + 1)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: c; their turns: c, place, turn_id, size) with the first turns of every fifth put in place of their own.

    c takes the first ``taken`` turns of c - c % 5 (the sign of c % 5 is that of c), then its own ones after as
    many. ``place`` orders them and may have gaps. Turnless conversations stand in the first table alone.
    """
    convs = turns.where("place = 0").select(F.col("conv_id").alias("c"), taken().alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("donor"))
    given = turns.where((F.col("conv_id") % 5 == 0) & (F.col("place") < MOST_TAKEN))
    given = given.groupBy(F.col("conv_id").alias("donor")).agg(F.array_sort(F.collect_list(F.struct("place", "turn_id", "size"))).alias("t"))  # at most MOST_TAKEN each
    head = convs.where("h > 0").join(given, "donor").select("c", F.explode(F.slice("t", 1, F.col("h").cast("int"))).alias("t")).select("c", "t.*")
    own = turns.where(F.col("place") >= taken()).select(F.col("conv_id").alias("c"), "place", "turn_id", "size")
    return convs.select("c"), head.union(own)


def prefix_trie(conversations: DataFrame, least_local: int = 256) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations (``turn_table``, ``rebuilt``), columns NODES.

    conv_id: the smallest conversation of the node, which with depth names it. The root (depth 0) has no turn and
    no parent; an empty table has no nodes. Repeated rows are turns that follow each other. n_convs, members;
    n_children; n_leaves, childless nodes in the subtree, itself included; saved_tokens: (n_convs - 1) x bytes of
    the node's turn, summed over its subtree; ends_sha256: over the ids, ascending and comma-joined, of members
    that end here. Buckets of at most ``least_local`` turns are always finished in their task.
    """
    spark = conversations.sparkSession
    convs, rows = rebuilt(checkpointed(turn_table(conversations)))
    rows = numbered(rows, "c", "place").select("c", (F.col("_at") - F.col("_start")).alias("i"), "turn_id", "size")
    each = F.array_sort(F.collect_list(F.struct("i", "turn_id", "size")))  # at most BLOCK
    blocks = rows.groupBy("c", F.expr(f"i div {BLOCK}").alias("block")).agg(F.max("i").alias("last"), each.alias("t"))
    blocks = written(blocks.select("c", "block", "last", F.col("t.turn_id").alias("ids"), F.col("t.size").alias("sizes")))
    lengths = blocks.groupBy("c").agg((F.max("last") + 1).alias("len"))
    first = blocks.where("block = 0").select("c", "ids", "sizes")
    live = convs.join(lengths, "c", "left").join(first, "c", "left").select("c", F.coalesce("len", F.lit(0).cast("long")).alias("len"), "ids", "sizes")
    live = written(live)
    n, total, root = live.agg(F.count("*"), F.sum("len"), F.min("c")).first()
    if not n:
        return spark.createDataFrame([], NODES)
    # at most eight buckets for each partition are larger than this
    limit = max(least_local, total // (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    live = live.withColumn("p", F.lit(root).cast("long"))
    large = [spark.createDataFrame([(0, root, n, 0, [])], "depth long, conv_id long, n_convs long, own long, above array<long>")]
    small, chains, ends, depth = [], [], [], 0
    while True:
        ends.append(live.where(F.col("len") == depth).select(F.lit(depth).cast("long").alias("depth"), "p", "c"))
        if depth and depth % BLOCK == 0:
            live = live.where(F.col("len") > depth).drop("ids", "sizes").join(blocks.where(F.col("block") == depth // BLOCK).select("c", "ids", "sizes"), "c")
        at = depth % BLOCK
        going = live.where(F.col("len") > depth).withColumns({"id": F.col("ids")[at], "size": F.col("sizes")[at]})
        big = going.groupBy("p", "id").agg(F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("len") - depth).alias("turns"), F.max("size").alias("size"), F.max("len").alias("len"))
        big = written(big.where(F.col("turns") > limit))
        dealt = going.drop("size").join(F.broadcast(big.select("p", "id", F.col("conv_id").alias("to"), F.col("n_convs").alias("n"))), ["p", "id"], "left")  # at most eight for each partition
        small.append(dealt.where("to is null").select(F.lit(depth).cast("long").alias("b"), "p", "id", "c", "len", F.lit(depth // BLOCK).cast("long").alias("block"), F.slice("ids", at + 1, BLOCK).alias("ids"), F.slice("sizes", at + 1, BLOCK).alias("sizes")))
        chains.append(big.where("n_convs = 1").select(F.lit(depth).cast("long").alias("b"), "p", F.col("conv_id").alias("c"), "len"))
        more = big.where("n_convs > 1").join(F.broadcast(large[-1].select(F.col("conv_id").alias("p"), "above")), "p")
        large.append(written(more.select(F.lit(depth + 1).cast("long").alias("depth"), "conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("size")).alias("own"), F.array_append("above", F.col("p")).alias("above"))))
        if large[-1].isEmpty():
            break
        depth += 1
        live = written(dealt.where("n > 1").select("c", F.col("to").alias("p"), "len", "ids", "sizes"))
    # the turns of small buckets: those at hand, and the blocks after them
    small = reduce(DataFrame.union, small)
    later = small.where(F.col("len") > (F.col("block") + 1) * BLOCK).select("b", "p", "id", "c", F.explode(F.expr(f"sequence(block + 1, (len - 1) div {BLOCK})")).alias("block")).join(blocks.select("c", "block", "ids", "sizes"), ["c", "block"])
    keys = ["b", "p", "id", "c", "block", "ids", "sizes"]
    dealt = small.select(keys).union(later.select(keys)).repartition("b", "p", "id").sortWithinPartitions("b", "p", "id", "c", "block")
    local = written(dealt.mapInArrow(_finish, f"{NODES}, top boolean"))
    chains = reduce(DataFrame.union, chains)
    steps = chains.select("*", F.explode(F.expr("sequence(b, len - 1, 1024)")).alias("d0")).repartition("c", "d0")
    steps = steps.select("c", "p", "b", "len", F.explode(F.expr("sequence(d0 + 1, least(d0 + 1024, len))")).alias("depth"))
    chain_nodes = steps.select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("b") + 1, F.col("p")).otherwise(F.col("c")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        (F.col("depth") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("len"), F.sha2(F.col("c").cast("string").cast("binary"), 256)).otherwise(EMPTY_SHA256).alias("ends_sha256"),
    )
    large = written(reduce(DataFrame.union, large))
    return local.drop("top").union(chain_nodes).union(_large_nodes(large, local, chains, reduce(DataFrame.union, ends)))


def _large_nodes(large: DataFrame, local: DataFrame, chains: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows of the nodes that rounds split; children, leaves and savings below them come from their buckets."""
    zero = F.lit(0).cast("long")
    parent = F.try_element_at("above", F.lit(-1))
    below = local.where("top").select((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id"), "n_leaves", "saved_tokens")
    below = below.union(chains.select(F.col("b").alias("depth"), F.col("p").alias("conv_id"), F.lit(1).cast("long"), zero))
    below = below.groupBy("depth", "conv_id").agg(F.count("*").alias("k"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    inner = large.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), parent.alias("conv_id")).agg(F.count("*").alias("k2"))
    own = large.join(below, ["depth", "conv_id"], "left").join(inner, ["depth", "conv_id"], "left").na.fill(0, ["k", "k2", "leaves", "saved"])
    own = written(own.select("depth", "conv_id", "n_convs", "above", (F.col("k") + F.col("k2")).alias("n_children"), F.when(F.col("k") + F.col("k2") == 0, 1).otherwise(F.col("leaves")).alias("leaves"), (F.col("own") + F.col("saved")).alias("saved")))
    up = own.select("leaves", "saved", F.posexplode(F.array_append("above", F.col("conv_id"))).alias("depth", "conv_id")).groupBy(F.col("depth").cast("long").alias("depth"), "conv_id").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    out = own.drop("leaves", "saved").join(up, ["depth", "conv_id"]).join(ends_hashes(ends), ["depth", "conv_id"], "left")
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """depth, conv_id, ends_sha256 over the ids c, ascending, of each (depth, p), however many there are.

    Ids become pieces of text in ranges; one task then hashes a node's pieces as a stream (a SHA-256 has one order),
    ten bytes or so for each conversation and never more than a piece at a time.
    """
    pieces = ranged(ends, "depth", "p", "c").drop("_range", "_place").mapInArrow(_pieces, "depth long, p long, c long, piece binary")
    return pieces.repartition("depth", "p").sortWithinPartitions("depth", "p", "c").mapInArrow(_hashes, "depth long, conv_id long, ends_sha256 string")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        depth, p, c = (b.column(i).to_numpy() for i in range(3))
        cuts = [0, *(np.flatnonzero((depth[1:] != depth[:-1]) | (p[1:] != p[:-1])) + 1), len(c)]
        rows = [(depth[i], p[i], c[i], ",".join(map(str, c[i:j].tolist())).encode()) for i, j in zip(cuts, cuts[1:]) if i < j]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["depth", "p", "c", "piece"])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"depth": [key[0]], "conv_id": [key[1]], "ends_sha256": [state.hexdigest()]})

    key, state = None, None
    for b in batches:
        for depth, p, piece in zip(b.column("depth").to_pylist(), b.column("p").to_pylist(), b.column("piece")):
            if (depth, p) == key:
                state.update(b",")
            else:
                if key is not None:
                    yield row()
                key, state = (depth, p), hashlib.sha256()
            state.update(piece.as_py())
    if key is not None:
        yield row()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the small buckets of one partition, whose rows come sorted by bucket, conversation and block."""
    names, types = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "top"], [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    out, bucket, key = [], [], None

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    for b in batches:
        for *head, c, _, ids, sizes in zip(*(x.to_pylist() for x in b.columns)):
            if head != key:
                if key is not None:
                    out += bucket_nodes(key[0], key[1], bucket)
                key, bucket = head, []
            if bucket and bucket[-1][0] == c:
                bucket[-1][1].extend(ids)
                bucket[-1][2].extend(sizes)
            else:
                bucket.append((c, ids, sizes))
        if len(out) > 10_000:
            yield rows()
            out = []
    if key is not None:
        out += bucket_nodes(key[0], key[1], bucket)
    if out:
        yield rows()


def bucket_nodes(depth: int, parent: int, members: list[tuple[int, list[int], list[int]]]) -> list[tuple]:
    """Nodes (NODES, top) of one bucket, whose ``members`` (conversation, turn ids, sizes) share the node ``parent`` at ``depth``.

    Multikey quicksort: a segment of members that share their first d turns is parted in three by turn d of its
    middle member; the middle part, whose members share that turn as well, is a node, and is parted by turn d + 1.
    """
    order, nodes, stack = list(range(len(members))), [], [(0, len(members), 0, -1)]
    ends: dict[int, list[int]] = {}
    while stack:
        lo, hi, d, above = stack.pop()
        turn = lambda m: members[m][1][d] if d < len(members[m][1]) else -1  # noqa: B023, E731
        pivot = turn(order[(lo + hi) // 2])
        part = order[lo:hi]
        less, same, more = ([m for m in part if turn(m) < pivot], [m for m in part if turn(m) == pivot], [m for m in part if turn(m) > pivot])
        order[lo:hi] = less + same + more
        i, j = lo + len(less), hi - len(more)
        stack += [x for x in ((lo, i, d, above), (j, hi, d, above)) if x[0] < x[1]]
        if pivot < 0:
            ends[above] = sorted(members[m][0] for m in same)
        else:
            nodes.append([above, d, min(members[m][0] for m in same), j - i, (j - i - 1) * members[same[0]][2][d], 0, 0])
            stack.append((i, j, d + 1, len(nodes) - 1))
    for k in range(len(nodes) - 1, -1, -1):  # children come after their parent
        above, _, _, _, saved, children, leaves = nodes[k]
        nodes[k][6] = leaves or 1
        if above >= 0:
            nodes[above][4] += saved
            nodes[above][5] += 1
            nodes[above][6] += nodes[k][6]
    return [
        (conv, depth + d + 1, nodes[above][2] if above >= 0 else parent, n, children, leaves, saved, hashlib.sha256(",".join(map(str, ends.get(k, ()))).encode()).hexdigest(), above < 0)
        for k, (above, d, conv, n, saved, children, leaves) in enumerate(nodes)
    ]
