"""Katz backoff n-gram model of any order: Good-Turing discounts, exactly normalised backoff weights, evaluated order by order.

The corpus is cut into blocks of tokens. A block sends its distinct words to buckets by hash, which count them,
number them and answer. Then it sends its distinct n-grams to buckets by the word before the last: all the shorter
contexts to which an n-gram backs off end with that word, so one bucket holds its counts of every order, and one
message gives them all. A bucket keeps one row of a table: its n-grams, their counts, and which of them each block
asked for. When the discounts of all orders are known, each row is read again, its contexts get their backoff
weights, and each block gets the log probability of each of its n-grams.

The n-grams of a frequent word are dealt to several buckets by their last word, and of a frequent pair by the word
before it, too; the facts of such contexts are then summed over those buckets by a further exchange, by hash of the
context. So no block, bucket or message grows with
the corpus; their number does, that of the messages with its square (a block sends one to each bucket).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import LOWER_TABLE, shared_dir

#: Counts up to this are discounted.
K = 5
#: The end of a text is a word of its own, which no text can hold; the start is a context only, and NONE is no context.
END, START, NONE = b"", 0, (1 << 32) - 1
_SPACE_ = "block string, doc_ids binary, nulls binary, held binary, sizes binary, ids binary, n_words long, words binary, order binary, counts binary"


def _zip(x: np.ndarray, steps: bool = False) -> bytes:
    """An array's bytes, most significant apart from least; ``steps``: of the differences of a sorted array."""
    x = np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)) if steps else x)
    return zstandard.compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes(), 6)


def _unzip(data: bytes, kind, steps: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    x = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if steps else x


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_PACKED = pa.schema([("block", pa.string()), *((n, pa.int64() if n == "n_words" else pa.binary()) for n in ("doc_ids", "nulls", "held", "sizes", "ids", "n_words", "words", "order", "counts"))])
_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("columns", pa.list_(pa.binary()))])
_ANSWER = pa.schema([("kind", pa.string()), ("block", pa.string()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("a", "b"))])
_TABLE = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("source", pa.int32()), ("columns", pa.list_(pa.binary())), ("blocks", pa.list_(pa.string())), ("places", pa.list_(pa.binary()))])
_SENT_, _ANSWER_, _TABLE_ = (
    "bucket int, block string, columns array<binary>",
    "kind string, block string, bucket int, a binary, b binary",
    "kind string, bucket int, source int, columns array<binary>, blocks array<string>, places array<binary>",
)


def pack(docs: DataFrame, most_tokens: int = 2_000_000) -> DataFrame:
    """One row for each block of about ``most_tokens`` tokens: its texts as numbers of the block's own words.

    words: sorted 64-bit hashes of the distinct tokens; ids: for each token the rank of its word, the most frequent
    first (small numbers pack well); order: for each rank the place of the word; counts: how often a word stands in
    the block's training texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        digest = xxhash.xxh64_intdigest

        def flush() -> pa.RecordBatch:
            names = np.fromiter((digest(w, 42) for w in seen), np.uint64, len(seen))
            words, place = np.unique(names, return_inverse=True)
            local, size = np.concatenate(ids), np.array(sizes, np.uint32)
            train = np.repeat(~np.array(held, bool), size)
            counts = np.bincount(place[local[train]], minlength=len(words)).astype(np.uint32)
            order = np.argsort(-np.bincount(local, minlength=len(names)), kind="stable")
            rank = np.empty(len(names), np.uint32)
            rank[order] = np.arange(len(names), dtype=np.uint32)
            local = rank[local]
            keys, nulls = np.array([d or 0 for d in doc_ids], np.int64), np.array([d is None for d in doc_ids], np.uint8)
            row = (f"{part}-{number}", _zip(keys), _zip(nulls), _zip(np.array(held, np.uint8)), _zip(size), _zip(local), len(words), _zip(words, True), _zip(place[order].astype(np.uint32)), _zip(counts))
            return _table(_PACKED, [row]).to_batches()[0]

        doc_ids, held, sizes, ids, seen, total = [], [], [], [], {END: 0}, 0
        for batch in batches:
            for doc_id, out, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = (text or "").encode().translate(LOWER_TABLE).split()
                tokens.append(END)
                doc_ids.append(doc_id)
                held.append(out)
                sizes.append(len(tokens))
                for w in tokens:
                    if w not in seen:
                        seen[w] = len(seen)
                ids.append(np.fromiter(map(seen.__getitem__, tokens), np.uint32, len(tokens)))
                total += len(tokens)
                if total >= most_tokens:
                    yield flush()
                    number += 1
                    doc_ids, held, sizes, ids, seen, total = [], [], [], [], {END: 0}, 0
        if doc_ids:
            yield flush()

    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    return docs.select("doc_id", out.alias("held"), "text").mapInArrow(run, _SPACE_)


def _send(block: str, where: np.ndarray, columns: list[np.ndarray], buckets: int, uses: np.ndarray | None = None) -> Iterator[tuple]:
    """A message to each bucket that has rows of ``columns`` (which stay in order; the first is sorted); ``uses``: the count of each row's last word."""
    order = np.argsort(where, kind="stable")
    ends = np.cumsum(np.bincount(where, minlength=buckets))
    for b, hi in enumerate(ends):
        at = order[ends[b - 1] if b else 0 : hi]
        if len(at):
            yield b, block, _pack([c[at] for c in columns], None if uses is None else uses[at])


def _pack(columns: list[np.ndarray], uses: np.ndarray | None = None) -> list[bytes]:
    """``uses`` goes once for each last word."""
    out = [_zip(c, i == 0) for i, c in enumerate(columns)]
    return out if uses is None else [*out, _zip(uses[np.unique(columns[0] & np.uint64(NONE), return_index=True)[1]])]


def _unpack(sent: list[bytes], kinds: list) -> list[np.ndarray]:
    """The columns of a message, ``uses`` again for each row."""
    out = [_unzip(x, k, i == 0) for i, (x, k) in enumerate(zip(sent, kinds))]
    return out if len(sent) == len(kinds) else [*out, _unzip(sent[-1], np.uint64)[np.unique(out[0] & np.uint64(NONE), return_inverse=True)[1]]]


@dataclass(frozen=True)
class Discounts:
    """Factors d_1 ... d_K of a count table, from how often each count from 1 to K + 1 occurs.

    Katz's Good-Turing factors, from the occurrences as counted, or else from a straight line through their
    logarithms; where both leave (0, 1) (tiny tables) one half is taken from each count.
    """

    factors: tuple[float, ...]

    @staticmethod
    def of(occurs: list[int]) -> Discounts:
        r, raw = np.arange(1, K + 2), np.array(occurs[: K + 1], float)
        if (raw > 0).all():
            slope, level = np.polyfit(np.log(r), np.log(raw), 1)
            for n in (raw, np.exp(level + slope * np.log(r))):
                common = (K + 1) * n[K] / n[0]
                if common < 1:
                    good = (r[1:] * n[1:] / n[:-1] / r[:-1] - common) / (1 - common)
                    if (0 < good).all() and (good < 1).all():
                        return Discounts(tuple(good.tolist()))
        return Discounts(tuple((k - 0.5) / k for k in range(1, K + 1)))

    def apply(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        factor = np.array([0.0, *self.factors, 1.0])
        return factor[np.minimum(counts, K + 1)] * counts


def _word_bucket(group: pa.Table) -> pa.Table:
    """Sum a bucket's words over all blocks; answer with each word's number in the bucket (from 1, the most frequent first) and count."""
    bucket, sent = group["bucket"][0].as_py(), [_unpack(x, [np.uint64, np.uint32]) for x in group["columns"].to_pylist()]
    words, place = np.unique(np.concatenate([x[0] for x in sent]), return_inverse=True)
    total = np.bincount(place, np.concatenate([x[1] for x in sent]), len(words)).astype(np.int64)
    number = np.zeros(len(words), np.uint64)
    number[np.argsort(-total, kind="stable")] = np.arange(1, len(words) + 1, dtype=np.uint64)
    number[total == 0] = 0
    bounds = np.cumsum([len(x[0]) for x in sent])[:-1]
    rows = [("word", b, bucket, _zip(number[p]), _zip(total[p].astype(np.uint64))) for b, p in zip(group["block"].to_pylist(), np.split(place, bounds))]
    # occurrences of each count up to K + 1, then tokens above K, tokens and types
    stats = [*_occurrences(total), int(total[total > K].sum()), int(total.sum()), int((total > 0).sum())]
    rows.append(("word_stats", None, bucket, np.array(stats, np.int64).tobytes(), None))
    end = words == xxhash.xxh64_intdigest(END, 42)
    order = np.argsort(number)[total[np.argsort(number)] > 0]
    rows.append(("unigrams", None, bucket, _zip(words[order]), _zip(total[order].astype(np.uint64))))
    if end.any():  # each text has one start and one end
        rows.append(("texts", None, bucket, total[end].astype(np.int64).tobytes(), None))
    return _table(_ANSWER, rows)


def _occurrences(counts: np.ndarray) -> list[int]:
    """How often each count from 1 to K + 1 occurs."""
    return np.bincount(np.minimum(counts, K + 2).astype(np.int64), minlength=K + 3)[1 : K + 2].tolist()


class Frequent:
    """Words whose n-grams, as the word before the last, are dealt to several of the ``buckets``, by the last word; all others stay together.

    contexts: their numbers, sorted; spread: to how many buckets each. pairs: of such a word and a last word, those
    that are as frequent themselves, sorted; their n-grams are dealt once more, by the word before. Their counts
    (pair_counts) and those of their last words (pair_uses) are known beforehand, so no bucket needs them whole.
    """

    #: A word or pair is frequent from a bucket's even share of the tokens, over PART, on.
    PART = 1

    def __init__(self, counts: dict[int, int], tokens: int, buckets: int, pairs: list[tuple[int, int, int]] = ()):
        """``counts``: training counts by word number; ``pairs``: (word before << 32 | word, count, count of the word)."""
        share = lambda k: min(buckets, -(-k * buckets * self.PART // tokens))
        self.buckets, found = buckets, sorted((c, share(k)) for c, k in counts.items() if self.is_frequent(k, tokens, buckets))
        self.contexts, self.spread = (np.array([x[i] for x in found], np.uint64) for i in (0, 1))
        pairs = sorted(pairs)
        self.pairs, self.pair_counts, self.pair_uses = (np.array([x[i] for x in pairs], np.uint64) for i in (0, 1, 2))
        self.pair_spread = np.array([share(x[1]) for x in pairs], np.uint64)

    @classmethod
    def is_frequent(cls, count: int, tokens: int, buckets: int) -> bool:
        return count * buckets * cls.PART > tokens

    @staticmethod
    def place(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key in the sorted list, and whether it is there."""
        if not len(known):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return at, known[at] == keys

    def bucket(self, columns: list[np.ndarray]) -> np.ndarray:
        contexts, words = columns[0] >> np.uint64(32), columns[0] & np.uint64(NONE)
        at, found = self.place(self.contexts, contexts)
        shift = np.zeros(len(words), np.uint64)
        shift[found] = words[found] % self.spread[at[found]]
        if len(columns) > 1:
            at, found = self.place(self.pairs, columns[0])
            shift[found] += columns[1][found].astype(np.uint64) % self.pair_spread[at[found]]
        return ((contexts + shift) % np.uint64(self.buckets)).astype(np.int64)

    def pair_facts(self, contexts: np.ndarray) -> np.ndarray:
        """What the frequent pairs add to the facts of each context of one word."""
        at, found = self.place(np.unique(contexts), self.pairs >> np.uint64(32))
        out = facts_of(at[found], self.pair_counts[found].astype(np.int64), self.pair_uses[found].astype(np.int64), len(contexts))
        return out[np.unique(contexts, return_inverse=True)[1]] if len(contexts) else out


def facts_of(context: np.ndarray, total: np.ndarray, lower: np.ndarray, n: int) -> np.ndarray:
    """A row for each of ``n`` contexts: how many of the words seen after it have each count up to K, tokens and words above, and the same by their lower counts.

    Whole numbers, enough for its backoff weight whatever the discounts turn out to be.
    """
    out = []
    for c in (total, lower):
        out += [np.bincount(context, c == r, n) for r in range(1, K + 1)]
        out += [np.bincount(context, np.where(c > K, c, 0), n), np.bincount(context, c > K, n)]
    return np.stack(out, 1).astype(np.int64)


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order (a pair of numbers, then one number a column), and the place of each row among them."""
    first, place = np.unique(columns[0], return_index=True, return_inverse=True)[1:]
    for c in columns[1:]:
        key = place.astype(np.uint64) << np.uint64(32) | c.astype(np.uint64)
        first, place = np.unique(key, return_index=True, return_inverse=True)[1:]
    return [c[first] for c in columns], place


class Level:
    """The n-grams of one order among a bucket's rows: ``length`` words of context before the last word.

    rows: rows with so long a context; gram: the n-gram of each; total: an n-gram's count; context: an n-gram's
    context; own: whether this bucket alone has it; lower: the count of the n-gram without its first word (of the last
    word alone at the first level); parent: a context without its first word; words: the words of a context, the nearest first.
    """

    def __init__(self, columns: list[np.ndarray], counts: np.ndarray, uses: np.ndarray, length: int, below: Level | None, frequent: Frequent):
        word, near = columns[0] & np.uint64(NONE), [columns[0] >> np.uint64(32), *columns[1:]]
        self.rows = np.flatnonzero(near[length - 1] != NONE)
        key = near[length - 1][self.rows].astype(np.uint64)
        if below is not None:  # a row with a longer context has the shorter one too
            inside = np.searchsorted(below.rows, self.rows)
            key |= below.context[below.gram[inside]].astype(np.uint64) << np.uint64(32)
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        self.words = [c[self.rows[first]] for c in near[:length]]
        self.parent = None if below is None else below.context[below.gram[inside[first]]]
        _, at, self.gram = np.unique(of.astype(np.uint64) << np.uint64(32) | word[self.rows], return_index=True, return_inverse=True)
        self.context = of[at]
        self.total = np.bincount(self.gram, counts[self.rows], len(at)).astype(np.int64)
        self.lower = uses[self.rows[at]].astype(np.int64) if below is None else below.total[below.gram[inside[at]]]
        self.own = np.ones(len(at), bool)
        if below is None:  # frequent pairs are in several buckets; no bucket counts them as its own
            place, found = frequent.place(frequent.pairs, columns[0][self.rows[at]])
            self.total[found], self.own[found] = frequent.pair_counts[place[found]], False

    def facts(self) -> np.ndarray:
        seen = np.flatnonzero((self.total > 0) & self.own)
        return facts_of(self.context[seen], self.total[seen], self.lower[seen], int(self.context.max(initial=-1)) + 1)


def levels(columns: list[np.ndarray], counts: np.ndarray, uses: np.ndarray, frequent: Frequent) -> list[Level]:
    out: list[Level] = []
    for length in range(1, len(columns) + 1):
        out.append(Level(columns, counts, uses, length, out[-1] if out else None, frequent))
    return out


def _kinds(order: int, count=np.uint32) -> list:
    """Types of a message's columns: (word before the last, last word), the further context, count."""
    return [np.uint64, *[np.uint32] * (order - 2), count]


def _parts(found: list[Level], frequent: Frequent, buckets: int) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """The contexts of frequent words, which are in several buckets: which they are at each level, where their facts are summed, their words."""
    which = [np.flatnonzero(frequent.place(frequent.contexts, x.words[0].astype(np.uint64))[1]) for x in found]
    words = [np.concatenate([(x.words[i][at] if i < len(x.words) else np.full(len(at), NONE)).astype(np.uint64) for x, at in zip(found, which)]) for i in range(len(found))]
    mixed = np.zeros(len(words[0]), np.uint64)
    for w in words:
        mixed = (mixed ^ w) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return which, (mixed % np.uint64(buckets)).astype(np.int64), words


def _gram_bucket(group: pa.Table, order: int, frequent: Frequent) -> pa.Table:
    """A bucket's row of the table; its counts of counts; and its part of the facts of contexts of frequent words."""
    bucket, sent = group["bucket"][0].as_py(), [_unpack(x, _kinds(order)) for x in group["columns"].to_pylist()]
    bounds = np.cumsum([len(x[0]) for x in sent])[:-1]
    whole = [np.concatenate(x) for x in zip(*sent)]
    del sent
    columns, place = _distinct(whole[:-2])
    counts = np.bincount(place, whole[-2], len(columns[0])).astype(np.uint64)
    uses = np.empty(len(counts), np.uint64)
    uses[place] = whole[-1]
    del whole
    rows = [("grams", bucket, None, _pack([*columns, counts], uses), group["block"].to_pylist(), [_zip(p.astype(np.uint32), True) for p in np.split(place, bounds)])]
    del place
    found = levels(columns, counts, uses, frequent)
    rows.append(("gram_stats", bucket, None, [np.array(_occurrences(x.total[x.own]), np.int64).tobytes() for x in found], None, None))
    which, where, words = _parts(found, frequent, frequent.buckets)
    if len(where):
        facts = np.concatenate([x.facts()[at] for x, at in zip(found, which)])
        for target in np.unique(where):
            at = where == target
            rows.append(("facts", int(target), bucket, [*(_zip(w[at]) for w in words), _zip(facts[at])], None, None))
    return _table(_TABLE, rows)


_WIDE = 2 * (K + 2)


def _sum_facts(group: pa.Table) -> pa.Table:
    """The facts of a context over all buckets that hold a part of it, for each of them in the order in which it sent its parts."""
    rows = group.to_pylist()
    words = [np.concatenate([_unzip(r["columns"][i], np.uint64) for r in rows]) for i in range(len(rows[0]["columns"]) - 1)]
    facts = np.concatenate([_unzip(r["columns"][-1], np.int64).reshape(-1, _WIDE) for r in rows])
    _, place = _distinct([words[0], *words[1:]])
    total = np.stack([np.bincount(place, f) for f in facts.T], 1).astype(np.int64)
    bounds = np.cumsum([len(_unzip(r["columns"][0], np.uint64)) for r in rows])[:-1]
    return _table(_TABLE, [("total", r["source"], r["bucket"], [_zip(total[p])], None, None) for r, p in zip(rows, np.split(place, bounds))])


def weights(facts: np.ndarray, own: Discounts, lower: Discounts, seen_below: np.ndarray | float, half_below: np.ndarray | bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens seen after each context, its backoff weight, and whether half a count is taken from each of its words.

    The weight is what the discounts leave, over the lower probability of all words not seen after the context, so
    all words sum to one. seen_below, half_below: the same of the context without its first word.
    """
    r = np.arange(1, K + 1)
    count, sums, many, below, sums_below, many_below = facts[:, :K], facts[:, K], facts[:, K + 1], facts[:, K + 2 : -2], facts[:, -2], facts[:, -1]
    seen, types = count @ r + sums, count.sum(1) + many
    half = (count.sum(1) == 0) & (types > 0)
    free = np.where(half, 0.5 * types, seen - count @ own.apply(r) - sums) / np.maximum(seen, 1)
    mass = np.where(half_below, sums_below - 0.5 * many_below, below @ lower.apply(r) + sums_below) / np.maximum(seen_below, 1)
    return seen, np.where(types > 0, free / (1 - mass), 1.0), half


def probabilities(found: list[Level], facts: list[np.ndarray], discounts: list[Discounts], p: np.ndarray, total: float) -> np.ndarray:
    """Probability of each row's last word after its context; ``p``: that of the word alone, of which there are ``total`` tokens."""
    p = p.copy()
    seen, half = np.array(total), np.array(False)
    for k, (level, f) in enumerate(zip(found, facts)):
        at = slice(None) if level.parent is None else level.parent
        below = (seen, half) if level.parent is None else (seen[at], half[at])
        seen, weight, half = weights(f, discounts[k + 1], discounts[k], *below)
        c = level.total
        own = np.where(half[level.context], c - 0.5, discounts[k + 1].apply(c)) / np.maximum(seen[level.context], 1)
        known, gram = c[level.gram] > 0, level.gram
        p[level.rows] = np.where(known, own[gram], p[level.rows] * weight[level.context[gram]])
    return p


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so sorted words meet the buckets in order."""
    return ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class _Block:
    """A packed block together with the answers to its words, which come bucket by bucket in the order of its words."""

    def __init__(self, packed: pa.Table, answers: list[dict], buckets: int):
        row = packed.to_pylist()[0]
        self.name, self.ids, self.sizes = row["block"], _unzip(row["ids"], np.uint32), _unzip(row["sizes"], np.uint32)
        self.held, self.doc_ids, self.nulls = _unzip(row["held"], np.uint8).astype(bool), _unzip(row["doc_ids"], np.int64), _unzip(row["nulls"], np.uint8).astype(bool)
        number, count = [], []
        for r in sorted((r for r in answers if r["kind"] == "word"), key=lambda r: r["bucket"]):
            n = _unzip(r["a"], np.uint64)
            number.append(np.where(n > 0, (n - np.uint64(1)) * np.uint64(buckets) + np.uint64(r["bucket"] + 1), np.uint64(0)))
            count.append(_unzip(r["b"], np.uint64).astype(np.int64))
        self.number, self.count = np.concatenate(number), np.concatenate(count)
        if len(self.number) != row["n_words"]:
            raise RuntimeError("answers do not fit the block's words")
        order = _unzip(row["order"], np.uint32)
        self.number, self.count = self.number[order], self.count[order]
        if self.number.max(initial=0) >= NONE:
            raise OverflowError("more than 2^32 distinct words")

    def grams(self, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The tokens whose word before is known, and of each: (that word, the token), then the words before that, NONE from the first unknown one on.

        The start of a text is known; before it there is nothing.
        """
        word = self.number[self.ids]
        starts = np.cumsum(self.sizes) - self.sizes
        at = np.arange(len(word)) - np.repeat(starts, self.sizes)
        near, known = [], np.ones(len(word), bool)
        for k in range(1, order):
            c = np.zeros_like(word)
            c[k:] = word[:-k]
            known &= (at + 1 >= k) & ((at + 1 == k) | (c > 0))
            near.append(np.where(known, np.where(at + 1 == k, START, c), NONE))
        rows = np.flatnonzero(near[0] != NONE)
        return rows, [(near[0] << np.uint64(32) | word)[rows], *(c[rows].astype(np.uint32) for c in near[1:])]


def score(docs: DataFrame, order: int = 3, most_tokens: int = 2_000_000) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``order``: words of the longest n-grams, 2 at least. Learns from the rows whose crc32(doc_id as text) leaves no 1
    on division by 5. A text has one start before its first word, so its first words have short contexts. Unknown
    words are one word that holds the unigram mass the discounts leave over. A seen n-gram has its discounted
    relative count; any other word gets the context's backoff weight times its probability after the context
    without its first word, and a context never seen in training backs off whole. The weight makes all words of a
    context sum to one exactly; a context without a discounted count gives one half of each count. Null texts count
    as empty (one token, the end); a null doc_id is a training row; repeated rows count as often as they stand; an
    empty table gives no rows; other columns are not read.
    """
    if order < 2:
        raise ValueError("order must be 2 at least")
    spark, home = docs.sparkSession, shared_dir(docs.sparkSession, "katz")
    pack(docs.select("doc_id", "text"), most_tokens).write.parquet(f"{home}/packed")
    packed = spark.read.parquet(f"{home}/packed")
    buckets = max(1, 2 * packed.count())

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, counts in zip(*(c.to_pylist() for c in batch.columns)):
                keys = _unzip(raw, np.uint64, True)
                yield from _table(_SENT, list(_send(block, word_bucket(keys, buckets), [keys, _unzip(counts, np.uint32)], buckets))).to_batches()

    asked = packed.select("block", "words", "counts").mapInArrow(words, _SENT_)
    asked.groupBy("bucket").applyInArrow(_word_bucket, _ANSWER_).write.partitionBy("kind").parquet(f"{home}/unigrams")
    unigrams = spark.read.schema(_ANSWER_).parquet(f"{home}/unigrams")
    # a row of nine numbers for each bucket
    stats = sum((np.frombuffer(r[0], np.int64) for r in unigrams.where("kind = 'word_stats'").select("a").toLocalIterator()), np.zeros(K + 4, np.int64))
    n, v = int(stats[K + 2]), int(stats[K + 3])
    uni = Discounts.of(stats[: K + 1].tolist())
    rest = max(n, 1) - float((uni.apply(np.arange(1, K + 1)) * stats[:K]).sum()) - float(stats[K + 1])
    unknown = max(rest, 0.5) / (max(n, 1) - rest + max(rest, 0.5))  # only a table without small counts needs the half
    total = float(max(n, 1)) if rest >= 0.5 else max(n, 1) - rest + 0.5
    many = max(1, n // (buckets * Frequent.PART))  # of training tokens, so few words have more
    alone = lambda uses: np.where(uses > 0, uni.apply(uses) / total, unknown)
    counted = pa.schema([("context", pa.int64()), ("word", pa.decimal128(20)), ("n", pa.int64())])

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                names, counts = _unzip(a, np.uint64), _unzip(b, np.uint64).astype(np.int64)
                hot = np.flatnonzero(counts >= many)
                yield pa.RecordBatch.from_pydict({"context": (hot * buckets + bucket + 1).tolist(), "word": [Decimal(int(x)) for x in names[hot]], "n": counts[hot].tolist()}, schema=counted)

    hot = unigrams.where("kind = 'unigrams'").select("bucket", "a", "b").mapInArrow(often, "context long, word decimal(20,0), n long")
    hot = sorted((int(r[1]), r[0], r[2]) for r in hot.toLocalIterator() if Frequent.is_frequent(r[2], n, buckets))
    texts = sum(int(np.frombuffer(r[0], np.int64)[0]) for r in unigrams.where("kind = 'texts'").select("a").toLocalIterator())
    hot_words, hot_numbers = np.array([x[0] for x in hot], np.uint64), np.array([START, *(x[1] for x in hot)], np.uint64)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each pair of frequent words (or of the start and one) stands in a block's training texts."""
        for batch in batches:
            for row in batch.to_pylist():
                at, found = Frequent.place(hot_words, _unzip(row["words"], np.uint64, True))
                which = np.where(found, at + 1, -1)[_unzip(row["order"], np.uint32)][_unzip(row["ids"], np.uint32)]
                sizes = _unzip(row["sizes"], np.uint32)
                before = np.concatenate([which[:0], [0], which[:-1]])[: len(which)]
                before[np.cumsum(sizes) - sizes] = 0
                use = (which > 0) & (before >= 0) & np.repeat(_unzip(row["held"], np.uint8) == 0, sizes)
                keys, k = np.unique(before[use] * len(hot_numbers) + which[use], return_counts=True)
                yield pa.RecordBatch.from_pydict({"a": keys // len(hot_numbers), "b": keys % len(hot_numbers), "n": k.astype(np.int64)})

    met = packed.select("words", "order", "ids", "sizes", "held").mapInArrow(pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # as many as buckets, over PART, at most
    met = met.where(F.col("n") * buckets * Frequent.PART > n).toLocalIterator()
    frequent = Frequent({x[1]: x[2] for x in hot} | {START: texts}, max(n, 1), buckets, [(int(hot_numbers[a]) << 32 | int(hot_numbers[b]), k, hot[b - 1][2]) for a, b, k in met])
    blocks = packed.drop("words", "counts")
    by_word = unigrams.where("kind = 'word'").select("kind", "block", "bucket", "a", "b")

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(_SENT, [])
        block = _Block(left, right.to_pylist(), buckets)
        rows, columns = block.grams(order)
        columns, place = _distinct(columns)
        counts = np.bincount(place, np.repeat(~block.held, block.sizes)[rows], len(columns[0])).astype(np.uint32)
        uses = np.empty(len(counts), np.uint64)
        uses[place] = block.count[block.ids[rows]]
        return _table(_SENT, list(_send(block.name, frequent.bucket(columns), [*columns, counts], buckets, uses)))

    asked = blocks.groupBy("block").cogroup(by_word.groupBy("block")).applyInArrow(ask, _SENT_)
    asked.groupBy("bucket").applyInArrow(lambda g: _gram_bucket(g, order, frequent), _TABLE_).write.partitionBy("kind").parquet(f"{home}/ngrams")
    ngrams = spark.read.schema(_TABLE_).parquet(f"{home}/ngrams")
    occurs = np.zeros((order - 1, K + 1), np.int64)
    for r in ngrams.where("kind = 'gram_stats'").select("columns").toLocalIterator():  # some numbers for each bucket
        occurs += np.array([np.frombuffer(x, np.int64) for x in r[0]])
    occurs[0] += np.array(_occurrences(frequent.pair_counts.astype(np.int64)), np.int64)
    discounts = [uni, *(Discounts.of(x.tolist()) for x in occurs)]
    sums = ngrams.where("kind = 'facts'").groupBy("bucket").applyInArrow(_sum_facts, _TABLE_)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(_ANSWER, [])
        row, totals = left.to_pylist()[0], {r["source"]: r["columns"][0] for r in right.to_pylist()}
        *columns, counts, uses = _unpack(row["columns"], _kinds(order, np.uint64))
        found = levels(columns, counts, uses, frequent)
        facts = [x.facts() for x in found]
        which, where, _ = _parts(found, frequent, buckets)
        whole = np.zeros((len(where), _WIDE), np.int64)
        for target in np.unique(where):
            whole[where == target] = _unzip(totals[int(target)], np.int64).reshape(-1, _WIDE)
        for f, at, new in zip(facts, which, np.split(whole, np.cumsum([len(x) for x in which])[:-1])):
            f[at] = new
        facts[0] += frequent.pair_facts(found[0].words[0].astype(np.uint64))
        # many n-grams have equal probabilities, so each value goes once, and of each n-gram its place
        log, which = np.unique(np.log10(probabilities(found, facts, discounts, alone(uses.astype(np.int64)), total)), return_inverse=True)
        rows = []
        for b, x in zip(row["blocks"], row["places"]):
            mine, place = np.unique(which[_unzip(x, np.uint32, True)], return_inverse=True)
            rows.append(("gram", b, row["bucket"], _zip(log[mine].view(np.int64), True), _zip(place.astype(np.uint32))))
        return _table(_ANSWER, rows)

    answers = ngrams.where("kind = 'grams'").groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(answer, _ANSWER_)
    result = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return result.empty_table()
        given = right.to_pylist()
        block = _Block(left, given, buckets)
        rows, columns = block.grams(order)
        columns, place = _distinct(columns)
        where = frequent.bucket(columns)
        log = np.zeros(len(where))
        for r in given:
            if r["kind"] == "gram":
                log[where == r["bucket"]] = _unzip(r["a"], np.int64, True).view(np.float64)[_unzip(r["b"], np.uint32)]
        uses = block.count[block.ids]
        each = np.log10(alone(uses))
        each[rows] = log[place]
        doc = np.repeat(np.arange(len(block.sizes)), block.sizes)
        add = lambda x: np.bincount(doc, x, len(block.sizes))
        base = np.log10((uses + 0.5) / (n + 0.5 * (v + 1)))
        cols = [pa.array(block.doc_ids, mask=block.nulls), block.held, block.sizes.astype(np.int64), add(uses > 0).astype(np.int64), np.full(len(block.sizes), n), add(base), add(each)]
        return pa.Table.from_arrays([pa.array(x) if not isinstance(x, pa.Array) else x for x in cols], schema=result)

    columns = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.groupBy("block").cogroup(by_word.union(answers).groupBy("block")).applyInArrow(scored, columns)
