"""Byte-level BPE through a sentencepiece model written directly from a rank file."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse
from pathlib import Path

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose ids a worker remembers; beyond it the memory is emptied and filled again (results are the same).
REMEMBERED = 400_000
#: Rows turned into one output batch, so that a batch of long texts stays small.
ROWS = 256


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in order of rank; ranks must be 0, 1, 2, ... ."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in Path(path).read_bytes().splitlines() if x))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks have holes")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece i is token i byte for byte in byte_symbols, its score is -i.

    The public message layout: pieces (1: text, 2: score, 3: kind), trainer settings (3: model kind, 4: size,
    40: unknown id) and normaliser settings (1: name, 3-5: no dummy prefix, white space kept, none escaped).
    One more piece, after the tokens, is the unknown one that sentencepiece demands; no text can give it.
    """
    symbol = byte_symbols()
    pieces = b"".join(
        _field(1, _field(1, "".join(map(symbol.__getitem__, t)).encode()) + _field(2, float(-i)) + _field(3, 1)) for i, t in enumerate(tokens)
    )
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + unknown + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        symbol = byte_symbols()
        self.symbols = dict(enumerate(symbol))
        back = {c: b for b, c in enumerate(symbol)}
        count = self.processor.get_piece_size() - 1
        pieces = [self.processor.id_to_piece(i) for i in range(count)]
        self.inverse = [bytes(map(back.__getitem__, p)) for p in pieces]
        self.whole = {p: i for i, p in enumerate(pieces)}
        self.packed = [struct.pack("<I", i) for i in range(count)]
        self.seen: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts, seen = [self.split(t) for t in texts], self.seen
        new = list(filterfalse(seen.__contains__, set(chain.from_iterable(parts))))
        if len(seen) + len(new) > REMEMBERED and seen:
            seen.clear()
            new = list(set(chain.from_iterable(parts)))
        named = [p.encode().decode("latin-1").translate(self.symbols) for p in new]
        rest = []
        for part, name in zip(new, named):
            if (i := self.whole.get(name)) is None:
                rest.append((part, name))
            else:
                seen[part] = self.packed[i]
        for (part, _), ids in zip(rest, self.processor.encode([n for _, n in rest], out_type=int, num_threads=1) if rest else ()):
            seen[part] = b"".join(map(self.packed.__getitem__, ids))
        return [b"".join(map(seen.__getitem__, p)) for p in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.inverse.__getitem__, memoryview(ids).cast("I")))


@lru_cache(1)
def _codec(model: bytes, pattern: str) -> Codec:
    """One for each worker process, whatever number of tasks it runs."""
    return Codec(model, pattern)


def _mapped(df: DataFrame, vocabulary: str, pattern: str, columns: str, step) -> DataFrame:
    # the vocabulary has a fixed size (about a megabyte), whatever the corpus
    model = df.sparkSession.sparkContext.broadcast(model_bytes(read_ranks(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or _codec(model.value, pattern)
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0).cast(pa.int64())} | step(codec, part.column(1).to_pylist()))

    return df.mapInArrow(run, f"doc_id long, {columns}")


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids. Special tokens do not exist: their strings are ordinary text.
    Repeated rows give repeated results; other columns of ``docs`` are not read.
    """
    return _mapped(docs.select("doc_id", "text"), vocabulary, pattern, "ids binary", lambda c, xs: {"ids": c.encode([x or "" for x in xs])})


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, bytes (binary) of every row of ``encoded`` (doc_id, ids); null ids give no bytes."""
    return _mapped(encoded.select("doc_id", "ids"), vocabulary, pattern, "bytes binary", lambda c, xs: {"bytes": [c.decode(x or b"") for x in xs]})


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, ids, bytes: ``decode`` of ``encode`` in one pass over the texts."""

    def step(codec: Codec, texts: list) -> dict:
        ids = codec.encode([x or "" for x in texts])
        return {"ids": ids, "bytes": [codec.decode(x) for x in ids]}

    return _mapped(docs.select("doc_id", "text"), vocabulary, pattern, "ids binary, bytes binary", step)


def digests(trip: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the result of ``round_trip``, and more of its columns."""
    return trip.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
        *more,
    )
