"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

The leaf of a live position holds the rank of the pair that starts there, with the position below it as the lower
digits, so the root is the leftmost pair of minimum rank. A merge changes three leaves: the pair itself, the position it
swallows and the live neighbour before it. n bytes take O(n log n) steps, so a very long match is no special case.

Matches repeat, so each worker keeps the ids of up to 2^19 recent units (see ``units``) and as many matches in memory; the result does not
depend on it.

Defined cases: a null text counts as empty and has no tokens; texts of any length are encoded whole; equal rows give equal
rows; an empty table gives no rows; further columns of the input are ignored unless listed in ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowmill.llm.common import query, table, with_text
from rowmill.llm.units import Memo, spaced_words, units

NONE = 1 << 62
PACKED = 4096  # matches of this many bytes and more keep their tree in packed arrays: a little slower, about a quarter of the memory


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one match."""
    known = ranks.get(piece)
    if known is not None:
        return [known]
    n = len(piece)
    digits = n.bit_length()
    low = (1 << digits) - 1
    size = 1 << (n - 1).bit_length()
    made = list if n < PACKED else lambda values: array("q", values)
    tree = made([NONE]) * (2 * size)
    rank = ranks.get
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            tree[size + i] = r << digits | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    end = made(range(1, n + 1))
    begin = made(range(-1, n))  # of the token that ends at a position

    while (best := tree[1]) != NONE:
        i = best & low
        swallowed = end[i]
        end[i] = after = end[swallowed]
        begin[after] = i
        r = rank(piece[i : end[after]]) if after < n else None
        changed = [(size + swallowed, NONE), (size + i, NONE if r is None else r << digits | i)]
        before = begin[i]
        if before >= 0:
            r = rank(piece[before:after])
            changed.append((size + before, NONE if r is None else r << digits | before))
        for k, value in changed:
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encoding and decoding by a rank file and a pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(r) for token, r in map(bytes.split, f)}
        self.tokens = {r: token for token, r in self.ranks.items()}
        self.matches = regex.compile(pattern).findall
        pieces = Memo(self._piece, 1 << 19)
        self.plain = Memo(lambda unit: b"".join(map(pieces.__getitem__, self.matches(unit))), 1 << 16)
        self.spaced = Memo(lambda word: b"".join(map(pieces.__getitem__, self.matches(" " + word))), 1 << 19)

    def _piece(self, piece: str) -> bytes:
        ids = merged(piece.encode(), self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> np.ndarray:
        words = spaced_words(text)
        if words is None:
            packed = b"".join(map(self.plain.__getitem__, units(text)))
        else:
            packed = self.plain[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:]))
        return np.frombuffer(packed, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(4)
def codec(path: str, pattern: str) -> Codec:
    """One for each worker process."""
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = (), ids: bool = True, digests: bool = False) -> DataFrame:
    """One row per row: the columns ``keep``, n_tokens, and the ids (array) or the SHA-256 of the ids and of the decoded bytes.

    ``path`` is a rank file that every worker can open. Rows stay in their tasks: no shuffle.
    """
    fields = [df.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    if digests:
        fields += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            columns: dict[str, list] = {f.name: [] for f in fields[len(keep) :]}
            for value in batch.column(len(keep)):
                tokens = own.encode(value.as_py() or "")
                columns["n_tokens"].append(len(tokens))
                if ids:
                    columns["ids"].append(tokens.astype("i8"))
                if digests:
                    columns["ids_sha256"].append(hashlib.sha256(tokens.tobytes()).hexdigest())
                    columns["decoded_sha256"].append(hashlib.sha256(own.decode(tokens)).hexdigest())
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int64())}
            made = [pa.array(v, types.get(c, pa.string())) for c, v in columns.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[f.name for f in fields])

    return with_text(df, keep, text).mapInArrow(encoded, T.StructType(fields))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "bytes") -> DataFrame:
    """``df`` with the bytes of the ids in column ``into`` (null for null ids)."""
    fields = [f for f in df.schema.fields if f.name != into] + [T.StructField(into, T.BinaryType())]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            made = [None if v is None else own.decode(np.array(v, "i8")) for v in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != into]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.binary())], names=[f.name for f in fields])

    return df.mapInArrow(decoded, T.StructType(fields))


@query("op10_byte_bpe")
def encoded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], ids=False, digests=True)
