"""SimHash near-duplicates through pivot distance tables.

A fingerprint has 64 bits; two link at RADIUS or fewer differing bits. Hamming distance is a metric, so distances to fixed reference
fingerprints ("pivots") bound it from below. Two tables of such distances are worked out once for each distinct fingerprint:

* block tables: the bits fall into RADIUS + 2 blocks or more, each with BLOCK_PIVOTS references that are compared on that block alone.
  RADIUS differing bits touch at most RADIUS blocks, so two linked fingerprints have all distances equal in the other blocks.
  Equality of the distances of as many blocks is the join key: an equi-join, which finds every link. More blocks make
  more keys, and each far more selective; the number only changes the work (see ``blocks_for``), never the links;
* full tables: distances of the whole fingerprint to FULL_PIVOTS references. A pair that meets is discarded if the
  largest difference of coordinates exceeds the radius; the rest is verified by counting differing bits.

Both tests are part of the join condition, and a pair counts only in the first key it shares, so the join
puts out each link once and never the pairs of a group. A key that many different fingerprints share is split by
adaptive execution (one side in parts, the other read by each); equal fingerprints are one row before any join.

Defined cases: a null or empty text, or white space only, has the fingerprint zero and links like any other; a null doc_id is in its component but never
its name (null if all ids of a component are null); a repeated row comes out as often as it came in; an empty table
gives no rows; very long texts are hashed in blocks of shingles; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations
from math import comb
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table
from rowmill.operators.components import components
from rowmill.session import materialize

SHINGLE = 4
RADIUS = 4
BITS = 64
SEED = 42
BLOCK_PIVOTS = 12
FULL_PIVOTS = 8
CHANCE = 64
STEP = 1 << 16

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes, repeats counted; unsigned."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)
    counts = np.zeros(BITS, np.int64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    for at in range(0, shingles, STEP):
        part = words[at : at + STEP + width - 1]
        n = min(STEP, shingles - at)
        texts = map(b" ".join, zip(*(part[k:] for k in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter(map(digest, texts), dtype="<u8", count=n)
        lanes = np.bincount((hashes.view(np.uint8).reshape(n, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
        counts += (lanes @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * counts > shingles, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp as a signed 64-bit number. Rows stay in their tasks."""
    schema = T.StructType([df.schema[key], T.StructField("fp", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column(1))
            fps = np.fromiter(map(fingerprint, values), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return df.select(df[key], df[text].cast("string")).mapInArrow(hashed, schema)


def reference(i: int) -> int:
    """Reference fingerprint i, as a signed number: a hash of its number."""
    return int(np.uint64(xxhash.xxh64_intdigest(f"reference {i}", SEED)).view(np.int64))


def blocks_for(rows: int, radius: int = RADIUS) -> int:
    """The least number of blocks at which chance makes a fingerprint meet at most CHANCE of ``rows`` others."""
    for blocks in range(radius + 2, radius + 7):
        if rows * comb(blocks, radius) <= CHANCE * 2 ** (BITS * (blocks - radius) / blocks):
            break
    return blocks


def block_masks(blocks: int = RADIUS + 2) -> list[int]:
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    return [int(np.uint64((1 << b) - (1 << a)).view(np.int64)) for a, b in zip(edges, edges[1:])]


def block_table(fp: Column, block: int, mask: int) -> Column:
    """The distances of one block's bits to its references, four bits each (a block has 11 bits at most)."""
    parts = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(reference(block * BLOCK_PIVOTS + i))).bitwiseAND(F.lit(mask))).cast("bigint"), 4 * i) for i in range(BLOCK_PIVOTS)]
    return sum(parts[1:], parts[0])


def full_table(fp: Column) -> Column:
    """The distances of all bits to the full references, eight bits each."""
    parts = [F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(reference(1000 + i)))).cast("bigint"), 8 * i) for i in range(FULL_PIVOTS)]
    return sum(parts[1:], parts[0])


def _largest_difference(a: Column, b: Column) -> Column:
    at = lambda c, i: F.shiftrightunsigned(c, 8 * i).bitwiseAND(F.lit(255))
    return F.greatest(*[F.abs(at(a, i) - at(b, i)) for i in range(FULL_PIVOTS)])


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints ``fp`` within the radius, once each."""
    masks = block_masks(blocks or blocks_for(distinct.count(), radius))
    same = list(combinations(range(len(masks)), len(masks) - radius))
    fp = F.col("fp")
    tables = distinct.select("fp", full_table(fp).alias("full"), *[block_table(fp, i, m).alias(f"t{i}") for i, m in enumerate(masks)])
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.xxhash64(F.lit(k), *[f"t{i}" for i in some]).alias("key")) for k, some in enumerate(same)])
    keyed = tables.select("fp", "full", F.explode(keys).alias("x")).select("fp", "full", "x.k", "x.key")
    a, b = keyed.alias("a"), keyed.alias("b")
    fa, fb = F.col("a.fp"), F.col("b.fp")
    differing = fa.bitwiseXOR(fb)
    first = F.lit(None).cast("int")  # the first key of blocks without a differing bit; radius or fewer bits leave one at least
    for k, some in reversed([*enumerate(same)]):
        first = F.when(differing.bitwiseAND(F.lit(reduce(or_, (masks[i] for i in some)))) == 0, F.lit(k)).otherwise(first)
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.k") == F.col("b.k")) & (fa < fb)
    close = (_largest_difference(F.col("a.full"), F.col("b.full")) <= radius) & (F.bit_count(differing) <= radius)
    return a.join(b, met & close & (first == F.col("a.k"))).select(fa.alias("a"), fb.alias("b"))


def grouped(hashed: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for each distinct fp of (key, fp): the least fp of its component and the least key of its rows."""
    distinct = hashed.groupBy("fp").agg(F.min(key).alias("least"))
    stars = components(links(distinct.select("fp"), radius))
    rooted = distinct.join(stars.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left")
    rooted = rooted.select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id), a row for each row. Text is read once; what is kept of it is 16 bytes a row."""
    hashed = materialize(fingerprints(df, key, text))
    groups = grouped(hashed, key, radius).drop("root")
    return hashed.join(groups, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of each component: that of the least key. Columns as they are.

    Rows whose key is null or occurs more than once are told apart by their fingerprint, worked out again for them alone.
    """
    hashed = materialize(fingerprints(df, key, text))
    groups = materialize(grouped(hashed, key, radius))
    unclear = materialize(hashed.groupBy(F.col(key).alias("k")).count().where("k is null or count > 1").select("k"))
    chosen = groups.select(F.col("component_id").alias("k")).where("k is not null").distinct().join(unclear, "k", "left_anti")
    kept = df.join(chosen, df[key] == chosen["k"], "left_semi")
    if not unclear.head(1):
        return kept
    again = df.join(unclear, df[key].eqNullSafe(unclear["k"]), "left_semi")
    rows = again.select(F.struct(*[again[c] for c in again.columns]).alias("row"), again[key].alias("k"), again[text].cast("string").alias("text"))
    rows = rows.select("row", "k", _fingerprint_column()(F.col("text")).alias("fp")).join(groups, "fp")
    rows = rows.where(F.col("k").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.first("row").alias("row"))
    return kept.unionByName(rows.select("row.*"))


def _fingerprint_column():
    @F.pandas_udf("bigint")
    def column(texts):
        import pandas as pd

        made = [fingerprint((t or "").encode()) for t in texts]
        return pd.Series(np.array(made, np.uint64).view(np.int64))

    return column


@query("op4_simhash_near_dedup")
def near_duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
