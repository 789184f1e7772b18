"""Removal of repeated passages: every byte covered by a WIDTH-byte string that starts twice or more in the corpus.

Strings are found by merging Burrows-Wheeler transforms of shards (``bwt``), dealt so that no task needs the whole corpus:

1. Each window of WIDTH bytes has an anchor: of the ANCHOR-byte pieces inside it the one of least hash, the leftmost of equals. Equal windows have equal anchors at
   equal places. A run of neighbouring windows with one anchor is a segment. A row for each segment carries its place, the anchor's hash as its key, and its own hash;
   no text is moved for this. Equal segments are counted as one with a weight.
2. Keys met once cannot hold a repeated window and go. The bytes of the other segments are cut from one document each.
3. Segments are dealt to buckets by key. A bucket builds the transform of each of its shards and merges them; common prefixes of WIDTH bytes or more in the merged order
   are the repeated intervals. Segments of weight two or more are repeated whole and serve the others as partners.
4. A key with more than KEY_SEGMENTS different segments is split before that: its windows are dealt by the place of the anchor into twice as many ranges, time after
   time; windows of one range share more and more bytes around the anchor, whose hash is the new key. With ranges of one place the key is the window,
   and equal windows are one segment, so every key ends small.
5. Repeated windows go back to all places of their segment and are joined into runs of bytes for each distinct text.

Matches never cross documents; overlaps within a document count. Spans are judged on the input.

Defined cases: a null text is empty; a text shorter than WIDTH bytes keeps all; equal texts of WIDTH bytes or more lose all; a null key is carried on; repeated rows count as
repeats and come out as often as they came in; an empty table gives no rows; very long texts are read whole, in pieces; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm import bwt
from rowmill.llm.common import query, table
from rowmill.operators.joins import skew_join
from rowmill.session import forget, materialize

WIDTH = 400
ANCHOR = 64
PIECE = 1 << 20
KEY_SEGMENTS = 4096
BUCKET_BYTES = 4 << 20
SHARD_BYTES = 1 << 20

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_LOW = np.uint64((1 << 21) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def anchors(data: np.ndarray, width: int = WIDTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(for each window of ``data``, at most PIECE of them, where its anchor starts; for each place its piece's hash). ``size`` is a power of two."""
    value, factor, step = data.astype(np.uint64) + np.uint64(1), int(_MIX[0]), 1
    while step < size:  # polynomial hash of twice the bytes
        value = value[:-step] * np.uint64(factor) + value[step:]
        factor, step = factor * factor % (1 << 64), step * 2
    value = _mixed(value)
    least = (_mixed(value + _MIX[0]) & ~_LOW) | np.arange(len(value), dtype=np.uint64)
    span, step = width - size + 1, 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    return (least & _LOW).astype(np.int64), value.view(np.int64)


def _segments(text: bytes, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Of texts one after another in ``text``: (text number, start, windows, anchor's place in the segment, key) of each segment."""
    out: list[tuple[np.ndarray, ...]] = []
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(data) - width + 1), PIECE):
        part = data[at : at + PIECE + width - 1]
        place, keys = anchors(part, width)
        start = np.arange(len(place)) + at
        owner = np.searchsorted(offsets, start, "right") - 1
        inside = start + width <= offsets[owner + 1]
        start, owner, place = start[inside], owner[inside], place[inside]
        if not len(start):
            continue
        begin = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
        windows = np.diff(np.append(begin, len(start)))
        first = start[begin]
        out.append((owner[begin], first - offsets[owner[begin]], windows, place[begin] + at - first, keys[place[begin]]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(5))


def _occurrences(width: int):
    """(id, txt, text) to a row for each segment."""
    names = ["id", "txt", "start", "windows", "anchor", "key", "seg"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v.as_buffer()) for v in batch.column(2)], np.int64)
            ends = np.cumsum(sizes)
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
                text = b"".join(v.as_buffer().to_pybytes() for v in batch.column(2).slice(at, stop - at))
                offsets = np.append(0, np.cumsum(sizes[at:stop]))
                owner, start, windows, anchor, key = _segments(text, offsets, width)
                begin = offsets[owner] + start
                seg = [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(begin.tolist(), (begin + windows + width - 1).tolist())]
                rows = pa.array(owner + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start), pa.array(windows.astype(np.int32)), pa.array(anchor.astype(np.int32)),
                     pa.array(key), pa.array(seg, pa.binary())], names=names)
                at = stop

    return cut


SEGMENTS = "seg binary, key bigint, anchor int, windows int, level int, weight bigint, data binary"


def _cut_segments(width: int):
    """(wanted segments of a text, text) to rows of SEGMENTS."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wanted, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_buffer().to_pybytes()
                rows = pa.RecordBatch.from_struct_array(wanted.values)
                start, windows = rows.column("start").to_numpy(), rows.column("windows").to_numpy()
                data = [raw[a : a + n + width - 1] for a, n in zip(start.tolist(), windows.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("seg"), rows.column("key"), rows.column("anchor"), rows.column("windows"), pa.array(np.ones(len(data), np.int32)), rows.column("weight"),
                     pa.array(data, pa.binary())], names=["seg", "key", "anchor", "windows", "level", "weight", "data"])

    return cut


def _split(width: int):
    """Segments of hot keys to parts whose anchors lie in one of twice as many ranges: (parent, shift, columns of SEGMENTS)."""
    places = width - ANCHOR + 1

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                level, data, anchor = row["level"] * 2, row["data"], row["anchor"]
                size = -(-places // level)
                # The window that starts at i has its anchor at anchor - i.
                low, high = anchor - row["windows"] + 1, anchor
                for cell in range(low // size, high // size + 1):
                    a, b = max(low, cell * size), min(high, cell * size + size - 1)
                    shift = anchor - b
                    part = data[shift : anchor - a + width]
                    known = data[max(0, anchor - cell * size) : anchor + width - min(cell * size + size, places) + 1]
                    key = xxhash.xxh64_intdigest(known, level * places + cell)
                    rows.append({"parent": row["seg"], "shift": shift, "seg": xxhash.xxh3_128_digest(part, level * places + cell),
                                 "key": key - (1 << 64) if key >> 63 else key,
                                 "anchor": b, "windows": b - a + 1, "level": level, "weight": row["weight"], "data": part})
            yield pa.RecordBatch.from_pylist(rows, schema=split_schema)

    split_schema = pa.schema([("parent", pa.binary()), ("shift", pa.int32()), ("seg", pa.binary()), ("key", pa.int64()), ("anchor", pa.int32()),
                              ("windows", pa.int32()), ("level", pa.int32()), ("weight", pa.int64()), ("data", pa.binary())])
    return split


def _bucket(width: int):
    """Segments of one bucket to (seg, lo, hi): the runs of windows that occur elsewhere in the bucket."""

    def merged(part: pa.Table) -> pa.Table:
        data = [v.as_py() for v in part.column("data")]
        named = [v.as_py() for v in part.column("seg")]
        seen: dict[bytes, int] = {}
        for i, name in enumerate(named):
            seen.setdefault(name, i)
        rows = list(seen.values())
        forced = part.column("anchor").to_numpy() + ANCHOR
        windows = part.column("windows").to_numpy()
        shards, of, size, group = [], [], 0, []
        for n, i in enumerate(rows):
            group.append(i)
            size += len(data[i])
            if size >= SHARD_BYTES or n == len(rows) - 1:
                shards.append(bwt.shard([data[j] for j in group], [int(forced[j]) for j in group]))
                of.append(group)
                size, group = 0, []
        segs, lows, highs = [], [], []
        for flags, shard, group in zip(bwt.repeated(shards, width) if shards else [], shards, of):
            edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))  # a segment's last width - 1 bytes start no window
            lo, hi = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            at = np.searchsorted(shard.bounds, lo, "right") - 1
            segs += [named[group[k]] for k in at.tolist()]
            lows.append(lo - shard.bounds[at])
            highs.append(hi - shard.bounds[at])
            assert all(h <= windows[group[k]] for k, h in zip(at.tolist(), highs[-1].tolist()))
        empty = [np.zeros(0, np.int64)]
        return pa.table({"seg": pa.array(segs, pa.binary()), "lo": pa.array(np.concatenate(lows or empty).astype(np.int32)),
                         "hi": pa.array(np.concatenate(highs or empty).astype(np.int32))})

    return merged


def _repeated(segments: DataFrame, width: int) -> DataFrame:
    """(seg, lo, hi) of stored distinct segments (rows of SEGMENTS): runs of windows that occur twice or more."""
    whole = segments.where("weight > 1").selectExpr("seg", "0 as lo", "windows as hi")
    sizes = segments.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(sizes.where(F.col("n") > KEY_SEGMENTS).select("key"))
    cold = segments.join(hot, "key", "left_anti")
    total = segments.agg(F.sum(F.length("data"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // BUCKET_BYTES)))).alias("bucket")
    found = cold.select(bucket, "seg", "anchor", "windows", "data").groupBy("bucket").applyInArrow(_bucket(width), "seg binary, lo int, hi int")
    found = whole.unionByName(found)
    if not hot.head(1):
        return found
    parts = materialize(segments.join(hot, "key", "left_semi").mapInArrow(_split(width), "parent binary, shift int, " + SEGMENTS))
    columns = [F.first(c).alias(c) for c in ("key", "anchor", "windows", "level", "data")]
    # Equal parts of different segments are one part of their summed weight.
    children = materialize(parts.groupBy("seg").agg(F.sum("weight").alias("weight"), *columns))
    below = _repeated(children, width)
    back = skew_join(parts.select("parent", "shift", "seg"), below, ["seg"])
    return found.unionByName(back.select(F.col("parent").alias("seg"), (F.col("lo") + F.col("shift")).alias("lo"), (F.col("hi") + F.col("shift")).alias("hi")))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(txt, spans): for each distinct text with repeated bytes, by its MD5, the runs [lo, hi) of bytes to remove, ascending and apart."""
    value = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs[key].alias("id"), _digest(value).alias("txt"), value.alias("text")).where(F.length("text") >= width)
    found = T.StructType([T.StructField("id", docs.schema[key].dataType), *T.StructType.fromDDL("txt binary, start bigint, windows int, anchor int, key bigint, seg binary")])
    places = materialize(rows.mapInArrow(_occurrences(width), found))
    once = places.groupBy("seg").agg(F.count(F.lit(1)).alias("weight"), F.min(F.struct("txt", "id", "start")).alias("at"), F.first("key").alias("key"),
                                     F.first("windows").alias("windows"), F.first("anchor").alias("anchor"))
    once = materialize(once)
    shared = once.groupBy("key").agg(F.sum("weight").alias("n")).where("n > 1").select("key")
    taken = F.struct("seg", "key", "anchor", "windows", "weight", F.col("at.start").alias("start"))
    wanted = once.join(shared, "key").groupBy(F.col("at.txt").alias("txt"), F.col("at.id").alias("id")).agg(F.collect_list(taken).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"txt": "w_txt", "id": "w_id"})
    texts = rows.join(wanted, (rows["txt"] == wanted["w_txt"]) & rows["id"].eqNullSafe(wanted["w_id"])).select("wanted", "text")
    segments = materialize(texts.mapInArrow(_cut_segments(width), SEGMENTS))
    runs = materialize(_repeated(segments, width))
    for done in (once, segments):
        forget(done)
    ranges = skew_join(places.select("txt", "start", "seg"), runs, ["seg"])
    ranges = ranges.select("txt", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + width - 1).alias("hi")).alias("r"))
    return ranges.groupBy("txt").agg(F.collect_set("r").alias("r")).mapInArrow(_joined, "txt binary, spans array<struct<lo: bigint, hi: bigint>>")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges that meet or overlap become one."""
    for batch in batches:
        spans = []
        for ranges in batch.column(1):
            lo, hi = (ranges.values.field(i).to_numpy() for i in range(2))
            by = np.argsort(lo, kind="stable")
            lo, reach = lo[by], np.maximum.accumulate(hi[by])
            new = np.append(True, lo[1:] > reach[:-1])
            spans.append([{"lo": a, "hi": b} for a, b in zip(lo[new].tolist(), reach[np.append(new[1:], True)].tolist())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], names=["txt", "spans"])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_bytes, spans, kept): for each row its bytes' number, the runs removed, and the bytes that remain."""
    value = F.coalesce(docs[text].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(docs[key].alias("id"), _digest(value).alias("txt"), value.alias("text"))
    joined = rows.join(repeats(docs, key, text, width), "txt", "left").select("id", "text", "spans")
    made = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL("n_bytes bigint, spans array<struct<lo: bigint, hi: bigint>>, kept binary")])

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes = [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                raw, at, parts = text.as_buffer().to_pybytes(), 0, []
                for span in spans.as_py() or ():
                    parts.append(raw[at : span["lo"]])
                    at = span["hi"]
                kept.append(b"".join([*parts, raw[at:]]))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), batch.column(2), pa.array(kept, pa.binary())], schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    to_arrow = to_arrow_schema(made)
    return joined.mapInArrow(removed, made)


@query("op11_suffix_array_dedup")
def documents_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    spans = F.coalesce("spans", F.array())
    removed = F.expr("aggregate(coalesce(spans, array()), 0L, (n, x) -> n + x.hi - x.lo)")
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size(spans).cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
