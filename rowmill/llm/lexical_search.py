"""Ranked lexical search: a sharded index of compressed posting blocks, searched with Block-Max MaxScore.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case. A score sums, over the distinct terms of a query,
w * ((10^9 * tf) div (1000 * tf + 20 * m)), with w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 50 + (50 * n * N) div L: a BM25 in whole numbers.

``build`` makes the index. One pass counts N (documents with a term) and L (terms); a second one cuts every task's documents into shards of about SHARD_BYTES of text.
A shard numbers its documents by their key and writes a row for each of its terms: postings in blocks of BLOCK, each block as varints of (gap, tf), and a head of
its first and last document, the largest impact (the second factor above) inside it, and where it ends. No posting is shuffled.

``search`` reads only the lists of the terms that the queries hold. Queries are dealt into groups of about GROUP; a task takes one shard and one group.
For each query it sorts the lists by their global bounds (w times the largest impact): the lists whose bounds together stay below the score of the k-th best so far
are non-essential. Documents of essential lists are candidates; the block maxima of the non-essential lists at a candidate's place reject it before any
of their blocks is decompressed, then list by list with real scores. Documents are visited in windows, so the bar rises on the way.
SEEDS shards are searched first; the k-th best score over them is a proven bar for all others. Shard heaps of k rows are merged by rank.

Defined cases: a null text has no terms and is not counted; documents without terms are never found; equal scores rank by ascending key, a null key last; documents
with one key are separate documents, whose order at equal scores and keys is free; queries with the same key are one query that holds the terms of all; a query without
terms, or none that weighs more than 0, has no rows; repeated rows are found as often as they occur; empty tables give no rows; very long texts are read whole; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table
from rowmill.operators.joins import bounded_broadcast
from rowmill.session import materialize

TOP = 50
BLOCK = 128
SHARD_BYTES = 16 << 20
GROUP = 256
SEEDS = 16
WINDOW = 4096

_CLASS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
_HEAD = np.dtype([("first", "<i4"), ("last", "<i4"), ("impact", "<i4"), ("end", "<i4")])


@dataclass(frozen=True)
class Index:
    """rows: (shard, term, df, impact, heads, data) for each term of a shard, and (shard, keys, lengths) with a null term for its documents."""

    rows: DataFrame
    documents: int
    terms: int
    key: T.StructField


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of the text, term) of every term, in order."""
    texts = texts.cast(pa.binary())
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_CLASS))
    # Only ASCII bytes are changed, so the offsets hold; a null has length 0.
    strings = pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, plain], offset=texts.offset) if len(texts) else pa.array([], pa.string())
    split = pc.ascii_split_whitespace(strings)
    found = split.flatten()
    where = np.repeat(np.arange(len(texts)), split.value_lengths().to_numpy(zero_copy_only=False))
    real = pc.not_equal(found, "")
    return where[real.to_numpy(zero_copy_only=False)], found.filter(real)


def query_terms(text: Column) -> Column:
    """The same terms of a query, as an array column; may hold an empty string."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.split(lower, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))


def _encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Varint bytes of whole numbers, and where each value ends."""
    size = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = size > k
        out[ends[has] - size[has] + k] = (values[has] >> 7 * k) & 127 | np.where(size[has] > k + 1, 128, 0)
    return out, ends


def _decode(data: np.ndarray) -> np.ndarray:
    starts = np.append(0, np.flatnonzero(data < 128)[:-1] + 1)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def norms(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents with these numbers of terms."""
    if len(lengths) and 50 * int(lengths.max()) * documents >= 1 << 63:
        return np.array([50 + 50 * int(n) * documents // terms for n in lengths], np.int64)
    return 50 + 50 * lengths.astype(np.int64) * documents // max(1, terms)


def _shard(number: int, keys: pa.Array, texts: pa.Array, documents: int, terms: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of one shard."""
    order = pc.sort_indices(keys, null_placement="at_end")
    keys, texts = keys.take(order), texts.take(order)
    where, found = words_of(texts)
    n = len(texts)
    lengths = np.bincount(where, minlength=n).astype(np.int64)
    one = pa.array([number], pa.int64())
    ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), keys)
    sizes = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(lengths))
    nothing = [pa.nulls(1, t) for t in (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())]
    yield pa.RecordBatch.from_arrays([one, *nothing, ids, sizes], names=names)
    if not len(found):
        return
    coded = found.dictionary_encode()
    pairs, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + where, return_counts=True)
    term, doc = pairs // n, pairs % n
    starts = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    df = np.diff(np.append(starts, len(term)))
    first = (np.arange(len(term)) - np.repeat(starts, df)) % BLOCK == 0
    blocks = np.flatnonzero(first)
    after = np.append(blocks[1:], len(term))
    impact = impacts(tf, norms(lengths, documents, terms)[doc])
    data, ends = _encode(np.column_stack([np.where(first, 0, doc - np.append(0, doc[:-1])), tf]).ravel())
    ends = np.append(0, ends[1::2])
    heads = np.zeros(len(blocks), _HEAD)
    list_of = np.repeat(np.arange(len(starts)), df)[blocks]
    heads["first"], heads["last"] = doc[blocks], doc[after - 1]
    heads["impact"] = np.maximum.reduceat(impact, blocks)
    heads["end"] = ends[after] - ends[starts][list_of]
    head_offsets = np.append(0, np.cumsum(np.bincount(list_of, minlength=len(starts)))) * _HEAD.itemsize
    cut = lambda offsets, raw: pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(raw)])
    whole = pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(starts), number)), coded.dictionary.take(pa.array(term[starts])), pa.array(df.astype(np.int64)),
         pa.array(np.maximum.reduceat(impact, starts)), cut(head_offsets, heads.tobytes()), cut(ends[np.append(starts, len(term))], data.tobytes()),
         pa.nulls(len(starts), ids.type), pa.nulls(len(starts), sizes.type)], names=names)
    for at in range(0, len(starts), 10_000):
        yield whole.slice(at, 10_000)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Index:
    """The index of all rows, written to the shared folder."""
    texts = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text")).where("text is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, _ = words_of(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([len(np.unique(where))], pa.int64()), pa.array([len(where)], pa.int64())], names=["n", "l"])

    total = texts.select("text").mapInArrow(counted, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    n, length_of_all = int(total[0] or 0), int(total[1] or 0)
    schema = T.StructType.fromDDL("shard bigint, term string, df bigint, impact bigint, heads binary, data binary")
    schema = schema.add("keys", T.ArrayType(docs.schema[key].dataType)).add("lengths", T.ArrayType(T.LongType()))
    names = schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        keys, texts, size = [], [], 0
        for batch in batches:
            length, at = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), 0
            while at < batch.num_rows:  # a shard ends with the document that fills it
                stop = at + int(np.searchsorted(np.cumsum(length[at:]), SHARD_BYTES - size)) + 1
                part = batch.slice(at, stop - at)
                keys.append(part.column(0))
                texts.append(part.column(1))
                size, at = size + int(length[at:stop].sum()), stop
                if size >= SHARD_BYTES:
                    yield from _shard(number, pa.concat_arrays(keys), pa.concat_arrays(texts), n, length_of_all, names)
                    number, keys, texts, size = number + 1, [], [], 0
        if keys:
            yield from _shard(number, pa.concat_arrays(keys), pa.concat_arrays(texts), n, length_of_all, names)

    return Index(materialize(texts.mapInArrow(cut, schema)), n, length_of_all, docs.schema[key])


class _List:
    """One posting list of a shard; blocks are decompressed when asked for, once."""

    def __init__(self, weight: int, df: int, impact: int, heads: bytes, data: bytes, norm: np.ndarray):
        self.weight, self.df, self.norm = weight, df, norm
        self.bound = weight * impact
        self.heads = np.frombuffer(heads, _HEAD)
        self.first, self.last = self.heads["first"].copy(), self.heads["last"].copy()
        self.most = self.heads["impact"].astype(np.int64) * weight
        self.data = np.frombuffer(data, np.uint8)
        self.docs, self.scores = np.empty(df, np.int64), np.empty(df, np.int64)
        self.ready = np.zeros(len(self.heads), bool)

    def open(self, lo: int, hi: int) -> None:
        """Decompress the blocks lo to hi - 1 that are not yet."""
        missing = np.flatnonzero(~self.ready[lo:hi]) + lo
        for run in np.split(missing, np.flatnonzero(np.diff(missing) > 1) + 1) if len(missing) else ():
            a, b = int(run[0]), int(run[-1]) + 1
            values = _decode(self.data[self.heads["end"][a - 1] if a else 0 : self.heads["end"][b - 1]]).reshape(-1, 2)
            at = slice(a * BLOCK, a * BLOCK + len(values))
            gaps = np.cumsum(values[:, 0])
            begin = np.arange(0, len(values), BLOCK)
            shift = self.first[a:b] - gaps[begin]
            docs = gaps + np.repeat(shift, np.diff(np.append(begin, len(values))))
            self.docs[at], self.scores[at] = docs, self.weight * impacts(values[:, 1], self.norm[docs])
            self.ready[a:b] = True

    def span(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents in [start, stop) and their scores."""
        lo, hi = int(np.searchsorted(self.last, start)), int(np.searchsorted(self.first, stop))
        if lo >= hi:
            return self.docs[:0], self.scores[:0]
        self.open(lo, hi)
        a, b = lo * BLOCK, min(hi * BLOCK, self.df)
        a, b = a + int(np.searchsorted(self.docs[a:b], start)), a + int(np.searchsorted(self.docs[a:b], stop))
        return self.docs[a:b], self.scores[a:b]

    def most_at(self, docs: np.ndarray) -> np.ndarray:
        """The block maximum at each of the documents, without decompression."""
        block = np.searchsorted(self.last, docs)
        inside = np.minimum(block, len(self.last) - 1)
        return np.where((block < len(self.last)) & (self.first[inside] <= docs), self.most[inside], 0)

    def score_at(self, docs: np.ndarray) -> np.ndarray:
        """Scores of ascending documents; opens their blocks only."""
        block = np.searchsorted(self.last, docs)
        inside = np.minimum(block, len(self.last) - 1)
        hit = (block < len(self.last)) & (self.first[inside] <= docs)
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(block[hit]):
            self.open(b, b + 1)
            a, z = b * BLOCK, min((b + 1) * BLOCK, self.df)
            some = np.flatnonzero(hit & (block == b))
            place = np.minimum(np.searchsorted(self.docs[a:z], docs[some]), z - a - 1) + a
            out[some] = np.where(self.docs[place] == docs[some], self.scores[place], 0)
        return out


def best(lists: list[_List], documents: int, k: int, bar: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k best with a score of at least ``bar`` and above 0, best first, ties by number."""
    lists = sorted(lists, key=lambda x: x.bound)
    sums = np.cumsum([x.bound for x in lists])
    docs, scores, bar = np.zeros(0, np.int64), np.zeros(0, np.int64), max(1, bar)
    for start in range(0, documents, WINDOW):
        stop = min(start + WINDOW, documents)
        spare = int(np.searchsorted(sums, bar))  # lists[:spare] together stay below the bar
        total, seen = np.zeros(stop - start, np.int64), np.zeros(stop - start, bool)
        for x in lists[spare:]:
            at, more = x.span(start, stop)
            total[at - start] += more
            seen[at - start] = True
        found = np.flatnonzero(seen)
        if not len(found):
            continue
        score, found = total[found], found + start
        bounds = [x.most_at(found) for x in lists[:spare]]
        most = score + sum(bounds, np.zeros(len(found), np.int64))
        for i in range(spare - 1, -1, -1):
            alive = np.flatnonzero(most >= bar)
            if len(alive) < len(found):
                score, found, most, bounds = score[alive], found[alive], most[alive], [x[alive] for x in bounds[: i + 1]]
            if not len(found):
                break
            real = lists[i].score_at(found)
            score, most = score + real, most + real - bounds[i]
        good = score >= bar
        docs, scores = np.append(docs, found[good]), np.append(scores, score[good])
        order = np.lexsort([docs, -scores])[:k]
        docs, scores = docs[order], scores[order]
        if len(docs) == k:
            bar = max(bar, int(scores[-1]))
    return docs, scores


def _heaps(index: Index, lists: DataFrame, queries: DataFrame, groups: DataFrame, item: T.StructField, k: int) -> DataFrame:
    """(item, key, score): for each query and shard the k best rows at or above the query's bar.

    queries: (term, grp, weight, items); groups: (grp, items, bars); lists: rows of the shards to search.
    """
    schema = T.StructType([T.StructField("item", item.dataType), T.StructField("key", index.key.dataType), T.StructField("score", T.LongType())])
    documents, terms = index.documents, index.terms

    def searched(part: pa.Table) -> pa.Table:
        posting = part.column("term").is_valid()
        about, rows = part.filter(pc.invert(posting)), part.filter(posting)
        keys, items = about.column("keys")[0].values, about.column("items")[0].values
        lengths = about.column("lengths")[0].values.to_numpy()
        bars = about.column("bars")[0].values.to_numpy()
        norm = norms(lengths, documents, terms)
        of: list[list[_List]] = [[] for _ in range(len(items))]
        for row in range(rows.num_rows):
            value = lambda name: rows.column(name)[row]  # noqa: B023, E731
            made = _List(value("weight").as_py(), value("df").as_py(), value("impact").as_py(), value("heads").as_py(), value("data").as_py(), norm)
            for i in value("places").as_py():
                of[i].append(made)
        taken, places, scores = [], [], []
        for i, some in enumerate(of):
            docs, score = best(some, len(lengths), k, int(bars[i])) if some else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            taken.append(np.full(len(docs), i))
            places.append(docs)
            scores.append(score)
        empty = [np.zeros(0, np.int64)]
        return pa.table({"item": items.take(pa.array(np.concatenate(taken or empty))), "key": keys.take(pa.array(np.concatenate(places or empty))),
                         "score": pa.array(np.concatenate(scores or empty))})

    posting = lists.where("term is not null").join(queries, "term").select("shard", "grp", "term", "df", "impact", "heads", "data", "weight", "places")
    about = lists.where("term is null").select("shard", "keys", "lengths").join(posting.select("shard", "grp").distinct(), "shard").join(groups, "grp")
    both = posting.unionByName(about, allowMissingColumns=True)
    return both.groupBy("shard", "grp").applyInArrow(searched, schema)


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """(item, rank, key, score) as rows of the k best documents of each query."""
    item = items.schema[key]
    asked = items.select(items[key].alias("item"), F.explode(query_terms(items[text].cast("string"))).alias("term")).where("term <> ''").distinct()
    asked = materialize(asked.withColumn("h", F.xxhash64("item")))
    groups = max(1, -(-asked.select("item").distinct().count() // GROUP))
    asked = asked.select("item", "term", F.pmod("h", F.lit(groups)).cast("int").alias("grp"))
    terms = bounded_broadcast(materialize(asked.select("term").distinct()))
    lists = materialize(index.rows.where("term is not null").join(terms, "term", "left_semi").unionByName(index.rows.where("term is null")))
    weight = F.floor(1000 * F.log((2 * F.lit(float(index.documents)) + 2) / (2 * F.col("n") + 1))).cast("bigint")
    weights = lists.where("term is not null").groupBy("term").agg(F.sum("df").cast("double").alias("n")).select("term", weight.alias("weight")).where("weight > 0")
    members = asked.groupBy("grp").agg(F.sort_array(F.collect_set(F.struct("item"))).alias("members"))
    members = materialize(members.select("grp", F.col("members.item").alias("items")))
    numbered = members.select("grp", F.posexplode("items").alias("place", "item"))
    placed = asked.join(numbered, (asked["grp"] == numbered["grp"]) & asked["item"].eqNullSafe(numbered["item"])).select(asked["grp"], "term", "place")
    queries = bounded_broadcast(materialize(placed.groupBy("term", "grp").agg(F.collect_list("place").alias("places")).join(weights, "term")))
    shards = lists.where("term is null").select("shard")
    seeds = [r.shard for r in shards.orderBy(F.xxhash64("shard"), "shard").limit(SEEDS).collect()]
    first, rest = lists.where(F.col("shard").isin(seeds)), lists.where(~F.col("shard").isin(seeds))
    zero = members.withColumn("bars", F.transform("items", lambda _: F.lit(0).cast("bigint")))
    heaps = materialize(_heaps(index, first, queries, bounded_broadcast(zero), item, k))
    bar = _merged(heaps, k).where(F.col("rank") == k).select("item", F.col("score").alias("bar"))
    barred = numbered.join(bar, numbered["item"].eqNullSafe(bar["item"]), "left").groupBy("grp").agg(
        F.array_sort(F.collect_list(F.struct("place", numbered["item"].alias("item"), F.coalesce("bar", F.lit(0).cast("bigint")).alias("bar")))).alias("all"))
    barred = materialize(barred.select("grp", F.col("all.item").alias("items"), F.col("all.bar").alias("bars")))
    heaps = heaps.unionByName(_heaps(index, rest, queries, bounded_broadcast(barred), item, k))
    return _merged(heaps, k).select("item", "rank", "key", "score")


SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(terms) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms
        FROM documents)),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term) CROSS JOIN totals),
asked AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r) CROSS JOIN totals
  GROUP BY ALL),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query("op12_lexical_search", SQL)
def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    found = search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")
