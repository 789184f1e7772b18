"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact weighted-shingle similarity.

An item of n words is compared with all windows of n words of a document (the whole document if it is shorter). Both are bags of five-word shingles. They match
at a weighted Jaccard similarity (sum of least counts by sum of largest counts) of SIMILARITY or more.

* Windows without a shingle of an item have similarity 0 with it, so only windows that overlap such a shingle are formed; an
  Aho-Corasick automaton over the items' shingles finds these places in one pass over the text. This loses nothing.
* Each window gets a 64-bit SimHash, from running sums of the bit votes of its shingles. The items' fingerprints are indexed by BLOCKS blocks of bits; a
  fingerprint within RADIUS bits differs by at most RADIUS // BLOCKS bits in one of the blocks, and each block's table lists
  the items for every such value. So the lookup returns all items within the radius.
* Every item found is verified by the exact similarity.
* At a similarity of 0.8 the distance is about 9 bits of 64, with a deviation of 3, so some matches lie outside RADIUS. None is lost: the automaton has
  told where the shingles of each item are, and two bags of c and m shingles that match have at least 4 (c + m) / 9 in common. Windows with as many
  shingles of an item are verified against it too, whatever their fingerprints.

The items are the stated query set: they reach the tasks in blocks of at most BLOCK_CHARS characters, and each block is held against all documents.

Defined cases: words are split at ASCII white space, A-Z in lower case; a null or empty text, on either side, matches nothing; an item or window of fewer
than five words is one shingle; rows of the same item or document match on their own; texts of any length are read whole; an empty table on either side gives no
matches; of windows equally similar to an item the first is named; further columns are ignored by ``matches`` and kept by ``without_leaks``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 14
BLOCKS = 5
BITS = 64
BLOCK_CHARS = 4_000_000

_EDGES = [round(BITS * i / BLOCKS) for i in range(BLOCKS + 1)]
_PARTS = [(np.uint64(a), np.uint64((1 << (b - a)) - 1), b - a) for a, b in zip(_EDGES, _EDGES[1:])]


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def shingles(words: list[bytes]) -> list[bytes]:
    if len(words) < SHINGLE:
        return [b" ".join(words)] if words else []
    return [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def votes(parts: list[bytes]) -> np.ndarray:
    """(shingles, 64): 1 for a set bit of the shingle's hash, else -1."""
    hashes = np.array([xxhash.xxh64_intdigest(s) for s in parts], "<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of vote sums."""
    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    least = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return least / (sum(a.values()) + sum(b.values()) - least)


class Index:
    """The items of one block: shingle automaton, fingerprint tables, shingle bags."""

    def __init__(self, items: tuple[str, ...]):
        import ahocorasick

        self.sizes: list[int] = []
        self.bags: list[Counter] = []
        self.fps: list[int] = []
        owners: dict[bytes, set[int]] = defaultdict(set)
        for i, text in enumerate(items):
            words = words_of(text)
            parts = shingles(words)
            self.sizes.append(len(words))
            self.bags.append(Counter(parts))
            self.fps.append(int(packed(votes(parts).sum(axis=0))[0]) if parts else 0)
            for s in parts:
                owners[s].add(i)
        self.find = ahocorasick.Automaton()
        for s, who in owners.items():
            self.find.add_word(f" {s.decode(errors='surrogateescape')} ", (s.count(b" ") + 1, len(s.decode(errors="surrogateescape")), tuple(who)))
        if owners:
            self.find.make_automaton()
        self.any = bool(owners)
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        for i, n in enumerate(self.sizes):
            blocks = self.tables.setdefault(n, [defaultdict(list) for _ in range(BLOCKS)])
            for block, (shift, mask, bits) in zip(blocks, _PARTS, strict=True):
                own = self.fps[i] >> int(shift) & int(mask)
                for d in range(RADIUS // BLOCKS + 1):
                    for flips in combinations(range(bits), d):
                        block[own ^ sum(1 << f for f in flips)].append(i)

    def within(self, size: int, fp: int) -> list[int]:
        """Items of ``size`` words whose fingerprint is within the radius: all of them."""
        met = {i for block, (shift, mask, _) in zip(self.tables[size], _PARTS, strict=True) for i in block.get(fp >> int(shift) & int(mask), ())}
        return [i for i in met if (self.fps[i] ^ fp).bit_count() <= RADIUS]

    def matches(self, text: str) -> dict[int, tuple[float, int]]:
        """Of each item that matches: the best similarity, and the first word of the first window that has it."""
        words = words_of(text) if self.any else []
        if not words:
            return {}
        flat = b" ".join(words).decode(errors="surrogateescape")
        hits = [(end - length, who) for end, (_, length, who) in self.find.iter(f" {flat} ")]
        if not hits:
            return {}
        # Places in " w1 w2 ... ": a hit's first character is the space before its first word.
        starts = np.cumsum([0] + [len(w.decode(errors="surrogateescape")) + 1 for w in words]).tolist()
        regions: dict[int, set[int]] = defaultdict(set)
        owned: dict[int, list[int]] = defaultdict(list)
        for at, who in hits:
            word = bisect_right(starts, at - 1) - 1
            for i in who:
                owned[i].append(word)
                n = min(self.sizes[i], len(words))
                reach = max(0, n - SHINGLE)
                regions[self.sizes[i]].update(range(max(0, word - reach), min(word, len(words) - n) + 1))
        parts = shingles(words)
        due = self._due(owned, len(words))
        found: dict[int, tuple[float, int]] = {}
        for size, places in regions.items():
            n = min(size, len(words))
            for run in _runs(sorted(places)):
                first, count = run[0], max(1, n - SHINGLE + 1)
                if n < SHINGLE:
                    sums = np.stack([votes([b" ".join(words[p : p + n])])[0] for p in run])
                else:
                    sums = np.concatenate([np.zeros((1, BITS), np.int64), np.cumsum(votes(parts[first : run[-1] + count]), axis=0)])
                    sums = sums[count:] - sums[:-count]
                for p, fp in zip(run, packed(sums).tolist(), strict=True):
                    near = {i for i in self.within(size, fp) if i in owned} | due.get((size, p), set())
                    if near:
                        bag = Counter(parts[p : p + count] if n >= SHINGLE else [b" ".join(words[p : p + n])])
                    for i in near:
                        s = similarity(self.bags[i], bag)
                        if s >= SIMILARITY and (i not in found or s > found[i][0]):
                            found[i] = (s, p)
        return found

    def _due(self, owned: dict[int, list[int]], length: int) -> dict[tuple[int, int], set[int]]:
        """(item size, first word) of the windows that hold enough shingles of an item to match it, with these items. ``owned``: ascending places of their shingles."""
        due: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, at in owned.items():
            n = min(self.sizes[i], length)
            count = max(1, n - SHINGLE + 1)
            least = max(1, ceil(SIMILARITY / (1 + SIMILARITY) * (self.bags[i].total() + count) - 1e-9))
            for first, last in zip(at, at[least - 1 :]):
                for p in range(max(0, last - count + 1), min(first, length - n) + 1):
                    due[self.sizes[i], p].add(i)
        return due


def _runs(places: list[int]) -> Iterator[list[int]]:
    run = [places[0]] if places else []
    for p in places[1:]:
        if p != run[-1] + 1 or len(run) >= 1 << 16:
            yield run
            run = []
        run.append(p)
    if run:
        yield run


@lru_cache(2)
def index(items: tuple[str, ...]) -> Index:
    """One for each worker process and block of items."""
    return Index(items)


def blocks_of(benchmark: DataFrame, key: str = "item_id", text: str = "text", most: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``most`` characters (a longer item is a block)."""
    block: list[tuple[int, str]] = []
    size = 0
    for item, value in benchmark.where(F.col(text).isNotNull()).select(key, text).orderBy(key, text).toLocalIterator():
        if block and size + len(value) > most:
            yield block
            block, size = [], 0
        block.append((item, value))
        size += len(value)
    if block:
        yield block


def _matched(items: list[tuple[int, str]], key: str):
    ids, texts = [i for i, _ in items], tuple(t for _, t in items)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(texts)
        for batch in batches:
            row, item, score, start = [], [], [], []
            for k, value in enumerate(batch.column(1)):
                for i, (s, p) in sorted(own.matches(value.as_py() or "").items()):
                    row.append(k)
                    item.append(ids[i])
                    score.append(s)
                    start.append(p)
            arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(start, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "item_id", "similarity", "first_word"])

    return matched


def matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, item_id, similarity, first_word): a row for each document row and item that match. One pass over the documents for each block of items."""
    fields = [docs.schema[key], T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType())]
    rows = docs.select(docs[key], docs[text].cast("string"))
    found = [rows.mapInArrow(_matched(items, key), T.StructType(fields)) for items in blocks_of(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], T.StructType(fields))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows that match no item, as they are."""
    position = docs.columns.index(text)

    def clean(texts: tuple[str, ...]):
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = index(texts)
            for batch in batches:
                yield batch.filter(pa.array([not own.matches(v.as_py() or "") for v in batch.column(position)], pa.bool_()))

        return kept

    for items in blocks_of(benchmark):
        docs = docs.mapInArrow(clean(tuple(t for _, t in items)), docs.schema)
    return docs


@query("op7_benchmark_decontamination")
def leaked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
