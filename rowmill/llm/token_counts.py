"""Token counts of whole texts, equal to those of the tokenizers library.

Huge texts are encoded in overlapping chunks with offsets. Two neighbours are spliced at a place in their overlap that is

* a stable cut of the text: white space after another character. No match of a byte-level pattern holds such a place
  (see ``units``), and no special string does, as long as these hold no white space (checked when the file is read);
* the start of a token in both chunks, as their offsets say.

To its left the first chunk's tokens hold, to its right the second's: both read the same text from there on. Where an overlap has no such place,
it is widened fourfold to the left, and when it would leave the first chunk, both are encoded as one.

Other texts are cut into units at the same places. A unit's count is asked from the library once and kept for up to 2^19 units of a worker.

Defined cases: a null text counts as empty and has no tokens; texts of any length are counted whole; equal rows give equal rows;
an empty table gives no rows; further columns are ignored unless listed in ``keep``.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowmill.llm.common import query, table, with_text
from rowmill.llm.units import spaced_words, units

#: Texts over this many characters are huge.
CHUNK = 1 << 15
OVERLAP = 1 << 9
LIMIT = 512
KEPT = 1 << 19
WIDTH = 64


class Counter:
    """Counts by one file of the tokenizers library."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if any(set(t.content) & set(" \t\n\r\f\v") or t.lstrip or t.rstrip for t in self.library.get_added_tokens_decoder().values()):
            raise ValueError("a special string with white space could lie across a cut")
        self.chunk, self.overlap = chunk, overlap
        self.counts: dict[str, int] = {}
        self.widened = 0

    def starts(self, text: str, begin: int, end: int) -> list[int]:
        """Where the tokens of text[begin:end] start in the text."""
        return [begin + a for a, _ in self.library.encode(text[begin:end], add_special_tokens=False).offsets]

    def splice(self, text: str, left: list[int], right: list[int], begin: int, end: int) -> int | None:
        """The last place in (begin, end) that is a stable cut and the start of a token on both sides."""
        for at in range(end - 1, begin, -1):
            if text[at] in " \n" and not text[at - 1].isspace():
                i, j = bisect_left(left, at), bisect_left(right, at)
                if i < len(left) and left[i] == at and j < len(right) and right[j] == at:
                    return at
        return None

    def huge(self, text: str) -> int:
        """The count of a text, by chunks."""
        total, begin, end, step = 0, 0, min(self.chunk, len(text)), self.chunk
        left = self.starts(text, begin, end)
        while end < len(text):
            overlap, to = self.overlap, min(end + step, len(text))
            while True:
                start = max(begin, end - overlap)
                right = self.starts(text, start, to)
                if start == begin:  # one chunk in place of both, and a longer step, so that no text is encoded over and over
                    step = to - begin
                    break
                if (at := self.splice(text, left, right, start, end)) is not None:
                    total += bisect_left(left, at)
                    right = right[bisect_left(right, at) :]
                    start, step = at, self.chunk
                    break
                overlap *= 4
                self.widened += 1
            left, begin, end = right, start, to
        return total + len(left)

    def parts(self, text: str) -> list[str]:
        words = spaced_words(text)
        return units(text) if words is None else [words[0], *[" " + w for w in words[1:]]]

    def ask(self, wanted: list[str]) -> dict[str, int]:
        return {u: len(e.ids) for u, e in zip(wanted, self.library.encode_batch_fast(wanted, add_special_tokens=False), strict=True)}

    def count(self, texts: list[str]) -> list[int]:
        parts = [None if len(t) > self.chunk else self.parts(t) for t in texts]
        wanted = {u for p in parts if p for u in p}.difference(self.counts)
        if len(self.counts) + len(wanted) > KEPT:
            self.counts = {}
            wanted = {u for p in parts if p for u in p}
        asked = self.ask(list(wanted))
        known = self.counts
        known.update(asked)
        found = [self.huge(t) if p is None else sum(map(known.__getitem__, p)) for t, p in zip(texts, parts, strict=True)]
        for u in asked:
            if len(u) > WIDTH:
                del known[u]
        return found


@lru_cache(4)
def counter(path: str) -> Counter:
    """One for each worker process."""
    return Counter(path)


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: Sequence[str] = (), limit: int = LIMIT, group: int = 1 << 20) -> DataFrame:
    """One row per row: ``keep``, n_bytes, n_tokens and over_limit. Texts are counted in groups of about ``group`` characters."""
    fields = [df.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            n_bytes, n_tokens, texts, size = [], [], [], 0
            for value in batch.column(len(keep)):
                texts.append(value.as_py() or "")
                n_bytes.append(len(value.as_buffer()) if value.is_valid else 0)
                size += len(texts[-1])
                if size >= group:
                    n_tokens += own.count(texts)
                    texts, size = [], 0
            n_tokens += own.count(texts)
            made = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[f.name for f in fields])

    return with_text(df, keep, text).mapInArrow(counted, T.StructType(fields))


@query("op9_token_counts")
def counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token counts of every document."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep=["doc_id"])
