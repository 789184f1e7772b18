"""Quality rules as a short-circuit cascade.

The two parts of the base test are rules like the others. A text goes through the rules until one rejects it, and a count is made when a rule first asks for
it, so a text that a cheap rule rejects never pays for the dear counts. The rules are independent of each other, so their order changes the work and never the
verdict. It is set by a sample: every rule runs on every sampled text with no count made before but that of the words, and the rules are then ordered
by the share they reject for each second they cost. ``judge`` returns the counts, so it makes all of them for every text; ``keep_passing`` stops early.

Defined cases: a null or empty text has no words and fails the base; words are split at the six ASCII white space characters; texts of any length are read
whole; equal rows give equal rows; an empty table gives no rows; rules of equal rate go by cost, then by name; further columns are ignored by ``judge`` and
kept by ``keep_passing``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table

SYMBOLS = b"#*$%&|<>"
SAMPLE = 2000
SEED = 8


class Text:
    """One text; each count is made once, when it is first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.data = text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.data, SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @property
    def base_failed(self) -> bool:
        return any(RULES[name](self) for name in BASE)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window which occurs twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words))
    size = len(number)
    pairs = ids[:-1] * size + ids[1:]
    if size > 1 << 20:  # so that the product below fits 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


UPPER, LOWER, DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))

#: Each rule is true for a text that it rejects.
RULES: dict[str, Callable[[Text], bool]] = {
    "few_words": lambda t: t.n_words < 50,
    "repeated_words": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > 3 * t.n_words,
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
    "repeated_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
    "exclamation": lambda t: 10 * t.data.count(b"!") > 3 * t.n_words,
    "digits": lambda t: 10 * _count(t.data, DIGITS) > 3 * t.word_chars,
    "shouting": lambda t: 2 * (upper := _count(t.data, UPPER)) > upper + _count(t.data, LOWER),
}
BASE = ("few_words", "repeated_words")


def cascade_order(df: DataFrame, text: str = "text", rules: dict[str, Callable[[Text], bool]] = RULES, sample: int = SAMPLE) -> list[str]:
    """Rule names by rejections per second over about ``sample`` rows; equal ones by cost, then by name."""

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0)
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py() or ""
                for name, rule in rules.items():
                    t = Text(text)
                    t.words  # shared by nearly all rules, so a cost of none
                    began = time.perf_counter()
                    rejected[name] += rule(t)
                    seconds[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array(list(seconds.values())), pa.array(list(rejected.values()), pa.int64())], names=["rule", "seconds", "rejected"])

    share = min(1.0, sample / max(1, df.count()))
    measured = df.select(df[text].cast("string")).sample(share, SEED).mapInArrow(timed, "rule string, seconds double, rejected bigint")
    found = measured.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    cost = {r.rule: r.seconds for r in found}
    rate = {r.rule: r.rejected / max(r.seconds, 1e-9) for r in found}
    return sorted(rules, key=lambda name: (-rate.get(name, 0.0), cost.get(name, 0.0), name))


def passes(t: Text, order: Sequence[str], rules: dict[str, Callable[[Text], bool]] = RULES) -> bool:
    """False at the first rule that rejects; the base is among the rules."""
    return not any(rules[name](t) for name in order)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdict, a row for each row."""
    order = cascade_order(df, text)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [df.schema[key]] + [T.StructField(c, T.LongType()) for c in counts] + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {f.name: [] for f in fields[1:]}
            for value in batch.column(1):
                t = Text(value.as_py() or "")
                for c in counts:
                    made[c].append(getattr(t, c))
                made["base_failed"].append(t.base_failed)
                made["kept"].append(passes(t, order))
            arrays = [pa.array(v, pa.int64() if c in counts else pa.bool_()) for c, v in made.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[f.name for f in fields])

    return df.select(df[key], df[text].cast("string")).mapInArrow(judged, T.StructType(fields))


def keep_passing(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass the base and all rules, as they are."""
    order, position = cascade_order(df, text), df.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([passes(Text(v.as_py() or ""), order) for v in batch.column(position)], pa.bool_()))

    return df.mapInArrow(kept, df.schema)


_SPACE = "\\x20\\x09-\\x0D"
ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^{_SPACE}]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS lines FROM texts),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS t(k) GROUP BY r),
counts AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[{_SPACE}]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines FROM words LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT 10 * n_symbols > 3 * n_words AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND NOT 2 * n_dup_lines > n_lines
  AND NOT 10 * length(regexp_replace(text, '[^!]', '', 'g')) > 3 * n_words AND NOT 10 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 3 * word_chars
  AND NOT 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS kept
FROM judged
"""


@query("op8_quality_rules", ORACLE)
def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judge(table(spark, sf_dir, "documents"))
