"""Chat formatting with loss masks, by incremental rendering of a template that is treated as a black box.

A template is any function from a list of (role, text) to a string. Turns are located by rendering the first 1, 2, 3 ... turns: where an output continues
the one before, the new part is the new turn's span; where it doesn't, the template rewrites history, and the turn where that shows is reported. Inside a span, the text's
place is found by rendering two other texts, "a" and "b", in its stead: what all such outputs share at both ends is the template's own. Texts under the loss mask
are those of ``LOSS_ROLES``.

Prefixes cost the square of the number of turns. A template of TURNWISE, which renders each turn alike whatever stands before it, is therefore applied to slices of
SLICE turns; slices, not conversations, are dealt out to the tasks. At every cut, inside a slice of rows and between slices, it is checked that the turns on both sides
render alike together and apart; a template that fails is reported like one that rewrites history. This check sees two turns: it can't show what depends on more of them.
So any other template is rendered for all prefixes of whole conversations, each in one task, at that cost, unless the caller says that it is turnwise (``whole=False``).
Digests are sequential by nature, so the slices of one conversation are read by one task, in order, as a stream: it holds one slice at a time.

``marked`` is the template here: ``### Role: text</turn>`` and a line end. In texts, a backslash goes before each backslash, inside ``</turn>`` and between the signs of
``###``, so no control string occurs in them; dropping each backslash and keeping the character after it restores the text.

Defined cases: turns are ordered by turn, role, text, nulls first; a null text or role counts as empty, any role text is restored; a null conv_id is a conversation of its
own; repeated rows are turns of their own; turns and conversations of any length are rendered whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowmill.llm.common import query, table
from rowmill.operators.ordered import framed

SLICE = 64
LOSS_ROLES = frozenset({"assistant"})
NAMED = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in NAMED.items()}

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>")
    return re.sub(r"#(?=##)", r"#\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def marked(turns: list[Turn]) -> str:
    """The template: a marked line of text for each turn, whatever stands before it."""
    head = lambda role: NAMED.get(role) or "=" + escape(role).replace(":", "\\:")
    return "".join(f"### {head(role)}: {escape(text)}</turn>\n" for role, text in turns)


#: Templates that render each turn alike whatever stands before it.
TURNWISE = frozenset({marked})

_TURN = re.compile(r"### ((?:\\.|[^\\:])*): (.*?)</turn>\n", re.DOTALL)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked``."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn starts at {at}")
        name = m[1]
        turns.append((_ROLES.get(name) or unescape(name[1:]), unescape(m[2])))
        at = m.end()
    return turns


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], int]:
    """The rendered turns; of each its start, text start, text end and end; the number of the first turn that rewrites history, or -1.

    After a rewriting turn, spans refer to the output up to it and further turns are not located.
    """
    before, spans = template([]), []
    for k in range(1, len(turns) + 1):
        shown = template(turns[:k])
        if not shown.startswith(before):
            return template(turns), spans, k - 1
        role = turns[k - 1][0]
        a, b = template([*turns[: k - 1], (role, "a")]), template([*turns[: k - 1], (role, "b")])
        head = len(os.path.commonprefix([a, b]))
        tail = len(a) - head - 1
        spans.append((len(before), head, len(shown) - tail, len(shown)))
        before = shown
    return before, spans, -1


SPANS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "text_start", "text_stop", "stop")] + [T.StructField("loss", T.BooleanType())]))
_SPANS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "text_start", "text_stop", "stop")] + [("loss", pa.bool_())]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _out(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _cut(rows: Iterator[tuple], size: float) -> Iterator[list[tuple]]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def _last_turns(rows: DataFrame, conv: str) -> DataFrame:
    """The last row of each slice, as a row of the next slice of its conversation."""
    ends = rows.groupBy(conv, "slice").agg(F.max(F.struct("turn", "role", "text")).alias("last"))
    ends = framed(ends, [conv], ["slice"], {"next": lambda w: F.lead("slice").over(w)}, after=1)
    return ends.where(F.col("next").isNotNull()).select(conv, F.col("next").alias("slice"), "last.turn", "last.role", "last.text")


def format_conversations(df: DataFrame, template: Template = marked, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", whole: bool | None = None) -> DataFrame:
    """(conv, slice, part, n_turns, formatted, spans, rewrites): a row for each slice of at most SLICE turns, in order of (slice, part).

    ``spans`` are character offsets in ``formatted`` with a loss flag for each turn; ``rewrites`` is true if the template changed what it had shown.
    With ``whole`` (as usual unless the template is of TURNWISE), a conversation is one slice of all its turns.
    """
    whole = template not in TURNWISE if whole is None else whole
    names = [conv, "slice", "part", "n_turns", "formatted", "spans", "rewrites"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS, pa.bool_()]

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conversation, number), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
            last: Turn | None = None
            first = next(rows)
            if first[2]:
                rows = chain([first], rows)
            else:
                last = (first[4] or "", first[5] or "")
            for part, some in enumerate(_cut(rows, math.inf if whole else SLICE)):
                turns = [(r[4] or "", r[5] or "") for r in some]
                shown, spans, rewriting = locate(turns, template)
                changed = rewriting >= 0 or (last is not None and template([last, turns[0]]) != template([last]) + template([turns[0]]))
                flagged = [dict(zip(("start", "text_start", "text_stop", "stop"), s), loss=t[0] in LOSS_ROLES) for s, t in zip(spans, turns)]
                yield _out([(conversation, number, part, len(turns), shown, flagged, changed)], names, types)
                last = turns[-1]

    slices = F.lit(0) if whole else F.coalesce(F.floor(F.col(turn) / SLICE), F.lit(-(1 << 62)))
    rows = df.select(
        F.col(conv).cast("bigint").alias(conv), slices.cast("bigint").alias("slice"), F.lit(True).alias("own"),
        F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"),
    )
    if not whole:
        rows = rows.unionByName(_last_turns(rows, conv).withColumn("own", F.lit(False)))
    dealt = rows.repartition(conv, "slice").sortWithinPartitions(conv, "slice", "own", "turn", "role", "text")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names[:4]] + [T.StructField("formatted", T.StringType()), T.StructField("spans", SPANS), T.StructField("rewrites", T.BooleanType())])
    return dealt.mapInArrow(rendered, schema)


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the formatted slices of each conversation say, read back from them."""
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        for conversation, slices in groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            rewrites = False
            for _, _, _, _, shown, spans, changed in slices:
                for role, text in read_back(shown):
                    turns.update(f"{role}\n{text}\n".encode())
                    n_turns += 1
                for s in spans:
                    if s["loss"]:
                        text = unescape(shown[s["text_start"] : s["text_stop"]])
                        loss.update(text.encode())
                        loss_chars += len(text)
                chars += len(shown)
                rewrites |= changed
            done.append((conversation, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewrites))
            if len(done) == 1000:
                yield _out(done, names, types)
                done = []
        yield _out(done, names, types)

    schema = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewrites boolean"
    return formatted.repartition(conv).sortWithinPartitions(conv, "slice", "part").mapInArrow(read, f"`{conv}` bigint, {schema}")


TRICKY = "\\### Assistant: </turn> ok"


@query("op2_chat_formatting")
def formatted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of one whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    return digests(format_conversations(rows.unionByName(more)))
