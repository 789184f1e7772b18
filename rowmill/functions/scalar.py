"""Scalar expressions that need more than one built-in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Date-format letters and the day number of 1970-01-01.
DATE_LETTERS = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "i": "mm", "s": "ss", "M": "MMMM", "W": "EEEE"}
EPOCH_DAY = 719528


def constant(value) -> Column:
    """A literal; a datetime without zone stays zone-free instead of becoming an instant in the session zone."""
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    return F.lit(value)


def pick(n: Column, *choices: str) -> Column:
    """The n-th choice (from 1), NULL when n is out of range."""
    return F.when(n.between(1, len(choices)), F.element_at(F.array(*map(F.lit, choices)), n.cast("int")))


def uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) fixed by key and salt, so a retried task draws the same one."""
    return draw(key, salt) / F.lit(float(2**32))


def draw(key: Column, salt: str) -> Column:
    """A 32-bit number fixed by key and salt."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(salt)))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint")


def format_date(c: Column, pattern: str) -> Column:
    """Format with percent letters, such as '%Y-%m'."""
    out, i = "", 0
    while i < len(pattern):
        if pattern[i] == "%":
            out += DATE_LETTERS[pattern[i + 1]]
            i += 2
        else:
            out += f"'{pattern[i]}'" if pattern[i].isalpha() else pattern[i]
            i += 1
    return F.date_format(c, out)


def period(c: Column) -> Column:
    """YYYYMM as a number."""
    return F.year(c) * 100 + F.month(c)


def period_diff(a: Column, b: Column) -> Column:
    """Months from period b to period a, both YYYYMM."""
    months = lambda p: F.floor(p / 100) * 12 + p % 100
    return months(a) - months(b)


def day_number(d: Column) -> Column:
    """Days since year 0."""
    return F.unix_date(d.cast("date")) + EPOCH_DAY


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp, whatever the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def start_of(unit: str, ts: Column) -> Column:
    """Start of the minute or hour of a zone-free timestamp from 1970 on, whatever the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add(unit, F.timestamp_diff(unit, epoch, ts), epoch)


def enum_ordinal(c: Column, domain: list[str]) -> Column:
    """Position of a value in its declared domain, from 1; NULL for NULL."""
    return F.array_position(F.array(*map(F.lit, domain)), c)


def set_mask(member: Column, domain: list[str]) -> Column:
    """Bit of one member of a SET domain, 0 outside it; combine rows with bit_or."""
    out = F.when(member == domain[0], F.lit(1).cast("bigint"))
    for i, v in enumerate(domain[1:], 1):
        out = out.when(member == v, F.lit(1 << i).cast("bigint"))
    return out.otherwise(F.lit(0).cast("bigint"))


def set_members(mask: Column, domain: list[str]) -> Column:
    """Members whose bit is set, in declared order."""
    marked = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(v)) for i, v in enumerate(domain)]
    return F.filter(F.array(*marked), lambda v: v.isNotNull())


def pad_char(c: Column, n: int) -> Column:
    """Fixed-width storage form."""
    return F.rpad(c, n, " ")


def read_char(c: Column) -> Column:
    """Fixed-width text as it is read back: trailing blanks are gone."""
    return F.rtrim(c)


def json_row(*columns: str | Column) -> Column:
    """A JSON object of the given columns; NULL fields stay in."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def pretty_json(c: Column, schema: str) -> Column:
    """Indented JSON. Each key starts a line, so the separator can be fixed per line."""
    text = F.to_json(F.from_json(c, schema), {"pretty": "true"})
    return F.regexp_replace(text, r'(?m)^(\s*"(?:[^"\\]|\\.)*") : ', "$1: ")
