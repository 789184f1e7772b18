"""Compare bound queries with their SQL in DuckDB: python tests/oracle_check.py [sf_dir] [name-substring ...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from rowmill.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value, digits=None):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return f"{value:.{digits or 12}g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    cols = sorted(df.columns)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = df.collect()
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    pos = [names.index(c) for c in cols]
    types = {c: (str(df.schema[c].dataType), str(cur.description[names.index(c)][1])) for c in cols}
    for c, (a, b) in types.items():
        if ("Decimal" in a) or "DECIMAL" in b or "HUGEINT" in b or (("Long" in a or "Integer" in a) != ("INT" in b)):
            return f"type of {c}: {a} vs {b}"
    a = sorted(tuple(plain(r[c]) for c in cols) for r in got)
    b = sorted(tuple(plain(r[p]) for p in pos) for r in want)
    if a == b:
        return None if a else "both empty"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; first {a[:2]} vs {b[:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ: {bad[:2]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            note = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # keep going, report at the end
            note = f"{type(e).__name__}: {str(e)[:600]}"
        if note and not note.startswith("rows only"):
            failed += 1
        if note or wanted:
            print(f"{name}: {note or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failed} failed of {len(entry.queries())}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
