"""Session helpers: a local session for tests and benches, and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "rowmill") -> SparkSession:
    """A local session for tests and bench.py; clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: spark.checkpoint.dir, or a fresh local one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rowmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, *folders: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it; with a folder for each value of the columns ``folders``, if given.

    Cuts the lineage like a checkpoint, keeps columns prunable, and fixes
    values (such as partition numbers) that a recomputation could change.
    """
    path = os.path.join(shared_folder(df.sparkSession), f"t-{uuid.uuid4().hex}")
    (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads; none if it does not exist."""
    store, where = _folder(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(where)) if store.exists(where) else []


def file_sizes(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """Bytes of files, from the listings of their folders."""
    out: dict[str, int] = {}
    wanted = {p.rsplit("/", 1)[-1] for p in paths}
    for folder in sorted({p.rsplit("/", 1)[0] for p in paths}):
        store, where = _folder(spark, folder)
        out |= {f.getPath().toString(): f.getLen() for f in store.listStatus(where) if f.getPath().getName() in wanted}
    return out


def remove(spark: SparkSession, path: str) -> None:
    store, where = _folder(spark, path)
    store.delete(where, True)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not exist yet."""
    store, where = _folder(spark, path)
    out = store.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    store, where = _folder(spark, path)
    source = store.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def forget(df: DataFrame) -> None:
    """Delete the files of a table from ``materialize`` that nothing reads any more, as a round's once the next one is written."""
    path = getattr(df, "_stored_at", None)
    if path is not None and hasattr(df, "_jdf"):
        remove(df.sparkSession, path)


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan; None where the session does not expose it (Spark Connect)."""
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Operators that put out no more rows than they take in.
KEEPING = {"Project", "Filter", "Aggregate", "Distinct", "Deduplicate", "Sort", "GlobalLimit", "LocalLimit", "Window", "Union",
           "SubqueryAlias", "Repartition", "RepartitionByExpression"}


def rows_bound(df: DataFrame) -> int | None:
    """At most how many rows a plan gives: those of the Parquet files below it, read from their footers.

    None if an operator may multiply rows (a generator, an expansion, a join
    other than a semi or anti join) or a leaf is of another kind.
    """
    if not hasattr(df, "_jdf"):
        return None

    def parts(seq) -> list:
        return [seq.apply(i) for i in range(seq.size())]

    def bound(node) -> int | None:
        name = node.nodeName()
        if name.startswith("LocalRelation"):
            return node.data().size()
        if name.startswith("LogicalRelation") or name.startswith("Relation"):
            relation = node.relation()
            if "HadoopFsRelation" not in relation.getClass().getName() or "Parquet" not in relation.fileFormat().getClass().getName():
                return None
            return df.sparkSession.read.parquet(*[p.toString() for p in parts(relation.location().rootPaths())]).count()
        if name == "Join":
            return bound(node.left()) if node.joinType().toString() in ("LeftSemi", "LeftAnti") else None
        if name not in KEEPING:
            return None
        below = [bound(child) for child in parts(node.children())]
        return None if None in below else sum(below)

    return bound(df._jdf.queryExecution().optimizedPlan())


def shuffles(df: DataFrame) -> bool:
    """True when computing ``df`` moves rows between tasks, so that computing it twice is worth avoiding."""
    try:
        return re.search(r"(?<!Broadcast)Exchange", df._jdf.queryExecution().executedPlan().toString()) is not None
    except AttributeError:
        return True


def settled(df: DataFrame) -> DataFrame:
    """``df`` itself if it is a plain scan, else its rows written once: what follows may read it several times."""
    return materialize(df) if shuffles(df) else df
