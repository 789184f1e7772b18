"""Stored tables in versions: data folders that never change, and one list of them per version, written last.

A table is a folder with ``data/<write>/_part=<label>/`` and ``versions/v-<number>``. A version's file lists the partition folders that make up the table. Readers take the newest
complete list, so a change shows whole or not at all: a write that fails, at whatever point, leaves the table as it was, and can simply be run again. A change writes
new folders for the partitions it touches and lists the old folders of all others, whose files keep their names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.operators import mutate
from rowmill.session import entries, read_small, remove, write_new

END = "end"
UNNAMED = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Spark names the folder of NULL and empty labels


class VersionedTable:
    """``label`` is the column that names a row's partition; NULL labels are a partition too."""

    def __init__(self, spark: SparkSession, path: str, label: str):
        self.spark, self.path, self.label = spark, path.rstrip("/"), label

    def _numbers(self) -> list[int]:
        return sorted(int(n[2:]) for n in entries(self.spark, f"{self.path}/versions") if n.startswith("v-"))

    def version(self) -> tuple[int, dict]:
        """(number, content) of the newest complete version; (0, empty) if there is none."""
        for number in reversed(self._numbers()):
            lines = read_small(self.spark, f"{self.path}/versions/v-{number:012d}").split("\n")
            if lines[-1] == END:
                return number, json.loads(lines[0])
        return 0, {"schema": None, "parts": {}}

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Rows to new folders; the folder of each label."""
        folder = f"data/{uuid.uuid4().hex}"
        df.hint("rebalance", F.col(self.label)).withColumn("_part", F.col(self.label)).write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        found = [n for n in entries(self.spark, f"{self.path}/{folder}") if n.startswith("_part=")]
        return {unquote(n.removeprefix("_part=")): f"{folder}/{n}" for n in found}

    def _commit(self, schema: str, parts: dict[str, list[str]]) -> None:
        """The one step that changes what readers see; fails if another writer was faster."""
        number = (self._numbers() or [0])[-1] + 1
        write_new(self.spark, f"{self.path}/versions/v-{number:012d}", json.dumps({"schema": schema, "parts": parts}) + "\n" + END)

    def create(self, df: DataFrame) -> None:
        parts = self._write(df)
        self._commit(df.schema.json(), {k: [v] for k, v in parts.items()})

    def read(self, labels: Iterable[str] | None = None) -> DataFrame:
        """The rows, of the named partitions only if given; others are neither listed nor opened."""
        from pyspark.sql.types import StructType

        content = self.version()[1]
        schema = StructType.fromJson(json.loads(content["schema"]))
        parts = content["parts"] if labels is None else {k: content["parts"][k] for k in labels if k in content["parts"]}
        folders = [f"{self.path}/{f}" for some in parts.values() for f in some]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def labels_of(self, df: DataFrame) -> list[str]:
        """Names of the partitions that the rows lie in, as in folders; at most as many as partitions."""
        return [r[0] for r in df.select(F.coalesce(F.nullif(F.col(self.label).cast("string"), F.lit("")), F.lit(UNNAMED))).distinct().collect()]

    def rewrite(self, labels: Iterable[str], change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the named partitions by what ``change`` makes of their rows; rows it labels otherwise are added to those partitions."""
        content = self.version()[1]
        gone = set(labels)
        new = self._write(change(self.read(gone)))
        parts = {k: v for k, v in content["parts"].items() if k not in gone}
        for name, folder in new.items():
            parts[name] = [*parts.get(name, []), folder]
        self._commit(content["schema"], parts)

    def upsert(self, rows: DataFrame, keys: list[str], update: list[str], order: list[str] | None = None) -> None:
        """``mutate.upsert`` of a batch with the table's columns; only partitions that the batch hits are read and written. The label must follow from the keys."""
        self.rewrite(self.labels_of(rows), lambda old: mutate.upsert(old, rows, keys, update, order))

    def update(self, assign: dict[str, Column], where: Column) -> None:
        self.rewrite(self.labels_of(self.read().filter(where)), lambda old: mutate.update(old, assign, where))

    def delete(self, where: Column) -> None:
        self.rewrite(self.labels_of(self.read().filter(where)), lambda old: mutate.delete(old, where))

    def split(self, rest: str, relabel: Column) -> None:
        """Move rows of the catch-all partition to the partitions that ``relabel`` names; a NULL stays where it is."""
        self.rewrite([rest], lambda old: old.withColumn(self.label, F.coalesce(relabel, F.col(self.label))))

    def drop_old(self) -> None:
        """Delete all versions but the newest, and data that it does not list. No reader may still use them, and no writer be at work."""
        number, content = self.version()
        used = {f.split("/")[1] for some in content["parts"].values() for f in some}
        for n in self._numbers():
            if n != number:
                remove(self.spark, f"{self.path}/versions/v-{n:012d}")
        for folder in entries(self.spark, f"{self.path}/data"):
            if folder not in used:
                remove(self.spark, f"{self.path}/data/{folder}")
