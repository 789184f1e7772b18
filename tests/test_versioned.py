"""Stored tables in versions: exact rows whatever fails, and untouched files."""

import pytest
from pyspark.sql import functions as F

from rowmill.session import entries
from rowmill.sources import versioned
from rowmill.sources.versioned import VersionedTable


def rows(table):
    return sorted((r.id, r.label or "", r.v) for r in table.read().collect())


def files(table):
    return {r[0] for r in table.read().select("_metadata.file_path").distinct().collect()}


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"), "label")
    made.create(spark.range(90).select("id", F.when(F.col("id") < 30, "a").when(F.col("id") < 80, "rest").alias("label"), F.lit(0).alias("v")))
    return made


START = sorted([(i, "a" if i < 30 else "rest" if i < 80 else "", 0) for i in range(90)])
def moved():
    return F.when(F.col("id") < 50, "b/1").when(F.col("id") < 60, "a")



@pytest.mark.parametrize("at", ["write", "after write", "commit", "half a commit"])
def test_failure_and_retry_give_exactly_the_rows(spark, table, monkeypatch, at):
    write, new = VersionedTable._write, versioned.write_new

    def broken_write(self, df):
        if at == "after write":
            write(self, df)
        raise OSError(at)

    def broken_commit(spark, path, text):
        if at == "half a commit":
            new(spark, path, text[: len(text) // 2])
        raise OSError(at)

    if "commit" in at:
        monkeypatch.setattr(versioned, "write_new", broken_commit)
    else:
        monkeypatch.setattr(VersionedTable, "_write", broken_write)
    with pytest.raises(OSError):
        table.split("rest", moved())
    assert rows(table) == START
    monkeypatch.undo()
    table.split("rest", moved())
    want = sorted([(i, "b/1" if 30 <= i < 50 else "a" if 50 <= i < 60 else label, v) for i, label, v in START])
    assert rows(table) == want
    assert sorted(r.id for r in table.read(["b/1"]).collect()) == list(range(30, 50))
    table.drop_old()
    assert rows(table) == want and len(entries(spark, table.path + "/versions")) == 1 and len(entries(spark, table.path + "/data")) == 2


def test_changes_leave_other_files_alone(spark, table):
    before = files(table)
    batch = spark.createDataFrame([(3, "a", 7), (3, "a", 8), (200, "a", 1)], "id long, label string, v int").withColumn("seq", F.monotonically_increasing_id())
    table.upsert(batch, ["id", "label"], ["v"], order=["seq"])
    after = dict((i, v) for i, _, v in rows(table))
    assert after[3] == 8 and after[200] == 1 and len(after) == 91
    kept = {f for f in before if "_part=a/" not in f}
    assert len(kept) >= 2 and kept < files(table) and not (before - kept) & files(table)
    table.update({"v": F.lit(5)}, F.col("id") == 85)
    table.delete((F.col("id") > 70) & (F.col("label") == "rest"))
    after = dict((i, v) for i, _, v in rows(table))
    assert after[85] == 5 and len(after) == 82 and table.version()[0] == 4
    with pytest.raises(Exception):  # another writer has taken the number
        numbers = table._numbers
        table._numbers = lambda: numbers()[:-1]
        table.delete(F.col("id") == 1)


def test_empty_partitions_go(spark, table):
    table.delete(F.col("label") == "a")
    assert set(table.version()[1]["parts"]) == {"rest", versioned.UNNAMED} and table.read(["a"]).collect() == []
    table.delete(F.lit(True))
    assert table.read().collect() == [] and table.read().columns == ["id", "label", "v"]
