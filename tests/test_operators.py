"""Fixtures with known results, and properties of single operators."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowmill.functions import scalar, udf
from rowmill.operators import (aggregates, audit, baskets, filters, hierarchy, islands, joins, layout, mutate, normalize, ordered, paging,
                               quality)
from rowmill.sources.versioned import VersionedTable
from rowmill.sources import generate, sink
from rowmill.sources.scan import literal_rows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Small tables with known results.
DEPT = [(1, "Engineering", "NYC"), (2, "Marketing", "LA"), (3, "HR", "Chicago"), (4, "Finance", "NYC")]
EMP = [(1, "Alice", 1, None, 120000), (2, "Bob", 1, 1, 95000), (3, "Carol", 1, 1, 90000), (4, "Dave", 2, None, 85000),
       (5, "Eve", 2, 4, 75000), (6, "Frank", 3, None, 70000), (7, "Grace", None, 1, 65000)]


@pytest.fixture(scope="module")
def org(spark):
    dept = literal_rows(spark, "dept_id int, dept string, location string", DEPT)
    emp = literal_rows(spark, "emp_id int, name string, dept_id int, manager_id int, salary int", EMP)
    return dept, emp


def test_joins(spark, org):
    dept, emp = org
    heads = dept.join(emp.groupBy("dept_id").agg(F.count("emp_id").alias("n")), "dept_id", "left").select("dept", F.coalesce("n", F.lit(0)))
    assert rows(heads) == [("Engineering", 3), ("Finance", 0), ("HR", 1), ("Marketing", 2)]
    assert joins.full_join(emp, dept, ["dept_id"]).select("name", "dept").distinct().count() == 8
    nyc = emp.join(dept.filter("location = 'NYC'"), "dept_id", "left")
    assert nyc.count() == 7 and nyc.filter("dept IS NOT NULL").count() == 3
    assert [r.name for r in emp.join(dept, "dept_id", "left_anti").collect()] == ["Grace"]
    assert joins.not_in(dept, "dept_id", emp, "dept_id").count() == 0  # the list holds a NULL
    assert joins.grid(dept.select("dept"), emp.select("name")).count() == 28


def test_org_chart_and_grades(spark, org):
    _, emp = org
    chart = hierarchy.org_chart(emp, "emp_id", "manager_id", "name")
    assert rows(chart.select("depth", "path")) == [(0, "Alice"), (0, "Dave"), (0, "Frank"), (1, "Alice → Bob"), (1, "Alice → Carol"),
                                                   (1, "Alice → Grace"), (1, "Dave → Eve")]
    grades = {r.name: r.g for r in emp.select("name", udf.salary_grade(F.col("salary")).alias("g")).collect()}
    assert grades == {"Alice": "Senior", "Bob": "Mid", "Carol": "Mid", "Dave": "Mid", "Eve": "Mid", "Frank": "Junior", "Grace": "Junior"}


# A small table with known results.
STAFF = [(1, "Alice", "Engineering", 95000, None), (2, "Bob", "Engineering", 85000, 1), (3, "Carol", "Marketing", 75000, 4),
         (4, "Dave", "Marketing", 90000, None), (5, "Eve", "Engineering", 80000, 1), (6, "Frank", "HR", 65000, None),
         (7, "Grace", "HR", 60000, 6), (8, "Heidi", "Engineering", 70000, 2)]


def test_staff(spark):
    s = literal_rows(spark, "emp_id int, name string, dept string, salary int, manager_id int", STAFF)
    assert rows(ordered.medians(s, ["dept"], "salary")) == [("Engineering", 82500.0), ("HR", 62500.0), ("Marketing", 82500.0)]
    assert rows(ordered.medians(s, [], "salary")) == [(77500.0,)]
    top = ordered.top_rows(s, ["dept"], ["-salary"], 2)
    assert {(r.dept, r.name) for r in top.collect()} == {("Engineering", "Alice"), ("Engineering", "Bob"), ("HR", "Frank"), ("HR", "Grace"),
                                                         ("Marketing", "Dave"), ("Marketing", "Carol")}
    up = hierarchy.ancestors(s, "emp_id", "manager_id", s.filter("emp_id = 8").select("emp_id"))
    assert rows(up.select("depth", "name")) == [(0, "Heidi"), (1, "Bob"), (2, "Alice")]
    from rowmill.plans.joining import above_group_mean
    assert sorted(r.name for r in above_group_mean(s, "dept", "salary").collect()) == ["Alice", "Bob", "Dave", "Frank"]
    from rowmill.plans.windowing import nth_highest
    assert [nth_highest(s, "salary", n).first().value for n in (2, 3, 99)] == [90000, 85000, None]


def test_rank_tables(spark):
    df = literal_rows(spark, "id int, v int", [(1, 100), (2, 100), (3, 90), (4, 80)])
    out = ordered.number_rows(ordered.ranks(df, [], ["-v"], rank="r", dense="d"), [], ["-v", "id"], "n").orderBy("id")
    assert [(r.n, r.r, r.d) for r in out.collect()] == [(1, 1, 1), (2, 1, 1), (3, 3, 2), (4, 4, 3)]


def test_sequences(spark):
    seq = literal_rows(spark, "id int", [(i,) for i in (1, 2, 4, 5, 8, 9, 10)])
    assert rows(islands.gaps(seq, "id")) == [(3, 3), (6, 7)]
    logs = literal_rows(spark, "id int, num int", list(enumerate([1, 1, 1, 2, 1, 2, 2], 1)))
    assert rows(islands.equal_runs(logs, "id", "num")) == [(1,)]
    numbers = literal_rows(spark, "n int", [(100,), (4,), (200,), (1,), (3,), (2,), (2,)])
    assert islands.runs_of(numbers, "n").agg(F.max("run_length")).first()[0] == 4
    stadium = literal_rows(spark, "id int, people int", list(enumerate([10, 109, 150, 99, 145, 1455, 199, 188], 1)))
    assert sorted(r.id for r in islands.rows_in_long_runs(stadium.filter("people >= 100"), "id", 3).collect()) == [5, 6, 7, 8]
    day = lambda d: dt.date(2024, 1, d)
    logins = literal_rows(spark, "u int, d date", [(1, day(1)), (1, day(2)), (1, day(3)), (1, day(5)), (2, day(1)), (2, day(2)), (2, day(2))])
    assert rows(islands.streaks(logins, "u", "d").select("u", "streak_start", "streak_end", "days")) == [
        (1, day(1), day(3), 3), (1, day(5), day(5), 1), (2, day(1), day(2), 2)]


def moment(h, m, s=0):
    return dt.datetime(2024, 1, 1, h, m, s)


@pytest.mark.parametrize("big", [False, True])
def test_sessions(spark, big, request):
    if big:
        request.getfixturevalue("small_tasks")
    times = [(1, moment(10, 0)), (1, moment(10, 15)), (1, moment(10, 50)), (1, moment(11, 30)), (2, moment(9, 0)), (2, moment(9, 20)),
             (3, moment(9, 0)), (3, moment(9, 30)), (3, moment(10, 0, 40)), (3, moment(10, 31, 40))]
    # A busy user whose gaps are all ten minutes: one session.
    times += [(4, moment(0, 0) + dt.timedelta(minutes=10 * i)) for i in range(300)]
    df = literal_rows(spark, "u int, ts timestamp_ntz, k int", [(u, x, i) for i, (u, x) in enumerate(times)])
    got = Counter((r.u, r.events) for r in islands.sessions(df, "u", "ts", "k").collect())
    assert got == Counter({(1, 2): 1, (1, 1): 2, (2, 2): 1, (3, 3): 1, (3, 1): 1, (4, 300): 1})


def test_bill_of_materials(spark):
    bom = literal_rows(spark, "c int, p int, name string, q int", [(1, None, "Product A", 1), (2, 1, "Assembly B", 2), (3, 1, "Part C", 3),
                                                                  (4, 2, "Part D", 1), (5, 2, "Part E", 2), (6, 4, "Raw F", 5)])
    out = hierarchy.exploded_parts(bom, "c", "p", "name", "q").orderBy("path")
    assert [(r.name[-1], r.total_needed) for r in out.collect()] == [("A", 1), ("B", 2), ("D", 2), ("F", 10), ("E", 4), ("C", 3)]


def test_cycle_is_an_error(spark):
    loop = literal_rows(spark, "id int, p int", [(1, 2), (2, 1)])
    with pytest.raises(ValueError):
        hierarchy.ancestors(loop, "id", "p", loop.filter("id = 1").select("id"))


def test_keep_lowest_and_duplicates(spark):
    people = literal_rows(spark, "id int, email string", [(1, "a@b.com"), (2, "c@d.com"), (3, "a@b.com"), (4, None), (5, None)])
    assert sorted(r.id for r in mutate.keep_lowest(people, "email", "id").collect()) == [1, 2, 4, 5]
    assert rows(aggregates.duplicates(people.filter("email IS NOT NULL"), ["email"])) == [("a@b.com", 2)]


def test_pivot_and_listing(spark, small_tasks):
    sales = literal_rows(spark, "p string, q string, v int", [("A", "Q1", 100), ("A", "Q2", 200), ("A", "Q3", 150), ("A", "Q4", 300), ("B", "Q1", 80),
                                                             ("B", "Q2", 120), ("B", "Q3", 90), ("B", "Q4", 200)])
    out = aggregates.pivot_sums(sales, ["p"], "q", ["Q1", "Q2", "Q3", "Q4"], F.col("v"))
    assert {(r.p, r.total) for r in out.collect()} == {("A", 750), ("B", 490)}
    words = spark.range(500).select(F.lit("g").alias("g"), F.col("id"), F.concat(F.lit("w"), "id").alias("w"))
    lines = aggregates.joined_lines(words, ["g"], "w", ["-id"], per_line=200).orderBy("line").collect()
    assert [r.line for r in lines] == [1, 2, 3]
    assert ", ".join(r.listing for r in lines) == ", ".join(f"w{i}" for i in range(499, -1, -1))


def test_constraints(spark):
    emp = literal_rows(spark, "id int, dept int, email string, salary int", [(1, 1, "a", 95000), (2, 1, "b", 88000), (3, 2, "c", 72000), (4, 99, "x", 50000),
                                                                            (5, 1, "a", 50000), (6, None, None, -100), (7, 1, None, None)])
    dept = literal_rows(spark, "dept int", [(1,), (2,), (3,)])
    assert [r.id for r in quality.check_foreign_key(emp, "dept", dept, "dept").collect()] == [4]
    assert rows(quality.check_unique(emp, ["email"])) == [("a", 2)]
    assert [r.id for r in quality.check_rule(emp, F.col("salary") > 0).collect()] == [6]
    assert sorted(r.id for r in quality.check_not_null(emp, ["email"]).collect()) == [6, 7]
    assert quality.check_primary_key(emp, ["id"]).isEmpty()
    keys = {r.columns: (r.is_superkey, r.is_candidate) for r in quality.column_keys(emp, ["id", "dept", "email"], 2).collect()}
    assert keys["id"] == (True, True) and keys["id,dept"] == (True, False) and keys["dept,email"] == (False, False)
    gone = literal_rows(spark, "d int", [(1,)])
    assert quality.delete_cascade(emp.select("dept", "id"), "dept", gone).count() == 3
    assert quality.delete_set_null(emp, "dept", gone).filter("dept IS NULL").count() == 5
    assert quality.delete_restrict(emp, "dept", gone).count() == 4


def test_null_logic(spark):
    r = spark.sql("SELECT NULL = NULL AS a, NULL IS NULL AS b, NULL <=> NULL AS c, coalesce(NULL, NULL, 'fallback') AS d, 0.1 + 0.2 AS e").first()
    assert (r.a, r.b, r.c, r.d, float(r.e)) == (None, True, True, "fallback", 0.3)


def test_scalars(spark):
    one = spark.range(1)
    day = F.lit(dt.datetime(2024, 3, 5, 14, 7, 9)).cast("timestamp_ntz")
    r = one.select(scalar.format_date(day, "%Y-%m-%d %H:%i:00").alias("a"), scalar.format_date(day, "%W, %M").alias("b"),
                   scalar.day_number(F.lit("2024-04-01").cast("date")).alias("c"), scalar.pick(F.lit(4), "x", "y").alias("d"),
                   scalar.enum_ordinal(F.lit("pending"), ["active", "inactive", "pending"]).alias("e"),
                   F.char_length(scalar.read_char(scalar.pad_char(F.lit("US"), 10))).alias("f"),
                   scalar.pretty_json(F.lit('{"a": "x : y", "b": 1}'), "a string, b int").alias("g"),
                   scalar.set_members(F.lit(5), ["r", "w", "x"]).alias("h"),
                   scalar.period_diff(F.lit(202402), F.lit(202311)).alias("i")).first()
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == ("2024-03-05 14:07:00", "Tuesday, March", 739342, None, 3, 2)
    assert r.g == '{\n  "a": "x : y",\n  "b": 1\n}' and r.h == ["r", "x"] and r.i == 3
    limits = one.select(*[udf.plan_limit(F.lit(p), F.lit(x)).alias(f"{p}{i}") for p in ("pro", "none") for i, x in enumerate(("max_users", "other"))]).first()
    assert tuple(limits) == (100, 0, None, 0)


def test_normal_forms(spark):
    wide = literal_rows(spark, "id int, list string", [(1, "Laptop, Mouse, Webcam"), (2, "Mouse")])
    items = normalize.split_list(wide, "list")
    assert rows(items) == [(1, 1, "Laptop"), (1, 2, "Mouse"), (1, 3, "Webcam"), (2, 1, "Mouse")]
    lookup, rest = normalize.decompose(items, ["item"], "item_id")
    assert lookup.count() == 3
    assert normalize.differences(items, rest.join(lookup, "item_id").drop("item_id")).isEmpty()
    assert normalize.differences(items, items.limit(3)).count() == 1
    prices = {1: 1299.99, 2: 29.99, 3: 49.99}
    lines = literal_rows(spark, "o int, p int, q int", [(1, 1, 1), (1, 2, 2), (2, 3, 1), (2, 2, 1), (3, 1, 2)])
    cost = literal_rows(spark, "p int, price double", list(prices.items())).withColumn("price", F.col("price").cast("decimal(18,2)"))
    totals = lines.join(cost, "p").groupBy("o").agg(F.sum(F.col("q") * F.col("price")).cast("double").alias("t"))
    assert rows(totals) == [(1, 1359.97), (2, 79.98), (3, 2599.98)]


@pytest.fixture(scope="module")
def dated(spark):
    dates = [dt.datetime(2022, 6, 15), dt.datetime(2023, 3, 20), dt.datetime(2024, 1, 5), dt.datetime(2024, 11, 1), dt.datetime(2025, 2, 1)]
    df = literal_rows(spark, "id int, ts timestamp_ntz", list(enumerate(dates, 1)))
    return df.withColumn("label", layout.year_bucket(F.col("ts"), 2022, 2024))


def test_partition_labels(spark, dated, tmp_path):
    assert rows(layout.partition_counts(dated, F.col("label"))) == [("p2022", 1), ("p2023", 1), ("p2024", 2), ("p_future", 1)]
    path = str(tmp_path / "t")
    layout.write_partitioned(dated, path, "label", compact=True)
    part = layout.read_years(spark, path, "ts", "label", 2022, 2024, dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1))
    assert sorted(r.id for r in part.collect()) == [3, 4]
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters_ = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert filters_ and "label" in filters_[0] and "p2024" in filters_[0] and "p2023" not in filters_[0]
    assert "GreaterThanOrEqual(ts" in plan
    table = VersionedTable(spark, str(tmp_path / "v"), "label")
    table.create(dated)
    table.split("p_future", layout.year_bucket(F.col("ts"), 2025, 2025))
    assert {r.label for r in table.read().select("label").distinct().collect()} == {"p2022", "p2023", "p2024", "p2025"}
    assert table.read().count() == 5
    assert layout.stored_sizes(spark, path, "label").filter("bytes > 0").count() >= 4
    sink.truncate(spark, path, "label=p2022")
    spark.catalog.refreshByPath(path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4, 5]
    kept, old = layout.split_archive(dated, "ts", dt.datetime(2024, 1, 1))
    assert (kept.count(), old.count()) == (3, 2)


def test_buckets_join_without_shuffle(spark, tmp_path):
    for name in ("a", "b"):
        layout.write_bucketed(spark.range(1000).withColumn(name, F.col("id") * 2), f"bucketed_{name}", str(tmp_path / name), "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = spark.table("bucketed_a").join(spark.table("bucketed_b"), "id")
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")


def test_list_partition_rejects(spark):
    df = literal_rows(spark, "id int, c string", [(1, "US"), (2, "UK"), (3, "JP"), (4, "AU"), (5, "ZZ"), (6, None)])
    groups = {"americas": ["US", "CA", "MX", "BR"], "europe": ["UK", "DE", "FR", "IT"], "apac": ["AU", "JP", "SG", "IN"]}
    good, rejects = layout.list_bucket(df, "c", groups)
    assert rows(good.groupBy("label").count()) == [("americas", 1), ("apac", 2), ("europe", 1)]
    assert sorted(r.id for r in rejects.collect()) == [5, 6]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    first = literal_rows(spark, "id int, a string", [(1, "x")])
    sink.replace_table(first, path)
    sink.append_rows(mutate.add_column(first, "b", "int", after="id"), path)
    assert rows(sink.read_evolved(spark, path).select("id", "b")) == [(1, None), (1, None)]
    sink.truncate(spark, path)
    assert spark.read.parquet(path).count() == 0


def test_typed_rows_and_clock(spark):
    out = mutate.with_defaults(literal_rows(spark, "id int, note string", [(1, None)]), "id bigint, note string, status string, at timestamp",
                               {"note": F.lit("never used"), "status": F.lit("pending"), "at": F.lit(dt.datetime(2024, 1, 1))})
    assert tuple(out.first()) == (1, None, "pending", dt.datetime(2024, 1, 1))


def test_upsert_idempotent(spark):
    t = literal_rows(spark, "k int, a int, b int", [(1, 1, 1), (2, 2, 2)])
    s = literal_rows(spark, "k int, a int, b int", [(2, 20, 20), (3, 30, 30)])
    once = mutate.upsert(t, s, ["k"], ["a"])
    assert rows(once) == [(1, 1, 1), (2, 20, 2), (3, 30, 30)]
    assert rows(mutate.upsert(once, s, ["k"], ["a"])) == rows(once)


def test_audit(spark):
    old = literal_rows(spark, "id int, v int", [(1, 1), (2, 2), (3, None)])
    new = literal_rows(spark, "id int, v int", [(1, 1), (2, 5), (3, None), (4, 4)])
    assert rows(audit.changes(old, new, "id", ["v"], "t").select("record_id", "action", "old_values", "new_values")) == [
        (2, "UPDATE", '{"v":2}', '{"v":5}'), (4, "INSERT", None, '{"v":4}')]


def test_paging(spark):
    df = spark.range(100)
    assert [r.id for r in paging.offset_page(df, ["id"], 2, 5).collect()] == [5, 6, 7, 8, 9]
    assert [r.id for r in paging.keyset_page(df, "id", 9, 3).collect()] == [10, 11, 12]
    assert [r.id for r in paging.top_k(df, ["-id"], 2).collect()] == [99, 98]


def test_filters(spark):
    df = literal_rows(spark, "id int, s string, deleted_at date", [(1, "CAFÉ", None), (2, "cafe", dt.date(2024, 1, 1)), (3, None, None)])
    assert df.filter(filters.same_text(F.col("s"), F.lit("Cafe"))).count() == 2
    assert filters.active(df).count() == 2
    whole = filters.disjoint_union(df, F.col("s") == "cafe", F.col("id") <= 3)
    assert rows(whole.select("id")) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_frequent_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(baskets, "PAIRS_PER_LINE", limit)
    rng = random.Random(2)
    lines = [(b, rng.randint(1, 9)) for b in range(60) for _ in range(rng.randint(1, 4))]
    lines += [(1000, rng.randint(1, 30)) for _ in range(150)]  # one basket holds about half of the lines
    naive = Counter()
    for basket in {b for b, _ in lines}:
        items = [i for b, i in lines if b == basket]
        for x in items:
            for y in items:
                if x < y:
                    naive[x, y] += 1
    want = sorted(((a, b, n) for (a, b), n in naive.items() if n >= 3), key=lambda r: (-r[2], r[0], r[1]))[:20]
    got = baskets.frequent_pairs(literal_rows(spark, "b int, i int", lines), "b", "i", 3, 20).collect()
    assert [(r.item_a, r.item_b, int(r.together)) for r in got] == want


def test_generators(spark):
    as_of = F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz")
    users = generate.users(spark, 1001, 6000, as_of)
    assert users.count() == 5000 and users.select("email").distinct().count() == 5000
    assert {r.status for r in users.select("status").distinct().collect()} == set(generate.USER_STATES)
    assert 0.27 < users.filter("last_login IS NULL").count() / 5000 < 0.33
    orders = generate.orders(spark, 5000, F.lit(50), as_of)
    low, high, first, last = orders.agg(F.min("amount"), F.max("amount"), F.min("customer_id"), F.max("customer_id")).first()
    assert low >= 5 and high <= 3000 and (first, last) == (1, 50)
    levels = {r.level: r["count"] for r in generate.logs(spark, 5000, as_of).groupBy("level").count().collect()}
    assert "FATAL" not in levels and 0.36 < levels["INFO"] / 5000 < 0.44
    txns = generate.transactions(spark, 2000, as_of)
    assert txns.exceptAll(generate.transactions(spark, 2000, as_of).repartition(3)).isEmpty()


def test_rough_count(spark):
    assert aggregates.rough_count(spark.range(200_000)) == (200_000, 0)
    sketch = aggregates.cardinality(spark.range(50_000).withColumn("m", F.col("id") % 1000), ["id", "m"], approximate=True)
    for r in sketch.collect():
        assert abs(r.cardinality / {"id": 50_000, "m": 1000}[r.column_name] - 1) < 0.15


def test_trips(spark):
    trips = literal_rows(spark, "client int, driver int, status string, day string", [
        (1, 10, "completed", "d1"), (2, 11, "cancelled", "d1"), (3, 12, "completed", "d1"), (4, 13, "cancelled", "d1"), (1, 10, "completed", "d2"),
        (2, 11, "completed", "d2"), (3, 12, "completed", "d2")])
    fair = trips.filter("client <> 2")
    out = fair.groupBy("day").agg(F.round(F.count_if(F.col("status") != "completed") / F.count("*"), 2).alias("r"))
    assert rows(out) == [("d1", 0.33), ("d2", 0.0)]


def test_relational_division(spark):
    bought = literal_rows(spark, "p int, c int", [(1, 1), (2, 1), (3, 2), (2, 2), (1, 1)])
    everyone = literal_rows(spark, "c int", [(1,), (2,)])
    assert rows(aggregates.bought_by_all(bought, ["p"], "c", everyone)) == [(2,)]


def test_shared_folder_setting(spark):
    from rowmill.session import materialize, shared_folder
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder and spark.conf.get("spark.checkpoint.dir") == folder
    assert materialize(spark.range(5)).count() == 5 and os.listdir(folder)
