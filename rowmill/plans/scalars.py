"""Scalar functions, one column each, in grouped queries."""

from pyspark.sql import functions as F

from rowmill.functions import scalar, udf
from rowmill.functions.money import money
from rowmill.plans.registry import query
from rowmill.sources.scan import latest


@query("fn_text", "FN-01", "FN-03", "FN-04", "FN-05", "FN-06", "FN-07", "FN-08", "FN-09", "FN-10", sql="""
    SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(p_name) AS chars, substring(p_name, 1, 5) AS head,
      left(p_name, 3) AS left3, p_name || ' [' || p_type || ']' AS joined, nullif(p_name, 'red ring') || '!' AS null_joined,
      trim('  ' || p_name || ' ') AS trimmed, replace(p_name, ' ', '_') AS replaced, instr(p_name, 'ring') AS pos,
      lpad(p_partkey::VARCHAR, 3, '0') AS padded, repeat('ab', p_size % 4) AS repeated FROM part""")
def text(t):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", F.upper(n).alias("up"), F.lower("p_brand").alias("low"), F.char_length(n).cast("bigint").alias("chars"),
        F.substring(n, 1, 5).alias("head"), F.left(n, F.lit(3)).alias("left3"),
        F.concat(n, F.lit(" ["), F.col("p_type"), F.lit("]")).alias("joined"),
        F.concat(F.nullif(n, F.lit("red ring")), F.lit("!")).alias("null_joined"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("trimmed"), F.replace(n, F.lit(" "), F.lit("_")).alias("replaced"),
        F.locate("ring", n).cast("bigint").alias("pos"), F.lpad(F.col("p_partkey").cast("string"), 3, "0").alias("padded"),
        F.expr("repeat('ab', p_size % 4)").alias("repeated"))


@query("fn_02_byte_length", "FN-02", sql="""
    SELECT p_partkey, strlen(s) AS bytes, length(s) AS chars FROM (SELECT p_partkey, replace(p_name, 'e', 'é') AS s FROM part)""")
def byte_length(t):
    s = F.replace("p_name", F.lit("e"), F.lit("é"))
    return t.part.select("p_partkey", F.octet_length(s).cast("bigint").alias("bytes"), F.char_length(s).cast("bigint").alias("chars"))


@query("fn_11_pick", "FN-11", sql="""
    SELECT p_partkey, ['small', 'medium', 'large'][p_size % 5] AS label FROM part""")
def pick(t):
    return t.part.select("p_partkey", scalar.pick(F.col("p_size") % 5, "small", "medium", "large").alias("label"))


@query("fn_12_casts", "FN-12", sql="""
    SELECT p_partkey, p_size::VARCHAR AS as_text, p_retailprice::DECIMAL(10,1)::DOUBLE AS rounded, replace(p_brand, 'Brand#', '')::BIGINT + 0 AS as_number,
      try_cast(p_brand AS BIGINT) AS dirty FROM part""")
def casts(t):
    return t.part.select("p_partkey", F.col("p_size").cast("string").alias("as_text"),
                         F.col("p_retailprice").cast("decimal(10,1)").cast("double").alias("rounded"),
                         (F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint") + 0).alias("as_number"),
                         F.col("p_brand").try_cast("bigint").alias("dirty"))


@query("fn_13_clock", "FN-13", sql="""
    SELECT o_orderkey, date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age_days FROM orders""")
def clock(t):
    return t.orders.select("o_orderkey", F.datediff(latest(t.orders, "o_orderdate"), "o_orderdate").cast("bigint").alias("age_days"))


@query("fn_dates", "FN-14", "FN-15", "FN-16", "FN-17", "FN-18", "FN-19", sql="""
    SELECT event_id, ts::DATE AS day, year(ts) AS y, month(ts) AS m, day(ts) AS d, dayname(ts) AS weekday, strftime(ts, '%Y-%m') AS ym,
      strftime(ts, '%Y%m') AS period, strftime(ts, '%Y-%m-%d %H:%M:00') AS minute, date_diff('day', DATE '2024-01-01', ts::DATE) AS since,
      ts + INTERVAL 3 DAY - INTERVAL 5 HOUR AS shifted, (ts::DATE + 30)::DATE AS due FROM events""")
def dates(t):
    ts = F.col("ts")
    big = lambda c: c.cast("bigint")
    return t.events.select(
        "event_id", F.to_date(ts).alias("day"), big(F.year(ts)).alias("y"), big(F.month(ts)).alias("m"), big(F.dayofmonth(ts)).alias("d"),
        scalar.format_date(ts, "%W").alias("weekday"), scalar.format_date(ts, "%Y-%m").alias("ym"),
        scalar.format_date(ts, "%Y%m").alias("period"), scalar.format_date(ts, "%Y-%m-%d %H:%i:00").alias("minute"),
        big(F.datediff(ts, F.lit("2024-01-01").cast("date"))).alias("since"),
        (ts + F.expr("INTERVAL 3 DAYS") - F.expr("INTERVAL 5 HOURS")).alias("shifted"), F.date_add(F.to_date(ts), 30).alias("due"))


@query("fn_20_22_spans", "FN-20", "FN-21", "FN-22", sql="""
    SELECT event_id, date_sub('hour', TIMESTAMP '2024-01-01 00:30:00', ts) AS hours, date_sub('minute', TIMESTAMP '2024-01-01 00:30:00', ts) AS minutes,
      date_sub('second', TIMESTAMP '2024-01-01 00:30:00', ts) AS seconds, (2024 * 12 + month(ts)) - (2022 * 12 + 11) AS months,
      date_diff('day', DATE '1970-01-01', ts::DATE) + 719528 AS day_no, floor(epoch(ts))::BIGINT AS unix FROM events""")
def spans(t):
    ts, start = F.col("ts"), F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id", *[F.timestamp_diff(u, start, ts).alias(n) for u, n in
                      (("HOUR", "hours"), ("MINUTE", "minutes"), ("SECOND", "seconds"))],
        scalar.period_diff(scalar.period(ts), F.lit(202211)).cast("bigint").alias("months"),
        scalar.day_number(ts).cast("bigint").alias("day_no"), scalar.epoch_seconds(ts).alias("unix"))


@query("fn_23_zone_shift", "FN-23", sql="""
    SELECT event_id, ts AS plain, ts + INTERVAL 330 MINUTE AS shifted FROM events""")
def zone_shift(t):
    return t.events.select("event_id", F.col("ts").alias("plain"),
                           F.convert_timezone(F.lit("UTC"), F.lit("+05:30"), "ts").alias("shifted"))


@query("fn_24_26_numbers", "FN-24", "FN-25", "FN-26", sql="""
    SELECT c_custkey, round(c_acctbal::DECIMAL(18,2), 0)::DOUBLE AS whole, round(c_acctbal::DECIMAL(18,2), 1)::DOUBLE AS tenth,
      ceil(c_acctbal)::BIGINT AS up, floor(c_acctbal)::BIGINT AS down, abs(c_acctbal) AS size, (floor(c_acctbal)::BIGINT) % 10 AS rest,
      power(c_nationkey, 2)::DOUBLE AS squared FROM customer""")
def numbers(t):
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.round(money(b), 0).cast("double").alias("whole"), F.round(money(b), 1).cast("double").alias("tenth"),
        F.ceil(b).alias("up"), F.floor(b).alias("down"), F.abs(b).alias("size"), (F.floor(b) % 10).alias("rest"),
        F.pow("c_nationkey", F.lit(2)).alias("squared"))


@query("fn_27_uniform", "FN-27", sql="""
    SELECT o_orderkey, ('0x' || left(md5(o_orderkey || ':draw'), 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM orders""")
def uniform(t):
    return t.orders.select("o_orderkey", scalar.uniform(F.col("o_orderkey"), "draw").alias("u"))


@query("fn_28_30_nulls", "FN-28", "FN-29", "FN-30", sql="""
    SELECT c_custkey, coalesce(a, -1) AS filled, coalesce(a, b, 99) AS first_set, nullif(c_mktsegment, 'MACHINERY') AS seg,
      CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side
    FROM (SELECT *, nullif(c_nationkey, 3) AS a, nullif(c_nationkey, 3) + 1 AS b FROM customer)""")
def nulls(t):
    a = F.nullif(F.col("c_nationkey"), F.lit(3))
    return t.customer.select(
        "c_custkey", F.ifnull(a, F.lit(-1)).alias("filled"), F.coalesce(a, a + 1, F.lit(99)).alias("first_set"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("seg"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("side"))


@query("fn_31_json_extract", "FN-31", sql="""
    SELECT event_id, props->>'$.k' AS k FROM events WHERE (props->>'$.k')::BIGINT > 50""")
def json_extract(t):
    k = F.get_json_object("props", "$.k")
    return t.events.filter(k.cast("bigint") > 50).select("event_id", k.alias("k"))


@query("fn_32_generated_column", "FN-32", sql="""
    SELECT event_k, count(*) AS n FROM (SELECT (props->>'$.k')::BIGINT AS event_k FROM events) GROUP BY 1""")
def generated_column(t):
    stored = t.events.withColumn("event_k", F.get_json_object("props", "$.k").cast("bigint"))
    return stored.groupBy("event_k").agg(F.count("*").alias("n"))


@query("fn_33_json_object", "FN-33", sql="""
    SELECT c_custkey, json_object('nation', nullif(c_nationkey, 3), 'segment', c_mktsegment)::VARCHAR AS doc FROM customer""")
def json_object(t):
    return t.customer.select("c_custkey", scalar.json_row(F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
                                                          F.col("c_mktsegment").alias("segment")).alias("doc"))


@query("fn_34_enum_ordinal", "FN-34", sql="""
    SELECT o_orderkey, list_position(['P', 'O', 'F'], o_orderstatus)::BIGINT AS ordinal FROM orders""")
def enum_ordinal(t):
    return t.orders.select("o_orderkey", scalar.enum_ordinal(F.col("o_orderstatus"), ["P", "O", "F"]).alias("ordinal"))


@query("fn_35_char_padding", "FN-35", sql="""
    SELECT p_partkey, length(rpad(p_name, 20, ' ')) AS stored, length(rtrim(rpad(p_name, 20, ' '))) AS as_read, length(p_name) AS plain FROM part""")
def char_padding(t):
    stored = scalar.pad_char(F.col("p_name"), 20)
    return t.part.select("p_partkey", F.char_length(stored).cast("bigint").alias("stored"),
                         F.char_length(scalar.read_char(stored)).cast("bigint").alias("as_read"),
                         F.char_length("p_name").cast("bigint").alias("plain"))


TYPES = ["view", "click", "signup", "purchase", "error"]


@query("fn_36_set_mask", "FN-36", sql="""
    WITH m AS (SELECT user_id, bit_or(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 4 WHEN 'purchase' THEN 8
      WHEN 'error' THEN 16 END)::BIGINT AS mask FROM events GROUP BY 1)
    SELECT user_id, mask, concat_ws(',', CASE WHEN mask & 1 > 0 THEN 'view' END, CASE WHEN mask & 2 > 0 THEN 'click' END,
      CASE WHEN mask & 4 > 0 THEN 'signup' END, CASE WHEN mask & 8 > 0 THEN 'purchase' END, CASE WHEN mask & 16 > 0 THEN 'error' END) AS members,
      mask & 8 > 0 AS bought FROM m""")
def set_mask(t):
    m = t.events.groupBy("user_id").agg(F.bit_or(scalar.set_mask(F.col("event_type"), TYPES)).alias("mask"))
    members = scalar.set_members(F.col("mask"), TYPES)
    return m.select("user_id", "mask", F.array_join(members, ",").alias("members"), F.array_contains(members, "purchase").alias("bought"))


@query("fn_37_pretty_json", "FN-37", sql="""
    SELECT event_id, '{' || chr(10) || '  "k": ' || (props->>'$.k') || chr(10) || '}' AS doc FROM events""")
def pretty_json(t):
    return t.events.select("event_id", scalar.pretty_json(F.col("props"), "k bigint").alias("doc"))


@query("udf_01_salary_grade", "UDF-01", sql="""
    SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 THEN 'Senior' WHEN o_totalprice >= 75000 THEN 'Mid' WHEN o_totalprice >= 50000 THEN 'Junior'
      ELSE 'Entry' END AS grade FROM orders""")
def salary_grade(t):
    return t.orders.select("o_orderkey", udf.salary_grade(F.col("o_totalprice")).alias("grade"))


@query("udf_01_salary_grade_sql", "UDF-01", sql="""
    SELECT grade, count(*) AS n FROM (SELECT CASE WHEN o_totalprice >= 100000 THEN 'Senior' WHEN o_totalprice >= 75000 THEN 'Mid'
      WHEN o_totalprice >= 50000 THEN 'Junior' ELSE 'Entry' END AS grade FROM orders) GROUP BY 1""")
def salary_grade_sql(t):
    udf.register_sql_functions(t.spark)
    return t.orders.groupBy(F.expr("salary_grade(o_totalprice)").alias("grade")).agg(F.count("*").alias("n"))


@query("udf_02_days_employed", "UDF-02", sql="""
    SELECT o_orderkey, date_diff('day', o_orderdate::DATE, (SELECT max(o_orderdate) FROM orders)::DATE) AS days FROM orders""")
def days_employed(t):
    return t.orders.select("o_orderkey", udf.days_employed(F.to_date("o_orderdate"), F.to_date(latest(t.orders, "o_orderdate"))).cast("bigint").alias("days"))


# Plan names and user limits, as in functions/udf.py.
PLAN_SQL = "['free', 'starter', 'pro', 'enterprise', 'legacy'][1 + {} % 5]"
LIMIT_SQL = "CASE {} WHEN 'free' THEN 5 WHEN 'starter' THEN 25 WHEN 'pro' THEN 100 WHEN 'enterprise' THEN 999999 END"


def plan_of(key):
    return scalar.pick(1 + F.col(key) % 5, "free", "starter", "pro", "enterprise", "legacy")


@query("udf_03_plan_limit", "UDF-03", sql=f"""
    SELECT c_custkey, plan, {LIMIT_SQL.format('plan')} AS users,
      CASE plan WHEN 'free' THEN 3 WHEN 'starter' THEN 20 WHEN 'pro' THEN 100 WHEN 'enterprise' THEN 999999 END AS projects, 0 AS other
    FROM (SELECT c_custkey, {PLAN_SQL.format('c_custkey')} AS plan FROM customer)""")
def plan_limit(t):
    d = t.customer.select("c_custkey", plan_of("c_custkey").alias("plan"))
    limit = lambda r: udf.plan_limit(F.col("plan"), F.lit(r))
    return d.select("c_custkey", "plan", limit("max_users").alias("users"), limit("max_projects").alias("projects"),
                    limit("max_seats").alias("other"))
