"""Window functions on raw rows and on periods.

Windows over raw rows go through rowmill.operators.ordered, which splits big
groups. Windows over days, months or years run on aggregated rows, whose number
the calendar bounds.
"""

from pyspark.sql import Window, functions as F

from rowmill.functions.money import money, money_sum, pct, ratio
from rowmill.operators import islands, ordered
from rowmill.operators.joins import attach
from rowmill.plans.registry import query

SEG = ["c_mktsegment"]
BEST = ["-c_acctbal", "c_custkey"]
W_SEG = "(PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)"


@query("wn_01_06_ranking", "WN-01", "WN-02", "WN-03", "WN-04", "WN-05", "WN-06", sql=f"""
    SELECT c_custkey, row_number() OVER {W_SEG} AS row_num, rank() OVER w AS rnk, dense_rank() OVER w AS dense,
      percent_rank() OVER w AS pct_rank, cume_dist() OVER w AS cume, ntile(4) OVER (ORDER BY c_acctbal DESC, c_custkey) AS quartile
    FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC)""")
def ranking(t):
    df = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    df = ordered.number_rows(df, SEG, BEST, "row_num")
    df = ordered.ranks(df, SEG, ["-c_acctbal"], rank="rnk", dense="dense", percent="pct_rank", cume="cume")
    return ordered.tiles(df, [], BEST, 4, "quartile").drop("c_mktsegment", "c_acctbal")


def seg_window(name, ident, expr, build):
    @query(name, ident, sql=f"SELECT c_custkey, {expr} AS v FROM customer")
    def run(t):
        return build(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")).select("c_custkey", "v")


seg_window("wn_01_row_number", "WN-01", f"row_number() OVER {W_SEG}", lambda d: ordered.number_rows(d, SEG, BEST, "v"))
seg_window("wn_02_rank", "WN-02", "rank() OVER (PARTITION BY c_mktsegment ORDER BY round(c_acctbal, -2) DESC)",
           lambda d: ordered.ranks(d.withColumn("r", F.round("c_acctbal", -2)), SEG, ["-r"], rank="v"))
seg_window("wn_03_dense_rank", "WN-03", "dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY round(c_acctbal, -2) DESC)",
           lambda d: ordered.ranks(d.withColumn("r", F.round("c_acctbal", -2)), SEG, ["-r"], dense="v"))
seg_window("wn_04_percent_rank", "WN-04", "percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC)",
           lambda d: ordered.ranks(d, SEG, ["-c_acctbal"], percent="v"))
seg_window("wn_05_cume_dist", "WN-05", "cume_dist() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC)",
           lambda d: ordered.ranks(d, SEG, ["-c_acctbal"], cume="v"))
seg_window("wn_06_ntile", "WN-06", "ntile(4) OVER (ORDER BY c_acctbal DESC, c_custkey)",
           lambda d: ordered.tiles(d, [], BEST, 4, "v"))
seg_window("wn_07_lag", "WN-07", "lag(c_acctbal) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey)",
           lambda d: ordered.framed(d, SEG, ["c_acctbal", "c_custkey"], {"v": lambda w: F.lag("c_acctbal").over(w)}, before=1))
seg_window("wn_08_lead", "WN-08", "lead(c_acctbal) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey)",
           lambda d: ordered.framed(d, SEG, ["c_acctbal", "c_custkey"], {"v": lambda w: F.lead("c_acctbal").over(w)}, after=1))
seg_window("wn_09_first_value", "WN-09", f"first_value(c_custkey) OVER {W_SEG}",
           lambda d: attach(d, ordered.first_of(d, SEG, BEST, {"v": "c_custkey"}), SEG))
seg_window("wn_10_last_value", "WN-10", "last_value(c_custkey) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey "
           "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
           lambda d: attach(d, ordered.first_of(d, SEG, ordered.flipped(BEST), {"v": "c_custkey"}), SEG))


@query("wn_11_nth_value", "WN-11", sql=f"SELECT c_custkey, nth_value(c_acctbal, 2) OVER {W_SEG} AS second FROM customer")
def nth_value(t):
    d = ordered.number_rows(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), SEG, BEST, "rn")
    d = attach(d, ordered.first_of(t.customer, SEG, BEST, {"second": "c_acctbal"}, nth=2), SEG)
    return d.select("c_custkey", F.when(F.col("rn") >= 2, F.col("second")).alias("second"))


@query("wn_12_14_group_totals", "WN-12", "WN-13", "WN-14", sql="""
    SELECT c_custkey, total::DOUBLE AS dept_total, total::DOUBLE / n AS dept_mean, n AS headcount, c_acctbal - total::DOUBLE / n AS diff,
      round(c_acctbal / nullif(total::DOUBLE, 0) * 100, 2) + 0.0::DOUBLE AS pct_of_dept
    FROM (SELECT *, sum(c_acctbal::DECIMAL(18,2)) OVER p AS total, count(*) OVER p AS n FROM customer WINDOW p AS (PARTITION BY c_nationkey))""")
def group_totals(t):
    d = ordered.totals(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"],
                       {"dept_total": money_sum("c_acctbal"), "headcount": F.count("*")})
    mean = F.col("dept_total") / F.col("headcount")
    return d.select("c_custkey", "dept_total", mean.alias("dept_mean"), "headcount", (F.col("c_acctbal") - mean).alias("diff"),
                    pct("c_acctbal", "dept_total").alias("pct_of_dept"))


DAILY = """d AS (SELECT o_orderdate::DATE AS day, count(*) AS cnt, sum(o_totalprice::DECIMAL(18,2)) AS revenue FROM orders GROUP BY 1)"""


def daily(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("cnt"),
                                                                       F.sum(money("o_totalprice")).alias("revenue"))


def mean_over(column, w):
    """Moving mean as exact sum over count."""
    return F.sum(column).over(w).cast("double") / F.count(column).over(w)


@query("wn_15_18_moving", "WN-15", "WN-17", "WN-18", "WN-19", sql=f"""
    WITH {DAILY} SELECT day, cnt, revenue::DOUBLE AS revenue, sum(revenue) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING)::DOUBLE AS cumulative,
      sum(revenue) OVER a::DOUBLE / count(revenue) OVER a AS rolling_7, sum(revenue) OVER b::DOUBLE / count(revenue) OVER b AS centred_5,
      sum(revenue) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS remaining
    FROM d WINDOW a AS (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), b AS (ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
def moving(t):
    w = Window.orderBy("day")
    return daily(t).select(
        "day", "cnt", F.col("revenue").cast("double").alias("revenue"),
        F.sum("revenue").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("cumulative"),
        mean_over("revenue", w.rowsBetween(-6, 0)).alias("rolling_7"), mean_over("revenue", w.rowsBetween(-2, 2)).alias("centred_5"),
        F.sum("revenue").over(w.rowsBetween(0, Window.unboundedFollowing)).cast("double").alias("remaining"))


@query("wn_15_running_rows", "WN-15", sql="""
    SELECT event_id, sum(value::DECIMAL(18,2)) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::DOUBLE AS running
    FROM events""")
def running_rows(t):
    d = t.events.select("event_id", "event_type", "ts", "value")
    out = ordered.running_sums(d, ["event_type"], ["ts", "event_id"], {"running": money("value")})
    return out.select("event_id", F.col("running").cast("double").alias("running"))


@query("wn_16_running_peers", "WN-16", sql="""
    SELECT o_orderkey, sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate)::DOUBLE AS running FROM orders""")
def running_peers(t):
    d = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    out = ordered.peer_sums(d, ["o_orderpriority"], ["o_orderdate"], {"running": money("o_totalprice")})
    return out.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query("ap_38_customer_running_total", "AP-38", "WN-16", sql="""
    SELECT o_custkey, o_orderkey, sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::DOUBLE AS running FROM orders""")
def customer_running_total(t):
    d = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    out = ordered.running_sums(d, ["o_custkey"], ["o_orderkey"], {"running": money("o_totalprice")})
    return out.select("o_custkey", "o_orderkey", F.col("running").cast("double").alias("running"))


@query("wn_17_rolling_rows", "WN-17", sql="""
    SELECT event_id, (sum(value::DECIMAL(18,2)) OVER w)::DOUBLE / count(*) OVER w AS rolling FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def rolling_rows(t):
    d = t.events.select("event_id", "event_type", "ts", money("value").alias("value"))
    out = ordered.framed(d, ["event_type"], ["ts", "event_id"], {"rolling": lambda w: mean_over("value", w.rowsBetween(-2, 0))}, before=2)
    return out.select("event_id", "rolling")


@query("wn_19_reverse_running", "WN-19", sql="""
    SELECT c_custkey, sum(c_acctbal::DECIMAL(18,2)) OVER (PARTITION BY c_mktsegment ORDER BY c_custkey
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS remaining FROM customer""")
def reverse_running(t):
    d = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    out = ordered.running_sums(d, SEG, ["-c_custkey"], {"remaining": money("c_acctbal")})
    return out.select("c_custkey", F.col("remaining").cast("double").alias("remaining"))


@query("wn_20_calendar_frame", "WN-20", sql=f"""
    WITH {DAILY} SELECT day, sum(revenue) OVER (ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)::DOUBLE AS week FROM d""")
def calendar_frame(t):
    w = Window.orderBy(F.unix_date("day")).rangeBetween(-7, 0)
    return daily(t).select("day", F.sum("revenue").over(w).cast("double").alias("week"))


@query("wn_21_window_over_aggregate", "WN-21", sql="""
    SELECT l_suppkey, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS revenue, rank() OVER (ORDER BY sum(l_extendedprice::DECIMAL(18,2)) DESC) AS rnk
    FROM lineitem GROUP BY 1""")
def window_over_aggregate(t):
    d = t.lineitem.groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).alias("revenue"))
    out = ordered.ranks(d, [], ["-revenue"], rank="rnk")
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query("wn_23_top_n", "WN-23", sql=f"""
    SELECT c_mktsegment, c_custkey FROM customer QUALIFY row_number() OVER {W_SEG} <= 2""")
def top_n(t):
    return ordered.top_rows(t.customer, SEG, BEST, 2).select("c_mktsegment", "c_custkey")


@query("wn_24_top_n_ties", "WN-24", sql="""
    SELECT p_brand, p_partkey, p_size FROM part QUALIFY dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) <= 3""")
def top_n_ties(t):
    return ordered.top_ranks(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], ["-p_size"], 3).drop("rnk")


def nth_highest(df, column, n):
    """The n-th highest distinct value as one row; NULL if there are fewer."""
    best = df.select(column).distinct().orderBy(F.desc(column)).limit(n)
    return best.agg(F.when(F.count("*") == n, F.min(column)).alias("value"))


@query("wn_25_nth_highest", "WN-25", sql="""
    SELECT (SELECT DISTINCT o_totalprice FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 2) AS value""")
def third_highest(t):
    return nth_highest(t.orders, "o_totalprice", 3)


@query("wn_25_second_highest", "WN-25", sql="""
    SELECT max(o_totalprice) AS value FROM orders WHERE o_totalprice < (SELECT max(o_totalprice) FROM orders)""")
def second_highest(t):
    return nth_highest(t.orders, "o_totalprice", 2)


@query("wn_26_year_growth", "WN-26", sql="""
    WITH y AS (SELECT year(o_orderdate) AS yr, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue FROM orders GROUP BY 1)
    SELECT yr, revenue, lag(revenue) OVER (ORDER BY yr) AS prev, round((revenue - lag(revenue) OVER (ORDER BY yr))
      / nullif(lag(revenue) OVER (ORDER BY yr), 0) * 100, 2) AS growth_pct FROM y""")
def year_growth(t):
    y = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("yr")).agg(money_sum("o_totalprice").alias("revenue"))
    y = y.withColumn("prev", F.lag("revenue").over(Window.orderBy("yr")))
    return y.withColumn("growth_pct", pct(F.col("revenue") - F.col("prev"), "prev"))


@query("wn_27_bucket_labels", "WN-27", sql="""
    SELECT c_custkey, CASE ntile(4) OVER (ORDER BY c_acctbal, c_custkey) WHEN 1 THEN 'Bottom 25%' WHEN 2 THEN '25-50%'
      WHEN 3 THEN '50-75%' ELSE 'Top 25%' END AS bucket FROM customer""")
def bucket_labels(t):
    labels = ("Bottom 25%", "25-50%", "50-75%", "Top 25%")  # fixed values
    d = ordered.tiles(t.customer.select("c_custkey", "c_acctbal"), [], ["c_acctbal", "c_custkey"], 4, "q")
    return d.select("c_custkey", F.element_at(F.array(*map(F.lit, labels)), F.col("q").cast("int")).alias("bucket"))


@query("wn_28_local_anomaly", "WN-28", sql="""
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice::DECIMAL(18,2)) AS revenue FROM orders GROUP BY 1),
      l AS (SELECT month, revenue::DOUBLE AS revenue, (sum(revenue) OVER w)::DOUBLE / count(*) OVER w AS local_avg FROM m
        WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
    SELECT *, revenue / nullif(local_avg, 0) AS ratio FROM l WHERE revenue / nullif(local_avg, 0) > 1.2 OR revenue / nullif(local_avg, 0) < 0.8""")
def local_anomaly(t):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum(money("o_totalprice")).alias("revenue"))
    m = m.withColumn("local_avg", mean_over("revenue", Window.orderBy("month").rowsBetween(-2, 2)))
    m = m.withColumn("revenue", F.col("revenue").cast("double")).withColumn("ratio", ratio("revenue", "local_avg"))
    return m.filter("ratio > 1.2 OR ratio < 0.8")


@query("wn_29_streaks", "WN-29", sql="""
    WITH d AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events),
      g AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day)::INT AS run FROM d)
    SELECT user_id, min(day) AS streak_start, max(day) AS streak_end, count(*) AS days FROM g GROUP BY user_id, run""")
def streaks(t):
    return islands.streaks(t.events.select("user_id", F.to_date("ts").alias("day")), "user_id", "day")


@query("wn_30_long_islands", "WN-30", sql="""
    WITH h AS (SELECT event_id, value, event_id - row_number() OVER (ORDER BY event_id) AS run FROM events WHERE value >= 8)
    SELECT event_id, value FROM h QUALIFY count(*) OVER (PARTITION BY run) >= 3""")
def long_islands(t):
    return islands.rows_in_long_runs(t.events.filter("value >= 8").select("event_id", "value"), "event_id", 3)


@query("wn_31_longest_run", "WN-31", sql="""
    WITH d AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), g AS (SELECT k - row_number() OVER (ORDER BY k) AS run FROM d)
    SELECT max(n) AS longest FROM (SELECT count(*) AS n FROM g GROUP BY run)""")
def longest_run(t):
    return islands.runs_of(t.lineitem, "l_orderkey").agg(F.max("run_length").alias("longest"))


@query("wn_32_gaps", "WN-32", sql="""
    SELECT id + 1 AS gap_start, nxt - 1 AS gap_end FROM
      (SELECT l_orderkey AS id, lead(l_orderkey) OVER (ORDER BY l_orderkey) AS nxt FROM (SELECT DISTINCT l_orderkey FROM lineitem)) WHERE nxt > id + 1""")
def gaps(t):
    return islands.gaps(t.lineitem.select("l_orderkey").distinct(), "l_orderkey")


def session_sql(minutes):
    return f"""
    WITH g AS (SELECT user_id, ts, event_id, date_sub('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS gap FROM events),
      s AS (SELECT user_id, ts, sum(CASE WHEN gap IS NULL OR gap > {minutes} THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session_no FROM g)
    SELECT user_id, session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events FROM s GROUP BY ALL"""


@query("wn_33_sessions", "WN-33", sql=session_sql(30))
def sessions(t):
    return islands.sessions(t.events.select("user_id", "ts", "event_id"), "user_id", "ts", "event_id", 30)


@query("wn_33_sessions_12h", "WN-33", sql=session_sql(720))
def long_sessions(t):
    return islands.sessions(t.events.select("user_id", "ts", "event_id"), "user_id", "ts", "event_id", 720)


@query("wn_34_equal_runs", "WN-34", sql="""
    SELECT DISTINCT a.event_type FROM events a JOIN events b ON b.event_id = a.event_id + 1 JOIN events c ON c.event_id = a.event_id + 2
    WHERE a.event_type = b.event_type AND b.event_type = c.event_type""")
def equal_runs(t):
    return islands.equal_runs(t.events, "event_id", "event_type", 3)
