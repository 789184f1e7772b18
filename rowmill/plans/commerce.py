"""Shop reports."""

from pyspark.sql import Window, functions as F

from rowmill.functions.money import money, money_avg, money_sum, pct
from rowmill.functions.scalar import period_diff
from rowmill.operators.joins import bounded_broadcast
from rowmill.operators import allocation, baskets, ordered, paging
from rowmill.plans.bindings import INVENTORY, ITEMS, inventory, items
from rowmill.plans.registry import query
from rowmill.session import settled
from rowmill.sources.scan import latest


def category_revenue(orders, lines, products, category, start):
    """Orders, units and net revenue per category for finished or open orders since ``start``."""
    recent = orders.filter(F.col("o_orderstatus").isin("F", "O") & (F.col("o_orderdate") >= start))
    sold = (lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_extendedprice", "l_discount")
            .join(recent.select("o_orderkey"), "o_orderkey")
            .join(products.select("p_partkey", F.col(category).alias("category")), "p_partkey"))
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    # One row per category and order first: a hot category is split by order, and no DISTINCT expansion is needed.
    per_order = sold.groupBy("category", "o_orderkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units"), F.sum(net).alias("net"))
    return per_order.groupBy("category").agg(F.count("*").alias("order_count"), F.sum("units").alias("units_sold"),
                                             F.sum("net").cast("double").alias("revenue")).orderBy(F.desc("revenue"))


@query("ap_01_revenue_by_category", "AP-01", sql=f"""
    WITH {ITEMS} SELECT p_brand AS category, count(DISTINCT o_orderkey) AS order_count, sum(quantity)::BIGINT AS units_sold,
      sum(gross - discount)::DOUBLE AS revenue FROM orders JOIN items ON o_orderkey = order_id JOIN part ON product_id = p_partkey
    WHERE o_orderstatus IN ('F', 'O') AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY GROUP BY 1""")
def revenue_by_category(t):
    return category_revenue(t.orders, t.lineitem, t.part, "p_brand", latest(t.orders, "o_orderdate", "30 DAYS"))


@query("ap_02_lifetime_value", "AP-02", sql="""
    SELECT c_custkey, c_name, count(*) AS total_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS lifetime_value,
      sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*) AS avg_order, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
      date_diff('day', min(o_orderdate), max(o_orderdate)) AS age_days FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus NOT IN ('P') GROUP BY 1, 2 ORDER BY lifetime_value DESC, c_custkey LIMIT 100""")
def lifetime_value(t):
    d = "o_orderdate"
    totals = t.orders.filter(~F.col("o_orderstatus").isin("P")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("total_orders"), money_sum("o_totalprice").alias("lifetime_value"), money_avg("o_totalprice").alias("avg_order"),
        F.min(d).alias("first_order"), F.max(d).alias("last_order"), F.datediff(F.max(d), F.min(d)).cast("bigint").alias("age_days"))
    named = totals.join(t.customer.select("c_custkey", "c_name"), "c_custkey")
    return paging.top_k(named, ["-lifetime_value", "c_custkey"], 100)


@query("ap_03_low_stock", "AP-03", sql=f"""
    WITH {INVENTORY} SELECT product_id, product, stock, reserved, stock - reserved AS available, reorder_point FROM inventory
    WHERE stock - reserved <= reorder_point""")
def low_stock(t):
    return (inventory(t).withColumn("available", F.col("stock") - F.col("reserved")).filter(F.col("available") <= F.col("reorder_point"))
            .select("product_id", "product", "stock", "reserved", "available", "reorder_point").orderBy("available", "product_id"))


@query("ap_04_monthly_trend", "AP-04", "WN-26", sql="""
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(o_totalprice::DECIMAL(18,2)) AS r FROM orders WHERE o_orderstatus NOT IN ('P') GROUP BY 1)
    SELECT month, r::DOUBLE AS revenue, (lag(r) OVER w)::DOUBLE AS prev_month, round((r::DOUBLE - (lag(r) OVER w)::DOUBLE) / nullif((lag(r) OVER w)::DOUBLE, 0) * 100, 2) AS growth_pct,
      (sum(r) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING))::DOUBLE AS cumulative FROM m WINDOW w AS (ORDER BY month)""")
def monthly_trend(t):
    m = (t.orders.filter(~F.col("o_orderstatus").isin("P")).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
         .agg(F.sum(money("o_totalprice")).alias("r")))
    w = Window.orderBy("month")  # one row per month
    m = m.select("month", F.col("r").cast("double").alias("revenue"), F.lag("r").over(w).cast("double").alias("prev_month"),
                 F.sum("r").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("cumulative"))
    return m.withColumn("growth_pct", pct(F.col("revenue") - F.col("prev_month"), "prev_month"))


@query("ap_05_top_products", "AP-05", sql="""
    WITH r AS (SELECT l_partkey, sum(l_extendedprice::DECIMAL(18,2)) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE o_orderstatus NOT IN ('P') GROUP BY 1), k AS (SELECT *, rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
      dense_rank() OVER (ORDER BY revenue DESC) AS dense, ntile(4) OVER (ORDER BY revenue DESC, l_partkey) AS quartile FROM r)
    SELECT l_partkey, p_name, revenue::DOUBLE AS revenue, revenue_rank, dense, quartile FROM k JOIN part ON l_partkey = p_partkey
    ORDER BY revenue_rank, l_partkey LIMIT 20""")
def top_products(t):
    live = t.orders.filter(~F.col("o_orderstatus").isin("P")).select(F.col("o_orderkey").alias("l_orderkey"))
    r = (t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice").join(live, "l_orderkey")
         .groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("revenue")))
    r = settled(r)  # the count and the best 20 read it
    n = r.agg(F.count("*")).scalar()
    top = paging.top_k(r, ["-revenue", "l_partkey"], 20)
    best = Window.orderBy(F.desc("revenue"))  # over 20 rows: a rank up to 20 depends on the rows above it only
    at = F.row_number().over(Window.orderBy(F.desc("revenue"), "l_partkey"))
    top = top.withColumns({"revenue_rank": F.rank().over(best), "dense": F.dense_rank().over(best), "quartile": paging.tile_of(at, n, 4)})
    return (top.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
            .select("l_partkey", "p_name", F.col("revenue").cast("double").alias("revenue"), "revenue_rank", "dense", "quartile"))


@query("ap_06_cohort_retention", "AP-06", sql="""
    WITH o AS (SELECT o_custkey, year(o_orderdate) * 100 + month(o_orderdate) AS m FROM orders),
      c AS (SELECT o_custkey, min(m) AS cohort FROM o GROUP BY 1)
    SELECT cohort, (m // 100 * 12 + m % 100) - (cohort // 100 * 12 + cohort % 100) AS months_since_first, count(DISTINCT o.o_custkey) AS users
    FROM o JOIN c ON o.o_custkey = c.o_custkey GROUP BY 1, 2""")
def cohort_retention(t):
    # Distinct (user, month) first: after it a user has at most one row per month, so the window groups are small.
    m = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint")
    seen = t.orders.select("o_custkey", m.alias("m")).distinct()
    seen = seen.withColumn("cohort", F.min("m").over(Window.partitionBy("o_custkey")))
    months = period_diff(F.col("m"), F.col("cohort"))
    return seen.groupBy("cohort", months.alias("months_since_first")).agg(F.count("*").alias("users"))


@query("ap_07_abandoned_carts", "AP-07", sql="""
    SELECT c_name, o_orderkey, o_totalprice, o_orderdate, date_sub('hour', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS hours_pending
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'P' AND o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 24 HOUR""")
def abandoned_carts(t):
    stuck = t.orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < latest(t.orders, "o_orderdate", "24 HOURS")))
    hours = F.timestamp_diff("HOUR", F.col("o_orderdate"), latest(t.orders, "o_orderdate"))
    return (stuck.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
            .select("c_name", "o_orderkey", "o_totalprice", "o_orderdate", hours.alias("hours_pending")))


@query("ap_08_bought_together", "AP-08", sql="""
    SELECT a.l_partkey AS item_a, b.l_partkey AS item_b, count(*) AS together FROM lineitem a JOIN lineitem b
    ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY together DESC, 1, 2 LIMIT 20""")
def bought_together(t):
    return baskets.frequent_pairs(t.lineitem.select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey", 2, 20)


def turnover(stock, sold):
    """Days of stock left at the 30-day pace, to one digit, halves up; NULL where nothing was sold.

    Whole-number arithmetic: the quotient often lies on a half, where doubles would decide by chance.
    """
    out = stock.join(sold, "product_id", "left")
    tenths = F.expr("(stock * 600 + units) div nullif(2 * units, 0)")
    return out.select("product_id", "product", "units", "stock", (tenths / 10).alias("days_left"))


TURNOVER = "SELECT product_id, product, units::BIGINT AS units, stock, ((stock * 600 + units::BIGINT) // nullif(2 * units::BIGINT, 0)) / 10 AS days_left FROM inventory LEFT JOIN s ON k = product_id"


@query("ap_09_turnover_all_time", "AP-09", sql=f"""
    WITH {INVENTORY}, s AS (SELECT l_partkey AS k, sum(l_quantity::BIGINT)::BIGINT AS units FROM lineitem GROUP BY 1) {TURNOVER}""")
def turnover_all_time(t):
    """The literal form: units of all lines, whatever their order date."""
    return turnover(inventory(t), items(t).groupBy("product_id").agg(F.sum("quantity").alias("units")))


@query("ap_09_turnover_30_days", "AP-09", sql=f"""
    WITH {INVENTORY}, s AS (SELECT l_partkey AS k, sum(l_quantity::BIGINT)::BIGINT AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE o_orderstatus <> 'P' AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY GROUP BY 1) {TURNOVER}""")
def turnover_30_days(t):
    recent = t.orders.filter((F.col("o_orderstatus") != "P") & (F.col("o_orderdate") >= latest(t.orders, "o_orderdate", "30 DAYS")))
    lines = items(t).join(recent.select(F.col("o_orderkey").alias("order_id")), "order_id")
    return turnover(inventory(t), lines.groupBy("product_id").agg(F.sum("quantity").alias("units")))


ASK = """r AS (SELECT l_partkey AS product_id, l_orderkey, l_linenumber, l_quantity::BIGINT AS qty, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem)"""
ALLOCATION = f"""WITH RECURSIVE {INVENTORY}, {ASK}, f AS (SELECT r.*, i.stock >= qty AS accepted, i.stock - CASE WHEN i.stock >= qty THEN qty ELSE 0 END AS rest
    FROM r JOIN inventory i ON r.product_id = i.product_id WHERE rn = 1 UNION ALL
    SELECT r.*, f.rest >= r.qty, f.rest - CASE WHEN f.rest >= r.qty THEN r.qty ELSE 0 END FROM f JOIN r ON r.product_id = f.product_id AND r.rn = f.rn + 1)"""


def allocated(t):
    asks = t.lineitem.select(F.col("l_partkey").alias("product_id"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"))
    return allocation.allocate(asks, inventory(t), "product_id", ["l_orderkey", "l_linenumber", "qty"], "qty")


@query("ap_10_allocation", "AP-10", sql=ALLOCATION + " SELECT product_id, l_orderkey, l_linenumber, qty, accepted FROM f")
def allocate_orders(t):
    return allocated(t)


@query("ap_10_stock_after", "AP-10", sql=ALLOCATION + """, u AS (SELECT product_id, sum(qty)::BIGINT AS used FROM f WHERE accepted GROUP BY 1)
    SELECT i.product_id, i.stock - coalesce(u.used, 0) AS stock FROM inventory i LEFT JOIN u ON i.product_id = u.product_id""")
def stock_after(t):
    return allocation.stock_after(inventory(t), allocated(t), "product_id", "qty").select("product_id", "stock")


# One order a step; each step carries the stock of all products, whose keys are 0, 1, 2, ...
@query("ap_10_pair_reservation", "AP-10", sql=f"""
    WITH RECURSIVE {INVENTORY}, l AS (SELECT l_orderkey AS o, l_partkey + 1 AS p, sum(l_quantity)::BIGINT AS q FROM lineitem GROUP BY 1, 2),
      n AS MATERIALIZED (SELECT o, row_number() OVER (ORDER BY o) AS i, list(p ORDER BY p) AS ps, list(q ORDER BY p) AS qs FROM l GROUP BY o),
      st AS (SELECT 0::BIGINT AS i, 0::BIGINT AS o, (SELECT list((stock * 4)::BIGINT ORDER BY product_id) FROM inventory) AS held, true AS accepted
        UNION ALL SELECT n.i, n.o, CASE WHEN list_bool_and(list_transform(ps, lambda p, k: coalesce(held[p] >= qs[k], false)))
            THEN list_transform(held, lambda v, k: v - coalesce(qs[list_position(ps, k)], 0)) ELSE held END,
          list_bool_and(list_transform(ps, lambda p, k: coalesce(held[p] >= qs[k], false))) FROM st JOIN n ON n.i = st.i + 1)
    SELECT o AS order_id, accepted FROM st WHERE i > 0""")
def pair_reservation(t):
    """Orders that need several products at once: all lines or none. ``settle`` sums the lines of an order that name the same product."""
    legs = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("account"), (-F.col("l_quantity").cast("bigint")).alias("delta"))
    stock = inventory(t).select(F.col("product_id").alias("account"), (F.col("stock") * 4).alias("stock"), F.lit(0).alias("floor"))
    return allocation.settle(legs, stock, "order_id", ["order_id"], "stock", "floor")


VERSIONED = f"""WITH RECURSIVE {INVENTORY}, q AS (SELECT l_partkey AS product_id, l_orderkey * 10 + l_linenumber AS pos, max(l_quantity)::BIGINT AS qty,
    (l_orderkey % 4) AS v FROM lineitem GROUP BY ALL), st AS (SELECT product_id, version::BIGINT AS version, stock::BIGINT AS stock, -1::BIGINT AS pos FROM inventory UNION ALL
    SELECT s.product_id, any_value(s.version) + 1, any_value(s.stock) - arg_min(q.qty, q.pos), min(q.pos) FROM st s JOIN q ON q.product_id = s.product_id
      AND q.v = s.version AND q.qty <= s.stock AND q.pos > s.pos GROUP BY s.product_id)"""


@query("ap_11_versioned_update", "AP-11", sql=VERSIONED + """
    SELECT product_id, max(version) AS version, min(stock) AS stock FROM st GROUP BY 1""")
def versioned_update(t):
    return versioned(t)[0]


@query("ap_11_versioned_applied", "AP-11", sql=VERSIONED + " SELECT product_id, pos FROM st WHERE pos >= 0")
def versioned_applied(t):
    return versioned(t)[1]


def versioned(t):
    asks = t.lineitem.groupBy(F.col("l_partkey").alias("product_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
                              (F.col("l_orderkey") % 4).alias("version")).agg(F.max("l_quantity").cast("bigint").alias("qty"))
    return allocation.apply_versioned(inventory(t), asks, "product_id", "pos", "qty")


SUMMARY = """SELECT o_orderkey, c_name, n_name, count(l_partkey) AS item_count, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS total FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2, 3"""


@query("ap_40_order_summary", "AP-40", sql=SUMMARY)
def order_summary(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("l_partkey").alias("item_count"), money_sum("l_extendedprice").alias("total"))
    buyers = t.customer.join(bounded_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "c_name", "n_name")
    return (t.orders.select("o_orderkey", "o_custkey").join(lines, "o_orderkey").join(buyers, "o_custkey")
            .select("o_orderkey", "c_name", "n_name", "item_count", "total"))


@query("ap_41_orders_per_user", "AP-41", sql="""
    SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 250000
    WHERE c_acctbal > 0 GROUP BY 1 ORDER BY orders DESC, c_custkey LIMIT 10""")
def orders_per_user(t):
    counts = t.orders.filter("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    users = t.customer.filter("c_acctbal > 0").select("c_custkey").join(counts, "c_custkey", "left")
    return paging.top_k(users.select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders")), ["-orders", "c_custkey"], 10)


@query("ap_42_status_dashboard", "AP-42", sql="SELECT o_custkey, count(*) AS paid FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def status_dashboard(t):
    return t.orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("paid"))
