"""Ledger, fraud rules and statements. Orders are the transactions of account o_custkey; finished ones are credits."""

from pyspark.sql import Column, functions as F

from rowmill.functions.money import money
from rowmill.functions.scalar import json_row
from rowmill.operators import allocation, ordered
from rowmill.operators.joins import attach
from rowmill.plans.registry import query
from rowmill.sources.scan import latest

CREDIT_LIMIT = 2000
MOVES = """mv AS (SELECT o_orderkey AS txn_id, o_custkey AS src, (o_custkey * 7 + 3) % (SELECT count(*) FROM customer) AS dst,
    (o_totalprice / 500)::BIGINT AS amount, o_orderdate AS ts FROM orders)"""


# One transfer a step, in order; each step carries the balances of all accounts, whose keys are 0, 1, 2, ...
STEPS = f"""{MOVES}, n AS MATERIALIZED (SELECT *, least(src, dst) AS lo, greatest(src, dst) AS hi, row_number() OVER (ORDER BY ts, txn_id) AS i FROM mv),
    st AS (SELECT 0::BIGINT AS i, 0::BIGINT AS txn, (SELECT list(floor(c_acctbal)::BIGINT ORDER BY c_custkey) FROM customer) AS held, true AS accepted
      UNION ALL SELECT n.i, txn_id, CASE WHEN held[src + 1] - amount >= -{CREDIT_LIMIT} THEN
          held[:lo] || [held[lo + 1] + CASE WHEN lo = src THEN -amount ELSE amount END] || held[lo + 2:hi] || [held[hi + 1] + CASE WHEN hi = src THEN -amount ELSE amount END]
          || held[hi + 2:] ELSE held END, held[src + 1] - amount >= -{CREDIT_LIMIT} FROM st JOIN n ON n.i = st.i + 1)"""


def moves(t):
    n = t.customer.agg(F.count("*")).scalar()
    return t.orders.select(F.col("o_orderkey").alias("txn_id"), F.col("o_custkey").alias("src"),
                           F.pmod(F.col("o_custkey") * 7 + 3, n).alias("dst"),
                           F.rint(F.col("o_totalprice") / 500).cast("bigint").alias("amount"), F.col("o_orderdate").alias("ts"))


def accounts(t):
    return t.customer.select(F.col("c_custkey").alias("account"), F.floor("c_acctbal").alias("balance"),
                             F.lit(-CREDIT_LIMIT).cast("bigint").alias("floor"))


@query("ap_12_ledger_posting", "AP-12", sql=f"""
    WITH {MOVES}, l AS (SELECT txn_id, src AS account, 'debit' AS type, -amount AS delta, ts FROM mv UNION ALL SELECT txn_id, dst, 'credit', amount, ts FROM mv),
      r AS (SELECT *, sum(delta) OVER (PARTITION BY account ORDER BY ts, txn_id, type)::BIGINT AS moved FROM l)
    SELECT txn_id, account, type, delta, floor(c_acctbal)::BIGINT + moved AS balance_after, floor(c_acctbal)::BIGINT + moved < -2000 AS overdrawn
    FROM r JOIN customer ON account = c_custkey""")
def ledger_posting(t):
    legs = allocation.transfer_legs(moves(t), "src", "dst", "amount")
    out = allocation.post_unchecked(legs, accounts(t).drop("floor"), ["ts", "txn_id", "type"], "balance", F.lit(-CREDIT_LIMIT))
    return out.select("txn_id", "account", "type", "delta", "balance_after", "overdrawn")


def settled(t):
    legs = allocation.transfer_legs(moves(t), "src", "dst", "amount")
    return legs, allocation.settle(legs, accounts(t), "txn_id", ["ts", "txn_id"], "balance", "floor")


@query("ap_12_ledger_sequential", "AP-12", sql=f"""
    WITH RECURSIVE {STEPS}, l AS (SELECT txn_id, src AS account, 'debit' AS type, -amount AS delta, ts FROM mv UNION ALL SELECT txn_id, dst, 'credit', amount, ts FROM mv)
    SELECT 'TXN-' || txn_id AS reference_id, account, type, delta, floor(c_acctbal)::BIGINT
      + (sum(delta) OVER (PARTITION BY account ORDER BY ts, txn_id, type))::BIGINT AS balance_after
    FROM l JOIN (SELECT txn FROM st WHERE i > 0 AND accepted) ON txn = txn_id JOIN customer ON account = c_custkey""")
def ledger_sequential(t):
    """Accept or refuse each transfer in order, then post the legs of the accepted ones."""
    legs, verdict = settled(t)
    posted = legs.join(verdict.filter("accepted").select("txn_id"), "txn_id", "left_semi")
    out = allocation.post_unchecked(posted, accounts(t).drop("floor"), ["ts", "txn_id", "type"], "balance", F.lit(-CREDIT_LIMIT))
    return out.select(F.concat(F.lit("TXN-"), "txn_id").alias("reference_id"), "account", "type", "delta", "balance_after")


@query("ap_12_transfer_status", "AP-12", sql=f"""
    WITH RECURSIVE {STEPS} SELECT txn AS txn_id, CASE WHEN accepted THEN 'success' ELSE 'failed' END AS status FROM st WHERE i > 0""")
def transfer_status(t):
    return settled(t)[1].select("txn_id", F.when(F.col("accepted"), "success").otherwise("failed").alias("status"))


def large_transactions(df, amount: str, limit: float, ts: str, start: Column):
    return df.filter((F.col(amount) > limit) & (F.col(ts) >= start))


def velocity(df, account: str, ts: str, amount: str, start: Column, more_than: int):
    """Accounts with more than so many transactions since ``start``."""
    recent = df.filter(F.col(ts) >= start).groupBy(account).agg(F.count("*").alias("txn_count"), F.sum(money(amount)).cast("double").alias("total"))
    return recent.filter(F.col("txn_count") > more_than)


def round_amounts(df, account: str, amount: str, ts: str, start: Column, min_amount: float, min_count: int):
    """Accounts with many whole amounts since ``start``."""
    whole = (F.col(amount) == F.floor(amount)) & (F.col(amount) >= min_amount) & (F.col(ts) >= start)
    return df.filter(whole).groupBy(account).agg(F.count("*").alias("round_count")).filter(F.col("round_count") >= min_count)


def done(t):
    return t.orders.filter("o_orderstatus <> 'P'")


@query("ap_13_large_transactions", "AP-13", sql="""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 10000 AND o_orderstatus <> 'P'
      AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1 DAY""")
def large(t):
    out = large_transactions(done(t), "o_totalprice", 10000, "o_orderdate", latest(t.orders, "o_orderdate", "1 DAY"))
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("ap_14_velocity", "AP-14", sql="""
    SELECT user_id, count(*) AS txn_count, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events WHERE event_type <> 'error'
      AND ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1 HAVING count(*) > 3""")
def velocity_rule(t):
    return velocity(t.events.filter("event_type <> 'error'"), "user_id", "ts", "value", latest(t.events, "ts", "24 HOURS"), 3)


@query("ap_15_round_amounts", "AP-15", sql="""
    SELECT l_suppkey, count(*) AS round_count FROM lineitem WHERE l_quantity = floor(l_quantity) AND l_quantity >= 40
      AND l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 365 DAY GROUP BY 1 HAVING count(*) >= 5""")
def round_rule(t):
    return round_amounts(t.lineitem, "l_suppkey", "l_quantity", "l_shipdate", latest(t.lineitem, "l_shipdate", "365 DAYS"), 40, 5)


@query("ap_16_fraud_alerts", "AP-16", sql="""
    WITH o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'), m AS (SELECT max(o_orderdate) AS d FROM orders)
    SELECT o_custkey AS account, 'large_transaction' AS rule_name, 'high' AS severity, json_object('txn_id', o_orderkey)::VARCHAR AS details FROM o, m
      WHERE o_totalprice > 10000 AND o_orderdate >= d - INTERVAL 1 DAY
    UNION ALL SELECT o_custkey, 'velocity', 'medium', json_object('txn_count', count(*))::VARCHAR FROM o, m WHERE o_orderdate >= d - INTERVAL 90 DAY GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT o_custkey, 'round_amount', 'low', json_object('round_count', count(*))::VARCHAR FROM o, m
      WHERE o_totalprice = floor(o_totalprice) AND o_totalprice >= 1000 AND o_orderdate >= d - INTERVAL 900 DAY GROUP BY 1 HAVING count(*) >= 1""")
def fraud_alerts(t):
    return alerts(done(t), "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", latest(t.orders, "o_orderdate"))


def alerts(df, account: str, key: str, amount: str, ts: str, as_of: Column):
    """All rules in one pass: a row for each rule that a transaction meets, counted by account (large ones singly), against the rule's least number; ``key`` is unique."""
    since = lambda days: F.col(ts) >= as_of - F.expr(f"INTERVAL {days} DAY")
    none = F.lit(None).cast(df.schema[key].dataType)
    hit = lambda rule, severity, txn, least: F.struct(F.lit(rule).alias("rule_name"), F.lit(severity).alias("severity"), txn.alias("txn"), F.lit(least).alias("least"))
    met = F.array_compact(F.array(
        F.when((F.col(amount) > 10000) & since(1), hit("large_transaction", "high", F.col(key), 1)),
        F.when(since(90), hit("velocity", "medium", none, 2)),
        F.when((F.col(amount) == F.floor(amount)) & (F.col(amount) >= 1000) & since(900), hit("round_amount", "low", none, 1))))
    hits = df.filter(since(900)).select(F.col(account).alias("account"), F.explode(met).alias("h")).select("account", "h.*")
    counts = hits.groupBy("account", "rule_name", "severity", "txn", "least").agg(F.count("*").alias("n")).filter("n >= least")
    count_as = lambda name: json_row(F.col("n").alias(name))
    details = (F.when(F.col("rule_name") == "large_transaction", json_row(F.col("txn").alias("txn_id")))
               .when(F.col("rule_name") == "velocity", count_as("txn_count")).otherwise(count_as("round_count")))
    return counts.select("account", "rule_name", "severity", details.alias("details"))


def statement(df, account: str, ts: str, key: str, amount: str, is_credit: Column, start: Column, opening: bool = False):
    """Transactions since ``start`` with a running balance, from 0 or from the balance of all earlier ones."""
    signed = F.when(is_credit, money(amount)).otherwise(-money(amount))
    df = df.withColumn("_signed", signed)
    recent = ordered.running_sums(df.filter(F.col(ts) >= start), [account], [ts, key], {"running": F.col("_signed")})
    if opening:
        before = df.filter(F.col(ts) < start).groupBy(account).agg(F.sum("_signed").alias("_open"))
        recent = attach(recent, before, [account]).withColumn("running", F.col("running") + F.coalesce("_open", F.lit(0)))
    return recent.withColumn("running", F.col("running").cast("double")).select(account, key, ts, amount, "running")


SIGNED = "CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,2) ELSE -o_totalprice::DECIMAL(18,2) END"


def statement_of(t, days, opening=False, account=None):
    d = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    d = d if account is None else d.filter(F.col("o_custkey") == account)
    return statement(d, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", F.col("o_orderstatus") == "F",
                     latest(t.orders, "o_orderdate", f"{days} DAYS"), opening)


@query("ap_17_statement", "AP-17", "WN-22", sql=f"""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, (sum({SIGNED}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))::DOUBLE AS running
    FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY""")
def account_statement(t):
    return statement_of(t, 365)


@query("ap_17_statement_opening", "AP-17", "WN-22", sql=f"""
    SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, (sum({SIGNED}) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))::DOUBLE AS running
    FROM orders) WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY""")
def statement_with_opening(t):
    return statement_of(t, 365, opening=True)


@query("ap_17_one_account", "AP-17", sql=f"""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, (sum({SIGNED}) OVER (ORDER BY o_orderdate, o_orderkey))::DOUBLE AS running
    FROM orders WHERE o_custkey = 1 AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 1500 DAY""")
def one_account(t):
    return statement_of(t, 1500, account=1)
