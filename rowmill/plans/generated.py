"""Generated tables, as many rows as the input table they stand beside."""

from pyspark.sql import functions as F

from rowmill.plans.registry import query
from rowmill.sources import generate
from rowmill.sources.scan import latest

NOW = "(SELECT max(o_orderdate) FROM orders)"


def draw(salt, n, key="n"):
    return f"((('0x' || left(md5({key} || ':{salt}'), 8))::BIGINT * {n}) >> 32)"


def one_of(values, salt):
    return f"{values!r}[{draw(salt, len(values))} + 1]"


def amount(lo, hi, salt):
    return f"({lo} + {draw(salt, hi - lo + 1)}) / 100"


def ago(span, salt):
    return f"{NOW} - INTERVAL 1 DAY * {draw(salt, span)}"


@query("src_04_generated_users", "SRC-04", sql=f"""
    SELECT n AS user_id, 'user' || n || '@' || {one_of(generate.MAIL_HOSTS, 'host')} AS email, 'user_' || lpad(n::VARCHAR, 5, '0') AS username,
      {one_of(generate.USER_STATES, 'state')} AS status, {one_of(generate.COUNTRIES, 'country')} AS country, {ago(730, 'created')} AS created_at,
      CASE WHEN {draw('seen', 10)} >= 3 THEN {ago(30, 'login')} END AS last_login FROM range(1001, 1001 + (SELECT count(*) FROM customer)) s(n)""")
def users(t):
    return generate.users(t.spark, 1001, 1000 + t.customer.count(), latest(t.orders, "o_orderdate"))


@query("src_05_generated_orders", "SRC-05", sql=f"""
    SELECT n AS order_id, {draw('customer', '(SELECT count(*) FROM customer)')} + 1 AS customer_id, {one_of(generate.ORDER_STATES, 'state')} AS status,
      {amount(500, 300000, 'amount')} AS amount, {ago(365, 'created')} AS created_at FROM range(1, 1 + (SELECT count(*) FROM orders)) s(n)""")
def orders(t):
    out = generate.orders(t.spark, t.orders.count(), t.customer.agg(F.count("*")).scalar(), latest(t.orders, "o_orderdate"))
    return out.withColumn("amount", F.col("amount").cast("double"))


@query("src_06_generated_transactions", "SRC-06", sql=f"""
    SELECT n AS txn_id, {draw('user', 1000)} + 1 AS user_id, {one_of(generate.TXN_TYPES, 'type')} AS type, {amount(100, 1000000, 'amount')} AS amount,
      {one_of(generate.CURRENCIES, 'currency')} AS currency, {one_of(generate.TXN_STATES, 'state')} AS status, {ago(365, 'created')} AS created_at
    FROM range(1, 1 + (SELECT count(*) FROM lineitem)) s(n)""")
def transactions(t):
    out = generate.transactions(t.spark, t.lineitem.count(), latest(t.orders, "o_orderdate"))
    return out.withColumn("amount", F.col("amount").cast("double"))


@query("src_07_generated_logs", "SRC-07", sql=f"""
    SELECT n AS log_id, {one_of(generate.LOG_LEVELS, 'level')} AS level, {one_of(generate.SERVICES, 'service')} AS service,
      {one_of(generate.MESSAGES, 'message')} AS message, CASE WHEN {draw('known', 10)} >= 2 THEN {draw('user', 10000)} END AS user_id,
      {draw('duration', 5000)} + 1 AS duration_ms, {ago(180, 'created')} AS created_at FROM range(1, 1 + (SELECT count(*) FROM events)) s(n)""")
def logs(t):
    return generate.logs(t.spark, t.events.count(), latest(t.orders, "o_orderdate"))
