"""Synthetic tables. Every value is drawn from a hash of the row id, so any task can make any row again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowmill.functions.scalar import draw
from rowmill.sources.scan import series

# The domains of the generated columns. INFO is listed twice, so it is twice as likely.
MAIL_HOSTS = ["gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "icloud.com"]
USER_STATES = ["active", "inactive", "banned"]
COUNTRIES = ["US", "UK", "CA", "AU", "DE", "FR", "JP", "IN"]
ORDER_STATES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded"]
TXN_TYPES = ["purchase", "refund", "transfer", "withdrawal", "deposit"]
CURRENCIES = ["USD", "EUR", "GBP"]
TXN_STATES = ["pending", "completed", "failed", "reversed"]
LOG_LEVELS = ["DEBUG", "INFO", "INFO", "WARN", "ERROR"]
SERVICES = ["api", "auth", "payment", "notification"]
MESSAGES = ["Request processed successfully", "User authenticated", "Cache miss — fetching from DB", "Slow query detected",
            "Connection timeout"]


def below(n: int | Column, salt: str) -> Column:
    """An integer below ``n``, drawn for this row under the name ``salt``; exact integer arithmetic."""
    bound = n if isinstance(n, Column) else F.lit(n)
    return F.shiftright(draw(F.col("n"), salt) * bound, 32)


def one_of(values: list[str], salt: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (below(len(values), salt) + 1).cast("int"))


def cents(lowest: int, highest: int, salt: str) -> Column:
    """An amount between two bounds given in cents."""
    return ((F.lit(lowest) + below(highest - lowest + 1, salt)) / 100).cast("decimal(15,2)")


def days_before(as_of: Column, span: int, salt: str) -> Column:
    return as_of - F.make_dt_interval(days=below(span, salt).cast("int"))


def users(spark: SparkSession, lo: int, hi: int, as_of: Column) -> DataFrame:
    seen = F.when(below(10, "seen") >= 3, days_before(as_of, 30, "login"))
    return series(spark, lo, hi).select(
        F.col("n").alias("user_id"), F.concat(F.lit("user"), "n", F.lit("@"), one_of(MAIL_HOSTS, "host")).alias("email"),
        F.concat(F.lit("user_"), F.lpad(F.col("n").cast("string"), 5, "0")).alias("username"),
        one_of(USER_STATES, "state").alias("status"), one_of(COUNTRIES, "country").alias("country"),
        days_before(as_of, 730, "created").alias("created_at"), seen.alias("last_login"))


def orders(spark: SparkSession, rows: int, customers: Column, as_of: Column) -> DataFrame:
    return series(spark, 1, rows).select(
        F.col("n").alias("order_id"), (below(customers, "customer") + 1).alias("customer_id"), one_of(ORDER_STATES, "state").alias("status"),
        cents(500, 300000, "amount").alias("amount"), days_before(as_of, 365, "created").alias("created_at"))


def transactions(spark: SparkSession, rows: int, as_of: Column, users: int = 1000) -> DataFrame:
    return series(spark, 1, rows).select(
        F.col("n").alias("txn_id"), (below(users, "user") + 1).alias("user_id"), one_of(TXN_TYPES, "type").alias("type"),
        cents(100, 1000000, "amount").alias("amount"), one_of(CURRENCIES, "currency").alias("currency"),
        one_of(TXN_STATES, "state").alias("status"), days_before(as_of, 365, "created").alias("created_at"))


def logs(spark: SparkSession, rows: int, as_of: Column) -> DataFrame:
    return series(spark, 1, rows).select(
        F.col("n").alias("log_id"), one_of(LOG_LEVELS, "level").alias("level"), one_of(SERVICES, "service").alias("service"),
        one_of(MESSAGES, "message").alias("message"), F.when(below(10, "known") >= 2, below(10000, "user")).alias("user_id"),
        (below(5000, "duration") + 1).alias("duration_ms"), days_before(as_of, 180, "created").alias("created_at"))
