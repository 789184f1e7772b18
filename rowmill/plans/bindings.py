"""Views over the input tables that stand in for tables they do not have, each with its SQL text."""

from pyspark.sql import DataFrame, functions as F

from rowmill.functions.money import money

# Staff: customers as a ten-way tree; every 17th has no department.
EMP = """emp AS (SELECT c_custkey + 1 AS emp_id, c_name AS name,
    CASE WHEN c_custkey > 0 THEN greatest((c_custkey + 1) // 10, 1) END AS manager_id,
    CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey END AS dept_id, c_acctbal AS salary FROM customer)"""


def emp(t) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(
        (key + 1).alias("emp_id"), F.col("c_name").alias("name"),
        F.when(key > 0, F.greatest(F.floor((key + 1) / 10), F.lit(1))).alias("manager_id"),
        F.when(key % 17 != 0, F.col("c_nationkey")).alias("dept_id"), F.col("c_acctbal").alias("salary"))


# Departments: the nations; the location is the region.
DEPT = """dept AS (SELECT n_nationkey AS dept_id, n_name AS dept, n_regionkey AS location FROM nation)"""


def dept(t) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("dept_id"), F.col("n_name").alias("dept"),
                           F.col("n_regionkey").alias("location"))


# Stock per part.
INVENTORY = """inventory AS (SELECT p_partkey AS product_id, p_name AS product, p_partkey * 37 % 101 AS stock,
    p_partkey * 11 % 17 AS reserved, 10 AS reorder_point, 0 AS version FROM part)"""


def inventory(t) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("product_id"), F.col("p_name").alias("product"), (k * 37 % 101).alias("stock"),
                         (k * 11 % 17).alias("reserved"), F.lit(10).alias("reorder_point"), F.lit(0).alias("version"))


# Bill of materials: parts as a four-way tree with three roots.
BOM = """bom AS (SELECT p_partkey + 1 AS component_id, nullif((p_partkey + 1) // 4, 0) AS parent_id,
    p_name AS name, 1 + p_partkey % 3 AS quantity FROM part)"""


def bom(t) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select((k + 1).alias("component_id"), F.nullif(F.floor((k + 1) / 4), F.lit(0)).alias("parent_id"),
                         F.col("p_name").alias("name"), (1 + k % 3).alias("quantity"))


# Order lines as item rows; the unit price is derived.
ITEMS = """items AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity::BIGINT AS quantity,
    l_extendedprice::DECIMAL(18,2) AS gross, l_extendedprice::DECIMAL(18,2) * l_discount::DECIMAL(4,2) AS discount FROM lineitem)"""


def items(t) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"), money("l_extendedprice").alias("gross"),
        (money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).alias("discount"))
