"""The driver tables seen as a retail panel, once for Spark and once as SQL text for the oracles.

market = supplier nation, contract = its region, product = part, period = month of the ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEC = "decimal(18,4)"
SCALE = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month_id(date):
    return F.year(date) * 12 + F.month(date)


def fixed_point(col):
    """Four-decimal amount as a whole number of ten-thousandths: sums are exact and cheap."""
    return F.rint(col * SCALE).cast("long")


def total(name: str):
    """Sum of a fixed-point column as double."""
    return F.sum(name).cast("double") / SCALE


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Line items with market, contract, source and period."""
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("n_regionkey") < 2, 3).otherwise(4).alias("source_id"),
        F.col("n_regionkey").alias("contract_id"),
        F.col("s_nationkey").alias("market_key"),
        F.col("l_partkey").alias("product_key"),
        month_id(day).alias("period_id"),
        F.last_day(day).alias("period_end"),
        fixed_point(F.col("l_quantity")).alias("quantity"),
        fixed_point(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
    )


SALES = """sales AS (
  SELECT CASE WHEN n_regionkey < 2 THEN 3 ELSE 4 END AS source_id, n_regionkey AS contract_id,
         s_nationkey AS market_key, l_partkey AS product_key,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS period_id, last_day(CAST(l_shipdate AS DATE)) AS period_end,
         CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS amount,
         l_orderkey AS order_key, l_linenumber AS line_number
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

MEASURES = ("volume", "value")
FACT_KEYS = ("source_id", "contract_id", "market_key", "product_key", "period_id", "period_end")


def facts(spark: SparkSession, d: str) -> DataFrame:
    return sales(spark, d).groupBy(*FACT_KEYS).agg(total("quantity").alias("volume"), total("amount").alias("value"))


FACTS = """facts AS (
  SELECT source_id, contract_id, market_key, product_key, period_id, period_end,
         CAST(sum(quantity) AS DOUBLE) AS volume, CAST(sum(amount) AS DOUBLE) AS value
  FROM sales GROUP BY ALL)"""


def brand_units(spark: SparkSession, d: str) -> DataFrame:
    """Facts by type and brand path, in fixed-point units."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("product_key"), F.concat_ws(" ", "p_type", "p_brand").alias("path"))
    return (
        sales(spark, d)
        .join(part, "product_key")
        .groupBy("contract_id", "market_key", "path", "period_id", "period_end")
        .agg(F.sum("quantity").alias("volume"), F.sum("amount").alias("value"))
    )


def in_units(df: DataFrame) -> DataFrame:
    """Fixed-point measures as plain amounts."""
    return df.withColumns({c: F.col(c) / SCALE for c in df.columns if c.split("_")[0] in MEASURES and not c.endswith(("share", "ipp", "iya", "ipd"))})


def brand_facts(spark: SparkSession, d: str) -> DataFrame:
    return in_units(brand_units(spark, d))


BRAND_FACTS = """brand_facts AS (
  SELECT contract_id, market_key, p_type || ' ' || p_brand AS path, period_id, period_end,
         CAST(sum(quantity) AS DOUBLE) AS volume, CAST(sum(amount) AS DOUBLE) AS value
  FROM sales JOIN part ON product_key = p_partkey GROUP BY ALL)"""


def tree_facts(spark: SparkSession, d: str) -> DataFrame:
    """Brand rows and their type totals as one two-level hierarchy."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("product_key"), "p_type", "p_brand")
    rows = sales(spark, d).join(part, "product_key")
    sums = [total("quantity").alias("volume"), total("amount").alias("value")]
    keys = ["market_key", "period_id"]
    brands = rows.groupBy(*keys, "p_type", "p_brand").agg(*sums).select(
        *keys, F.concat_ws(" ", "p_type", "p_brand").alias("path"), F.col("p_type").alias("parent_path"), F.lit(2).alias("level"), F.lit("N").alias("is_top"), "volume", "value"
    )
    tops = rows.groupBy(*keys, "p_type").agg(*sums).select(
        *keys, F.col("p_type").alias("path"), F.lit(None).cast("string").alias("parent_path"), F.lit(1).alias("level"), F.lit("Y").alias("is_top"), "volume", "value"
    )
    return brands.unionByName(tops)


TREE = """tree AS MATERIALIZED (
  SELECT market_key, period_id, p_type || ' ' || p_brand AS path, p_type AS parent_path, 2 AS level, 'N' AS is_top,
         CAST(sum(quantity) AS DOUBLE) AS volume, CAST(sum(amount) AS DOUBLE) AS value
  FROM sales JOIN part ON product_key = p_partkey GROUP BY ALL
  UNION ALL
  SELECT market_key, period_id, p_type, NULL, 1, 'Y', CAST(sum(quantity) AS DOUBLE), CAST(sum(amount) AS DOUBLE)
  FROM sales JOIN part ON product_key = p_partkey GROUP BY ALL)"""


def periods(spark: SparkSession, d: str) -> DataFrame:
    """One row per month that occurs, with previous and year-ago pointers."""
    day = F.col("l_shipdate").cast("date")
    months = table(spark, d, "lineitem").select(F.trunc(day, "MM").alias("start_date"), F.last_day(day).alias("end_date")).distinct()
    no = month_id(F.col("start_date"))
    return months.select(
        no.alias("period_id"),
        F.lit("MTH").alias("class"),
        F.lit("MH").alias("type"),
        "start_date",
        "end_date",
        (no - 1).alias("prev_id"),
        (no - 12).alias("year_ago_id"),
    )


PERIODS = """periods AS (
  SELECT DISTINCT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS period_id, 'MTH' AS class, 'MH' AS type,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS start_date, last_day(CAST(l_shipdate AS DATE)) AS end_date,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) - 1 AS prev_id,
         CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) - 12 AS year_ago_id
  FROM lineitem)"""


def products(spark: SparkSession, d: str) -> DataFrame:
    """Parts as level-3 products: structure 1, category = type, brand, item."""
    code = F.col("p_partkey").cast("string")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("product_key"),
        code.alias("code"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.concat_ws(" ", F.lit("1"), "p_type", "p_brand", code).alias("attributes"),
        F.concat_ws(" ", "p_type", "p_brand", code).alias("path"),
        F.col("p_size").alias("size"),
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_type AS category, p_brand AS brand,
         '1 ' || p_type || ' ' || p_brand || ' ' || p_partkey AS attributes,
         p_type || ' ' || p_brand || ' ' || p_partkey AS path, p_size AS size
  FROM part)"""


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Delivery log: a month of a contract is delivered by the runs (order years) that hold its lines."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), F.year("o_orderdate").alias("run_id"))
    rows = sales(spark, d).select("order_key", "source_id", "contract_id", "period_end").distinct()
    return rows.join(orders, "order_key").select("run_id", "source_id", "contract_id", "period_end", F.lit("MTH").alias("class")).distinct()


DELIVERIES = """deliveries AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS run_id, source_id, contract_id, period_end, 'MTH' AS class
  FROM sales JOIN orders ON order_key = o_orderkey)"""


def fixed_line(*cells: tuple[int, int, object]):
    """A text line with each column right-padded into (start, length); cells in order of start."""
    parts, at = [], 1
    for start, length, col in cells:
        if start > at:
            parts.append(F.lit(" " * (start - at)))
        parts.append(F.rpad(F.coalesce(col.cast("string"), F.lit("")), length, " "))
        at = start + length
    return F.concat(*parts)
