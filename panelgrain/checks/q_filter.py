"""Row predicates (FLT-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.operators import filters as FL
from panelgrain.operators.lookup import delivered_status


@query("flt01_any_value", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 45 OR l_discount > 0.08")
def flt01(spark, d):
    rows = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") > 45, F.col("l_quantity")).alias("a"), F.when(F.col("l_discount") > 0.08, F.col("l_discount")).alias("b"))
    return FL.keep_any_value(rows, ["a", "b"]).select("l_orderkey", "l_linenumber")


def coded_lines(spark, d):
    """Lines with a record letter first and a record code at position 7, from orders."""
    status = F.col("o_orderstatus")
    letter = F.when(status == "F", "U").when(status == "O", "G").otherwise("L")
    code = F.when(status == "F", "02").when(status == "O", "04").otherwise("06")
    return P.table(spark, d, "orders").select("o_orderkey", F.concat(letter, F.lit("....."), code, F.lit("|"), F.col("o_orderkey")).alias("value"))


@query("flt02_record_letter", "SELECT o_orderkey, 'U.....02|' || o_orderkey AS value FROM orders WHERE o_orderstatus = 'F'")
def flt02(spark, d):
    return FL.by_record_letter(coded_lines(spark, d), "U")


@query("flt03_record_code", "SELECT o_orderkey, 'G.....04|' || o_orderkey AS value FROM orders WHERE o_orderstatus = 'O'")
def flt03(spark, d):
    return FL.by_record_code(coded_lines(spark, d), "04")


@query(
    "flt04_fact_line",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'N'",
)
def flt04(spark, d):
    number = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber"))
    filler = F.when(F.col("l_returnflag") == "N", " ").otherwise("0")
    lines = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.rpad(number, 64, "0"), filler, F.lit("9  tail")).alias("value"))
    spaced = lines.withColumn("value", F.when(F.col("value").rlike(r"0 9  tail$"), F.concat(F.substring("value", 1, 30), F.lit(" "), F.substring("value", 32, 100))).otherwise(F.col("value")))
    return spaced.where(FL.is_fact_line(F.col("value"))).select("l_orderkey", "l_linenumber")


@query("flt05_tag_rows", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand <> 'Brand#1' AND p_type <> 'SMALL'")
def flt05(spark, d):
    return FL.drop_tag_rows(P.table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), {"p_brand": "Brand#1", "p_type": "SMALL"})


@query("flt06_bad_ascii", "SELECT doc_id FROM documents WHERE NOT regexp_full_match(text, '[\\x00-\\x7F]*', 's')")
def flt06(spark, d):
    return FL.bad_ascii_rows(P.table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id")


@query(
    "flt07_status_word",
    """WITH a AS (SELECT DISTINCT l_partkey AS part FROM lineitem WHERE year(l_shipdate) = 1996), b AS (SELECT DISTINCT l_partkey AS part FROM lineitem WHERE year(l_shipdate) = 1995)
       SELECT part, 'Missing' AS status FROM b WHERE part NOT IN (SELECT part FROM a)""",
)
def flt07(spark, d):
    lines = P.table(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.year("l_shipdate").alias("y"))
    status = delivered_status(lines.where("y = 1996"), lines.where("y = 1995"), ["part"], ("New", "Missing", "Delivered"))
    return FL.status_contains(status, "missing")


@query("flt08_within_months", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-06-01'")
def flt08(spark, d):
    rows = P.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return FL.within_months(rows, "day", as_of="2001-08-17", months=62)


@query("flt09_not_listed", "SELECT p_partkey, p_size FROM part WHERE p_size NOT IN (SELECT s_nationkey FROM supplier)")
def flt09(spark, d):
    listed = P.table(spark, d, "supplier").select(F.col("s_nationkey").alias("p_size")).distinct()
    return FL.not_listed(P.table(spark, d, "part").select("p_partkey", "p_size"), listed, "p_size").select("p_partkey", "p_size")


@query("flt10_safe_names", "SELECT DISTINCT p_brand AS name, FALSE AS safe FROM part UNION ALL SELECT DISTINCT p_type, TRUE FROM part")
def flt10(spark, d):
    names = P.table(spark, d, "part").select(F.explode(F.array("p_brand", "p_type")).alias("name")).distinct()
    return names.withColumn("safe", F.col("name").rlike(r"^[A-Za-z0-9_.]+$"))


@query(
    "flt11_split_assigned",
    """SELECT c_custkey, CASE WHEN s_suppkey IS NULL THEN 'open' ELSE 'assigned' END AS state FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def flt11(spark, d):
    keys = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    have, open_ = FL.split_assigned(P.table(spark, d, "customer").select("c_custkey").join(keys, "c_custkey", "left"), "s_name")
    return have.select("c_custkey", F.lit("assigned").alias("state")).unionByName(open_.select("c_custkey", F.lit("open").alias("state")))
