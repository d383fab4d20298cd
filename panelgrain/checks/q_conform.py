"""Column maps, projections, expressions (MAP-*, PRJ-*, UDX-2)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.operators import conform as C
from panelgrain.operators import expressions as X
from panelgrain.operators import measures as M
from panelgrain.operators.periods import add_period_expressions
from panelgrain.session import scratch_path
from panelgrain.spec import ContractSpec, ExpressionSet

SPEC = ContractSpec(run_id=7, contract_id=101, source_id=3, category_id="SMALL", currency="USD")


def vendor_parts(spark, d):
    """Parts under vendor-like column names, one padded, one numbered pair."""
    part = P.table(spark, d, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias(" Item Code "),
        F.col("p_name").alias("Item Name"),
        F.col("p_brand").alias("Brand"),
        F.col("p_type").alias("Kind"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).alias("Size"),
    )


def column_map(spark, d):
    """A column map derived from the part table: one row per brand, so that it repeats and varies."""
    rows = [("item code", "product_code"), ("item name", "product_name"), ("brand", "grouping#1"), ("kind", "grouping#2"), ("kind", "category"), ("size", "size")]
    pairs = F.array(*[F.struct(F.lit(a).alias("file_column"), F.lit(b).alias("target_column")) for a, b in rows])
    return P.table(spark, d, "part").select("p_brand", F.lit("PROD_DIM").alias("dimension"), F.explode(pairs).alias("r")).select("p_brand", "dimension", "r.*")


@query("map01_trim_names", "SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_name FROM part")
def map01(spark, d):
    trimmed = C.lower_names(C.trim_names(vendor_parts(spark, d)))
    return trimmed.select(F.col("item code").alias("item_code"), F.col("item name").alias("item_name"))


MAP_SQL = """WITH m AS (SELECT DISTINCT unnest([{'f': 'item code', 't': 'product_code'}, {'f': 'item name', 't': 'product_name'},
  {'f': 'brand', 't': 'grouping#1'}, {'f': 'kind', 't': 'grouping#2'}, {'f': 'kind', 't': 'category'}, {'f': 'size', 't': 'size'}]) AS r FROM part)
"""


@query("map02_map_rows", MAP_SQL + "SELECT r.f AS file_column, r.t AS target_column FROM m")
def map02(spark, d):
    return C.map_rows(column_map(spark, d), "(?i)prod")


@query("map03_targets_per_column", MAP_SQL + "SELECT r.f AS file_column, string_agg(r.t, ',' ORDER BY r.t) AS targets FROM m GROUP BY 1")
def map03(spark, d):
    return C.targets_per_column(C.map_rows(column_map(spark, d), "(?i)prod"))


@query("map04_fan_out", "SELECT CAST(p_partkey AS VARCHAR) AS product_code, p_type AS category, p_type AS kind_text FROM part")
def map04(spark, d):
    return C.apply_map(vendor_parts(spark, d), {"item code": ["product_code"], "kind": ["category", "kind_text"]})


@query("map05_drop_unmapped", "SELECT p_brand AS \"Brand\", p_type AS \"Kind\" FROM part")
def map05(spark, d):
    return C.drop_unmapped(vendor_parts(spark, d), ["brand", "kind", "absent"])


@query("map06_null_measures", "SELECT CAST(p_partkey AS VARCHAR) AS code, CAST(p_size AS VARCHAR) AS size, p_name AS name FROM part WHERE p_size > 10 AND p_name IS NOT NULL")
def map06(spark, d):
    rows = C.apply_map(vendor_parts(spark, d), {"item code": ["code"], "size": ["size"], "item name": ["name"]})
    return C.drop_null_measures(rows, ["size", "name", "absent"], how="any")


@query(
    "map06_null_measures_all",
    "SELECT p_partkey AS code, CASE WHEN p_size > 10 THEN p_size END AS size, CASE WHEN p_size < 25 THEN p_retailprice END AS price FROM part",
)
def map06_all(spark, d):
    part = P.table(spark, d, "part")
    rows = part.select(F.col("p_partkey").alias("code"), F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"), F.when(F.col("p_size") < 25, F.col("p_retailprice")).alias("price"))
    return C.drop_null_measures(rows, ["size", "price"], how="all")


@query(
    "map07_join_parts",
    "SELECT CAST(p_partkey AS VARCHAR) AS code, p_brand || ':' || p_type || ':' || p_size AS grouping FROM part",
)
def map07(spark, d):
    part = P.table(spark, d, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("code"),
        F.col("p_size").cast("string").alias("grouping#10"),
        F.col("p_type").alias("grouping#2"),
        F.concat(F.lit(" "), "p_brand", F.lit(": ")).alias("grouping#1"),
    )
    return C.join_parts(rows, clean=True)


@query("map08_finish_load", "SELECT n_name || ':' || r_name AS market_code FROM nation JOIN region ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey")
def map08(spark, d):
    nation, region, supplier = (P.table(spark, d, t) for t in ("nation", "region", "supplier"))
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return C.finish_load(rows.select(F.concat(F.lit(":"), "n_name", F.lit(" :: "), "r_name").alias("market_code")), "fact")


@query("map08_distinct_load", "SELECT DISTINCT p_brand AS brand, p_type AS category FROM part")
def map08_distinct(spark, d):
    return C.finish_load(P.products(spark, d).select("brand", "category"), "product")


TARGET = T.StructType(
    [
        T.StructField("product_key", T.LongType()),
        T.StructField("price", T.DecimalType(38, 10)),
        T.StructField("brand", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("colour", T.StringType()),
        T.StructField("weight", T.DecimalType(38, 10)),
    ]
)


@query(
    "prj01_conform",
    """SELECT p_partkey AS product_key, CAST(CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS DECIMAL(38,10)) AS DOUBLE) AS price, p_brand AS brand,
       TRY_CAST(p_type AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS colour, CAST(NULL AS DOUBLE) AS weight FROM part""",
)
def prj01(spark, d):
    part = P.table(spark, d, "part")
    rows = part.select(F.col("p_type").alias("SIZE"), F.col("p_brand").alias("Brand"), F.col("p_partkey").cast("string").alias("PRODUCT_KEY"), F.col("p_retailprice").cast(P.DEC).alias("price"), "p_name")
    out = C.conform(rows, TARGET)
    return out.withColumns({"price": F.col("price").cast("double"), "weight": F.col("weight").cast("double")})


@query("prj02_case_names", "SELECT p_partkey AS p_partkey, p_name AS p_name FROM part")
def prj02(spark, d):
    return C.lower_names(C.upper_names(P.table(spark, d, "part").select("p_partkey", "p_name")))


@query("prj03_union_by_name", "SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def prj03(spark, d):
    customers = P.table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return C.union_all([customers, suppliers])


@query("prj04_partition_columns", "SELECT s_suppkey, CAST(3 AS SMALLINT) AS part_source_id, CAST(101 AS BIGINT) AS part_contract_id FROM supplier")
def prj04(spark, d):
    return C.add_partition_columns(P.table(spark, d, "supplier").select("s_suppkey"), SPEC)


@query(
    "prj05_security_key",
    """SELECT s_suppkey, n_regionkey AS contract_id, CASE WHEN n_regionkey IN (1, 3) THEN r_name ELSE 'public' END AS security_key
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def prj05(spark, d):
    nation = P.table(spark, d, "nation")
    rows = P.table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("contract_id"))
    keys = P.table(spark, d, "region").where("r_regionkey IN (1, 3)").select(F.col("r_regionkey").alias("contract_id"), F.col("r_name").alias("security_key"))
    return C.add_security_key(rows, keys)


@query(
    "prj06_period_expressions",
    """SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start,
       last_day(CAST(l_shipdate AS DATE)) AS period_end, 'MH' AS period_type FROM lineitem""",
)
def prj06(spark, d):
    days = P.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct()
    return add_period_expressions(days, {"period_start": "trunc(day, 'MM')", "period_end": "last_day(day)", "period_type": "'MH'"})


@query("prj07_expression_catalogue", "SELECT p_partkey, upper(p_brand) AS brand, p_type || '/' || p_size AS variant FROM part")
def prj07(spark, d):
    sets = [
        ExpressionSet(101, "attributes", {"brand": "upper(p_brand)", "variant": "concat(p_type, '/', p_size)"}),
        ExpressionSet(55, "attributes", {"brand": "lower(p_brand)"}),
    ]
    out = C.apply_expressions(P.table(spark, d, "part"), C.choose_expressions(sets, "attributes", 9))
    return out.select("p_partkey", "brand", "variant")


@query("udx02_expression_set", "SELECT p_partkey, lower(p_brand) AS p_brand FROM part")
def udx02(spark, d):
    sets = [ExpressionSet(101, "attributes", {"p_brand": "upper(p_brand)"}), ExpressionSet(55, "attributes", {"p_brand": "lower(p_brand)"})]
    return C.apply_expressions(P.table(spark, d, "part").select("p_partkey", "p_brand"), C.choose_expressions(sets, "attributes", 55))


RAW = "CAST(CAST(l_quantity AS DECIMAL(18,4)) AS DOUBLE)"


def fact_text(spark, d):
    """Line items as delivered measures: three slots of decimal amounts."""
    return P.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast(P.DEC).alias("measure_1"),
        F.col("l_extendedprice").cast(P.DEC).alias("measure_2"),
        F.col("l_tax").cast(P.DEC).alias("measure_3"),
    )


def as_double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "prj08_multipliers",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(18,4)) * 1000 AS DOUBLE) AS measure_1,
       CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 1000 AS DOUBLE) AS measure_2, CAST(CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE) AS measure_3 FROM lineitem""",
)
def prj08(spark, d):
    return as_double(M.apply_multipliers(fact_text(spark, d), {"measure_1,measure_2": "1000"}), "measure_1", "measure_2", "measure_3")


@query(
    "prj09_precision",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(18,4)) / 100 AS DOUBLE) AS measure_1,
       CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS DOUBLE) AS measure_2 FROM lineitem""",
)
def prj09(spark, d):
    rows = M.scale_precision(fact_text(spark, d).drop("measure_3"), {"measure_1": 2, "measure_2": 0})
    return as_double(rows, "measure_1", "measure_2")


@query(
    "prj10_factor_rename",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(18,4)) * 2 AS DOUBLE) AS volume,
       CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 0.5 AS DOUBLE) AS value FROM lineitem""",
)
def prj10(spark, d):
    columns = [
        M.MeasureColumn("measure_1", "volume", "2", "7"),
        M.MeasureColumn("measure_2", "value", None, "0.5"),
        M.MeasureColumn("measure_3", "tax", None, None, in_use=False),
    ]
    return as_double(M.apply_measure_columns(fact_text(spark, d), ["l_orderkey", "l_linenumber"], columns), "volume", "value")


@query(
    "prj11_pad_measures",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_tax AS DECIMAL(18,4)) AS DOUBLE) AS measure_3, CAST(NULL AS DOUBLE) AS measure_4,
       CAST(NULL AS DOUBLE) AS measure_100 FROM lineitem""",
)
def prj11(spark, d):
    padded = C.pad_measures(fact_text(spark, d))
    return as_double(padded.select("l_orderkey", "l_linenumber", "measure_3", "measure_4", "measure_100"), "measure_3", "measure_4", "measure_100")


@query(
    "prj12_derived_measures",
    """WITH s AS (SELECT product_key, sum(quantity) AS q, sum(amount) AS a FROM sales GROUP BY 1)
       SELECT product_key, CAST(q AS DOUBLE) AS volume, CAST(a AS DOUBLE) AS value, round(CAST(a AS DOUBLE) / CAST(q AS DOUBLE), 4) AS price,
              round(CAST(a AS DOUBLE) / CAST(q AS DOUBLE), 4) * 2 AS double_price FROM s""",
    (P.SALES,),
)
def prj12(spark, d):
    base = P.sales(spark, d).groupBy("product_key").agg(P.total("quantity").alias("volume"), P.total("amount").alias("value"))
    first = M.derive_measures(base, {"price": "round(try_divide(cast(value as double), cast(volume as double)), 4)"})
    second = M.derive_measures(first, {"double_price": "price * 2"})
    return as_double(second, "volume", "value", "price", "double_price")


def stored_expressions(spark):
    """A lookup table of expression sets, rows in no order: contract 7 has sets of its own, others take the default's."""
    rows = [
        (101, "measures", "price_class", "CASE WHEN price > 1400 THEN 'high' ELSE 'low' END"), (101, "measures", "price", "0"), (7, "measures", "premium", "price_class = 'high' AND share > 0.5"),
        (7, "measures", "price_class", "CASE WHEN price > 1400 THEN 'high' ELSE 'low' END"), (7, "measures", "price", "round(try_divide(value, volume), 4)"),
        (7, "measures", "share", "round(try_divide(volume, volume + 100), 4)"), (7, "measures", "volume", "volume + 1"), (7, "broken", "a", "b + 1"), (7, "broken", "b", "a * 2"),
        (7, "broken", "margin", "value - cost"), (7, "broken", "rate", "margin / value"), (7, "broken", "double_value", "value * 2"), (7, "broken", "half", "value /"),
    ]
    path = scratch_path(spark, "expressions")
    spark.createDataFrame(rows, "contract_id int, set_name string, column_name string, expression string").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "prj12_stages_from_a_table",
    """WITH s AS (SELECT product_key, CAST(sum(quantity) AS DOUBLE) + 1 AS volume, CAST(sum(amount) AS DOUBLE) AS value FROM sales GROUP BY 1),
       p AS (SELECT *, round(value / nullif(volume, 0), 4) AS price, round(volume / nullif(volume + 100, 0), 4) AS share FROM s),
       c AS (SELECT *, CASE WHEN price > 1400 THEN 'high' ELSE 'low' END AS price_class FROM p)
       SELECT product_key, volume, value, price, share, price_class, price_class = 'high' AND share > 0.5 AS premium FROM c""",
    (P.SALES,),
)
def prj12_stages(spark, d):
    """Four stages out of five rows in mixed order: volume; price and share; the class; the premium."""
    base = P.sales(spark, d).groupBy("product_key").agg(P.total("quantity").alias("volume"), P.total("amount").alias("value"))
    staged = X.stage_expressions(spark, X.expression_rows(stored_expressions(spark), "measures", 7), base.schema)
    return staged.apply(base).select("product_key", "volume", "value", "price", "share", "price_class", "premium")


@query(
    "prj12_rejected_expressions",
    """SELECT DISTINCT l_returnflag, column_name, reason FROM lineitem, (VALUES ('a', 'circle: a -> b -> a'), ('b', 'circle: b -> a -> b'), ('half', 'does not parse'),
       ('margin', 'unknown column cost'), ('rate', 'needs margin')) t(column_name, reason)""",
)
def prj12_rejected(spark, d):
    """What a set's faults keep from the facts of each return flag."""
    facts = P.table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("value"))
    staged = X.stage_expressions(spark, X.expression_rows(stored_expressions(spark), "broken", 7), facts.schema)
    faults = F.array(*[F.struct(F.lit(name).alias("column_name"), F.lit(reason).alias("reason")) for name, _, reason in staged.rejected])
    flags = staged.apply(facts).where("double_value = value * 2").select("l_returnflag").distinct()
    return flags.select("l_returnflag", F.explode(faults).alias("fault")).select("l_returnflag", "fault.*")


@query("prj13_minus", "SELECT r_name FROM region")
def prj13(spark, d):
    return C.minus(P.table(spark, d, "region"), ["r_regionkey"])


@query("prj14_cast_all", "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_returnflag FROM lineitem")
def prj14(spark, d):
    return C.cast_all(P.table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), {"l_orderkey": "string", "l_quantity": "bigint"})


@query(
    "prj15_placeholders",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN '1991-04-15' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sold FROM orders""",
)
def prj15(spark, d):
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" NOT APPLICABLE ")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = P.table(spark, d, "orders").select("o_orderkey", text.alias("sold_text"))
    return C.fill_placeholders(rows, "sold_text", "sold", "NOT APPLICABLE", "1991-04-15").drop("sold_text")
