"""Facts: mapping, image, shares, indexes (FCT-*, JN-12)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.operators import compare as C
from panelgrain.operators import measures as M
from panelgrain.operators.lookup import Layer
from panelgrain.plans.facts import fact_image
from panelgrain.spec import ContractSpec

MEASURES = list(P.MEASURES)

# ---------------------------------------------------------------- period sides and indexes

SIDES = """sides AS (SELECT c.*, p.volume AS volume_pp, p.value AS value_pp, y.volume AS volume_ya, y.value AS value_ya FROM brand_facts c
  LEFT JOIN brand_facts p ON p.market_key = c.market_key AND p.path = c.path AND p.period_id = c.period_id - 1
  LEFT JOIN brand_facts y ON y.market_key = c.market_key AND y.path = c.path AND y.period_id = c.period_id - 12)"""
SIDE_KEYS = ["contract_id", "market_key", "path"]


def sides(spark, d):
    facts = P.brand_facts(spark, d).drop("period_end")
    return C.period_sides(facts, P.periods(spark, d), SIDE_KEYS, MEASURES)


@query(
    "jn12_period_shift",
    "SELECT contract_id, market_key, path, period_id, volume, value, volume_pp, value_pp, volume_ya, value_ya FROM sides",
    (P.SALES, P.BRAND_FACTS, SIDES),
)
def jn12(spark, d):
    return sides(spark, d)


FISCAL = """fiscal AS (SELECT contract_id, market_key, path, (period_id // 12) * 100 + period_id % 12 AS period_id, volume FROM brand_facts),
  back AS (SELECT f.*, CASE WHEN period_id % 100 = 0 THEN period_id - 89 ELSE period_id - 1 END AS prev_id FROM fiscal f)"""


@query(
    "jn12_period_shift_of_a_fiscal_calendar",
    """SELECT b.contract_id, b.market_key, b.path, b.period_id, b.volume, p.volume AS volume_pp, y.volume AS volume_ya FROM back b
       LEFT JOIN fiscal p ON p.market_key = b.market_key AND p.path = b.path AND p.period_id = b.prev_id
       LEFT JOIN fiscal y ON y.market_key = b.market_key AND y.path = b.path AND y.period_id = b.period_id - 100""",
    (P.SALES, P.BRAND_FACTS, FISCAL),
)
def jn12_fiscal(spark, d):
    """Period ids that are no ordinals: year * 100 + month, with pointers."""
    fiscal = lambda no: F.floor(no / 12) * 100 + no % 12
    periods = P.periods(spark, d).select(*[fiscal(F.col(c)).alias(c) for c in ("period_id", "prev_id", "year_ago_id")])
    facts = P.brand_facts(spark, d).withColumn("period_id", fiscal(F.col("period_id")))
    return C.period_sides(facts, periods, SIDE_KEYS, ["volume"])


@query("jn12_repeated_facts", "SELECT market_key, product_key, period_id, count(*) AS facts FROM sales GROUP BY ALL HAVING count(*) > 1", (P.SALES,))
def jn12_repeated(spark, d):
    """Sales lines that share a market, product and month, as a delivery that repeats its facts would."""
    return C.repeated_facts(P.sales(spark, d), ["market_key", "product_key"])


def rounded(df):
    """Shares and indexes to six digits, to compare with SQL."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith(("_share", "_ipp", "_iya", "_ipd"))})


TOPS = """tops AS (SELECT market_key AS m, period_id AS p, sum(quantity)::DOUBLE AS volume_top, sum(amount)::DOUBLE AS value_top FROM sales GROUP BY 1, 2)"""


@query(
    "fct05_share_of_total",
    """SELECT market_key, path, period_id, round(volume / volume_top * 100, 6) AS volume_share, round(value / value_top * 100, 6) AS value_share FROM brand_facts JOIN tops ON m = market_key AND p = period_id""",
    (P.SALES, P.BRAND_FACTS, TOPS),
)
def fct05_total(spark, d):
    return rounded(C.share_of_total(P.brand_units(spark, d), ["market_key", "period_id"], MEASURES).select("market_key", "path", "period_id", "volume_share", "value_share"))


@query(
    "fct05_share_of_top",
    """SELECT a.market_key, a.path, a.period_id, round(a.volume / nullif(b.volume, 0) * 100, 6) AS volume_share, round(a.value / nullif(b.value, 0) * 100, 6) AS value_share
       FROM tree a LEFT JOIN (SELECT market_key, period_id, path, volume, value FROM tree WHERE is_top = 'Y') b ON b.market_key = a.market_key AND b.period_id = a.period_id AND b.path = split_part(a.path, ' ', 1)""",
    (P.SALES, P.TREE),
)
def fct05_top(spark, d):
    return rounded(C.share_of_top(P.tree_facts(spark, d), ["market_key", "period_id"], "path", 1, MEASURES).select("market_key", "path", "period_id", "volume_share", "value_share"))


INDEX = "round(({a} - {b}) / nullif({b}, 0) * 100, 6)"


def _index_sql(m):
    return f"{INDEX.format(a=m, b=m + '_pp')} AS {m}_ipp, {INDEX.format(a=m, b=m + '_ya')} AS {m}_iya"


@query(
    "fct06_indexes",
    f"""SELECT market_key, n_name AS market_name, path, period_id, volume, value, round(volume / volume_top * 100, 6) AS volume_share, round(value / value_top * 100, 6) AS value_share,
        {_index_sql('volume')}, {_index_sql('value')} FROM sides JOIN tops ON m = market_key AND p = period_id JOIN nation ON n_nationkey = market_key""",
    (P.SALES, P.BRAND_FACTS, SIDES, TOPS),
)
def fct06(spark, d):
    """Flagship: monthly brand sales per market with shares and period indexes.

    Shares come first, so that totals and facts share one shuffle of the aggregated sales.
    """
    shared = C.share_of_total(P.brand_units(spark, d), ["market_key", "period_id"], MEASURES)
    lined = C.period_sides(shared, P.periods(spark, d), SIDE_KEYS, MEASURES, carry=[f"{m}_share" for m in MEASURES])
    names = P.table(spark, d, "nation").select(F.col("n_nationkey").alias("market_key"), F.col("n_name").alias("market_name"))
    out = P.in_units(C.indexes(lined, MEASURES)).join(names, "market_key")
    shown = [f"{m}_{s}" for m in MEASURES for s in ("share", "ipp", "iya")]
    return rounded(out.select("market_key", "market_name", "path", "period_id", *MEASURES, *shown))


@query(
    "fct06_factored_indexes",
    """SELECT market_key, path, period_id, round((volume * f - volume_pp) / nullif(volume_pp, 0) * 100, 6) AS volume_ipp, round((volume - volume_ya) / nullif(volume_ya, 0) * 100, 6) AS volume_iya
       FROM (SELECT *, CASE WHEN period_id % 3 = 0 THEN 0.8 ELSE 1.0 END::DOUBLE AS f FROM sides)""",
    (P.SALES, P.BRAND_FACTS, SIDES),
)
def fct06_factored(spark, d):
    factor = F.when(F.col("period_id") % 3 == 0, F.lit(0.8)).otherwise(F.lit(1.0))
    return rounded(C.indexes(sides(spark, d).withColumn("time_factor", factor), ["volume"]).select("market_key", "path", "period_id", "volume_ipp", "volume_iya"))


# ---------------------------------------------------------------- deliveries


STATUS = """status AS (SELECT contract_id, period_end, max(run_id) AS run_id, count(*) AS deliveries FROM deliveries GROUP BY 1, 2)"""


@query(
    "fct03_period_status",
    """SELECT contract_id, period_end, run_id, deliveries, CASE WHEN deliveries = 1 THEN 'Y' ELSE 'N' END AS is_new, CASE WHEN deliveries > 1 THEN 'Y' ELSE 'N' END AS is_redelivered FROM status""",
    (P.SALES, P.DELIVERIES, STATUS),
)
def fct03(spark, d):
    return C.period_status(C.delivery_counts(P.deliveries(spark, d), ["contract_id", "period_end"]))


@query(
    "fct03_period_status_of_run",
    """SELECT contract_id, period_end, CASE WHEN run_id = 2000 AND deliveries = 1 THEN 'Y' ELSE 'N' END AS is_new, CASE WHEN run_id = 2000 AND deliveries > 1 THEN 'Y' ELSE 'N' END AS is_redelivered FROM status""",
    (P.SALES, P.DELIVERIES, STATUS),
)
def fct03_run(spark, d):
    return C.period_status(C.delivery_counts(P.deliveries(spark, d), ["contract_id", "period_end"]), run_id=2000).select("contract_id", "period_end", "is_new", "is_redelivered")


RUN_FACTS = """runs AS (SELECT contract_id, market_key, path, period_end, CAST(sum(quantity) FILTER (y >= 1999) AS DOUBLE) AS now_volume, CAST(sum(quantity) FILTER (y < 1999) AS DOUBLE) AS old_volume
  FROM (SELECT s.*, year(o_orderdate) AS y, p_type || ' ' || p_brand AS path FROM sales s JOIN orders ON order_key = o_orderkey JOIN part ON product_key = p_partkey) GROUP BY ALL)"""


def run_facts(spark, d):
    """Brand facts per side of a cut: what runs from 1999 deliver, what earlier runs left."""
    part = P.table(spark, d, "part").select(F.col("p_partkey").alias("product_key"), F.concat_ws(" ", "p_type", "p_brand").alias("path"))
    orders = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), F.year("o_orderdate").alias("y"))
    rows = P.sales(spark, d).join(part, "product_key").join(orders, "order_key")
    keys = ["contract_id", "market_key", "path", "period_end"]

    def side(cond):
        return rows.where(cond).groupBy(*keys).agg(P.total("quantity").alias("volume"))

    return side("y >= 1999"), side("y < 1999"), keys


@query(
    "fct04_comparison_set",
    """SELECT r.contract_id, r.market_key, r.path, r.period_end, r.now_volume AS volume, CASE WHEN s.deliveries > 1 THEN r.old_volume END AS volume_pd,
       CASE WHEN s.deliveries = 1 THEN 'Y' ELSE 'N' END AS is_new FROM runs r JOIN status s ON r.contract_id = s.contract_id AND r.period_end = s.period_end WHERE r.now_volume IS NOT NULL""",
    (P.SALES, P.DELIVERIES, STATUS, RUN_FACTS),
)
def fct04(spark, d):
    now, old, keys = run_facts(spark, d)
    status = C.period_status(C.delivery_counts(P.deliveries(spark, d), ["contract_id", "period_end"]))
    out = C.comparison_set(now, status, old, ["contract_id", "period_end"], keys, ["volume"])
    return out.select(*keys, "volume", "volume_pd", "is_new")


PUBLISHED = T.StructType(
    [
        T.StructField("contract_id", T.LongType()),
        T.StructField("market_key", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("period_id", T.LongType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("volume_ya", T.DoubleType()),
        T.StructField("volume_pd", T.DoubleType()),
        T.StructField("note", T.StringType()),
    ]
)


@query(
    "fct07_validation_facts",
    """SELECT CAST(contract_id AS BIGINT) AS contract_id, CAST(market_key AS BIGINT) AS market_key, path, CAST(period_id AS BIGINT) AS period_id, volume, coalesce(volume_ya, 0) AS volume_ya,
       CAST(0 AS DOUBLE) AS volume_pd, CAST(NULL AS VARCHAR) AS note FROM sides WHERE contract_id > 0""",
    (P.SALES, P.BRAND_FACTS, SIDES),
)
def fct07(spark, d):
    return C.publishable(sides(spark, d), PUBLISHED, ["volume_ya", "volume_pd"])


@query(
    "fct08_validation_hierarchy",
    """WITH dim AS (SELECT DISTINCT '1 ' || category AS path, '1 ' || category AS parent_path, '1 ' || category AS top_path FROM products
         UNION SELECT '1 ' || category || ' ' || brand, '1 ' || category, '1 ' || category FROM products UNION SELECT attributes, '1 ' || category || ' ' || brand, '1 ' || category FROM products),
       keyed AS (SELECT attributes AS path, product_key FROM products UNION ALL SELECT '1 ' || category || ' ' || brand, max(product_key) FROM products GROUP BY 1
         UNION ALL SELECT '1 ' || category, max(product_key) FROM products GROUP BY 1)
       SELECT d.path, k.product_key, d.top_path, d.parent_path, q.product_key AS parent_key FROM dim d JOIN keyed k ON k.path = d.path JOIN keyed q ON q.path = d.parent_path""",
    (P.PRODUCTS,),
)
def fct08(spark, d):
    from panelgrain.checks.q_product import dimension_tree

    level = F.col("level_id") - 10
    rows = dimension_tree(spark, d).withColumns(
        {"level": level, "parent_level": F.greatest(level - 1, F.lit(1)), "top_level": F.lit(1), "is_top": F.when(level == 1, "Y").otherwise("N")}
    )
    return C.validation_hierarchy(rows).select("path", "product_key", "top_path", "parent_path", "parent_key")


@query(
    "fct09_threshold_snapshot",
    """SELECT n_nationkey AS level_id, CAST(n_regionkey * 1.5 AS DOUBLE) AS previous_limit, CAST(2000 AS BIGINT) AS run_id, 'public' AS security_key FROM nation""",
)
def fct09(spark, d):
    rows = P.table(spark, d, "nation").select((-F.col("n_nationkey")).alias("level_id"), (F.col("n_regionkey") * 1.5).alias("previous_limit"))
    log = P.table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("run_id")).where("run_id < 2000")
    return C.snapshot_thresholds(rows, log, 2000, "public")


# ---------------------------------------------------------------- mapping and image


@query(
    "fct01_measure_mapping",
    """SELECT 'v' || p_partkey AS vendor_measure, CASE WHEN p_size % 5 = 2 THEN 20000000 ELSE 10000000 END + p_partkey AS measure_id,
       ordinal, name || p_partkey AS physical_name, CAST(p_size AS DOUBLE) AS vendor_factor, CAST(CASE WHEN p_size % 5 = 2 THEN 2.5 END AS DOUBLE) AS contract_factor,
       'measure_' || ordinal AS slot
       FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS ordinal FROM part) p JOIN (VALUES ('m'), ('n')) t(name) ON name = 'm' OR p_size % 7 = 0
       WHERE p_size % 5 <> 3""",
)
def fct01(spark, d):
    """Every fifth source measure is unknown; every seventh feeds two names."""
    part = P.table(spark, d, "part")
    key, name = F.col("p_partkey"), F.concat(F.lit("v"), "p_partkey").alias("vendor_measure")
    measures = part.select(name, key.alias("line_num"), F.lit(5).alias("vendor_id"), F.lit(9).alias("contract_id"))
    own = part.where("p_size % 5 = 2").select(name, F.lit(9).alias("contract_id"), (key + 20_000_000).alias("measure_id"))
    default = part.where("p_size % 5 <> 3").select(name, F.lit(5).alias("vendor_id"), (key + 10_000_000).alias("measure_id"))
    ids = part.select("p_partkey", "p_size", (key + F.when(F.col("p_size") % 5 == 2, 20_000_000).otherwise(10_000_000)).alias("measure_id"))
    names = ids.withColumn("name", F.explode(F.when(F.col("p_size") % 7 == 0, F.array(F.lit("m"), F.lit("n"))).otherwise(F.array(F.lit("m")))))
    lookup = names.select("measure_id", F.concat("name", "p_partkey").alias("physical_name"), F.lit(True).alias("in_use"))
    vendor = ids.select("measure_id", (F.col("p_size") * 1.0).alias("factor"))
    contract = ids.where("p_size % 5 = 2").select("measure_id", F.lit(2.5).alias("factor"))
    layers = [Layer(own, ("vendor_measure", "contract_id")), Layer(default, ("vendor_measure", "vendor_id"))]
    out = M.slots_of_order(M.map_measures(measures, layers, lookup, vendor, contract))
    return out.select("vendor_measure", "measure_id", "ordinal", "physical_name", "vendor_factor", "contract_factor", "slot")


IMAGE = T.StructType(
    [
        T.StructField("source_id", T.ShortType()),
        T.StructField("contract_id", T.LongType()),
        T.StructField("period_end", T.DateType()),
        T.StructField("market_key", T.LongType()),
        T.StructField("product_key", T.LongType()),
        T.StructField("period_id", T.LongType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("volume", T.DecimalType(38, 10)),
        T.StructField("value", T.DecimalType(38, 10)),
        T.StructField("price", T.DecimalType(38, 10)),
    ]
)


@query(
    "fct02_fact_image",
    """SELECT CAST(3 AS SMALLINT) AS source_id, CAST(101 AS BIGINT) AS contract_id, period_end, CAST(market_key AS BIGINT) AS market_key, product_key + 1000001 AS product_key,
       CAST(period_id AS BIGINT) AS period_id, CAST(7 AS BIGINT) AS run_id, CAST(quantity AS DOUBLE) AS volume, CAST(NULL AS DOUBLE) AS price, CAST(3 AS SMALLINT) AS part_source_id, CAST(101 AS BIGINT) AS part_contract_id FROM sales""",
    (P.SALES,),
)
def fct02(spark, d):
    rows = P.sales(spark, d).select(
        F.concat(F.lit("M"), "market_key").alias("market_code"), F.concat(F.lit("P"), "product_key").alias("product_code"), F.date_format("period_end", "yyyyMM").alias("period_code"), (F.col("quantity") / P.SCALE).alias("volume"), (F.col("amount") / P.SCALE).alias("value")
    )
    markets = P.table(spark, d, "nation").select(F.concat(F.lit("M"), "n_nationkey").alias("market_code"), F.col("n_nationkey").alias("market_key"))
    products = P.table(spark, d, "part").select(F.concat(F.lit("P"), "p_partkey").alias("product_code"), (F.col("p_partkey") + 1_000_001).alias("product_key"))
    periods = P.periods(spark, d).select(F.date_format("start_date", "yyyyMM").alias("period_code"), "period_id", F.col("end_date").alias("period_end"))
    out = fact_image(rows, markets, products, periods, IMAGE, ContractSpec(run_id=7, contract_id=101, source_id=3))
    return out.withColumns({c: F.col(c).cast("double") for c in ("volume", "price")}).drop("value")
