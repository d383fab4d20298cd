"""Whole plans: operators chained as a run chains them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.checks import panel as P
from panelgrain.checks import q_panel
from panelgrain.checks.q_extract import delivered
from panelgrain.checks.q_lookup import WEEKS, week_associations
from panelgrain.checks.registry import query
from panelgrain.operators import compare as C
from panelgrain.operators import layouts as L
from panelgrain.operators import measures as M
from panelgrain.operators.lookup import Layer
from panelgrain.plans.comparison import tier1_comparison, tier2_comparison
from panelgrain.plans.delivery import tier1_delivery
from panelgrain.session import scratch_path
from panelgrain.sources import sinks as S
from panelgrain.spec import ContractSpec, PeriodPolicy

SPEC = ContractSpec(run_id=7, contract_id=101, source_id=3)
NAMES = ("m1", "m2", "m21", "m45")
IMAGE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("contract_id", "market_key", "product_key", "period_id", "run_id")]
    + [T.StructField(n, T.DecimalType(38, 10)) for n in NAMES]
)
RECORDS = """records AS (SELECT l_suppkey, l_partkey, CAST(l_shipdate AS DATE) AS day, CAST(max(l_quantity) AS INTEGER) AS q FROM lineitem GROUP BY ALL)"""


def record_lines(spark, d):
    """Records of 45 measures on three physical lines each, as a vendor's text file."""
    day = F.col("l_shipdate").cast("date")
    records = P.table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey", day.alias("day")).agg(F.max("l_quantity").cast("int").alias("q"))
    lines = records.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(2))))
    texts = {"market_code": F.col("l_suppkey"), "product_code": F.col("l_partkey"), "period_code": F.date_format("day", "yyyyMMdd"), "market_prefix": F.lit("N"), "filler": F.lit("")}
    cells = [(1, 1, F.lit("U")), *[(f.start, f.length, texts[f.name]) for f in L.FACT_A.fields]]
    for i in range(20):
        k = F.col("line") * 20 + i + 1
        cells.append((L.FACT_A.slot_start + i * L.FACT_A.slot_width, L.FACT_A.slot_width, F.when(k <= 45, F.col("q") * 100 + k)))
    cells.append((L.FACT_A.tail.start, L.FACT_A.tail.length, F.lit("")))
    return lines.select(P.fixed_line(*sorted(cells, key=lambda c: c[0])).alias("value"))


def measure_columns(spark, d):
    """45 source measures; every fifth is unknown, so the slots of the others must not move."""
    part = P.table(spark, d, "part").where("p_partkey BETWEEN 1 AND 45")
    key, name = F.col("p_partkey"), F.concat(F.lit("v"), "p_partkey").alias("vendor_measure")
    source = part.select(name, key.alias("line_num"), F.lit(5).alias("vendor_id"))
    known = part.where("p_partkey % 5 <> 3").select(name, F.lit(5).alias("vendor_id"), (key + 1000).alias("measure_id"))
    lookup = part.select((key + 1000).alias("measure_id"), F.concat(F.lit("m"), key).alias("physical_name"), F.lit(True).alias("in_use"))
    factor = part.select((key + 1000).alias("measure_id"), (key * F.lit(0.5)).alias("factor"))
    mapped = M.map_measures(source, [Layer(known, ("vendor_measure", "vendor_id"))], lookup, factor, factor.limit(0))
    return M.read_measure_columns(M.slots_of_order(mapped))


@query(
    "pln01_tier1_delivery",
    """SELECT CAST(101 AS BIGINT) AS contract_id, CAST(l_suppkey AS BIGINT) AS market_key, l_partkey + 1000000 AS product_key, CAST(year(day) * 12 + month(day) AS BIGINT) AS period_id, CAST(7 AS BIGINT) AS run_id,
       (q * 100 + 1) * 0.5::DOUBLE AS m1, (q * 100 + 2) * 1.0::DOUBLE AS m2, (q * 100 + 21) * 10.5::DOUBLE AS m21, (q * 100 + 45) * 22.5::DOUBLE AS m45 FROM records
       UNION ALL SELECT 101, s_suppkey, 0, 0, 1, 1.5, NULL, NULL, NULL FROM supplier""",
    (RECORDS,),
)
def tier1(spark, d):
    """Text lines of a delivery to the image, followed by stored facts."""
    days = P.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct()
    periods = days.select(F.date_format("day", "yyyyMMdd").alias("period_code"), P.month_id(F.col("day")).alias("period_id"))
    markets = P.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("market_code"), F.col("s_suppkey").alias("market_key"))
    products = P.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("product_code"), (F.col("p_partkey") + 1_000_000).alias("product_key"))
    old = {"contract_id": 101, "product_key": 0, "period_id": 0, "run_id": 1}
    stored = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("market_key"), *[F.lit(v).cast("long").alias(k) for k, v in old.items()], F.lit(1.5).cast("decimal(38,10)").alias("m1"))
    stored = stored.select("*", *[F.lit(None).cast("decimal(38,10)").alias(n) for n in NAMES[1:]], F.lit(3).cast("short").alias("part_source_id"), F.lit(101).cast("long").alias("part_contract_id"))
    done = tier1_delivery(delivered(spark, record_lines(spark, d), "records", d), L.FACT_A, measure_columns(spark, d), markets, products, periods, IMAGE, SPEC, stored)
    return done.image.select("contract_id", "market_key", "product_key", "period_id", "run_id", *[F.col(n).cast("double").alias(n) for n in NAMES])


@query(
    "pln02_comparison_both_factors",
    """SELECT market_key, path, period_id, round((volume * f - volume_pp * g) / nullif(volume_pp, 0) * 100, 6) AS volume_ipp, round((volume * f - volume_ya) / nullif(volume_ya, 0) * 100, 6) AS volume_iya,
       round(volume / volume_top * 100, 6) AS volume_share
       FROM (SELECT *, CASE WHEN period_id % 3 = 0 THEN 0.8 ELSE 1.0 END::DOUBLE AS f, CASE WHEN (period_id - 1) % 3 = 0 THEN 0.8 ELSE 1.0 END::DOUBLE AS g FROM sides) JOIN tops ON m = market_key AND p = period_id""",
    (P.SALES, P.BRAND_FACTS, q_panel.SIDES, q_panel.TOPS),
)
def both_factors(spark, d):
    """Shares, sides and indexes in a row; the time factor scales the current and the previous side, and year ago."""
    shared = C.share_of_total(P.brand_facts(spark, d).drop("period_end"), ["market_key", "period_id"], ["volume"])
    lined = C.period_sides(shared, P.periods(spark, d), q_panel.SIDE_KEYS, ["volume"], carry=["volume_share"])
    factor = lambda period: F.when(period % 3 == 0, F.lit(0.8)).otherwise(F.lit(1.0))
    scaled = lined.withColumns({"time_factor": factor(F.col("period_id")), "time_factor_pp": factor(F.col("period_id") - 1)})
    out = C.indexes(scaled, ["volume"], PeriodPolicy(scale_previous=True, scale_year_ago=True))
    return q_panel.rounded(out.select("market_key", "path", "period_id", "volume_ipp", "volume_iya", "volume_share"))


FACTORS = """months AS (SELECT year(period_end) * 12 + month(period_end) AS p, CASE WHEN count(*) = 5 THEN 0.8 ELSE 1.0 END::DOUBLE AS f FROM weeks GROUP BY period_end, 1)"""
RUNS = """runs AS (SELECT contract_id, year(period_end) * 12 + month(period_end) AS p, run_id FROM deliveries)"""
SHOWN = ["is_new", "is_redelivered", "time_factor", "volume_share", "volume_ipp", "volume_iya", "volume_ipd"]


def month_runs(spark, d):
    """Runs that delivered a month of a contract."""
    return P.deliveries(spark, d).select("run_id", "contract_id", P.month_id(F.col("period_end")).alias("period_id"))


def before(facts, wanted):
    """What was stored before: the same facts with one unit less, where the condition holds."""
    return facts.where(wanted).withColumn("volume", F.col("volume") - 1)


@query(
    "pln03_tier1_comparison",
    """SELECT a.market_key, a.path, a.period_id, CASE WHEN r = 1997 AND n = 1 THEN 'Y' ELSE 'N' END AS is_new, CASE WHEN r = 1997 AND n > 1 THEN 'Y' ELSE 'N' END AS is_redelivered, coalesce(f.f, 1.0) AS time_factor,
       round(a.volume / nullif(t.volume, 0) * 100, 6) AS volume_share, round((a.volume * coalesce(f.f, 1.0) - b.volume * coalesce(g.f, 1.0)) / nullif(b.volume, 0) * 100, 6) AS volume_ipp,
       round((a.volume - y.volume) / nullif(y.volume, 0) * 100, 6) AS volume_iya,
       CASE WHEN r = 1997 AND n > 1 AND a.market_key % 2 = 0 THEN round(1 / nullif(a.volume - 1, 0) * 100, 6) END AS volume_ipd
       FROM tree a LEFT JOIN tree t ON t.market_key = a.market_key AND t.period_id = a.period_id AND t.is_top = 'Y' AND t.path = split_part(a.path, ' ', 1)
         LEFT JOIN tree b ON b.market_key = a.market_key AND b.path = a.path AND b.period_id = a.period_id - 1
         LEFT JOIN tree y ON y.market_key = a.market_key AND y.path = a.path AND y.period_id = a.period_id - 12
         LEFT JOIN months f ON f.p = a.period_id LEFT JOIN months g ON g.p = a.period_id - 1
         JOIN (SELECT p, max(run_id) AS r, count(DISTINCT run_id) AS n FROM runs GROUP BY 1) s ON s.p = a.period_id""",
    (P.SALES, P.TREE, P.DELIVERIES, WEEKS, FACTORS, RUNS),
)
def tier1_compared(spark, d):
    """A weekly run's comparison over two product levels; markets with even keys were stored before."""
    facts = P.tree_facts(spark, d).select("market_key", "period_id", "path", "is_top", *P.MEASURES)
    done = tier1_comparison(
        facts, before(facts, "market_key % 2 = 0"), month_runs(spark, d).drop("contract_id"), P.periods(spark, d), week_associations(spark, d), run_id=1997, weekly_run=True,
        keys=["market_key", "path"], period_keys=["period_id"], measures=["volume"], within=["market_key", "period_id"],
    )
    return q_panel.rounded(done.facts.select("market_key", "path", "period_id", *SHOWN))


@query(
    "pln04_tier2_comparison",
    """SELECT c.contract_id, c.market_key, c.path, c.period_id, CASE WHEN n = 1 THEN 'Y' ELSE 'N' END AS is_new, CASE WHEN n > 1 THEN 'Y' ELSE 'N' END AS is_redelivered, coalesce(f.f, 1.0) AS time_factor,
       round(c.volume / volume_top * 100, 6) AS volume_share, round((c.volume * coalesce(f.f, 1.0) - volume_pp) / nullif(volume_pp, 0) * 100, 6) AS volume_ipp,
       round((c.volume * coalesce(f.f, 1.0) - volume_ya) / nullif(volume_ya, 0) * 100, 6) AS volume_iya,
       CASE WHEN n > 1 AND c.market_key % 3 = 1 THEN round(1 / nullif(c.volume - 1, 0) * 100, 6) END AS volume_ipd
       FROM sides c JOIN tops ON m = c.market_key AND tops.p = c.period_id LEFT JOIN months f ON f.p = c.period_id
         JOIN (SELECT contract_id AS k, p, count(DISTINCT run_id) AS n FROM runs GROUP BY 1, 2) s ON s.k = c.contract_id AND s.p = c.period_id""",
    (P.SALES, P.BRAND_FACTS, q_panel.SIDES, q_panel.TOPS, P.DELIVERIES, WEEKS, FACTORS, RUNS),
)
def tier2_compared(spark, d):
    """A weekly run's comparison of brands within contracts; every third market was stored before."""
    facts = P.brand_facts(spark, d).drop("period_end")
    done = tier2_comparison(
        facts, before(facts, "market_key % 3 = 1"), month_runs(spark, d), P.periods(spark, d), week_associations(spark, d), weekly_run=True,
        keys=q_panel.SIDE_KEYS, period_keys=["contract_id", "period_id"], measures=["volume"], within=["market_key", "period_id"],
    )
    return q_panel.rounded(done.facts.select("contract_id", "market_key", "path", "period_id", *SHOWN))


ODD = """odd AS (SELECT p_partkey, p_size, 'a b%' || p_type || '+x=' || (p_size % 3) AS area FROM part)"""


def odd_parts(spark, d):
    """Parts under partition values with a blank, a percent sign, a plus and an equals sign."""
    area = F.concat(F.lit("a b%"), "p_type", F.lit("+x="), (F.col("p_size") % 3).cast("string"))
    return P.table(spark, d, "part").select("p_partkey", "p_size", area.alias("area"))


@query("snk08_odd_partitions", "SELECT p_partkey, p_size, area FROM odd WHERE area NOT LIKE '%=1' AND (area NOT LIKE '%=2' OR p_size >= 25)", (ODD,))
def odd_deletes(spark, d):
    """Partitions and rows deleted under a base path and partition values with special characters."""
    path = scratch_path(spark, "odd table % +")
    S.write_partitions(odd_parts(spark, d), path, ["area"])
    S.drop_partitions(spark, path, F.col("area").endswith("=1"), ["area"])
    gone = odd_parts(spark, d).where("area LIKE '%=2' AND p_size < 25").select("p_partkey", "area")
    S.delete_rows(spark, path, gone, ["p_partkey", "area"], ["area"])
    return spark.read.parquet(path).select("p_partkey", "p_size", "area")


@query("snk04_partitioned_sync", "SELECT p_partkey, p_size + 1 AS p_size, area, TRUE AS in_folder FROM odd WHERE p_size > 10", (ODD,))
def partitioned_sync(spark, d):
    """A synced table keeps its partition folders."""
    path = scratch_path(spark, "synced table")
    S.write_partitions(odd_parts(spark, d), path, ["area"])
    S.sync(spark, odd_parts(spark, d).where("p_size > 10").withColumn("p_size", F.col("p_size") + 1), path, ["p_partkey"])
    return spark.read.parquet(path).select("p_partkey", "p_size", "area", F.contains(F.col("_metadata.file_path"), F.lit("/area=")).alias("in_folder"))
