"""Joins and periods (JN-*, TIM-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.functions.text import path_parent
from panelgrain.operators import lookup as J
from panelgrain.operators import periods as T
from panelgrain.operators.extract import deepest_level

# ---------------------------------------------------------------- joins


@query(
    "jn01_inner_lookups",
    """SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def jn01(spark, d):
    s, n, r = (P.table(spark, d, t) for t in ("supplier", "nation", "region"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@query(
    "jn02_star_lookup",
    """SELECT f.market_key, f.product_key, f.period_id, n_name AS market_name, p_name AS product_name, start_date, f.volume FROM facts f
       LEFT JOIN nation ON f.market_key = n_nationkey LEFT JOIN (SELECT * FROM part WHERE p_size <> 7) ON f.product_key = p_partkey LEFT JOIN periods ON f.period_id = periods.period_id""",
    (P.SALES, P.FACTS, P.PERIODS),
)
def jn02(spark, d):
    facts = P.facts(spark, d).select("market_key", "product_key", "period_id", "volume")
    markets = P.table(spark, d, "nation").select(F.col("n_nationkey").alias("market_key"), F.col("n_name").alias("market_name"))
    products = P.table(spark, d, "part").where("p_size <> 7").select(F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"))
    periods = P.periods(spark, d).select("period_id", "start_date")
    return J.star(facts, [(markets, ["market_key"]), (products, ["product_key"]), (periods, ["period_id"])])


@query(
    "jn03_layered_lookup",
    """SELECT p_partkey, CASE WHEN p_size < 10 THEN 'contract ' || p_brand WHEN p_type IN ('SMALL', 'LARGE') THEN 'country ' || p_type ELSE 'default' END AS rule
       FROM part""",
)
def jn03(spark, d):
    part = P.table(spark, d, "part")
    rows = part.select("p_partkey", "p_brand", "p_type", F.col("p_size").alias("size"))
    by_contract = part.where("p_size < 10").select("p_brand", F.col("p_size").alias("size"), F.concat(F.lit("contract "), "p_brand").alias("rule")).distinct()
    by_country = part.where("p_type IN ('SMALL', 'LARGE')").select("p_type", F.concat(F.lit("country "), "p_type").alias("rule")).distinct()
    default = part.select("p_brand", F.lit("default").alias("rule")).distinct()
    layers = [J.Layer(by_contract, ("p_brand", "size")), J.Layer(by_country, ("p_type",)), J.Layer(default, ("p_brand",))]
    return J.layered(rows, layers, "rule").select("p_partkey", "rule")


@query("jn04_not_logged", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS run_id FROM orders WHERE year(o_orderdate) >= 1998")
def jn04(spark, d):
    orders = P.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("run_id"))
    return J.not_logged(orders, orders.where("run_id < 1998"), ["run_id"]).select("o_orderkey", "run_id")


@query("jn05_invalid_products", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 5)")
def jn05(spark, d):
    bad = P.table(spark, d, "part").where("p_size < 5").select(F.col("p_partkey").alias("l_partkey"))
    return P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(bad, "l_partkey", "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


def name_patterns(spark, d):
    """LIKE patterns per brand from the parts themselves: exact names, first words, last words, middles, and escaped wildcards."""
    part = P.table(spark, d, "part")
    middle = part.where("p_size = 25").select("p_brand", F.concat(F.lit("%"), F.substring_index("p_name", " ", 1), F.lit("_%")).alias("pattern"))
    escaped = part.where("p_size = 30").select("p_brand", F.concat("p_name", F.lit("\\%_off")).alias("pattern"))
    escaped_end = part.where("p_size = 31").select("p_brand", F.lit("%\\%\\_off").alias("pattern"))
    exact = part.where("p_size = 1").select("p_brand", F.col("p_name").alias("pattern"))
    head = part.where("p_size < 20").select("p_brand", F.concat(F.substring_index("p_name", " ", 1), F.lit(" %")).alias("pattern"))
    tail = part.where("p_size > 45").select("p_brand", F.concat(F.lit("%"), F.substring_index("p_name", " ", -1)).alias("pattern"))
    return reduce(DataFrame.union, [exact, head, tail, middle, escaped, escaped_end]).distinct().withColumn("label", F.concat(F.lit("<"), "pattern", F.lit(">")))


def coded_parts(spark, d):
    """Names as codes; some carry a literal percent sign."""
    code = F.when(F.col("p_size").isin(30, 31), F.concat("p_name", F.lit("%_off"))).otherwise(F.col("p_name"))
    return P.table(spark, d, "part").select("p_partkey", "p_brand", code.alias("code"))


RANKED_PATTERNS = r"""coded AS (SELECT p_partkey, p_brand, CASE WHEN p_size IN (30, 31) THEN p_name || '%_off' ELSE p_name END AS code FROM part),
       pats AS (SELECT p_brand, p_name AS pattern FROM part WHERE p_size = 1 UNION SELECT p_brand, split_part(p_name, ' ', 1) || ' %' FROM part WHERE p_size < 20
         UNION SELECT p_brand, '%' || split_part(p_name, ' ', -1) FROM part WHERE p_size > 45 UNION SELECT p_brand, '%' || split_part(p_name, ' ', 1) || '_%' FROM part WHERE p_size = 25
         UNION SELECT p_brand, p_name || '\%_off' FROM part WHERE p_size = 30 UNION SELECT p_brand, '%\%\_off' FROM part WHERE p_size = 31),
       ranked AS (SELECT c.p_brand, c.code, pattern, row_number() OVER (PARTITION BY c.p_brand, c.code
           ORDER BY length(regexp_replace(regexp_extract(pattern, '^([^%_\\]|\\.)*'), '\\(.)', '\1', 'g')) DESC, length(regexp_extract(pattern, '^([^%_\\]|\\.)*')) < length(pattern), pattern) AS rn
         FROM (SELECT DISTINCT p_brand, code FROM coded) c JOIN pats ON pats.p_brand = c.p_brand AND c.code LIKE pattern ESCAPE '\')"""


@query(
    "jn06_like_lookup",
    f"""WITH {RANKED_PATTERNS}
       SELECT p.p_partkey, r.pattern, '<' || r.pattern || '>' AS label FROM coded p LEFT JOIN ranked r ON r.p_brand = p.p_brand AND r.code = p.code AND rn = 1""",
)
def jn06(spark, d):
    return J.like_lookup(coded_parts(spark, d), name_patterns(spark, d), ["p_brand"], "code", "pattern", ["label"]).select("p_partkey", "pattern", "label")


@query("jn06_like_conflicts", f"WITH {RANKED_PATTERNS} SELECT p_brand, code, pattern, '<' || pattern || '>' AS label FROM ranked WHERE rn > 1")
def jn06_conflicts(spark, d):
    return J.like_conflicts(coded_parts(spark, d), name_patterns(spark, d), ["p_brand"], "code", "pattern", ["label"])


INNER = """inner_pats AS (SELECT DISTINCT '%' || substr(c_name, 13, 3 + c_custkey % 4) || CASE WHEN c_nationkey % 2 = 0 THEN '_' || right(c_name, 1) ELSE '' END || '%' AS pattern FROM customer)"""


@query("jn06_inner_patterns", f"WITH {INNER} SELECT pattern, count(*) AS codes, min(c_name) AS first_code FROM inner_pats JOIN customer ON c_name LIKE pattern GROUP BY 1")
def jn06_inner(spark, d):
    """About as many patterns wild at both ends as there are customers, against all names."""
    customer = P.table(spark, d, "customer")
    text = F.expr("concat('%', substring(c_name, 13, cast(3 + c_custkey % 4 as int)), CASE WHEN c_nationkey % 2 = 0 THEN concat('_', right(c_name, 1)) ELSE '' END, '%')")
    hits = J.like_hits(customer.select(F.col("c_name").alias("code")).distinct(), customer.select(text.alias("pattern")).distinct(), [], "code", "pattern")
    return hits.groupBy("pattern").agg(F.count("*").alias("codes"), F.min("code").alias("first_code"))


@query(
    "jn07_start_or_end",
    """WITH given AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
       t AS (SELECT strftime(day, '%Y%m%d') AS period_code, day AS period_start, day AS period_end, CASE WHEN day(day) % 3 = 0 THEN 'WK' ELSE 'MH' END AS period_type FROM given)
       SELECT DISTINCT t.period_code, t.period_type, p.period_id FROM t LEFT JOIN periods p ON (t.period_start = p.start_date OR t.period_end = p.end_date) AND t.period_type = p.type""",
    (P.PERIODS,),
)
def jn07(spark, d):
    day = F.col("day")
    days = P.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    given = days.select(F.date_format(day, "yyyyMMdd").alias("period_code"), day.alias("period_start"), day.alias("period_end"), F.when(F.dayofmonth(day) % 3 == 0, "WK").otherwise("MH").alias("period_type"))
    return T.resolve_by_start_or_end(given, P.periods(spark, d)).select("period_code", "period_type", "period_id")


@query(
    "jn08_period_by_end",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS period_end, 'MH' AS period_type, p.period_id FROM orders LEFT JOIN periods p ON CAST(o_orderdate AS DATE) = p.end_date""",
    (P.PERIODS,),
)
def jn08(spark, d):
    given = P.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("period_end"), F.lit("MH").alias("period_type"))
    return T.resolve_by_end(given, P.periods(spark, d)).select("period_end", "period_type", "period_id")


def vendor_codes(spark, d):
    return P.periods(spark, d).select(F.date_format("start_date", "yyyyMM").alias("vendor_code"), "period_id", "start_date").where("year(start_date) <> 1997").drop("start_date")


CODES = "codes AS (SELECT strftime(start_date, '%Y%m') AS vendor_code, period_id FROM periods WHERE year(start_date) <> 1997)"


@query(
    "jn09_period_by_code",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS code, c.period_id, p.end_date AS period_end FROM orders LEFT JOIN codes c ON strftime(o_orderdate, '%Y%m') = c.vendor_code
       LEFT JOIN periods p ON p.period_id = c.period_id""",
    (P.PERIODS, CODES),
)
def jn09(spark, d):
    rows = P.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("code"), F.lit(0).alias("period_id"))
    return T.resolve_by_code(rows, vendor_codes(spark, d), P.periods(spark, d)).select("o_orderkey", "code", "period_id", "period_end")


def level_metadata(spark, d):
    """Per type two structures whose levels carry attribute names in a different order."""
    types = P.table(spark, d, "part").select(F.col("p_type").alias("category")).distinct()
    one = [("1", 1, "CATEGORY"), ("1", 2, "BRAND"), ("1", 3, "ITEM"), ("2", 1, "CATEGORY"), ("2", 2, "SIZE"), ("2", 3, "BRAND"), ("1", 12, "DEEP"), ("2", 12, "DEEP")]
    rows = F.array(*[F.struct(F.lit(s).alias("structure"), F.lit(n).alias("level"), F.lit(a).alias("attribute_name")) for s, n, a in one])
    return types.select("category", F.explode(rows).alias("r")).select("category", "r.*")


@query(
    "jn10_level_fan_out",
    """SELECT p_partkey, 'CATEGORY' AS level_name_1, CASE WHEN p_size > 25 THEN 'SIZE' ELSE 'BRAND' END AS level_name_2, CASE WHEN p_size > 25 THEN 'BRAND' ELSE 'ITEM' END AS level_name_3,
       CAST(NULL AS VARCHAR) AS level_name_4, CASE WHEN p_size % 3 = 0 THEN 'CATEGORY' WHEN p_size % 3 = 1 THEN CASE WHEN p_size > 25 THEN 'SIZE' ELSE 'BRAND' END WHEN p_size > 40 THEN 'DEEP'
         ELSE CASE WHEN p_size > 25 THEN 'BRAND' ELSE 'ITEM' END END AS own_level_name FROM part""",
)
def jn10(spark, d):
    rows = P.table(spark, d, "part").select("p_partkey", F.col("p_type").alias("category"), F.when(F.col("p_size") > 25, "2").otherwise("1").alias("structure"), F.when(F.expr("p_size % 3 = 2 AND p_size > 40"), 12).otherwise(F.col("p_size") % 3 + 1).alias("level"))
    out = J.fan_out_levels(rows, level_metadata(spark, d), ["category", "structure"])
    return out.select("p_partkey", "level_name_1", "level_name_2", "level_name_3", "level_name_4", "own_level_name")


@query(
    "jn11_parent_self_join",
    """SELECT a.market_key, a.period_id, a.path, a.parent_path, b.parent_volume FROM tree a LEFT JOIN (SELECT market_key, period_id, path, volume AS parent_volume FROM tree) b
       ON a.market_key = b.market_key AND a.period_id = b.period_id AND a.parent_path = b.path""",
    (P.SALES, P.TREE),
)
def jn11(spark, d):
    tree = P.tree_facts(spark, d).withColumnRenamed("parent_path", "type_path")
    keyed = tree.withColumn("full_path", F.concat_ws(" ", "market_key", "period_id", "path"))
    out = J.with_parent(keyed, "full_path", path_parent(F.col("full_path")), ["volume"])
    return out.select("market_key", "period_id", "path", F.col("type_path").alias("parent_path"), "parent_volume")


@query(
    "jn13_newest_change",
    """WITH a AS (SELECT o_custkey AS k, o_orderdate AS t FROM orders), r AS (SELECT user_id AS k, ts AS t FROM events)
       SELECT coalesce(x.k, y.k) AS k, strftime(greatest(x.t, y.t), '%Y-%m-%d %H:%M') AS newest FROM (SELECT k, max(t) AS t FROM a GROUP BY 1) x FULL JOIN (SELECT k, max(t) AS t FROM r GROUP BY 1) y ON x.k = y.k""",
)
def jn13(spark, d):
    adds = P.table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("added"))
    removes = P.table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("ts").alias("removed"))
    return J.newest_change(adds, removes, ["k"], "added", "removed", "newest").withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm"))


@query(
    "jn14_complete_levels",
    """SELECT CAST(coalesce(g, level) AS INTEGER) AS level, n FROM (SELECT unnest(range(1, 10)) AS g) FULL JOIN (SELECT p_size AS level, count(*) AS n FROM part WHERE p_type <> 'SMALL' GROUP BY 1) ON g = level""",
)
def jn14(spark, d):
    counts = P.table(spark, d, "part").where("p_type <> 'SMALL'").groupBy(F.col("p_size").alias("level")).agg(F.count("*").alias("n"))
    return J.complete_levels(counts, "level")


@query(
    "jn15_run_levels",
    """SELECT s_suppkey, n_name, r.run_id FROM supplier, nation, (SELECT contract_id, max(run_id) AS run_id FROM deliveries GROUP BY 1) r
       WHERE s_nationkey = n_nationkey AND n_regionkey = r.contract_id""",
    (P.SALES, P.DELIVERIES),
)
def jn15(spark, d):
    last = P.deliveries(spark, d).groupBy("contract_id").agg(F.max("run_id").alias("run_id"))
    s, n = P.table(spark, d, "supplier"), P.table(spark, d, "nation")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(last, F.col("n_regionkey") == F.col("contract_id")).select("s_suppkey", "n_name", "run_id")


@query("jn16_scalar_row", "SELECT p_partkey, p_size = (SELECT max(p_size) FROM part) AS at_bottom FROM part")
def jn16(spark, d):
    part = P.table(spark, d, "part")
    return part.select("p_partkey", (F.col("p_size") == deepest_level(part, "p_size")).alias("at_bottom"))


def week_associations(spark, d):
    """Month -> week associations: a week belongs to the month of its last day."""
    day = F.col("l_shipdate").cast("date")
    weeks = P.table(spark, d, "lineitem").select(F.next_day(F.date_sub(day, 1), "Sun").alias("week_end")).distinct()
    return weeks.select(
        F.last_day("week_end").alias("end_a"), F.lit("MH").alias("type_a"), F.lit("WKMS").alias("type_b"), F.date_format("week_end", "yyyyMMdd").alias("id_b")
    )


WEEKS = """weeks AS (SELECT DISTINCT last_day(w) AS period_end, w FROM (SELECT CAST(l_shipdate AS DATE) + CAST((7 - dayofweek(l_shipdate)) % 7 AS INTEGER) AS w FROM lineitem))"""


@query("tim05_five_week_factor", "SELECT period_end, count(*) AS weeks, CASE WHEN count(*) = 5 THEN 0.8 ELSE 1.0 END::DOUBLE AS time_factor FROM weeks GROUP BY 1", (WEEKS,))
def tim05(spark, d):
    return T.five_week_factor(week_associations(spark, d), weekly_run=True)


@query(
    "jn17_factor_per_row",
    """SELECT s.order_key, s.line_number, s.product_key, s.period_end, coalesce(CASE WHEN n = 5 THEN 0.8 ELSE 1.0 END, 1.0)::DOUBLE AS time_factor FROM sales s
       LEFT JOIN (SELECT period_end, count(*) AS n FROM weeks GROUP BY 1) w ON s.period_end = w.period_end""",
    (P.SALES, WEEKS),
)
def jn17(spark, d):
    factors = T.five_week_factor(week_associations(spark, d), weekly_run=True).select("period_end", "time_factor")
    rows = P.sales(spark, d).join(factors, "period_end", "left")
    return rows.select("order_key", "line_number", "product_key", "period_end", F.coalesce("time_factor", F.lit(1.0)).alias("time_factor"))


@query("jn18_semi_delete", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000)")
def jn18(spark, d):
    wanted = P.table(spark, d, "orders").where("o_orderstatus = 'F' AND o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return P.table(spark, d, "customer").select("c_custkey").join(wanted, "c_custkey", "left_semi")


@query(
    "jn19_earlier_claims",
    """SELECT e.event_id, f.run_id AS holder FROM (SELECT user_id AS claim_key, event_id, event_type AS run_id, ts FROM events) e
       JOIN (SELECT user_id AS claim_key, event_type AS run_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) AS rn FROM events) WHERE rn = 1) f
       ON e.claim_key = f.claim_key AND e.run_id <> f.run_id AND f.ts <= e.ts""",
)
def jn19(spark, d):
    claims = P.table(spark, d, "events").select(F.col("user_id").alias("claim_key"), "event_id", F.col("event_type").alias("run_id"), F.col("ts").alias("claimed_at"))
    return J.earlier_claims(claims).select("event_id", "holder")


@query(
    "jn20_visible_rows",
    """SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))""",
)
def jn20(spark, d):
    rows = P.table(spark, d, "supplier").join(P.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    region = P.table(spark, d, "region")
    principal = F.when(F.col("r_name").isin("ASIA", "EUROPE"), "analyst").otherwise("admin")
    permissions = region.select(F.col("r_regionkey").alias("n_regionkey"), principal.alias("principal"))
    return J.visible_rows(rows, permissions, "analyst", "n_regionkey").select("s_suppkey", "n_regionkey")


# ---------------------------------------------------------------- periods


@query(
    "tim01_resolution_by_code",
    """SELECT s.order_key, s.line_number, s.product_key, c.period_id, p.end_date AS period_end FROM sales s LEFT JOIN codes c ON strftime(s.period_end, '%Y%m') = c.vendor_code LEFT JOIN periods p ON p.period_id = c.period_id""",
    (P.SALES, P.PERIODS, CODES),
)
def tim01(spark, d):
    rows = P.sales(spark, d).select("order_key", "line_number", "product_key", F.date_format("period_end", "yyyyMM").alias("code"))
    return T.resolve_by_code(rows, vendor_codes(spark, d), P.periods(spark, d)).select("order_key", "line_number", "product_key", "period_id", "period_end")


def flat_periods(spark, d):
    """Months, odd and even bi-months and bi-weeks of the line items' calendar, with parents flattened."""
    months = P.periods(spark, d)
    blank = {f"{p}_{s}": F.lit(None).cast("date" if s in ("start", "end") else "int" if s == "id" else "string") for p in ("even_bimonth", "month") for s in ("id", "class", "type", "start", "end")}
    base = months.select("period_id", "class", "type", "start_date", "end_date").withColumns(blank)
    half = months.where(F.month("start_date").isin(2, 4, 6, 8, 10, 12)).select(
        (F.col("period_id") + 100000).alias("period_id"),
        F.lit("BIMTH").alias("class"),
        F.when(F.col("period_id") % 4 == 0, "EB").otherwise("OB").alias("type"),
        "start_date",
        F.last_day(F.add_months("start_date", 1)).alias("end_date"),
    ).withColumns(blank)
    fortnights = months.select(
        (F.col("period_id") + 200000).alias("period_id"),
        F.lit("WK").alias("class"),
        F.lit("BW").alias("type"),
        "start_date",
        F.date_add("start_date", 13).alias("end_date"),
        F.when(F.col("period_id") % 4 < 2, F.floor(F.col("period_id") / 4).cast("int") * 4 + 100000).alias("even_bimonth_id"),
        F.lit("BIMTH").alias("even_bimonth_class"),
        F.when(F.col("period_id") % 4 < 2, "EB").alias("even_bimonth_type"),
        F.col("start_date").alias("even_bimonth_start"),
        F.col("end_date").alias("even_bimonth_end"),
        F.col("period_id").alias("month_id"),
        F.lit("MTH").alias("month_class"),
        F.lit("MH").alias("month_type"),
        F.col("start_date").alias("month_start"),
        F.col("end_date").alias("month_end"),
    )
    return base.unionByName(half).unionByName(fortnights)


@query(
    "tim02_associations",
    """WITH b AS (SELECT period_id + 100000 AS period_id, CASE WHEN period_id % 4 = 0 THEN 'EB' ELSE 'OB' END AS type, period_id AS m, start_date, last_day(CAST(start_date + INTERVAL 1 MONTH AS DATE)) AS end_date FROM periods WHERE month(start_date) IN (2, 4, 6, 8, 10, 12)),
       fwd AS (SELECT b.period_id AS id_a, 'BIMTH' AS class_a, b.type AS type_a, b.start_date AS start_a, b.end_date AS end_a, p.period_id AS id_b, 'MTH' AS class_b, 'MH' AS type_b, p.start_date AS start_b, p.end_date AS end_b
               FROM b JOIN periods p ON p.period_id IN (b.m, b.m + 1)),
       bw AS (SELECT period_id + 200000 AS id_b, 'WK' AS class_b, 'BW' AS type_b, start_date AS start_b, start_date + 13 AS end_b, period_id AS m, start_date, end_date FROM periods)
       SELECT 1 AS assoc_type, * FROM fwd
       UNION SELECT 1, id_b, class_b, type_b, start_b, end_b, id_a, class_a, type_a, start_a, end_a FROM fwd
       UNION SELECT 1, m - m % 4 + 100000, 'BIMTH', 'EB', start_date, end_date, id_b, class_b, type_b, start_b, end_b FROM bw WHERE m % 4 < 2
       UNION SELECT 1, m, 'MTH', 'MH', start_date, end_date, id_b, class_b, type_b, start_b, end_b FROM bw""",
    (P.PERIODS,),
)
def tim02(spark, d):
    months = P.periods(spark, d)
    evens = months.where(F.month("start_date").isin(2, 4, 6, 8, 10, 12)).select((F.col("period_id") + 100000).alias("period_a"), F.explode(F.array(F.col("period_id"), F.col("period_id") + 1)).alias("period_b"))
    stored = evens.select(F.lit(1).alias("assoc_type"), F.lit(2).alias("calendar"), "period_a", "period_b")
    other = evens.select(F.lit(1).alias("assoc_type"), F.lit(1).alias("calendar"), "period_a", "period_b")
    return T.period_associations(stored.unionByName(other), flat_periods(spark, d))


@query(
    "tim03_class_of_type",
    """SELECT s_suppkey AS contract_id, CASE s_nationkey % 3 WHEN 0 THEN 'MTH' WHEN 1 THEN 'WK' END AS class FROM supplier""",
)
def tim03(spark, d):
    kind = F.when(F.col("s_nationkey") % 3 == 0, "MH").when(F.col("s_nationkey") % 3 == 1, "WKMS").otherwise("??")
    contracts = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("contract_id"), kind.alias("period_type"))
    types = spark.createDataFrame([("MH", "MTH"), ("WKMS", "WK"), ("EB", "BIMTH")], "period_type string, class string")
    return T.class_of_type(types, contracts).select("contract_id", "class")


@query(
    "tim04_retention_date",
    """SELECT o_orderkey, CASE WHEN n <= 0 THEN NULL WHEN c = 'WK' THEN d - CAST(7 * n AS INTEGER) WHEN c = 'MTH' THEN CAST(d - to_months(CAST(n AS INTEGER)) AS DATE) WHEN c = 'BIMTH' THEN CAST(d - to_months(CAST(2 * n AS INTEGER)) AS DATE)
         WHEN c = 'QTR' THEN CAST(d - to_months(CAST(3 * n AS INTEGER)) AS DATE) ELSE d - CAST(7 * n AS INTEGER) END AS keep_from
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_custkey % 6 - 1 AS n, ['WK', 'MTH', 'BIMTH', 'QTR', 'CUSTM'][1 + o_orderkey % 5] AS c FROM orders)""",
)
def tim04(spark, d):
    classes = F.array(*[F.lit(c) for c in ("WK", "MTH", "BIMTH", "QTR", "CUSTM")])
    name = F.get(classes, (F.col("o_orderkey") % 5).cast("int"))
    return P.table(spark, d, "orders").select("o_orderkey", T.retention_date(F.col("o_orderdate").cast("date"), name, F.col("o_custkey") % 6 - 1).alias("keep_from"))


@query(
    "tim06_attach_period",
    """SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m') AS period_code, c.period_id, p.end_date AS period_end, 'USD' AS currency
       FROM lineitem JOIN codes c ON strftime(l_shipdate, '%Y%m') = c.vendor_code JOIN periods p ON p.period_id = c.period_id""",
    (P.PERIODS, CODES),
)
def tim06(spark, d):
    rows = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyyMM").alias("period_code"))
    resolved = T.resolve_by_code(vendor_codes(spark, d).select(F.col("vendor_code").alias("code"), F.lit(0).alias("period_id")), vendor_codes(spark, d), P.periods(spark, d))
    return T.attach_period(rows, resolved, "USD").select("l_orderkey", "l_linenumber", "l_partkey", "period_code", "period_id", "period_end", "currency")
