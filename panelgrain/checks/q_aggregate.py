"""Aggregations, windows, sorts, sets, reshapes and scalar families (AGG-*, WIN-*, SRT-*, SET-*, RSH-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.functions import text as X
from panelgrain.functions.numbering import ordered_numbers
from panelgrain.operators import dedup as D
from panelgrain.operators import reshape as R
from panelgrain.operators.compare import delivery_counts
from panelgrain.operators.conform import conform, empty_like, union_all
from panelgrain.operators.extract import deepest_level
from panelgrain.quality.framework import fail_flags

# ---------------------------------------------------------------- aggregations


@query("agg01_share_totals", "SELECT market_key, period_id, CAST(sum(quantity) AS DOUBLE) AS volume, CAST(sum(amount) AS DOUBLE) AS value FROM sales GROUP BY 1, 2", (P.SALES,))
def agg01(spark, d):
    return P.sales(spark, d).groupBy("market_key", "period_id").agg(P.total("quantity").alias("volume"), P.total("amount").alias("value"))


@query(
    "agg02_delivery_counts",
    "SELECT contract_id, period_end, max(run_id) AS run_id, count(*) AS deliveries FROM deliveries GROUP BY 1, 2",
    (P.SALES, P.DELIVERIES),
)
def agg02(spark, d):
    return delivery_counts(P.deliveries(spark, d), ["contract_id", "period_end"])


@query(
    "agg03_unanimous",
    """SELECT p_type, p_brand, CASE WHEN count(DISTINCT p_name) = 1 THEN min(p_name) END AS p_name, CASE WHEN count(DISTINCT p_size) = 1 THEN min(p_size) END AS p_size,
       CASE WHEN count(DISTINCT left(p_name, 1)) = 1 THEN min(left(p_name, 1)) END AS initial FROM part GROUP BY 1, 2""",
)
def agg03(spark, d):
    return D.unanimous(P.table(spark, d, "part").withColumn("initial", F.substring("p_name", 1, 1)), ["p_type", "p_brand"], ["p_name", "p_size", "initial"])


@query("agg04_single_members", "SELECT p_name, p_size FROM part GROUP BY 1, 2 HAVING count(*) = 1")
def agg04(spark, d):
    return D.single_member_keys(P.table(spark, d, "part"), ["p_name", "p_size"])


@query("agg05_ordered_names", "SELECT p_brand, string_agg(p_type, ' ' ORDER BY lvl, p_type) AS types FROM (SELECT DISTINCT p_brand, length(p_type) AS lvl, p_type FROM part) GROUP BY 1")
def agg05(spark, d):
    return D.ordered_names(P.table(spark, d, "part").withColumn("lvl", F.length("p_type")), ["p_brand"], "lvl", "p_type", "types").select("p_brand", "types")


@query(
    "agg05_bounded_names",
    """SELECT p_type, string_agg(p_name, '; ' ORDER BY p_size, p_name) FILTER (n <= 20) AS names, greatest(max(n) - 20, 0) AS names_left_out
       FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_name) AS n FROM (SELECT DISTINCT p_type, p_size, p_name FROM part)) GROUP BY 1""",
)
def agg05_bounded(spark, d):
    """The first twenty part names of a type by size, and the number of the others."""
    return D.ordered_names(P.table(spark, d, "part"), ["p_type"], "p_size", "p_name", "names", "; ", most=20)


@query("agg06_newest_change", "SELECT contract_id, max(period_end) AS newest FROM sales GROUP BY 1", (P.SALES,))
def agg06(spark, d):
    return D.max_per(P.sales(spark, d), ["contract_id"], "period_end", "newest")


@query("agg07_latest_period", "SELECT contract_id, max(period_end) AS period_end, arg_max(period_id, period_end) AS period_id FROM sales GROUP BY 1", (P.SALES,))
def agg07(spark, d):
    return P.sales(spark, d).groupBy("contract_id").agg(F.max("period_end").alias("period_end"), F.max_by("period_id", "period_end").alias("period_id"))


@query("agg08_row_count", "SELECT CAST(year(o_orderdate) AS INTEGER) AS run_id, count(*) AS rows FROM orders GROUP BY 1")
def agg08(spark, d):
    return P.table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("run_id")).agg(F.count("*").alias("rows"))


@query("agg09_distinct_keys", "SELECT DISTINCT contract_id, period_end FROM sales", (P.SALES,))
def agg09(spark, d):
    return P.sales(spark, d).select("contract_id", "period_end").distinct()


@query("agg10_deepest_level", "SELECT p_partkey, (SELECT CAST(max(p_size) AS INTEGER) FROM part) AS deepest FROM part")
def agg10(spark, d):
    part = P.table(spark, d, "part")
    return part.select("p_partkey", deepest_level(part, "p_size").alias("deepest"))


@query("agg11_last_run", "SELECT contract_id, max(run_id) AS run_id FROM deliveries GROUP BY 1", (P.SALES, P.DELIVERIES))
def agg11(spark, d):
    return D.max_per(P.deliveries(spark, d), ["contract_id"], "run_id", "run_id")


@query(
    "agg12_fail_flags",
    """SELECT o_custkey AS run_id, CASE WHEN bool_or(o_orderstatus = 'F') THEN 'Y' ELSE 'N' END AS failed,
       CASE WHEN bool_or(o_orderstatus = 'F') THEN 'FAILED' ELSE 'PASSED' END AS overall FROM orders GROUP BY 1""",
)
def agg12(spark, d):
    rows = P.table(spark, d, "orders").select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("PASSED").alias("result"))
    return fail_flags(rows, ["run_id"])


# ---------------------------------------------------------------- windows


@query(
    "win01_latest_per_key",
    """SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn
       FROM orders WHERE o_orderpriority IS NOT NULL) WHERE rn = 1""",
)
def win01(spark, d):
    rows = P.table(spark, d, "orders")
    return D.latest_per_key(rows, ["o_custkey", "o_orderpriority"], "o_orderdate", "o_orderkey", not_null="o_orderpriority").select("o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "win02_latest_result",
    """SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def win02(spark, d):
    return D.latest_per_key(P.table(spark, d, "events"), ["event_type", "user_id"], "ts", "event_id").select("event_type", "user_id", "event_id")


@query(
    "win03_latest_product",
    """SELECT path, product_key FROM (SELECT p_type || ' ' || p_brand AS path, p_partkey AS product_key, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_size DESC, p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def win03(spark, d):
    rows = P.products(spark, d).withColumn("path", F.concat_ws(" ", "category", "brand"))
    return D.latest_per_key(rows, ["path"], "size", "product_key").select("path", "product_key")


@query(
    "win04_latest_with_prefixes",
    """SELECT path, product_key, split_part(path, ' ', 1) AS top_path, split_part(path, ' ', 1) || ' ' || split_part(path, ' ', 2) AS parent_path FROM products""",
    (P.PRODUCTS,),
)
def win04(spark, d):
    newest = D.latest_per_key(P.products(spark, d), ["path"], "size", "product_key")
    return newest.select("path", "product_key", X.path_prefix(F.col("path"), 1).alias("top_path"), X.path_prefix(F.col("path"), 2).alias("parent_path"))


@query(
    "win05_first_claim",
    """SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def win05(spark, d):
    return D.first_per_key(P.table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id")


@query("win06_display_order", "SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS display_order FROM part")
def win06(spark, d):
    return ordered_numbers(P.table(spark, d, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], "display_order").select("p_partkey", "display_order")


@query("win07_ordinal", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS ordinal FROM events")
def win07(spark, d):
    return ordered_numbers(P.table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"], "ordinal").select("event_id", "ordinal")


@query(
    "win08_nth_values",
    """SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderkey END) AS order_1, max(CASE WHEN rn = 2 THEN o_orderkey END) AS order_2, max(CASE WHEN rn = 3 THEN o_orderkey END) AS order_3
       FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) GROUP BY 1""",
)
def win08(spark, d):
    return D.nth_values(P.table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderkey", 3, "order_")


@query(
    "win09_first_line",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
)
def win09(spark, d):
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")]
    return D.first_per_key(P.table(spark, d, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_linenumber", "l_partkey")


@query("win10_repeated_rows", "SELECT * FROM (SELECT p_partkey, p_name, p_size, count(*) OVER (PARTITION BY p_name, p_size) AS copies FROM part) WHERE copies > 1")
def win10(spark, d):
    return D.repeated_rows(P.table(spark, d, "part").select("p_partkey", "p_name", "p_size"), ["p_name", "p_size"])


# ---------------------------------------------------------------- sorts and sets


@query("srt01_by_outcome", "SELECT o_orderstatus AS result, o_orderkey FROM orders ORDER BY 1, 2")
def srt01(spark, d):
    return P.table(spark, d, "orders").select(F.col("o_orderstatus").alias("result"), "o_orderkey").orderBy("result", "o_orderkey")


@query("srt02_newest", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 1")
def srt02(spark, d):
    return P.table(spark, d, "events").orderBy(F.col("ts").desc(), "event_id").limit(1).select("event_id", "event_type")


@query("srt03_by_ordinal", "SELECT n_nationkey AS ordinal, n_name FROM nation ORDER BY 1")
def srt03(spark, d):
    return P.table(spark, d, "nation").select(F.col("n_nationkey").alias("ordinal"), "n_name").orderBy("ordinal")


@query("srt04_empty_frame", "SELECT p_partkey, p_name FROM part")
def srt04(spark, d):
    part = P.table(spark, d, "part").select("p_partkey", "p_name")
    return part.unionByName(empty_like(part))


@query("set01_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation")
def set01(spark, d):
    frames = [P.table(spark, d, t).select(F.col(c).alias("k")).distinct() for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))]
    return reduce(DataFrame.unionByName, frames).distinct()


@query("set02_stacked_distinct", "SELECT DISTINCT word FROM (SELECT p_brand AS word FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_name FROM part) WHERE word IS NOT NULL")
def set02(spark, d):
    words = P.table(spark, d, "part").select(F.explode(F.array("p_brand", "p_type", "p_name")).alias("word"))
    return words.where("word IS NOT NULL").distinct()


@query("set03_class_union", "SELECT 'customer' AS kind, c_custkey AS k FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier UNION ALL SELECT 'part', p_partkey FROM part")
def set03(spark, d):
    kinds = (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))
    return union_all([P.table(spark, d, t).select(F.lit(t).alias("kind"), F.col(c).alias("k")) for t, c in kinds])


@query("set04_except", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey * 2 FROM lineitem")
def set04(spark, d):
    sold = P.table(spark, d, "lineitem").select(F.col("l_partkey") * 2)
    return P.table(spark, d, "part").select(F.col("p_partkey").alias("k")).subtract(sold)


@query("set05_union_conformed", "SELECT l_orderkey AS k, CAST(l_quantity AS DOUBLE) AS v, l_returnflag AS note FROM lineitem UNION ALL SELECT o_orderkey, TRY_CAST(o_totalprice || CASE WHEN o_orderstatus = 'P' THEN '?' ELSE '' END AS DOUBLE), NULL FROM orders")
def set05(spark, d):
    """Frames with other orders, types and columns; a text that is no number becomes null."""
    shape = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType()), T.StructField("note", T.StringType())])
    lines = P.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("NOTE"), F.col("l_quantity").alias("v"), F.col("l_orderkey").cast("string").alias("k"), "l_tax")
    price = F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.when(F.col("o_orderstatus") == "P", "?").otherwise(""))
    orders = P.table(spark, d, "orders").select(price.alias("v"), F.col("o_orderkey").alias("k"))
    return union_all([conform(lines, shape), conform(orders, shape)])


# ---------------------------------------------------------------- reshapes


@query(
    "rsh01_unpivot_header",
    """SELECT n_nationkey, u.position, u.measure_code FROM (SELECT n_nationkey, unnest([{'position': 1, 'measure_code': n_name}, {'position': 2, 'measure_code': CAST(n_regionkey AS VARCHAR)}]) AS u FROM nation)""",
)
def rsh01(spark, d):
    nation = P.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("col1"), F.col("n_name").alias("col2"), F.col("n_regionkey").cast("string").alias("col3"))
    keyed = nation.select(F.col("col1"), "col2", "col3")
    long = keyed.unpivot(["col1"], ["col2", "col3"], "column", "measure_code")
    return long.select(F.col("col1").cast("int").alias("n_nationkey"), (F.substring("column", 4, 3).cast("int") - 1).alias("position"), "measure_code")


@query(
    "rsh01_header_positions",
    """SELECT CAST(p AS INTEGER) AS position, code AS measure_code, count(*) AS headers FROM (SELECT unnest([1, 2]) AS p, unnest([p_brand, p_type]) AS code FROM part) GROUP BY 1, 2""",
)
def rsh01_header(spark, d):
    header = P.table(spark, d, "part").select(F.lit("a").alias("col1"), F.lit("b").alias("col2"), F.lit("c").alias("col3"), F.col("p_brand").alias("col4"), F.col("p_type").alias("col5"))
    return R.unpivot_header(header).groupBy("position", "measure_code").agg(F.count("*").alias("headers"))


@query(
    "rsh02_metadata_pivot",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type ELSE p_brand END AS a_form, CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS b_group FROM part""",
)
def rsh02(spark, d):
    big = F.col("p_size") > 25
    rows = P.table(spark, d, "part").select("p_partkey", F.when(big, "a_form").otherwise("b_group").alias("n1"), F.when(big, "b_group").otherwise("a_form").alias("n2"), F.col("p_type").alias("c1"), F.col("p_brand").alias("c2"))
    return R.pivot_by_metadata(rows, ["n1", "n2"], ["c1", "c2"], ["b_group", "a_form"]).select("p_partkey", "a_form", "b_group")


SLOTS = [f"slot_{i}" for i in range(1, 21)]


def physical_lines(spark, d, measures: int = 45):
    """Line items as records of 45 measures on three physical lines of 20 slots; the second measure of
    every third order is missing and odd lines have a last line less."""
    item = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q")).dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    lines = item.withColumn("line", F.explode(F.sequence(F.lit(1), F.lit(-(-measures // 20))))).withColumn("before", F.col("q") * 100 + (F.col("line") - 1) * 20)

    def slot(i):
        """Measure k = 20 * (line - 1) + i is q * 100 + k. Short, as 20 of these make one generated method."""
        text = (F.col("before") + i).cast("string")
        if i == 2:
            text = F.when((F.col("line") == 1) & (F.col("l_orderkey") % 3 == 0), F.lit("N/A")).otherwise(text)
        return F.when(F.col("line") <= (measures - i) // 20 + 1, text).otherwise(F.lit("")).alias(f"slot_{i}")

    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "line", *[slot(i) for i in range(1, 21)])


@query(
    "rsh03_stitch_lines",
    """SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, q * 100.0 + 1 AS measure_1, CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE q * 100.0 + 2 END AS measure_2,
       q * 100.0 + 20 AS measure_20, q * 100.0 + 21 AS measure_21, q * 100.0 + 45 AS measure_45, CAST(NULL AS DOUBLE) AS measure_46
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(first(CAST(l_quantity AS INTEGER)) AS DOUBLE) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2, 3, 4) WHERE n = 1""",
)
def rsh03(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    single = P.table(spark, d, "lineitem").groupBy(*keys).agg(F.count("*").alias("n")).where("n = 1").drop("n")
    stitched = R.stitch_lines(physical_lines(spark, d), keys, ["line"], SLOTS, measures=range(1, 61)).join(single, keys, "left_semi")
    shown = [1, 2, 20, 21, 45, 46]
    return stitched.select(*keys, *[F.col(f"measure_{k}").cast("double").alias(f"measure_{k}") for k in shown])


@query(
    "rsh03_surplus_lines",
    """SELECT l_orderkey, l_linenumber, line, CAST(r AS INTEGER) AS line_rank FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, line) AS r
       FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem), (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS line)) WHERE r > 5""",
)
def rsh03_surplus(spark, d):
    """Whole orders as records: from the sixth line on there is no measure for a line."""
    lines = physical_lines(spark, d)
    return R.surplus_lines(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "line"], SLOTS).select("l_orderkey", "l_linenumber", "line", "line_rank")


@query(
    "rsh04_delimited_clean",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 OR l_linenumber = 1 THEN NULL ELSE round(l_tax, 2) END AS measure_1, CASE WHEN l_discount < 0.05 THEN NULL ELSE round(l_discount, 2) END AS measure_2
       FROM lineitem WHERE l_tax <> 0 OR l_discount >= 0.05""",
)
def rsh04(spark, d):
    def text(c, missing):
        short = F.regexp_replace(F.format_string("%.2f", F.col(c)), "^0", "")
        if c == "l_tax":  # `,05` and `0,05` are no numbers, but their rows stay
            short = F.when(F.col("l_linenumber") == 1, F.when(F.col("l_orderkey") % 2 == 0, F.translate(short, ".", ",")).otherwise(F.concat(F.lit("0"), F.translate(short, ".", ",")))).otherwise(short)
        return F.when(missing, F.lit("N/A")).otherwise(short)

    rows = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text("l_tax", F.col("l_tax") == 0).alias("measure_1"), text("l_discount", F.col("l_discount") < 0.05).alias("measure_2"))
    out = R.clean_delimited_facts(rows, ["measure_1", "measure_2"])
    return out.withColumns({m: F.col(m).cast("double") for m in ("measure_1", "measure_2")})


@query("rsh05_explode_list", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def rsh05(spark, d):
    return R.explode_list(P.table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "word", " ").select("p_partkey", "word")


@query(
    "rsh06_bad_cells",
    """SELECT conv_id, turn, 'text' AS column_name, text AS value FROM conversations WHERE NOT regexp_full_match(text, '[\\x00-\\x7F]*', 's')
       UNION ALL SELECT conv_id, turn, 'role', role FROM conversations WHERE NOT regexp_full_match(role, '[\\x00-\\x7F]*', 's')""",
)
def rsh06(spark, d):
    return R.bad_cells(P.table(spark, d, "conversations"), ["conv_id", "turn"])


# ---------------------------------------------------------------- scalar families


@query(
    "fn_string_family",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS up, lower(p_brand) AS low, substring(p_name, 2, 3) AS middle, split_part(p_name, ' ', 1) AS head,
       concat_ws('-', p_brand, p_type) AS joined, regexp_replace(p_brand, '#', '_', 'g') AS replaced, p_name LIKE 's%' AS starts, strpos(p_name, ' ') AS blank_at, length(p_name) AS size, contains(p_name, 'ring') AS has_ring FROM part""",
)
def fn_string(spark, d):
    name, brand = F.col("p_name"), F.col("p_brand")
    return P.table(spark, d, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("up"),
        F.lower(brand).alias("low"),
        F.substring(name, 2, 3).alias("middle"),
        F.substring_index(name, " ", 1).alias("head"),
        F.concat_ws("-", brand, "p_type").alias("joined"),
        F.regexp_replace(brand, "#", "_").alias("replaced"),
        name.like("s%").alias("starts"),
        F.instr(name, " ").alias("blank_at"),
        F.length(name).alias("size"),
        name.contains("ring").alias("has_ring"),
    )


@query(
    "fn_numeric_family",
    """SELECT l_orderkey, l_linenumber, abs(CAST(l_quantity AS BIGINT) - 25) AS gap, round(l_extendedprice / nullif(l_discount, 0), 4) AS guarded, TRY_CAST(l_returnflag AS INTEGER) AS parsed,
       greatest(l_tax, l_discount) AS larger, CAST(power(10, l_linenumber) AS BIGINT) AS scale, coalesce(nullif(l_returnflag, 'N'), 'none') AS flag FROM lineitem""",
)
def fn_numeric(spark, d):
    return P.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(F.col("l_quantity").cast("bigint") - 25).alias("gap"),
        F.round(F.try_divide("l_extendedprice", "l_discount"), 4).alias("guarded"),
        F.col("l_returnflag").try_cast("int").alias("parsed"),
        F.greatest("l_tax", "l_discount").alias("larger"),
        F.pow(F.lit(10), "l_linenumber").cast("bigint").alias("scale"),
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("none")).alias("flag"),
    )


@query(
    "fn_date_family",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) - 14 AS fortnight_before, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE) AS two_months_before,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, strftime(o_orderdate, '%Y-%m') AS month_text, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders""",
)
def fn_date(spark, d):
    day = F.col("o_orderdate").cast("date")
    return P.table(spark, d, "orders").select(
        day.alias("day"),
        F.date_sub(day, 14).alias("fortnight_before"),
        F.add_months(day, -2).alias("two_months_before"),
        F.trunc(day, "MM").alias("month_start"),
        F.date_format(day, "yyyy-MM").alias("month_text"),
        F.last_day(day).alias("month_end"),
    ).distinct()


@query(
    "fn_array_family",
    """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[3] AS third_word,
       array_to_string(list_sort(string_split(p_name, ' ')), ',') AS sorted_words, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x)), '/') AS loud FROM part""",
)
def fn_array(spark, d):
    words = F.split("p_name", " ")
    return P.table(spark, d, "part").select(
        "p_partkey",
        F.size(words).alias("words"),
        F.get(words, F.lit(0)).alias("first_word"),
        F.get(words, F.lit(2)).alias("third_word"),
        F.array_join(F.array_sort(words), ",").alias("sorted_words"),
        F.array_join(F.transform(words, F.upper), "/").alias("loud"),
    )
