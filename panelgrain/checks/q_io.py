"""Sources and sinks (SRC-*, SNK-*). Files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.checks import panel as P
from panelgrain.checks.q_conform import column_map, vendor_parts
from panelgrain.checks.registry import query
from panelgrain.operators import conform as C
from panelgrain.plans import publish as PUB
from panelgrain.session import scratch_path
from panelgrain.sources import readers as R
from panelgrain.sources import sinks as S

PART_TEXT = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part"
PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


def written(spark, df, label, kind="parquet", **options):
    path = scratch_path(spark, label)
    df.write.format(kind).options(**options).save(path)
    return path


# ---------------------------------------------------------------- sources


@query("src01_raw_pipe", PART_TEXT)
def src01(spark, d):
    return R.read_raw(spark, written(spark, P.table(spark, d, "part").select(*PART), "pipe", "csv", header=True, sep="|"), "SFF")


@query("src01_raw_comma", PART_TEXT)
def src01_comma(spark, d):
    return R.read_raw(spark, written(spark, P.table(spark, d, "part").select(*PART), "comma", "csv", header=True), "SFF3")


@query("src01_raw_text", "SELECT 'L' || rpad(CAST(c_custkey AS VARCHAR), 9, ' ') || c_name AS value FROM customer")
def src01_text(spark, d):
    lines = P.table(spark, d, "customer").select(F.concat(F.lit("L"), F.rpad(F.col("c_custkey").cast("string"), 9, " "), "c_name").alias("value"))
    return R.read_raw(spark, written(spark, lines, "lines", "text"), "FFS")


@query(
    "src02_wide_facts",
    """SELECT CAST(l_suppkey AS VARCHAR) AS col1, CAST(l_partkey AS VARCHAR) AS col2, CAST(l_linenumber AS VARCHAR) AS col4, CAST(NULL AS VARCHAR) AS col103, CASE WHEN l_linenumber = 2 THEN 105 END AS surplus FROM lineitem
       UNION ALL SELECT 'MKT_TAG', 'PROD_TAG', 'm1', NULL, NULL""",
)
def src02(spark, d):
    item = P.table(spark, d, "lineitem")
    text = {1: "l_suppkey", 2: "l_partkey", 3: "l_orderkey", 4: "l_linenumber"}
    rows = item.select(*[(F.col(text[i]) if i in text else F.lit(None)).cast("string").alias(f"col{i}") for i in range(1, 104)])
    words = list(R.SFF3_WORDS.values())
    header = spark.createDataFrame([tuple([*words, "m1"] + [None] * 99)], rows.schema)
    # Some lines have two columns too many.
    cells = [F.coalesce(F.col(f"col{i}"), F.lit("")) for i in range(1, 104)]
    tail = F.when(F.col("col4") == "2", F.lit(",x,y")).otherwise("")
    lines = rows.unionByName(header).select(F.concat(F.concat_ws(",", *cells), tail).alias("value"))
    facts = R.read_wide_facts(spark, written(spark, lines, "wide", "text"), "SFF3")
    return facts.select("col1", "col2", "col4", "col103", F.size(F.split("surplus", ",")).alias("surplus")).withColumn("surplus", F.when(F.col("surplus") > 0, F.col("surplus")))


@query(
    "src03_mapped_load",
    """SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS product_code, p_name AS product_name, p_type AS category, p_brand || ':' || p_type AS grouping, CAST(p_size AS VARCHAR) AS size
       FROM part WHERE p_size > 10""",
)
def src03(spark, d):
    path = written(spark, vendor_parts(spark, d), "vendor", "csv", header=True, sep=";", quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    targets = C.read_map(C.map_rows(column_map(spark, d), "PROD"))
    return C.load_mapped(R.read_delimited(spark, path, ";"), targets, "product", ["size"])


@query(
    "src04_contract_settings",
    """SELECT s_suppkey AS contract_id, s_name || '%' AS file_pattern, CASE WHEN s_nationkey <> 4 THEN 'step' END AS step_pattern, CASE WHEN n_regionkey < 3 THEN '|' END AS delimiter,
       concat_ws(', ', CASE WHEN s_nationkey = 4 THEN 'step_pattern' END, CASE WHEN n_regionkey >= 3 THEN 'delimiter' END) AS missing FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def src04(spark, d):
    nation = P.table(spark, d, "nation")
    contracts = P.table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("contract_id"),
        F.concat("s_name", F.lit("%")).alias("file_pattern"),
        F.when(F.col("s_nationkey") != 4, "step").alias("step_pattern"),
        F.col("n_regionkey").alias("delimiter_id"),
    )
    delimiters = P.table(spark, d, "region").where("r_regionkey < 3").select(F.col("r_regionkey").alias("delimiter_id"), F.lit("|").alias("delimiter"))
    return R.contract_settings(contracts, delimiters)


@query("src05_files_like", "SELECT event_id, event_type || '_' || user_id || '.ZIP' AS name FROM events WHERE event_type = 'click' AND CAST(user_id AS VARCHAR) LIKE '1_'")
def src05(spark, d):
    files = P.table(spark, d, "events").select("event_id", F.concat("event_type", F.lit("_"), "user_id", F.lit(".ZIP")).alias("name"))
    return R.files_like(files, "CLICK_1?.zip")


@query("src06_step_read", "SELECT p_partkey, p_name FROM part")
def src06(spark, d):
    path = S.snapshot(P.table(spark, d, "part").select("p_partkey", "p_name"), scratch_path(spark, "steps"), 7, "parts")
    return R.read_step(spark, path)


@query("src09_parameterised", "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity FROM lineitem WHERE l_linenumber = 3 AND l_shipmode_like GROUP BY 1".replace(" AND l_shipmode_like", " AND l_quantity >= 10"))
def src09(spark, d):
    text = "SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS quantity FROM {lines} WHERE l_linenumber = :line AND l_quantity >= :low GROUP BY 1"
    return R.read_query(spark, text, {"line": 3, "low": 10}, lines=P.table(spark, d, "lineitem"))


FACT_TYPES = {"source_id": "short", "contract_id": "long", "market_key": "long", "product_key": "long", "period_id": "long"}


def stored_facts(spark, d):
    """The fact table as published: partitioned by source, contract and period end."""
    path = scratch_path(spark, "table") + "/fact_mth"
    S.write_partitions(PUB.with_fact_partitions(C.cast_all(P.facts(spark, d), FACT_TYPES)), path, PUB.FACT_PARTITIONS)
    return path


@query("src10_read_fact", "SELECT market_key::BIGINT AS market_key, product_key, period_end, volume FROM facts WHERE contract_id = 2", (P.SALES, P.FACTS))
def src10(spark, d):
    base = stored_facts(spark, d).rsplit("/", 1)[0]
    return R.read_fact(spark, base, "MTH", 4, 2).select("market_key", "product_key", "period_end", "volume")


@query(
    "src11_contract_lookup",
    """SELECT s_suppkey AS contract_id, p_type AS category, n_nationkey AS country, n_name AS country_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN (SELECT DISTINCT l_suppkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey) ON l_suppkey = s_suppkey""",
)
def src11(spark, d):
    contracts = P.table(spark, d, "supplier").select(F.col("s_suppkey").alias("contract_id"), F.col("s_nationkey").alias("country"))
    part = P.table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    categories = P.table(spark, d, "lineitem").join(part, "l_partkey").select(F.col("l_suppkey").alias("contract_id"), "category").distinct()
    countries = P.table(spark, d, "nation").select(F.col("n_nationkey").alias("country"), F.col("n_name").alias("country_name"))
    return R.contract_lookup(contracts, categories, countries)


@query("src11_rows_of", "SELECT p_partkey, p_name FROM part WHERE p_type = 'PROMO' AND p_brand = 'Brand#5'")
def src11_rows(spark, d):
    return R.rows_of(P.table(spark, d, "part"), p_type="PROMO", p_brand="Brand#5").select("p_partkey", "p_name")


def commit_rows(spark, d):
    """Commit-log rows as JSON: each contract-month is added by its runs; half the months are also removed later."""
    rows = P.deliveries(spark, d)
    values = F.struct(F.col("contract_id").cast("string").alias("contract_id"), F.col("period_end").cast("string").alias("period_end"))
    adds = rows.select(F.struct(values.alias("partitionValues"), (F.col("run_id") * 1000).cast("long").alias("modificationTime")).alias("add"))
    removed = rows.where(F.month("period_end") <= 6).groupBy("contract_id", "period_end").agg(F.max("run_id").alias("run_id"))
    removes = removed.select(F.struct(values.alias("partitionValues"), (F.col("run_id") * 1000 + 5).cast("long").alias("deletionTimestamp")).alias("remove"))
    return adds.unionByName(removes, allowMissingColumns=True)


@query(
    "src12_commit_log",
    """SELECT CAST(contract_id AS VARCHAR) AS contract_id, CAST(period_end AS VARCHAR) AS period_end, CAST(run_id * 1000 AS BIGINT) AS added FROM deliveries""",
    (P.SALES, P.DELIVERIES),
)
def src12(spark, d):
    path = written(spark, commit_rows(spark, d), "commits", "json")
    log = R.read_commit_log(spark, path, PUB.COMMIT_SCHEMA).where("add IS NOT NULL")
    return log.select(F.col("add.partitionValues")["contract_id"].alias("contract_id"), F.col("add.partitionValues")["period_end"].alias("period_end"), F.col("add.modificationTime").alias("added"))


@query("src13_side_file", "SELECT CAST(n_regionkey AS VARCHAR) AS hierarchy_number, CAST(n_nationkey AS VARCHAR) AS hierarchy_level, n_name AS column_name FROM nation")
def src13(spark, d):
    rows = P.table(spark, d, "nation").select(F.col("n_regionkey").alias("hierarchy_number"), F.col("n_nationkey").alias("hierarchy_level"), F.col("n_name").alias("column_name"))
    return R.read_delimited(spark, written(spark, rows, "hierarchies", "csv", header=True), ",")


@query("src14_map_snapshot", "SELECT file_column, target_column, count(*) AS n FROM (SELECT unnest(['item code', 'item name', 'brand', 'kind', 'kind', 'size']) AS file_column, unnest(['product_code', 'product_name', 'grouping#1', 'grouping#2', 'category', 'size']) AS target_column FROM part WHERE p_brand = 'Brand#7') GROUP BY 1, 2")
def src14(spark, d):
    mine = column_map(spark, d).where("p_brand = 'Brand#7'")
    path = S.snapshot(mine, scratch_path(spark, "maps"), 7, "column_map")
    return R.read_step(spark, path).groupBy("file_column", "target_column").agg(F.count("*").alias("n"))


@query("src15_any_format", "SELECT p_partkey, p_name, p_size FROM part")
def src15(spark, d):
    rows = P.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    return R.read_any(spark, "orc", written(spark, rows, "orc", "orc"), rows.schema, {"mergeSchema": "false"})


# ---------------------------------------------------------------- sinks


@query("snk01_snapshot", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def snk01(spark, d):
    base = scratch_path(spark, "snapshots")
    rows = P.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    S.snapshot(rows.limit(0), base, 7, "lines")
    return spark.read.parquet(S.snapshot(rows, base, 7, "lines"))


@query(
    "snk02_dynamic_overwrite",
    "SELECT contract_id, market_key, product_key, period_id, CASE WHEN contract_id = 1 THEN volume * 2 ELSE volume END AS volume FROM facts",
    (P.SALES, P.FACTS),
)
def snk02(spark, d):
    path = scratch_path(spark, "dynamic")
    rows = P.facts(spark, d).select("market_key", "product_key", "period_id", "volume", "contract_id")
    S.write_partitions(rows, path, ["contract_id"])
    S.write_partitions(rows.where("contract_id = 1").withColumn("volume", F.col("volume") * 2), path, ["contract_id"])
    return spark.read.parquet(path)


UPSERTED = """SELECT product_key, CASE WHEN size < 10 THEN name || ' new' ELSE name END AS name, category FROM products WHERE category <> 'PROMO' OR size < 10"""


@query("snk03_upsert", UPSERTED, (P.PRODUCTS,))
def snk03(spark, d):
    path = scratch_path(spark, "upsert")
    base = P.products(spark, d)
    S.write_partitions(base.where("category <> 'PROMO'").select("product_key", "name", "category"), path, ["category"])
    changed = base.where("size < 10").select("category", "product_key", F.concat("name", F.lit(" new")).alias("name"))
    S.upsert(spark, changed, path, ["product_key", "category"], ["category"])
    return spark.read.parquet(path).select("product_key", "name", "category")


@query(
    "snk03_files_rewritten",
    """WITH stored AS (SELECT product_key, category, product_key % 4 AS quarter, size FROM products WHERE product_key % 8 <> 3)
       SELECT category, count(DISTINCT quarter) AS files_before, CAST(coalesce(max(hit), 0) AS BIGINT) AS files_rewritten, CAST(coalesce(max(rows), 0) AS BIGINT) AS rows_rewritten,
         CAST(coalesce(max(matched), 0) AS BIGINT) AS rows_matched, count(*) + any_value(added) AS rows_after
       FROM stored LEFT JOIN (SELECT category AS c, count(*) AS hit, sum(n) AS rows, sum(m) AS matched
           FROM (SELECT category, quarter, count(*) AS n, count(*) FILTER (quarter = 3 AND size < 10) AS m FROM stored GROUP BY ALL) WHERE m > 0 GROUP BY 1) ON category = c
         JOIN (SELECT category AS d, count(*) FILTER (product_key % 8 = 3 AND size < 10) AS added FROM products GROUP BY 1) ON category = d
       GROUP BY category""",
    (P.PRODUCTS,),
)
def snk03_files(spark, d):
    """Four files a category, by the key's remainder; changes and new rows all have remainder 3, so three files of four stay."""
    path = scratch_path(spark, "upsert-files")
    base = P.products(spark, d).select("product_key", "name", "size", "category")
    stored = base.where("product_key % 8 <> 3").repartitionById(4, F.pmod("product_key", F.lit(4)).cast("int"))
    stored.write.partitionBy("category").parquet(path)
    files = spark.read.parquet(path).select("category", "_metadata.file_path").groupBy("category").agg(F.countDistinct("file_path").alias("files_before"))
    before = written_frame(spark, files)
    changed = base.where("product_key % 4 = 3 AND size < 10").withColumn("name", F.concat("name", F.lit(" new")))
    report = S.upsert(spark, changed, path, ["product_key", "category"], ["category"])
    per = report.groupBy("category").agg(F.count("*").alias("files_rewritten"), F.sum("rows").alias("rows_rewritten"), F.sum("matched").alias("rows_matched"))
    after = spark.read.parquet(path).groupBy("category").agg(F.count("*").alias("rows_after"))
    return before.join(per, "category", "left").na.fill(0, ["files_rewritten", "rows_rewritten", "rows_matched"]).join(after, "category")


def written_frame(spark, df):
    path = scratch_path(spark, "written")
    df.write.parquet(path)
    return spark.read.parquet(path)


def sync_frames(spark, d):
    base = P.products(spark, d).select("product_key", "name", "brand", "size")
    old = base.where("size > 5").select("product_key", F.when(F.col("size") == 20, "was").otherwise(F.col("name")).alias("name"), "brand")
    return old, base.where("size < 40").drop("size")


@query(
    "snk04_sync_changes",
    """SELECT product_key, CASE WHEN size <= 5 THEN 'I' WHEN size >= 40 THEN 'D' ELSE 'U' END AS change FROM products WHERE size <= 5 OR size >= 40 OR size = 20""",
    (P.PRODUCTS,),
)
def snk04(spark, d):
    old, new = sync_frames(spark, d)
    return S.sync(spark, new, written(spark, old, "sync"), ["product_key"])


@query("snk04_sync_table", "SELECT product_key, name, brand FROM products WHERE size < 40", (P.PRODUCTS,))
def snk04_table(spark, d):
    old, new = sync_frames(spark, d)
    path = written(spark, old, "sync-table")
    S.sync(spark, new, path, ["product_key"])
    return spark.read.parquet(path)


@query(
    "snk04_sync_by_digests",
    """SELECT brand, count(*) AS products, sum(CASE WHEN size = 20 AND brand LIKE '%1' THEN 1 ELSE 0 END) AS renamed, sum(CASE WHEN size = 20 AND brand LIKE '%1' THEN 1 ELSE 0 END) > 0 AS rewritten
       FROM products WHERE brand <> 'Brand#7' GROUP BY brand""",
    (P.PRODUCTS,),
)
def snk04_digests(spark, d):
    """A table by brand after a sync that renames some products of a few brands and drops one brand: which folders have new files."""
    path = scratch_path(spark, "digests")
    base = P.products(spark, d).select("product_key", "name", "size", "brand")
    S.write_partitions(base, path, ["brand"])
    before = written_frame(spark, spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct())
    renamed = F.when((F.col("size") == 20) & F.col("brand").endswith("1"), F.concat("name", F.lit(" new"))).otherwise(F.col("name"))
    S.sync(spark, base.where("brand <> 'Brand#7'").withColumn("name", renamed), path, ["product_key"])
    now = spark.read.parquet(path).select("brand", F.col("name").endswith(" new").cast("long").alias("new"), F.col("_metadata.file_path").alias("file"))
    fresh = now.join(before.withColumn("old", F.lit(True)), "file", "left")
    return fresh.groupBy("brand").agg(F.count("*").alias("products"), F.sum("new").alias("renamed"), F.max(F.col("old").isNull()).alias("rewritten"))


@query(
    "snk05_product_merge",
    """SELECT product_key, CASE WHEN size < 30 THEN 'delivered' ELSE 'stored' END AS origin, CAST(CASE WHEN category IN ('SMALL', 'LARGE') THEN 3 ELSE 4 END AS INTEGER) AS part_source_id FROM products WHERE size < 30 OR size > 10""",
    (P.PRODUCTS,),
)
def snk05(spark, d):
    path = scratch_path(spark, "products")
    rows = P.products(spark, d).select("product_key", "size", F.when(F.col("category").isin("SMALL", "LARGE"), 3).otherwise(4).alias("part_source_id"))
    S.write_partitions(rows.where("size > 10").select("product_key", F.lit("stored").alias("origin"), "part_source_id"), path, ["part_source_id"])
    S.upsert(spark, rows.where("size < 30").select("product_key", F.lit("delivered").alias("origin"), "part_source_id"), path, ["product_key", "part_source_id"], ["part_source_id"])
    return spark.read.parquet(path)


@query(
    "snk06_market_upsert",
    """SELECT n_nationkey AS market_key, CASE WHEN n_regionkey IN (1, 2) THEN 'renamed ' || n_name ELSE n_name END AS name, n_regionkey AS part_source_id FROM nation""",
)
def snk06(spark, d):
    path = scratch_path(spark, "markets")
    rows = P.table(spark, d, "nation").select(F.col("n_nationkey").alias("market_key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("part_source_id"))
    S.write_partitions(rows.where("part_source_id <> 1"), path, ["part_source_id"])
    changed = rows.where("part_source_id IN (1, 2)").withColumn("name", F.concat(F.lit("renamed "), "name"))
    S.upsert(spark, changed, path, ["market_key", "part_source_id"], ["part_source_id"])
    return spark.read.parquet(path)


@query(
    "snk07_association_upsert",
    """SELECT DISTINCT category || ' ' || brand AS child_path, CASE WHEN category = 'SMALL' THEN 'moved' ELSE category END AS parent_path FROM products""",
    (P.PRODUCTS,),
)
def snk07(spark, d):
    rows = P.products(spark, d).select(F.concat_ws(" ", "category", "brand").alias("child_path"), F.col("category").alias("parent_path")).distinct()
    moved = rows.where("parent_path = 'SMALL'").withColumn("parent_path", F.lit("moved"))
    return S.upserted(rows, moved, ["child_path"])


@query(
    "snk08_replace_run",
    """SELECT contract_id, market_key, product_key, period_id, CASE WHEN contract_id = 3 AND market_key > 10 THEN volume + 1 ELSE volume END AS volume FROM facts WHERE contract_id <> 3 OR market_key > 10""",
    (P.SALES, P.FACTS),
)
def snk08(spark, d):
    path = scratch_path(spark, "replace")
    rows = P.facts(spark, d).select("market_key", "product_key", "period_id", "volume", "contract_id")
    S.write_partitions(rows, path, ["contract_id"])
    again = rows.where("contract_id = 3 AND market_key > 10").withColumn("volume", F.col("volume") + 1)
    S.replace_run(spark, again, path, ["contract_id"], ["contract_id"])
    return spark.read.parquet(path)


@query("snk10_refresh", "SELECT 'overwrite' AS mode, r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT 'merge', n_nationkey, n_name FROM nation UNION ALL SELECT 'partition', p_size, p_brand FROM part")
def snk10(spark, d):
    base = scratch_path(spark, "refresh")
    frames = {t: P.table(spark, d, t) for t in ("region", "nation", "part")}
    frames["nation"].limit(0).write.parquet(f"{base}/nation")
    jobs = [
        {"source": "region", "target": f"{base}/region", "mode": "overwrite"},
        {"source": "nation", "target": f"{base}/nation", "mode": "merge", "keys": ["n_nationkey"]},
        {"source": "part", "target": f"{base}/part", "mode": "overwrite", "partition_by": ["p_type"]},
        {"source": "absent", "target": f"{base}/absent", "mode": "overwrite", "active": False},
    ]
    done = S.refresh(spark, jobs, frames.__getitem__)
    names = (("overwrite", "r_regionkey", "r_name"), ("merge", "n_nationkey", "n_name"), ("partition", "p_size", "p_brand"))
    return C.union_all([spark.read.parquet(p).select(F.lit(m).alias("mode"), F.col(k).alias("k"), F.col(n).alias("name")) for p, (m, k, n) in zip(done, names)])


STORE = T.StructType([T.StructField("code", T.StringType()), T.StructField("size", T.LongType()), T.StructField("note", T.StringType())])


@query("snk11_for_lookup_store", "SELECT code, CAST(size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS note FROM products", (P.PRODUCTS,))
def snk11(spark, d):
    rows = P.products(spark, d).withColumns({"part_source_id": F.lit(3), "security_key": F.lit("x")})
    return S.for_lookup_store(rows, STORE)


@query("snk12_any_format", "SELECT p_partkey, p_name, p_type FROM part")
def snk12(spark, d):
    path = scratch_path(spark, "any")
    S.write_any(P.table(spark, d, "part").select("p_partkey", "p_name", "p_type"), "json", path, partition_by=["p_type"])
    return spark.read.schema("p_partkey bigint, p_name string, p_type string").json(path)
