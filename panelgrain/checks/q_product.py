"""Surrogate keys and product dimension operators (KEY-*, DIM-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain.checks import panel as P
from panelgrain.checks.registry import query
from panelgrain.operators import keys as K
from panelgrain.operators import product as D
from panelgrain.operators.extract import split_attributes

# ---------------------------------------------------------------- keys


def known_names(spark, d):
    """Key map of an earlier run: customers of one segment."""
    return P.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_name").alias("natural_key"), (F.col("c_custkey") + 1_000_001).alias("surrogate_key"), F.lit(1).cast("long").alias("run_id")
    )


KNOWN = "known AS (SELECT c_name AS natural_key, c_custkey + 1000001 AS surrogate_key FROM customer WHERE c_mktsegment = 'BUILDING')"


@query(
    "key01_assign_keys",
    """SELECT o_orderkey, c_name AS natural_key, coalesce(k.surrogate_key, n.surrogate_key) AS surrogate_key FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN known k ON c_name = k.natural_key
       LEFT JOIN (SELECT c_name AS natural_key, (SELECT max(surrogate_key) FROM known) + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS surrogate_key
                  FROM (SELECT DISTINCT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_name NOT IN (SELECT natural_key FROM known))) n ON c_name = n.natural_key""",
    (KNOWN,),
)
def key01(spark, d):
    names = P.table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("natural_key"))
    rows = P.table(spark, d, "orders").join(names, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "natural_key")
    return K.assign_keys(rows, ["natural_key"], known_names(spark, d), 2)[0].select("o_orderkey", "natural_key", "surrogate_key")


@query(
    "key01_key_map",
    """SELECT category, brand, 1000000 + row_number() OVER (ORDER BY substr(md5(category || '|' || brand), 1, 3), category, brand) AS surrogate_key, CAST(3 AS BIGINT) AS run_id
       FROM (SELECT DISTINCT category, brand FROM products)""",
    (P.PRODUCTS,),
)
def key01_map(spark, d):
    products = P.products(spark, d)
    empty = spark.createDataFrame([], "category string, brand string, surrogate_key long, run_id long")
    return K.new_keys(products, ["category", "brand"], empty, 3)


@query(
    "key01_separator_in_keys",
    """SELECT a, b, 1000000 + row_number() OVER (ORDER BY substr(md5(a || '|' || b), 1, 3), a, b) AS surrogate_key, CAST(3 AS BIGINT) AS run_id
       FROM (SELECT DISTINCT p_type || '|' || p_brand AS a, p_name AS b FROM part UNION SELECT DISTINCT p_type, p_brand || '|' || p_name FROM part)""",
)
def key01_separator(spark, d):
    """Two keys that read alike when joined by the separator get two numbers, the same ones in every run."""
    part = P.table(spark, d, "part")
    bar = F.lit("|")
    first = part.select(F.concat("p_type", bar, "p_brand").alias("a"), F.col("p_name").alias("b"))
    second = part.select(F.col("p_type").alias("a"), F.concat("p_brand", bar, "p_name").alias("b"))
    empty = spark.createDataFrame([], "a string, b string, surrogate_key long, run_id long")
    rows, added = K.assign_keys(first.unionByName(second).repartition(5), ["a", "b"], empty, 3)
    return rows.join(added.select("a", "b", "run_id"), ["a", "b"]).select("a", "b", "surrogate_key", "run_id").distinct()


@query(
    "key02_keys_for_new",
    """WITH p AS (SELECT *, CASE WHEN size < 20 THEN 'NEW PRODUCT' ELSE 'FULL MATCH' END AS change FROM products)
       SELECT code, change, CASE WHEN change = 'FULL MATCH' THEN product_key ELSE 1000000 + n END AS surrogate_key FROM p
       LEFT JOIN (SELECT code AS c, row_number() OVER (ORDER BY substr(md5(code), 1, 3), code) AS n FROM p WHERE change = 'NEW PRODUCT') ON c = code""",
    (P.PRODUCTS,),
)
def key02(spark, d):
    fresh = F.col("size") < 20
    rows = P.products(spark, d).select("code", F.when(fresh, D.NEW).otherwise(D.FULL_MATCH).alias("change"), F.when(~fresh, F.col("product_key")).alias("surrogate_key"))
    empty = spark.createDataFrame([], "code string, surrogate_key long, run_id long")
    return K.assign_keys_to_new(rows, ["code"], empty, 4, D.NEW)[0].select("code", "change", "surrogate_key")


# ---------------------------------------------------------------- attributes


def metadata(spark, d):
    """Structure 1 of every category: type, brand, item."""
    types = P.table(spark, d, "part").select(F.col("p_type").alias("category")).distinct()
    steps = [(1, "a1", "CATEGORY", "type_text", 11), (2, "a2", "BRAND", "brand_text", 12), (3, "a3", "ITEM", "item", 13)]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("level"), F.lit(i).alias("attribute_id"), F.lit(a).alias("attribute_name"), F.lit(c).alias("column_name"), F.lit(k).alias("level_id"))
            for n, i, a, c, k in steps
        ]
    )
    return types.select("category", F.lit("1").alias("structure"), F.explode(rows).alias("r")).select("category", "structure", "r.*")


def coded_products(spark, d):
    """Products cut to level 1, 2 or 3 by size, with positional codes."""
    depth = F.when(F.col("size") < 5, 2).when(F.col("size") < 15, 3).otherwise(4)
    rows = P.products(spark, d).withColumn("attributes", F.array_join(F.slice(F.split("attributes", " "), F.lit(1), depth), " "))
    return split_attributes(rows.select("code", "name", "category", "attributes"))


CODED = """coded AS (SELECT code, name, category, brand, CASE WHEN size < 5 THEN 1 WHEN size < 15 THEN 2 ELSE 3 END AS level FROM products)"""


@query(
    "dim01_attribute_codes",
    """SELECT code, CASE level WHEN 1 THEN 'CATEGORY' WHEN 2 THEN 'BRAND' ELSE 'ITEM' END AS own_level_name, level + 10 AS own_level_id, category AS type_text,
       CASE WHEN level > 1 THEN brand END AS brand_text, CASE WHEN level > 2 THEN code END AS item FROM coded""",
    (P.PRODUCTS, CODED),
)
def dim01(spark, d):
    out = D.attribute_codes(coded_products(spark, d), metadata(spark, d))
    return out.select("code", "own_level_name", "own_level_id", "type_text", "brand_text", "item")


def values(spark, d):
    """Value names: categories by exact code, brands by pattern, with a wildcard for the teens."""
    part = P.table(spark, d, "part")
    types = part.select(F.col("p_type").alias("category"), F.lit("a1").alias("attribute_id"), F.col("p_type").alias("code_pattern"), F.initcap("p_type").alias("value_name"))
    exact = part.where("length(p_brand) = 7").select(F.col("p_type").alias("category"), F.lit("a2").alias("attribute_id"), F.col("p_brand").alias("code_pattern"), F.concat(F.lit("Brand no. "), F.substring("p_brand", 7, 2)).alias("value_name"))
    teens = part.select(F.col("p_type").alias("category"), F.lit("a2").alias("attribute_id"), F.lit("Brand#1%").alias("code_pattern"), F.lit("Teens").alias("value_name"))
    return types.unionByName(exact).unionByName(teens).distinct()


BRAND_VALUE = """CASE WHEN level = 1 THEN NULL WHEN length(brand) = 7 AND EXISTS (SELECT 1 FROM part WHERE p_type = category AND p_brand = brand) THEN 'Brand no. ' || substring(brand, 7, 2)
  WHEN brand LIKE 'Brand#1%' THEN brand END"""


@query(
    "dim02_attribute_values",
    f"""SELECT code, upper(left(category, 1)) || lower(substring(category, 2)) AS type_text, {BRAND_VALUE} AS brand_text, CAST(NULL AS VARCHAR) AS item FROM coded""",
    (P.PRODUCTS, CODED),
)
def dim02(spark, d):
    leveled = D.attach_levels(coded_products(spark, d), metadata(spark, d))
    return D.attribute_values(leveled, values(spark, d), ["type_text", "brand_text", "item"]).select("code", "type_text", "brand_text", "item")


def stored_products(spark, d):
    """What the dimension held before: some products missing, renamed or re-pathed."""
    rows = P.products(spark, d).where("size <> 3")
    return rows.select(
        F.col("code").alias("product_code"),
        "attributes",
        F.when(F.col("size") == 4, F.concat("name", F.lit(" old"))).otherwise(F.col("name")).alias("name"),
        F.when(F.col("size") == 5, F.concat("path", F.lit(" old"))).otherwise(F.col("path")).alias("match_path"),
        (F.col("product_key") + 1_000_001).alias("product_key"),
    )


def delivered_products(spark, d):
    return P.products(spark, d).select(
        F.col("code").alias("product_code"), "attributes", "name", F.col("path").alias("match_path"), F.when(F.col("size") < 30, "ITEM").otherwise("BRAND").alias("level_name"),
        F.when(F.col("size") == 6, "PRESET").alias("change"),
    )


@query(
    "dim03_change_class",
    """SELECT code AS product_code, CASE size WHEN 6 THEN 'PRESET' WHEN 3 THEN 'NEW PRODUCT' WHEN 4 THEN 'ITEM NAME CHANGE' WHEN 5 THEN 'EXTERNAL CODE MATCH' ELSE 'FULL MATCH' END AS change,
       CASE WHEN size <> 3 THEN product_key + 1000001 END AS product_key FROM products""",
    (P.PRODUCTS,),
)
def dim03(spark, d):
    return D.classify_changes(delivered_products(spark, d), stored_products(spark, d)).select("product_code", "change", "product_key")


@query(
    "dim04_normalised",
    """SELECT code, upper(left(category, 1)) || lower(substring(category, 2)) AS type_text,
       CASE WHEN length(brand) = 7 THEN 'Brand no. ' || substring(brand, 7, 2) WHEN brand LIKE 'Brand#1%' THEN 'Teens' ELSE brand END AS brand_text,
       CASE WHEN level = 1 THEN upper(left(category, 1)) || lower(substring(category, 2)) WHEN level = 2 THEN
         CASE WHEN length(brand) = 7 THEN 'Brand no. ' || substring(brand, 7, 2) WHEN brand LIKE 'Brand#1%' THEN 'Teens' ELSE brand END END AS own_value FROM coded""",
    (P.PRODUCTS, CODED),
)
def dim04(spark, d):
    depth = F.when(F.col("size") < 5, "CATEGORY").when(F.col("size") < 15, "BRAND").otherwise("ITEM")
    rows = P.products(spark, d).select("code", "category", F.col("category").alias("type_text"), F.col("brand").alias("brand_text"), depth.alias("level_name"))
    attributes = {"type_text": ("a1", "CATEGORY"), "brand_text": ("a2", "BRAND")}
    return D.normalise_attributes(rows, attributes, values(spark, d)).select("code", "type_text", "brand_text", "own_value")


@query(
    "dim05_generated_names",
    """SELECT code, CASE level WHEN 3 THEN name WHEN 2 THEN brand ELSE category END AS product_name,
       CASE level WHEN 3 THEN 'own text' WHEN 2 THEN 'id-' || category || ' ' || brand ELSE category END AS product_description FROM coded""",
    (P.PRODUCTS, CODED),
)
def dim05(spark, d):
    depth = F.when(F.col("size") < 5, 1).when(F.col("size") < 15, 2).otherwise(3)
    names = F.when(depth == 1, "CATEGORY").when(depth == 2, "BRAND").otherwise("ITEM")
    rows = P.products(spark, d).select(
        "code",
        F.concat(F.lit("id-"), "category").alias("category"),
        F.lit("1").alias("structure"),
        depth.alias("level"),
        names.alias("level_name"),
        F.col("category").alias("type_text"),
        F.col("brand").alias("brand_text"),
        F.col("name").alias("product_name"),
        F.lit("own text").alias("product_description"),
    )
    shape = metadata(spark, d).withColumn("category", F.concat(F.lit("id-"), "category"))
    return D.generate_names(rows, shape, ["type_text", "brand_text"]).select("code", "product_name", "product_description")


@query(
    "dim06_disambiguated",
    """WITH p AS (SELECT code, name, category || ' ' || brand AS attributes, category || ' ' || name AS match_path, size FROM products),
       c AS (SELECT *, count(*) OVER (PARTITION BY name, attributes) > 1 OR size = 9 AS clash FROM p)
       SELECT code AS product_code, name || CASE WHEN clash THEN ' (' || code || ')' ELSE '' END AS name, match_path || CASE WHEN clash THEN ' (' || code || ')' ELSE '' END AS match_path FROM c""",
    (P.PRODUCTS,),
)
def dim06(spark, d):
    base = P.products(spark, d)
    rows = base.select(F.col("code").alias("product_code"), "name", F.concat_ws(" ", "category", "brand").alias("attributes"), F.concat_ws(" ", "category", "name").alias("match_path"))
    stored = base.where("size = 9").select(
        F.col("code").alias("product_code"), F.concat_ws(" ", "category", "brand").alias("attributes"), F.concat(F.col("name"), F.lit(" ("), F.col("code"), F.lit(")")).alias("name")
    )
    return D.disambiguate_names(rows, stored).select("product_code", "name", "match_path")


@query(
    "dim07_resolve_stored",
    """SELECT code AS product_code, CASE WHEN size <> 3 THEN product_key + 1000001 END AS product_key, CASE WHEN size = 4 THEN name || ' old' ELSE name END AS name FROM products""",
    (P.PRODUCTS,),
)
def dim07(spark, d):
    rows = P.products(spark, d).select(F.col("code").alias("product_code"), "name", F.lit(None).cast("long").alias("product_key"))
    return D.resolve_stored(rows, stored_products(spark, d)).select("product_code", "product_key", "name")


def dimension_tree(spark, d):
    """Types, brands and items as one dimension of paths with structure number 1."""
    base = P.products(spark, d).select(F.lit(3).alias("source_id"), "attributes", "product_key", "size")
    items = base.select("source_id", F.col("attributes").alias("path"), F.lit(13).alias("level_id"), "product_key", F.col("size").alias("run_id"))
    upper = [
        base.groupBy("source_id", F.substring_index("attributes", " ", n).alias("path")).agg(F.lit(10 + n - 1).alias("level_id"), F.max("product_key").alias("product_key"), F.max("size").alias("run_id"))
        for n in (2, 3)
    ]
    return items.unionByName(upper[0]).unionByName(upper[1]).withColumn("security_key", F.lit("public"))


@query(
    "dim08_parent_associations",
    """SELECT DISTINCT '1 ' || category || ' ' || brand AS child_path, '1 ' || category AS parent_path, 'public' AS security_key FROM products
       UNION SELECT attributes, '1 ' || category || ' ' || brand, 'public' FROM products""",
    (P.PRODUCTS,),
)
def dim08(spark, d):
    levels = spark.createDataFrame([(11, 1), (12, 2), (13, 3)], "level_id int, level int")
    return D.parent_associations(dimension_tree(spark, d), levels)


@query(
    "dim09_category_staging",
    """WITH newest AS (SELECT * FROM (SELECT p_type AS category, nullif(p_brand, 'Brand#3') AS super, p_name AS upc, p_size, p_retailprice > 1000 AS dear, left(p_name, 1) AS initial,
           row_number() OVER (PARTITION BY p_type, nullif(p_brand, 'Brand#3'), p_name ORDER BY p_size DESC, left(p_name, 1)) AS rn FROM part) WHERE rn = 1),
       rows_ AS (SELECT category, super, upc, p_size, initial FROM newest
         UNION ALL SELECT category, super, NULL, NULL, CASE WHEN count(DISTINCT initial) = 1 THEN min(initial) END FROM newest GROUP BY 1, 2)
       SELECT CASE WHEN upc IS NOT NULL AND super IS NOT NULL THEN upc || ';' || category || ';' || super WHEN upc IS NOT NULL THEN upc || ';' || category || ';NOT APPLICABLE'
                   WHEN super IS NOT NULL THEN category || ';' || super ELSE category END AS external_id, p_size AS size, initial, CAST(NULL AS BIGINT) AS product_key, CAST(0 AS BIGINT) AS contract_id FROM rows_""",
)
def dim09(spark, d):
    rows = P.table(spark, d, "part").select(
        F.col("p_type").alias("category"), F.nullif("p_brand", F.lit("Brand#3")).alias("super"), F.col("p_name").alias("upc"), F.col("p_size").alias("size"), F.substring("p_name", 1, 1).alias("initial")
    )
    stored = spark.createDataFrame([], "external_id string, source_id short, product_key long")
    out = D.stage_category_products(rows, stored, "category", "super", "upc", "size", ["initial"], 4)
    return out.select("external_id", "size", "initial", "product_key", "contract_id")


@query(
    "dim11_level_decode",
    """WITH p AS (SELECT p_partkey AS product_key, p_size AS run_id, p_type, p_brand, p_name,
           CASE p_type WHEN 'SMALL' THEN 'A!B!C' WHEN 'LARGE' THEN '03 level' WHEN 'PROMO' THEN 'Brand' WHEN 'MEDIUM' THEN 'Drill down' WHEN 'STANDARD' THEN NULL ELSE 'Pack' END AS lvl FROM part)
       SELECT product_key, run_id, CAST(src AS SMALLINT) AS source_id, CAST(c AS BIGINT) AS contract_id,
         CASE WHEN lvl IS NULL THEN CASE WHEN p_brand = 'Brand#1' THEN 'maker' ELSE 'NoLevelName' END WHEN p_type = 'ECONOMY' THEN 'Hier no. 2, level no. 7 - Pack' ELSE lvl END AS level_name,
         CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN p_type ELSE p_name END AS product_text,
         CASE WHEN c = 1 THEN CASE WHEN p_type = 'PROMO' THEN 17 ELSE 99 END ELSE CASE p_type WHEN 'SMALL' THEN 3 WHEN 'LARGE' THEN 3 WHEN 'ECONOMY' THEN 27 ELSE 1 END END AS level_number,
         CASE WHEN run_id = (SELECT max(p_size) FROM part) THEN 'Y' ELSE 'N' END AS last_run
       FROM p JOIN (VALUES (4, 1), (4, 2), (5, 3)) AS k(src, c) ON src = CASE WHEN run_id < 26 THEN 4 ELSE 5 END WHERE lvl IS NULL OR lvl <> 'Drill down'""",
)
def dim11(spark, d):
    kind = F.col("p_type")
    name = F.when(kind == "SMALL", "A!B!C").when(kind == "LARGE", "03 level").when(kind == "PROMO", "Brand").when(kind == "MEDIUM", "Drill down").when(kind == "ECONOMY", "Pack")
    part = P.table(spark, d, "part")
    rows = part.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_size").alias("run_id"),
        F.when(F.col("p_size") < 26, 4).otherwise(5).cast("short").alias("source_id"),
        name.alias("level_name"),
        F.when(kind == "ECONOMY", 2).alias("level_id"),
        F.when(kind == "ECONOMY", "7").alias("model_number"),
        F.when(F.col("p_brand") == "Brand#1", "yes").alias("private_label"),
        F.lit("maker").alias("maker"),
        kind.alias("category_text"),
        F.lit(None).cast("string").alias("category"),
        F.col("p_name").alias("long_text"),
        F.lit(None).cast("string").alias("short_text"),
    )
    contracts = spark.createDataFrame([(4, 1, True), (4, 2, False), (5, 3, False)], "source_id short, contract_id long, ranked boolean")
    numbers = F.array(*[F.lit(c).cast("long") for c in (1, 2, 3)])
    last = part.agg(F.max("p_size").alias("run_id")).select("run_id", F.explode(numbers).alias("contract_id"))
    ranks = spark.createDataFrame([("BRAND", 17), ("SIZE", 63)], "level_name string, rank int")
    return D.decode_levels(rows, ranks, last, contracts, skip_sources=(3, 100))


DIMENSION = "code string, name string, category string, surrogate_key long, run_id long, contract_id long, part_source_id short"


@query(
    "dim10_dimension_load",
    """WITH s AS (SELECT code, name || ' old' AS name, category, product_key + 1000001 AS surrogate_key FROM products WHERE category IN ('SMALL', 'LARGE', 'PROMO')),
       n AS (SELECT code, (SELECT max(surrogate_key) FROM s) + row_number() OVER (ORDER BY substr(md5(code), 1, 3), code) AS k FROM products WHERE category IN ('ECONOMY', 'MEDIUM'))
       SELECT p.code, CASE WHEN size < 10 THEN coalesce(s.name, NULL) ELSE p.name END AS name, p.category, coalesce(s.surrogate_key, n.k) AS surrogate_key, CAST(7 AS BIGINT) AS run_id
       FROM products p LEFT JOIN s ON s.code = p.code LEFT JOIN n ON n.code = p.code WHERE p.category NOT IN ('PROMO', 'STANDARD')
       UNION ALL SELECT code, name, category, surrogate_key, CAST(1 AS BIGINT) FROM s WHERE category = 'PROMO'""",
    (P.PRODUCTS,),
)
def dim10(spark, d):
    from panelgrain.plans.dimension import load_dimension
    from panelgrain.spec import ContractSpec

    base = P.products(spark, d)
    stored = base.where("category IN ('SMALL', 'LARGE', 'PROMO')").select(
        "code",
        F.concat("name", F.lit(" old")).alias("name"),
        "category",
        (F.col("product_key") + 1_000_001).alias("surrogate_key"),
        F.lit(1).cast("long").alias("run_id"),
        F.lit(101).cast("long").alias("contract_id"),
        F.lit(3).cast("short").alias("part_source_id"),
    )
    delivered = base.where("category NOT IN ('PROMO', 'STANDARD')").select("code", F.when(F.col("size") >= 10, F.col("name")).alias("name"), "category")
    again = delivered.unionByName(delivered).unionByName(delivered.limit(0).withColumn("code", F.lit(None).cast("string")))
    load = load_dimension(again, stored, stored.select("code", "surrogate_key"), ContractSpec(7, 101, 3), "code", "surrogate_key")
    return load.dimension.select("code", "name", "category", "surrogate_key", "run_id")
