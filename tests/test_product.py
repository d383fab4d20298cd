"""Product dimension: change labels, associations, names, staging."""

from pyspark.sql import functions as F

from panelgrain.operators import product as D
from panelgrain.plans.dimension import load_dimension
from panelgrain.spec import ContractSpec
from tests.conftest import rows


def test_change_labels(spark):
    incoming = spark.createDataFrame(
        [("p1", "1 A", "x", "ITEM", "n", "KEPT"), ("p2", "1 A", "x", "ITEM", "n", None), ("p3", "1 A", "x", "ITEM", "new", None), ("p3", "1 B", "x", "BRAND", "new", None), ("p4", "1 A", "x", "ITEM", "n", None), ("p5", None, "x", "ITEM", "n", None)],
        "product_code string, match_path string, attributes string, level_name string, name string, change string",
    )
    stored = spark.createDataFrame(
        [("p3", "1 A", "x", "old", "K3"), ("p4", "1 A", "x", "n", "K4")], "product_code string, match_path string, attributes string, name string, product_key string"
    )
    got = rows(D.classify_changes(incoming, stored), "product_code", "level_name", "change", "product_key")
    assert got == [
        ("p1", "ITEM", "KEPT", None),
        ("p2", "ITEM", "NEW PRODUCT", None),
        ("p3", "BRAND", "EXTERNAL CODE MATCH", "K3"),
        ("p3", "ITEM", "ITEM NAME CHANGE", "K3"),
        ("p4", "ITEM", "FULL MATCH", "K4"),
        ("p5", "ITEM", None, None),
    ]


def test_parent_associations(spark):
    products = spark.createDataFrame(
        [(3, "1 A", 1, 11, 5, "s"), (3, "1 A B", 2, 12, 5, "s"), (3, "1 A B C", 3, 13, 5, "old"), (3, "1 A B C", 4, 13, 6, "s"), (3, "1 X Y", 5, 12, 5, "s")],
        "source_id int, path string, product_key int, level_id int, run_id int, security_key string",
    )
    levels = spark.createDataFrame([(11, 1), (12, 2), (13, 3)], "level_id int, level int")
    assert rows(D.parent_associations(products, levels)) == [("1 A B", "1 A", "s"), ("1 A B C", "1 A B", "s")]
    assert ("1 A", "1 A", "s") in rows(D.parent_associations(products, levels, allow_self=True))
    assert D.parent_associations(products.limit(0), levels).columns == ["child_path", "parent_path", "security_key"]


def test_names_get_the_code_when_they_clash(spark):
    products = spark.createDataFrame(
        [("p1", "Soap", "1 A", "1 A"), ("p2", "Soap", "1 A", "1 A"), ("p3", "Gel", "1 A", "1 A"), ("p4", "Bar", "1 B", "1 B")], "product_code string, name string, attributes string, match_path string"
    )
    stored = spark.createDataFrame([("p4", "1 B", "Bar (p4)"), ("p3", "1 A", "Gel")], "product_code string, attributes string, name string")
    got = rows(D.disambiguate_names(products, stored), "product_code", "name", "match_path")
    assert got == [("p1", "Soap (p1)", "1 A (p1)"), ("p2", "Soap (p2)", "1 A (p2)"), ("p3", "Gel", "1 A"), ("p4", "Bar (p4)", "1 B (p4)")]


def test_external_id(spark):
    df = spark.createDataFrame([("c", "k", "g"), ("c", "k", None), (None, "k", "g"), (None, "k", None)], "u string, k string, g string")
    got = [r[0] for r in df.select(D.external_id(F.col("u"), F.col("k"), F.col("g"))).collect()]
    assert got == ["c;k;g", "c;k;NOT APPLICABLE", "k;g", "k"]


def test_values_keep_raw_codes_for_wildcards(spark):
    metadata = spark.createDataFrame([("S", "1", 1, "a", "CATEGORY", "cat", 11), ("S", "1", 2, "b", "BRAND", "brand", 12)], "category string, structure string, level int, attribute_id string, attribute_name string, column_name string, level_id int")
    codes = [("p1", "1", "S", "B7", 2), ("p2", "1", "S", "ZZ", 2), ("p3", "1", "S", "Q1", 2)]
    products = spark.createDataFrame([(p, a0, a1, a2, *[None] * 8, lvl) for p, a0, a1, a2, lvl in codes], "code string, " + ", ".join(f"attribute_{i} string" for i in range(11)) + ", level int")
    values = spark.createDataFrame([("S", "a", "S", "Soap"), ("S", "b", "B7", "Brand seven"), ("S", "b", "Z%", "Zeds")], "category string, attribute_id string, code_pattern string, value_name string")
    out = D.attribute_values(D.attach_levels(products, metadata), values, ["cat", "brand"])
    assert rows(out, "code", "own_level_name", "cat", "brand") == [("p1", "BRAND", "Soap", "Brand seven"), ("p2", "BRAND", "Soap", "ZZ"), ("p3", "BRAND", "Soap", None)]


def test_decode_levels(spark):
    data = [(1, "A!B", None, None), (2, "07x", None, None), (3, "Brand", 2.0, "5"), (4, None, None, None), (5, "LEVEL", None, None), (6, "drill x", None, None)]
    products = spark.createDataFrame([(k, 9, 4, n, i, m, None, "mk", "cat", "c", "long", "short") for k, n, i, m in data], "product_key int, run_id int, source_id int, level_name string, level_id double, model_number string, private_label string, maker string, category_text string, category string, long_text string, short_text string")
    ranks = spark.createDataFrame([("Brand", 17)], "level_name string, rank int")
    last = spark.createDataFrame([(1, 9)], "contract_id int, run_id int")
    contracts = spark.createDataFrame([(4, 1, False)], "source_id int, contract_id int, ranked boolean")
    got = rows(D.decode_levels(products, ranks, last, contracts), "product_key", "level_name", "level_number", "product_text", "last_run")
    assert got == [(1, "A!B", 2, "long", "Y"), (2, "07x", 7, "long", "Y"), (3, "Hier no. 2, level no. 5 - Brand", 25, "long", "Y"), (4, "NoLevelName", 1, "cat", "Y")]


def test_dimension_load_is_repeatable(spark):
    stored = spark.createDataFrame([("a", "old", 1_000_001, 1, 3)], "code string, name string, product_key long, run_id long, part_source_id short")
    delivered = spark.createDataFrame([("a", None), ("b", "new"), ("b", "new"), (None, "x")], "code string, name string")
    spec = ContractSpec(7, 101, 3)
    load = load_dimension(delivered, stored, stored.select("code", "product_key"), spec, "code", "product_key")
    assert rows(load.dimension, "code", "name", "product_key", "run_id") == [("a", "old", 1_000_001, 7), ("b", "new", 1_000_002, 7)]
    key_map = stored.select("code", "product_key").unionByName(load.new_keys.select("code", "product_key"))
    again = load_dimension(delivered, load.dimension, key_map, spec, "code", "product_key")
    assert rows(again.dimension) == rows(load.dimension) and again.new_keys.count() == 0
