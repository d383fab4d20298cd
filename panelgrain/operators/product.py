"""Product dimension operators (DIM-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrain.functions.text import path_prefix
from panelgrain.operators.dedup import latest_per_key, repeated_keys, unanimous
from panelgrain.operators.lookup import like_lookup
from panelgrain.operators.reshape import pivot_by_metadata
from panelgrain.spec import MAX_LEVELS

# ---- Fixed values: change labels and level names. ----
NEW, NAME_CHANGE, CODE_MATCH, FULL_MATCH = "NEW PRODUCT", "ITEM NAME CHANGE", "EXTERNAL CODE MATCH", "FULL MATCH"
ITEM, CATEGORY, COMPANY = "ITEM", "CATEGORY", "COMPANY"
NO_LEVEL, NO_NAME = "NoLevelName", "NoProductName"
# ---- end of fixed values ----

LEVELS = range(1, MAX_LEVELS + 1)


def attach_levels(products: DataFrame, metadata: DataFrame) -> DataFrame:
    """Level column names and attribute ids 1..9 of a product's (category, structure), its own level
    id and name. The metadata is pivoted by level once, so there is one join instead of ten."""
    picks = [
        F.max(F.when(F.col("level") == i, F.col(source))).alias(f"{target}_{i}")
        for i in LEVELS
        for source, target in (("column_name", "column"), ("attribute_id", "attribute_id"), ("level_id", "level_id"), ("attribute_name", "level_name"))
    ]
    wide = metadata.groupBy(F.col("structure").alias("attribute_0"), F.col("category").alias("attribute_1")).agg(*picks)

    def own(name: str) -> Column:
        return F.coalesce(*[F.when(F.col("level") == i, F.col(f"{name}_{i}")) for i in LEVELS])

    joined = products.join(wide, ["attribute_0", "attribute_1"], "left")
    return joined.withColumns({"own_level_id": own("level_id"), "own_level_name": own("level_name")}).drop(
        *[f"{n}_{i}" for n in ("level_id", "level_name") for i in LEVELS]
    )


def metadata_columns(metadata: DataFrame) -> list[str]:
    """Sorted attribute column names; bounded by the metadata."""
    rows = metadata.select("column_name").where(F.col("column_name").isNotNull()).distinct().collect()
    return sorted(r.column_name for r in rows)


def attribute_codes(products: DataFrame, metadata: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    """One column per attribute holding the code at whichever level carries that attribute."""
    leveled = attach_levels(products, metadata)
    names = [f"column_{i}" for i in LEVELS]
    codes = [f"attribute_{i}" for i in LEVELS]
    return pivot_by_metadata(leveled, names, codes, wanted or metadata_columns(metadata))


def resolve_cells(
    df: DataFrame, cells: dict[str, tuple[Column, Column]], category: Column, values: DataFrame
) -> DataFrame:
    """For each named cell (attribute id, code): the value row whose LIKE pattern the code matches, as
    `<cell>_pattern` and `<cell>_value`.

    All cells go through one lookup in long form over distinct inputs, then come back as columns.
    """
    inputs = [category.alias("category")]
    for cell, (attribute, code) in cells.items():
        inputs += [attribute.cast("string").alias(f"{cell}_a"), code.alias(f"{cell}_c")]
    keyed = df.withColumn("_k", F.md5(F.to_json(F.struct(*inputs))))
    parts = [F.struct(F.lit(c).alias("cell"), a.cast("string").alias("attribute_id"), v.alias("code")) for c, (a, v) in cells.items()]
    long = keyed.select("_k", category.alias("category"), F.explode(F.array(*parts)).alias("r")).select("_k", "category", "r.*")
    long = long.where(F.col("attribute_id").isNotNull() & F.col("code").isNotNull()).distinct()
    rules = values.select("category", F.col("attribute_id").cast("string").alias("attribute_id"), "code_pattern", "value_name")
    found = like_lookup(long, rules, ["category", "attribute_id"], "code", "code_pattern", ["value_name"])
    picks = []
    for cell in cells:
        mine = F.col("cell") == cell
        picks += [
            F.max(F.when(mine, F.col("code_pattern"))).alias(f"{cell}_pattern"),
            F.max(F.when(mine, F.col("value_name"))).alias(f"{cell}_value"),
        ]
    return keyed.join(found.groupBy("_k").agg(*picks), "_k", "left").drop("_k")


def attribute_values(leveled: DataFrame, values: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """One column per wanted attribute holding its value name; the raw code where the pattern has a
    wildcard, null where no pattern matches. The ninth level always keeps its code."""
    cells = {f"cell_{i}": (F.col(f"attribute_id_{i}"), F.col(f"attribute_{i}")) for i in LEVELS[:-1]}
    found = resolve_cells(leveled, cells, F.col("attribute_1"), values)
    texts = {
        f"value_{i}": F.when(F.instr(f"cell_{i}_pattern", "%") > 0, F.col(f"attribute_{i}")).otherwise(F.col(f"cell_{i}_value"))
        for i in LEVELS[:-1]
    }
    last = LEVELS[-1]
    found = found.withColumns({**texts, f"value_{last}": F.col(f"attribute_{last}")})
    found = found.drop(*[f"{c}_{s}" for c in cells for s in ("pattern", "value")])
    return pivot_by_metadata(found, [f"column_{i}" for i in LEVELS], [f"value_{i}" for i in LEVELS], wanted)


def classify_changes(products: DataFrame, stored: DataFrame) -> DataFrame:
    """Change class of each product against the stored one with the same code.

    A preset label is kept; otherwise the first that applies: new, item name change, code match
    (other path), full match. `stored` holds one row per code.
    """
    old = stored.select(
        "product_code",
        F.col("match_path").alias("_path"),
        F.col("attributes").alias("_attributes"),
        F.col("name").alias("_name"),
        "product_key",
    )
    known = F.col("_known")
    label = (
        F.when(F.col("change").isNotNull(), F.col("change"))
        .when(F.col("product_code").isNotNull() & F.col("match_path").isNotNull() & known.isNull(), F.lit(NEW))
        .when(
            known
            & (F.col("attributes") == F.col("_attributes"))
            & (F.col("name") != F.col("_name"))
            & (F.col("level_name") == ITEM),
            F.lit(NAME_CHANGE),
        )
        .when(known & (F.col("match_path") != F.col("_path")), F.lit(CODE_MATCH))
        .when(known & (F.col("match_path") == F.col("_path")), F.lit(FULL_MATCH))
    )
    joined = products.join(old.withColumn("_known", F.lit(True)), "product_code", "left")
    return joined.withColumn("change", label).drop("_known", "_path", "_attributes", "_name")


def normalise_attributes(
    products: DataFrame, attributes: dict[str, tuple[str, str]], values: DataFrame, category: str = "category"
) -> DataFrame:
    """Replace each attribute's code by its value name, unless the name itself is a wildcard text.

    `attributes` maps a column to (attribute id, attribute name). `own_value` is the value of the
    attribute that names the product's level.
    """
    cells = {c: (F.lit(attribute), F.col(c)) for c, (attribute, _) in attributes.items()}
    found = resolve_cells(products, cells, F.col(category), values)

    def value(c: str) -> Column:
        name = F.col(f"{c}_value")
        return F.when(F.instr(name, "%") > 0, F.col(c)).otherwise(F.coalesce(name, F.col(c)))

    own = F.coalesce(*[F.when(F.col("level_name") == name, value(c)) for c, (_, name) in attributes.items()])
    kept = [F.col(c) for c in products.columns if c not in attributes]
    return found.select(*kept, *[value(c).alias(c) for c in attributes], own.alias("own_value"))


def generate_names(products: DataFrame, metadata: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Short name and description of a product from its attributes in level order.

    The name leaves out the category and company unless the product sits on that level; the
    description writes the category id there instead and keeps the company. Item rows keep their
    own texts. The columns of a level come as a short array from the metadata and are looked up row
    by row: one join, whatever the number of levels.
    """
    part = F.struct("level", "column_name", "attribute_name")
    steps = metadata.where(F.col("attribute_name") != ITEM).select("structure", "category", "level", "column_name", "attribute_name").distinct()
    shape = steps.groupBy("structure", "category").agg(F.array_sort(F.collect_list(part)).alias("_steps"))
    cells = F.create_map(*[x for c in attributes for x in (F.lit(c), F.col(c))])
    up_to = F.filter("_steps", lambda s: s["level"] <= F.col("level"))

    def text(s: Column) -> Column:
        return F.try_element_at("_cells", s["column_name"])

    def foreign(s: Column, name: str) -> Column:
        return (s["attribute_name"] == name) & (F.col("level_name") != name)

    short = F.transform(up_to, lambda s: F.when(~foreign(s, CATEGORY) & ~foreign(s, COMPANY), text(s)))
    long = F.transform(up_to, lambda s: F.when(foreign(s, CATEGORY), F.col("category")).otherwise(text(s)))
    made = products.join(shape, ["structure", "category"], "left").withColumn("_cells", cells)
    item = F.col("level_name") == ITEM
    return made.withColumns(
        {
            "product_name": F.when(item, F.col("product_name")).otherwise(F.concat_ws(" ", short)),
            "product_description": F.when(item, F.col("product_description")).otherwise(F.concat_ws(" ", long)),
        }
    ).drop("_cells", "_steps")


def disambiguate_names(products: DataFrame, stored: DataFrame) -> DataFrame:
    """Append the code in brackets to name and match path where the (name, attributes) pair repeats in
    the file, or where the stored product already carries the bracketed name."""
    pair = ["name", "attributes"]
    repeated = repeated_keys(products, pair).select(*pair, F.lit(True).alias("_repeated"))
    bracketed = F.concat(F.col("name"), F.lit(" ("), F.col("product_code"), F.lit(")"))
    old = stored.select(
        "product_code", "attributes", F.col("name").alias("_bracketed"), F.lit(True).alias("_stored")
    ).distinct()
    out = (
        products.join(repeated, pair, "left")
        .withColumn("_bracketed", bracketed)
        .join(old, ["product_code", "attributes", "_bracketed"], "left")
    )
    clash = F.coalesce("_stored", "_repeated", F.lit(False))
    path = F.concat(F.col("match_path"), F.lit(" ("), F.col("product_code"), F.lit(")"))
    return out.withColumns(
        {
            "match_path": F.when(clash, path).otherwise(F.col("match_path")),
            "name": F.when(clash, F.col("_bracketed")).otherwise(F.col("name")),
        }
    ).drop("_repeated", "_stored", "_bracketed")


def resolve_stored(products: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored key and name of current products, where known."""
    old = stored.select("product_code", F.col("product_key").alias("_key"), F.col("name").alias("_name"))
    return (
        products.join(old, "product_code", "left")
        .withColumns({"product_key": F.coalesce("_key", "product_key"), "name": F.coalesce("_name", "name")})
        .drop("_key", "_name")
    )


def parent_associations(products: DataFrame, levels: DataFrame, allow_self: bool = False) -> DataFrame:
    """Child path -> parent path for parents that exist.

    Newest product per (source, path); the parent keeps as many codes as the child's level number
    (two on level 1). A row that would be its own parent is left out unless asked for.
    """
    newest = latest_per_key(products, ["source_id", "path"], "run_id", "product_key")
    leveled = newest.join(levels.select("level_id", "level"), "level_id")
    depth = F.when(F.col("level") == 1, 2).otherwise(F.col("level"))
    children = leveled.select(
        F.col("path").alias("child_path"), path_prefix(F.col("path"), depth).alias("parent_path"), "security_key"
    )
    if not allow_self:
        children = children.where(F.col("child_path") != F.col("parent_path"))
    parents = newest.select(F.col("path").alias("parent_path")).distinct()
    kept = children.join(parents, "parent_path", "left_semi")
    return kept.select("child_path", "parent_path", "security_key").distinct()


def external_id(code: Column, category: Column, group: Column) -> Column:
    """Composite id by which parts are present: code;category;group, code;category;NOT APPLICABLE,
    category;group, or category."""
    missing = F.coalesce(group, F.when(code.isNotNull(), F.lit("NOT APPLICABLE")))
    return F.concat_ws(";", code, category, missing)


def stage_category_products(
    products: DataFrame, stored: DataFrame, category: str, group: str, code: str, sold: str, shared: Sequence[str], source_id: int
) -> DataFrame:
    """Category-wide staging: newest row per (category, group, code), a summary row per (category,
    group) with the values all its products share, composite ids, stored keys."""
    newest = latest_per_key(products, [category, group, code], sold, *shared, not_null=category)
    summary = unanimous(newest, [category, group], list(shared))
    rows = newest.unionByName(summary, allowMissingColumns=True)
    rows = rows.withColumns(
        {
            "external_id": external_id(F.col(code), F.col(category), F.col(group)),
            "source_id": F.lit(source_id).cast("short"),
            "contract_id": F.lit(0).cast("long"),
        }
    )
    keys = stored.where(F.col("source_id") == source_id).select("external_id", "product_key").distinct()
    return rows.join(keys, "external_id", "left")


def decode_levels(
    products: DataFrame, ranks: DataFrame, last_runs: DataFrame, contracts: DataFrame, skip_sources: Sequence[int] = ()
) -> DataFrame:
    """Level name, level number and product text of tier 2 products, with a last-run flag.

    Name: the stored one; with a hierarchy and model number it is spelled out; without a name, the
    maker for private labels, else a placeholder. Number: by separators `!`, by a leading zero digit,
    by hierarchy and model number, else 1. For contracts with `ranked` set, the number comes from
    the (name -> rank) table, 99 when the name is unknown.
    """
    name = F.col("level_name")
    numbered = F.col("model_number").isNotNull() & F.col("level_id").isNotNull()
    private = F.upper("private_label") == "YES"
    level_text = (
        F.when(name.isNull() & private, F.col("maker"))
        .when(name.isNull(), F.lit(NO_LEVEL))
        .when(numbered, F.concat(F.lit("Hier no. "), F.col("level_id").cast("long").cast("string"), F.lit(", level no. "), F.col("model_number"), F.lit(" - "), name))
        .otherwise(name)
    )
    level_number = (
        F.when(name.contains("!"), F.length(name) - F.length(F.replace(name, F.lit("!"), F.lit(""))) + 1)
        .when(name.startswith("0"), F.substring(name, 2, 1).try_cast("int"))
        .when(numbered, F.concat(F.col("level_id").cast("long").cast("string"), F.col("model_number")).try_cast("int"))
        .otherwise(F.lit(1))
    )
    described = F.coalesce("long_text", "short_text", F.lit(NO_NAME))
    rows = products.where(~F.coalesce(F.upper(name) == "LEVEL", F.lit(False)) & ~F.coalesce(F.upper(name).contains("DRILL"), F.lit(False)))
    if skip_sources:
        rows = rows.where(~F.col("source_id").isin(*skip_sources))
    rows = rows.withColumns({"_text": level_text, "_number": level_number})
    rows = rows.join(contracts.select("source_id", "contract_id", "ranked"), "source_id")
    rows = rows.join(last_runs.select("contract_id", F.col("run_id").alias("_last")), "contract_id")
    rank_rows = ranks.select(F.upper("level_name").alias("_rank_name"), "rank")
    rows = rows.join(rank_rows, F.upper("_text") == F.col("_rank_name"), "left")
    top = F.coalesce("category_text", "category", "long_text", "short_text", F.lit(NO_NAME))
    return rows.select(
        "product_key",
        "run_id",
        "source_id",
        "contract_id",
        F.col("_text").alias("level_name"),
        F.when(F.col("_number") == 1, top).otherwise(described).alias("product_text"),
        F.when(F.col("ranked"), F.coalesce("rank", F.lit(99))).otherwise(F.col("_number")).alias("level_number"),
        F.when(F.col("run_id") == F.col("_last"), "Y").otherwise("N").alias("last_run"),
    )
