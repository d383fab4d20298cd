"""Fixed-width and delimited extracts (EXT-*): one operator per family, layouts as data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrain.functions.numbering import ordered_numbers
from panelgrain.operators import layouts as L
from panelgrain.operators.filters import by_record_code, by_record_letter, drop_tag_rows, is_fact_line, keep_any_value
from panelgrain.spec import MAX_ATTRIBUTE_CODES, ContractSpec, DelimitedLayout, Field, FixedLayout


def records(lines: DataFrame, layout: FixedLayout) -> DataFrame:
    """Lines of the layout's record type."""
    kind, _, mark = layout.record.partition(":")
    if kind == "letter":
        return by_record_letter(lines, mark)
    if kind == "code":
        return by_record_code(lines, mark)
    return lines.where(is_fact_line(F.col("value")))


def cut(line: str, fields: Sequence[Field]) -> list[Column]:
    """Trimmed text of each field.

    Cutting a string by characters walks it from the start for every field. In a line of single-byte
    characters a character is a byte, so the bytes are sliced directly; other lines are cut by
    characters.
    """
    text, raw = F.col(line), F.col(line).cast("binary")
    single = F.length(text) == F.octet_length(text)

    def piece(f: Field) -> Column:
        by_byte = F.substring(raw, f.start, f.length).cast("string")
        return F.trim(F.when(single, by_byte).otherwise(F.substring(text, f.start, f.length))).alias(f.name)

    return [piece(f) for f in fields]


def extract_fixed_width(lines: DataFrame, layout: FixedLayout, prefix_when: str | None = None) -> DataFrame:
    """Trimmed fields of the layout's lines; columns other than `value` (run id, line number) pass through.

    A short line still gives a row: fields past its end are empty. `prefix_when` prepends the market
    prefix where the market code equals that indicator; a layout with a prefix field always does.
    """
    rest = [c for c in lines.columns if c != "value"]
    out = records(lines, layout).select(*rest, *cut("value", layout.all_fields()))
    if layout.prefix_field:
        return out.withColumn("code", F.trim(F.concat(layout.prefix_field, "code"))).drop(layout.prefix_field)
    if prefix_when is not None:
        code = F.col("market_code")
        out = out.withColumn("market_code", F.when(code == prefix_when, F.concat("market_prefix", code)).otherwise(code))
    return out


def extract_delimited(df: DataFrame, layout: DelimitedLayout) -> DataFrame:
    """Code, name, attribute list and order of a headered file; without an order column rows are numbered by code."""
    if layout.order is None:
        df = ordered_numbers(df, [layout.code], "line_num")
    picked = [
        F.col(layout.code).alias("code"),
        F.col(layout.long_name).alias("name"),
        *([F.col(layout.attributes).alias("attributes")] if layout.attributes else []),
        F.col(layout.order or "line_num").cast("long").alias("line_num"),
    ]
    used = {layout.code, layout.long_name, layout.attributes, layout.order, "line_num"}
    return df.select(*picked, *[c for c in df.columns if c not in used])


def split_attributes(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Positional codes 0..10 (null past the end), codes past the eleventh as one text, and the level, which is tokens - 1."""
    tokens = F.split(F.col(attributes), " ")
    codes = {f"attribute_{i}": F.get(tokens, F.lit(i)) for i in range(MAX_ATTRIBUTE_CODES)}
    more = F.when(F.size(tokens) > MAX_ATTRIBUTE_CODES, F.array_join(F.slice(tokens, MAX_ATTRIBUTE_CODES + 1, F.size(tokens)), " "))
    return df.withColumns({**codes, "more_attributes": more, "level": F.size(tokens) - 1})


def add_match_path(df: DataFrame, deepest: Column | int, attributes: str = "attributes", name: str = "name") -> DataFrame:
    """The attribute list, plus the name on rows of the deepest level."""
    at_bottom = F.col("level") == (F.lit(deepest) if isinstance(deepest, int) else deepest)
    path = F.when(at_bottom, F.concat_ws(" ", attributes, name)).otherwise(F.col(attributes))
    return df.withColumn("match_path", path)


def deepest_level(levels: DataFrame, level: str = "level") -> Column:
    """Deepest level of a category as a scalar; no join with the data."""
    return levels.agg(F.round(F.max(F.col(level).cast("double"))).cast("int").alias("deepest")).scalar()


def add_ids(df: DataFrame, contract: ContractSpec) -> DataFrame:
    return df.withColumns(
        {
            "run_id": F.lit(contract.run_id).cast("long"),
            "contract_id": F.lit(contract.contract_id).cast("long"),
            "source_id": F.lit(contract.source_id).cast("short"),
        }
    )


def extract_markets(lines: DataFrame, layout: FixedLayout | DelimitedLayout, contract: ContractSpec) -> DataFrame:
    """Markets with attribute codes; a level-9 market carries its name in the match path."""
    read = extract_fixed_width if isinstance(layout, FixedLayout) else extract_delimited
    return add_ids(add_match_path(split_attributes(read(lines, layout)), 9), contract)


def clean_product_text(lines: DataFrame, layout: FixedLayout) -> DataFrame:
    """Replace characters the product formats do not allow, before positions are cut."""
    if layout is L.PRODUCT_A:
        dotted = F.regexp_replace("value", L.PRODUCT_TEXT_DOT, "___")
        return lines.withColumn("value", F.regexp_replace(dotted, f"[^{L.PRODUCT_TEXT_ALLOWED}]", "__"))
    if layout is L.PRODUCT_A2:
        return lines.withColumn("value", F.regexp_replace("value", L.PRODUCT_TEXT_UNKNOWN, "_"))
    return lines


def extract_products(
    lines: DataFrame, layout: FixedLayout | DelimitedLayout, contract: ContractSpec, deepest: Column | int
) -> DataFrame:
    """Products with attribute codes and match path; names double as the first short and long name."""
    if isinstance(layout, FixedLayout):
        rows = extract_fixed_width(clean_product_text(records(lines, layout), layout), layout)
    else:
        rows = extract_delimited(lines, layout)
    named = rows.withColumns({"product_name": F.col("name"), "product_description": F.col("name")})
    return add_ids(add_match_path(split_attributes(named), deepest), contract)


def extract_periods(lines: DataFrame, layout: FixedLayout | DelimitedLayout) -> DataFrame:
    """Period codes and names with the placeholder period id 0."""
    read = extract_fixed_width if isinstance(layout, FixedLayout) else extract_delimited
    return read(lines, layout).withColumn("period_id", F.lit(0))


def extract_measures(lines: DataFrame, layout: FixedLayout | DelimitedLayout) -> DataFrame:
    read = extract_fixed_width if isinstance(layout, FixedLayout) else extract_delimited
    return read(lines, layout)


def extract_delimited_facts(df: DataFrame, contract: ContractSpec, invalid_products: DataFrame | None = None) -> DataFrame:
    """Wide delimited facts: drop empty and header rows, name keys and measures 1..n, add ids,
    and leave out products of invalid hierarchies. `line_num` and `surplus` pass through."""
    beside = [c for c in ("line_num", "surplus") if c in df.columns]
    columns = [c for c in df.columns if c not in beside]
    rows = keep_any_value(df, columns)
    keys = [F.col(c).alias(k) for c, k in zip(columns, L.FACT_KEYS)]
    measures = [F.col(c).alias(f"measure_{i}") for i, c in enumerate(columns[3:], start=1)]
    facts = add_ids(drop_tag_rows(rows.select(*keys, *measures, *beside), L.FACT_TAGS), contract)
    if invalid_products is None:
        return facts
    return facts.join(invalid_products.select("product_code").distinct(), "product_code", "left_anti")


def hierarchy_paths(definitions: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """(hierarchy number, its level columns in order). A hierarchy has at most nine levels."""
    usable = definitions.where(~F.col("column_name").isin(*skip)) if skip else definitions
    pairs = usable.select("hierarchy_number", F.col("hierarchy_level").cast("int").alias("lvl"), "column_name").distinct()
    names = F.transform(F.array_sort(F.collect_list(F.struct("lvl", "column_name"))), lambda p: p["column_name"])
    return pairs.groupBy("hierarchy_number").agg(names.alias("level_columns"))


def products_from_hierarchies(
    products: DataFrame, definitions: DataFrame, marker: str = "X", skip: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Products pathed by their hierarchy's level columns, and product codes of invalid hierarchies.

    `products` holds product_id, hierarchy_number, hierarchy_level, name and the level columns. The
    path is the hierarchy number and the non-blank level values; a named row ends in `marker`. The
    level columns are looked up row by row in one pass, so no branch per hierarchy is planned.
    A hierarchy with a single definition row is invalid.
    """
    fixed = {"product_id", "hierarchy_number", "hierarchy_level", "name"}
    cells = [x for c in products.columns if c not in fixed for x in (F.lit(c), F.trim(F.col(c)))]
    rows = products.distinct().withColumn("_cells", F.create_map(*cells))
    counts = definitions.groupBy("hierarchy_number").agg(F.count("*").alias("_rows"))
    shape = hierarchy_paths(definitions, skip).join(counts, "hierarchy_number")
    pathed = rows.join(shape, "hierarchy_number")
    values = F.transform("level_columns", lambda c: F.try_element_at("_cells", c))
    filled = F.filter(values, lambda v: v != "")
    named = F.trim("name") != ""
    path = F.concat_ws(" ", F.col("hierarchy_number"), filled, F.when(named, F.lit(marker)))
    out = pathed.select(
        F.coalesce("product_id", F.lit("")).alias("product_code"),
        path.alias("attributes"),
        F.coalesce("name", F.lit("")).alias("name"),
        "hierarchy_number",
        "hierarchy_level",
        "_rows",
    )
    valid = out.where("_rows > 1").drop("_rows").distinct()
    invalid = out.where("_rows = 1").select("product_code").distinct()
    return valid, invalid
