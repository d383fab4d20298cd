"""The rule catalogue (DQ-01..DQ-55). A rule returns the offending rows; frames and columns:

facts      market_code, product_code, period_code, line_num, measure columns as text or decimal
markets / products / measures / periods   code, name, attributes, level, attribute_0.. as extracted
stored_*   the dimension as last published; last_* what the previous run delivered
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelgrain.functions.ratios import ratio
from panelgrain.functions.text import is_bad_measure, path_parent
from panelgrain.operators.dedup import repeated_keys, repeated_rows
from panelgrain.operators.lookup import delivered_status
from panelgrain.operators.product import NEW
from panelgrain.operators.reshape import bad_cells, bad_values
from panelgrain.quality.framework import Frames, RepeatedKey, rule
from panelgrain.spec import MEASURES_PER_LINE

AXES = ("market", "product", "period")


def _absent(rows: DataFrame, known: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key columns (left) have no match in the known columns (right)."""
    keys = known.select(*[F.col(r).alias(l) for l, r in on.items()]).distinct()
    return rows.join(keys, list(on), "left_anti")


def _absent_tags(facts: DataFrame, known: DataFrame, axis: str) -> DataFrame:
    """Distinct fact tags of one axis that the reference file does not define."""
    tags = facts.select(F.col(f"{axis}_code").alias("code")).distinct()
    return _absent(tags, known, {"code": "code"}).select(F.lit(axis).alias("axis"), "code")


def _changed(rows: DataFrame, stored: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Rows whose column differs from the stored row with the same key."""
    old = stored.select(*on, F.col(column).alias(f"stored_{column}")).distinct()
    return rows.join(old, list(on)).where(~F.col(column).eqNullSafe(F.col(f"stored_{column}")))


def _shared(rows: DataFrame, keys: Sequence[str], of: str, name: str) -> DataFrame:
    """Keys under which more than one value of a column occurs; two values suffice, so min/max do."""
    spread = rows.groupBy(*keys).agg(F.min(of).alias(f"first_{name}"), F.max(of).alias(f"last_{name}"))
    return spread.where(F.col(f"first_{name}") != F.col(f"last_{name}"))


# ---------------------------------------------------------------- file structure


def _measures(facts: DataFrame) -> list[str]:
    return [c for c in facts.columns if c.startswith("measure_")]


def _bad_measures(facts: DataFrame, p: dict) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(is_bad_measure(F.col(c)).cast("int"), F.lit(0)) for c in _measures(facts)], F.lit(0))


@rule("DQ-01", "Bad fact data format", (1, 5), ["facts"], per_row=_bad_measures)
def bad_fact_format(f: Frames, p: dict) -> DataFrame:
    return bad_values(f["facts"], ["line_num"], _measures(f["facts"]), is_bad_measure)


@rule("DQ-02", "Missing mandatory columns", (1,), ["column_map", "columns"])
def missing_mandatory(f: Frames, p: dict) -> DataFrame:
    needed = f["column_map"].where("mandatory").select(F.col("file_column").alias("column_name")).distinct()
    return needed.join(f["columns"], "column_name", "left_anti")


@rule("DQ-03", "Unmapped and missing optional columns", (3,), ["column_map", "columns"])
def optional_columns(f: Frames, p: dict) -> DataFrame:
    mapped = f["column_map"].where("NOT mandatory").select(F.col("file_column").alias("column_name"))
    needed = f["column_map"].where("mandatory").select(F.col("file_column").alias("column_name"))
    actual = f["columns"].join(needed, "column_name", "left_anti")
    return delivered_status(actual, mapped, ["column_name"], ("unmapped", "missing", "mapped")).where("status <> 'mapped'")


@rule("DQ-04", "Fact tag not defined in reference", (1,), ["facts", "markets", "products", "periods"])
def undefined_tags(f: Frames, p: dict) -> DataFrame:
    return reduce(DataFrame.unionByName, [_absent_tags(f["facts"], f[f"{a}s"], a) for a in AXES])


@rule("DQ-05", "Fact market tag undefined", (5,), ["facts", "markets"])
def undefined_market(f: Frames, p: dict) -> DataFrame:
    return _absent_tags(f["facts"], f["markets"], "market")


@rule("DQ-06", "Fact product tag undefined", (5,), ["facts", "products"])
def undefined_product(f: Frames, p: dict) -> DataFrame:
    return _absent_tags(f["facts"], f["products"], "product")


@rule("DQ-07", "Fact period tag undefined", (5,), ["facts", "periods"])
def undefined_period(f: Frames, p: dict) -> DataFrame:
    return _absent_tags(f["facts"], f["periods"], "period")


@rule("DQ-08", "Duplicated fact", (1,), ["facts"], per_key=RepeatedKey(rows=True), keys=("market_code", "product_code", "period_code"))
def duplicated_fact(f: Frames, p: dict) -> DataFrame:
    return repeated_rows(f["facts"], p["keys"]).select(*p["keys"], "line_num", "copies")


@rule("DQ-09", "Duplicated market code", (1, 5), ["markets"], per_key=RepeatedKey(), keys=("code",))
def duplicated_market(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["markets"], p["keys"])


@rule("DQ-10", "Duplicated product code", (1, 5), ["products"], per_key=RepeatedKey(), keys=("code",))
def duplicated_product(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["products"], p["keys"])


@rule("DQ-11", "Duplicated measure", (5,), ["measures"], per_key=RepeatedKey(), keys=("code",))
def duplicated_measure(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["measures"], p["keys"])


@rule("DQ-12", "Duplicated product attributes", (5,), ["products"], per_key=RepeatedKey(), keys=("attributes",))
def duplicated_attributes(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["products"], p["keys"])


@rule("DQ-13", "Duplicated period", (5,), ["periods"], per_key=RepeatedKey(), keys=("code",))
def duplicated_period(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["periods"], p["keys"])


@rule("DQ-14", "Data exists", (5,), [], files=("facts", "markets", "measures", "products", "periods"))
def data_exists(f: Frames, p: dict) -> DataFrame:
    """One row per delivered file without rows; one row of each file settles it."""
    counts = [f[n].limit(1).agg(F.count("*").alias("rows")).select(F.lit(n).alias("file"), "rows") for n in p["files"] if n in f]
    return reduce(DataFrame.unionByName, counts).where("rows = 0").select("file")


@rule("DQ-15", "Incorrect file format", (5,), ["lines", "contract"])
def incorrect_format(f: Frames, p: dict) -> DataFrame:
    """Lines whose detected layout is not the one the contract declares."""
    value = F.col("value")
    detected = F.when(value.contains("|"), "pipe").when(value.contains(","), "comma").otherwise("fixed")
    shown = f["lines"].withColumn("detected", detected)
    return shown.join(f["contract"].select("contract_id", "declared"), "contract_id").where("detected <> declared")


@rule("DQ-16", "Incorrect period type", (5,), ["periods", "contract"])
def incorrect_period_type(f: Frames, p: dict) -> DataFrame:
    declared = f["contract"].select("contract_id", F.col("period_type").alias("declared_type"))
    return f["periods"].join(declared, "contract_id").where("period_type <> declared_type")


@rule("DQ-17", "Fact lines do not match number of measures", (5,), ["facts"], keys=("market_code", "product_code", "period_code"), measures=100)
def wrong_line_count(f: Frames, p: dict) -> DataFrame:
    expected = -(-p["measures"] // MEASURES_PER_LINE)
    lines = f["facts"].groupBy(*p["keys"]).agg(F.count("*").alias("lines"))
    return lines.where(F.col("lines") != expected).withColumn("expected", F.lit(expected).cast("long"))


@rule("DQ-18", "Too many measures in the row", (5,), ["facts"])
def too_many_measures(f: Frames, p: dict) -> DataFrame:
    return f["facts"].where(F.trim("rest") != "").select("line_num", "rest")


@rule("DQ-19", "Category matches contract", (5,), ["products", "categories"])
def foreign_category(f: Frames, p: dict) -> DataFrame:
    return _absent(f["products"], f["categories"], {"category": "category"})


# ---------------------------------------------------------------- vendor reference


@rule("DQ-20", "Unknown hierarchy for product", (9,), ["products", "structures"])
def unknown_product_hierarchy(f: Frames, p: dict) -> DataFrame:
    return _absent(f["products"], f["structures"], {"category": "category", "structure": "structure"})


def _too_deep(rows: DataFrame, levels: DataFrame) -> DataFrame:
    deepest = levels.groupBy("category").agg(F.max("level").alias("deepest"))
    return rows.join(deepest, "category").where(F.col("level") > F.col("deepest"))


@rule("DQ-21", "Too many attributes for product hierarchy", (9,), ["products", "levels"])
def product_too_deep(f: Frames, p: dict) -> DataFrame:
    return _too_deep(f["products"], f["levels"])


def _no_parent(rows: DataFrame) -> DataFrame:
    children = rows.withColumn("parent_path", path_parent(F.col("path"))).where("parent_path IS NOT NULL")
    return _absent(children, rows, {"parent_path": "path"})


@rule("DQ-22", "No parent in product hierarchy", (9,), ["products"])
def product_without_parent(f: Frames, p: dict) -> DataFrame:
    return _no_parent(f["products"])


@rule("DQ-23", "Duplicated product after mapping", (9,), ["products"])
def two_codes_one_path(f: Frames, p: dict) -> DataFrame:
    return _shared(f["products"], ["path"], "code", "code")


@rule("DQ-24", "External code change", (9,), ["products", "stored_products"])
def code_change(f: Frames, p: dict) -> DataFrame:
    return _changed(f["products"], f["stored_products"], ["path"], "code")


# ---------------------------------------------------------------- information


@rule("DQ-25", "Measure description differs from expected", (7,), ["measures", "measure_lookup"])
def measure_name_differs(f: Frames, p: dict) -> DataFrame:
    return _changed(f["measures"], f["measure_lookup"], ["code"], "name")


@rule("DQ-26", "Modified market description", (3, 7), ["markets", "stored_markets"])
def market_name_changed(f: Frames, p: dict) -> DataFrame:
    return _changed(f["markets"], f["stored_markets"], ["code"], "name")


@rule("DQ-27", "Missing product", (7,), ["products", "last_products"])
def missing_product(f: Frames, p: dict) -> DataFrame:
    return _absent(f["last_products"], f["products"], {"code": "code"})


@rule("DQ-28", "Same brand under two companies", (7,), ["products"])
def brand_of_two_companies(f: Frames, p: dict) -> DataFrame:
    return _shared(f["products"], ["brand"], "company", "company")


@rule("DQ-29", "Skipped measures", (7,), ["measures", "measure_lookup"])
def skipped_measures(f: Frames, p: dict) -> DataFrame:
    used = f["measure_lookup"].where("in_use").select("code").distinct()
    return f["measures"].join(used, "code", "left_anti")


def _bad_characters(kind: str):
    def find(f: Frames, p: dict) -> DataFrame:
        return bad_cells(f[f"{kind}s"], [p["id"]])

    return find


for _kind in ("product", "market", "measure", "period"):
    rule(f"DQ-30-{_kind}", f"Bad characters in {_kind} file", (7,), [f"{_kind}s"], id="code")(_bad_characters(_kind))


@rule("DQ-31", "Invalid attribute combination", (7,), ["products", "allowed"], attributes=("category", "brand"))
def invalid_combination(f: Frames, p: dict) -> DataFrame:
    return _absent(f["products"], f["allowed"], {a: a for a in p["attributes"]})


@rule("DQ-32", "New product list", (7,), ["classified_products"])
def new_products(f: Frames, p: dict) -> DataFrame:
    return f["classified_products"].where(F.col("change") == NEW)


# ---------------------------------------------------------------- reference


@rule("DQ-33", "Unknown measure", (6,), ["mapped_measures"])
def unknown_measure(f: Frames, p: dict) -> DataFrame:
    return f["mapped_measures"].where("measure_id IS NULL")


@rule("DQ-34", "Duplicated measure after mapping", (6,), ["mapped_measures"])
def repeated_measure_id(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["mapped_measures"].where("measure_id IS NOT NULL"), ["measure_id"])


@rule("DQ-35", "Empty or zero in every row", (6,), ["facts"], key="product_code", measures=("volume", "value"))
def all_zero(f: Frames, p: dict) -> DataFrame:
    largest = F.greatest(*[F.abs(F.coalesce(F.col(m), F.lit(0))) for m in p["measures"]]) if len(p["measures"]) > 1 else F.abs(F.coalesce(F.col(p["measures"][0]), F.lit(0)))
    return f["facts"].groupBy(p["key"]).agg(F.max(largest).alias("_largest")).where("_largest = 0").drop("_largest")


def _where(condition: str):
    return lambda rows, p: F.coalesce(F.expr(condition).cast("int"), F.lit(0))


@rule("DQ-36", "Unknown attribute value", (6,), ["attribute_cells"], per_row=_where("code IS NOT NULL AND value_name IS NULL"))
def unknown_value(f: Frames, p: dict) -> DataFrame:
    return f["attribute_cells"].where("code IS NOT NULL AND value_name IS NULL")


@rule("DQ-37", "Periods not properly generated", (2, 6), ["deliveries", "periods"], keys=("contract_id",))
def period_gaps(f: Frames, p: dict) -> DataFrame:
    """Expected periods between a key's first and last delivery against what came, with a status:
    missing, new (one delivery) or redelivered (more).

    Calendar periods get an ordinal within their class. Each delivered period stands for itself and for those
    it leaves out up to the key's next one, so the deliveries are read and counted once. A delivered period that the calendar
    does not have is listed with the status unknown; a span starts and ends with its known periods.
    """
    keys = list(p["keys"])
    came = f["deliveries"].groupBy(*keys, "class", "period_end").agg(F.countDistinct("run_id").alias("deliveries"))
    in_order = F.row_number().over(Window.partitionBy("class").orderBy("period_end"))
    calendar = f["periods"].select("class", F.col("end_date").alias("period_end")).distinct().withColumn("_no", in_order)
    following = F.lead("_no").over(Window.partitionBy(*keys, "class").orderBy("_no"))
    placed = came.join(calendar, ["class", "period_end"], "left").withColumn("_next", following)
    until = F.when(F.col("_no").isNotNull(), F.coalesce(F.col("_next") - 1, F.col("_no")))
    spans = placed.withColumn("_at", F.explode_outer(F.sequence("_no", until)))
    own = spans.select(*keys, "class", F.when(F.col("_at").isNull() | (F.col("_at") == F.col("_no")), F.col("period_end")).alias("_own"), "deliveries", "_at")
    dates = calendar.select("class", F.col("period_end").alias("_end"), F.col("_no").alias("_at"))
    status = F.when(F.col("_at").isNull(), "unknown").when(F.col("_own").isNull(), "missing").when(F.col("deliveries") == 1, "new").otherwise("redelivered")
    return own.join(dates, ["class", "_at"], "left").select(*keys, "class", F.coalesce("_own", "_end").alias("period_end"), status.alias("status"))


@rule("DQ-38", "Duplicated period after mapping", (6,), ["mapped_periods"], per_key=RepeatedKey(("period_id",), known=True))
def repeated_period_id(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["mapped_periods"].where("period_id IS NOT NULL"), ["period_id"])


@rule("DQ-39", "Missing and delivered areas", (2, 6), ["markets", "last_markets"], key="code")
def area_status(f: Frames, p: dict) -> DataFrame:
    return delivered_status(f["markets"], f["last_markets"], [p["key"]])


@rule("DQ-40", "Unknown period", (2, 6), ["mapped_periods"], per_row=_where("period_id IS NULL"))
def unknown_period(f: Frames, p: dict) -> DataFrame:
    return f["mapped_periods"].where("period_id IS NULL")


@rule("DQ-41", "Unknown market", (6,), ["mapped_markets"], per_row=_where("market_key IS NULL"))
def unknown_market(f: Frames, p: dict) -> DataFrame:
    return f["mapped_markets"].where("market_key IS NULL")


@rule("DQ-42", "Duplicated market after mapping", (6,), ["mapped_markets"], per_key=RepeatedKey(("market_key",), known=True))
def repeated_market_key(f: Frames, p: dict) -> DataFrame:
    return repeated_keys(f["mapped_markets"].where("market_key IS NOT NULL"), ["market_key"])


@rule("DQ-43", "Missing and delivered hierarchies", (2, 6), ["products", "last_products"])
def hierarchy_status(f: Frames, p: dict) -> DataFrame:
    return delivered_status(f["products"], f["last_products"], ["structure"])


@rule("DQ-44", "Missing and delivered measures", (6,), ["measures", "last_measures"])
def measure_status(f: Frames, p: dict) -> DataFrame:
    return delivered_status(f["measures"], f["last_measures"], ["code"])


@rule("DQ-45", "Modified product attributes", (2, 6), ["products", "stored_products"])
def attributes_changed(f: Frames, p: dict) -> DataFrame:
    return _changed(f["products"], f["stored_products"], ["code"], "attributes")


@rule("DQ-46", "No parent in market hierarchy", (6,), ["markets"])
def market_without_parent(f: Frames, p: dict) -> DataFrame:
    return _no_parent(f["markets"])


@rule("DQ-47", "Unknown hierarchy for market", (6,), ["markets", "structures"])
def unknown_market_hierarchy(f: Frames, p: dict) -> DataFrame:
    return _absent(f["markets"], f["structures"], {"category": "category", "structure": "structure"})


@rule("DQ-48", "Too many attributes for market hierarchy", (6,), ["markets", "levels"])
def market_too_deep(f: Frames, p: dict) -> DataFrame:
    return _too_deep(f["markets"], f["levels"])


# ---------------------------------------------------------------- business


def _limits(facts: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Facts with the limits of their level; a level without a threshold row has none of the limits."""
    return facts.join(thresholds.withColumn("has_limits", F.lit(True)), "level_id", "left").withColumn("has_limits", F.coalesce("has_limits", F.lit(False)))


def _beyond(col: str, limit: str) -> Column:
    """Past the limit; without a threshold row any known change is, so that no level goes unchecked."""
    return F.coalesce(F.when(F.col("has_limits"), F.abs(col) > F.col(limit)).otherwise(F.col(col) != 0), F.lit(False))


@rule("DQ-49", "Unexpected change vs previous period or year ago", (4, 8), ["comparison", "thresholds"], measure="volume")
def unexpected_change(f: Frames, p: dict) -> DataFrame:
    m = p["measure"]
    moved = _beyond(f"{m}_ipp", "previous_limit") | _beyond(f"{m}_iya", "year_ago_limit")
    return _limits(f["comparison"], f["thresholds"]).where(moved & (~F.col("has_limits") | (F.abs(m) > F.col("absolute_limit"))))


@rule("DQ-50", "Unexpected backdata difference", (4, 8), ["comparison", "thresholds"], measure="volume")
def backdata_difference(f: Frames, p: dict) -> DataFrame:
    return _limits(f["comparison"], f["thresholds"]).where(_beyond(f"{p['measure']}_ipd", "delivery_limit"))


@rule("DQ-51", "Negative fact values", (4, 8), ["facts"], per_row=lambda rows, p: F.coalesce((F.col(p["measure"]) < -abs(p["limit"])).cast("int"), F.lit(0)), measure="value", limit=0)
def negative_values(f: Frames, p: dict) -> DataFrame:
    return f["facts"].where(F.col(p["measure"]) < -abs(p["limit"]))


@rule("DQ-52", "Parent and children mismatch on volume", (8,), ["facts"], within=("market_key", "period_id"), measure="volume", limit=0.0)
def parent_mismatch(f: Frames, p: dict) -> DataFrame:
    """Parents whose value is off from the sum of their children by more than `limit` percent; off a parent of 0, by anything."""
    within, m = list(p["within"]), p["measure"]
    kids = f["facts"].where("parent_path IS NOT NULL").groupBy(*within, F.col("parent_path").alias("path")).agg(F.sum(m).alias("children"))
    both = f["facts"].select(*within, "path", F.col(m).alias("parent")).join(kids, [*within, "path"])
    off = F.col("parent") - F.col("children")
    gap = F.when(F.col("parent") == 0, off != 0).otherwise(F.abs(ratio(off, F.col("parent"))) * 100 > p["limit"])
    return both.where(gap)


@rule("DQ-53", "Top level mismatch between hierarchies", (8,), ["facts"], within=("market_key", "period_id"), measure="volume")
def top_mismatch(f: Frames, p: dict) -> DataFrame:
    tops = f["facts"].where("is_top = 'Y'")
    spread = tops.groupBy(*p["within"]).agg(F.min(p["measure"]).alias("lowest"), F.max(p["measure"]).alias("highest"))
    return spread.where("lowest <> highest")


@rule("DQ-54", "Missing fact for parent level", (8,), ["facts"], within=("market_key", "period_id"))
def parent_without_fact(f: Frames, p: dict) -> DataFrame:
    within = list(p["within"])
    needed = f["facts"].where("parent_path IS NOT NULL").select(*within, F.col("parent_path").alias("path")).distinct()
    return needed.join(f["facts"].select(*within, "path").distinct(), [*within, "path"], "left_anti")


@rule("DQ-55", "Missing and delivered product level", (8,), ["products", "last_products"])
def level_status(f: Frames, p: dict) -> DataFrame:
    return delivered_status(f["products"], f["last_products"], ["level"])
