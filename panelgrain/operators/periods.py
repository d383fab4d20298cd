"""Period dimension operators (TIM-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrain.operators.lookup import match_any_key

# Period type and class codes that steer associations and factors.
MONTH_CLASS, MONTH_TYPE, MONTH_WEEK_TYPE = "MTH", "MH", "WKMS"
BIMONTH_TYPES, EVEN_BIMONTH, BIWEEK = ("EB", "OB"), "EB", "BW"
USED_CALENDAR = 2

SIDE = ("id", "class", "type", "start", "end")


def resolve_by_code(periods: DataFrame, code_map: DataFrame, dim: DataFrame) -> DataFrame:
    """Vendor period code -> period id -> end date; unknown codes keep nulls."""
    codes = code_map.select(F.col("vendor_code").alias("code"), "period_id")
    ends = dim.select("period_id", F.col("end_date").alias("period_end"))
    return periods.drop("period_id").join(codes, "code", "left").join(ends, "period_id", "left")


def resolve_by_end(periods: DataFrame, dim: DataFrame) -> DataFrame:
    """Period id by end date and type, distinct."""
    keys = dim.select("period_id", F.col("end_date").alias("period_end"), F.col("type").alias("period_type"))
    return periods.join(keys, ["period_end", "period_type"], "left").distinct()


def resolve_by_start_or_end(periods: DataFrame, dim: DataFrame) -> DataFrame:
    """Period by start or end date, with the type; rows that match neither keep a null id."""
    side = dim.select("period_id", "start_date", "end_date", F.col("type").alias("period_type"))
    pairs = [("period_start", "start_date"), ("period_end", "end_date")]
    hits = [
        match_any_key(periods, side.withColumnRenamed(key, "_d"), [(left, "_d")], ["period_type"], ["period_id"])
        for left, key in pairs
    ]
    hits = reduce(DataFrame.unionByName, hits).distinct()
    return periods.distinct().join(hits.select("period_code", "period_type", "period_id"), ["period_code", "period_type"], "left")


def add_period_expressions(periods: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Contract expressions for period start, end and type as columns."""
    return periods.selectExpr("*", *[f"{text} AS {name}" for name, text in expressions.items()])


def class_of_type(types: DataFrame, contracts: DataFrame) -> DataFrame:
    """Period class of each contract's period type."""
    return contracts.join(types.select("period_type", "class"), "period_type", "left")


def _side(prefix: str, letter: str) -> list[Column]:
    return [F.col(f"{prefix}{part}").alias(f"{part}_{letter}") for part in SIDE]


def period_associations(assoc: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct associations of the used calendar: as stored, month <-> bi-month in both directions,
    bi-week to its even bi-month, and bi-week to its month.

    The stored associations are joined once; the reversed rows come from the same pass.
    """
    own = {"id": "period_id", "class": "class", "type": "type", "start": "start_date", "end": "end_date"}
    a = dim.select(*[F.col(own[p]).alias(f"{p}_a") for p in SIDE])
    b = dim.select(*[F.col(own[p]).alias(f"{p}_b") for p in SIDE])
    used = assoc.where(F.col("calendar") == USED_CALENDAR).select(
        "assoc_type", F.col("period_a").alias("id_a"), F.col("period_b").alias("id_b")
    )
    stored = used.join(a, "id_a").join(b, "id_b")
    names = [f"{p}_{s}" for s in "ab" for p in SIDE]
    reverses = (
        (F.col("assoc_type") == 1)
        & F.col("type_a").isin(*BIMONTH_TYPES)
        & (F.col("class_b") == MONTH_CLASS)
        & (F.col("type_b") == MONTH_TYPE)
    )
    forward = F.struct(*[F.col(n) for n in names])
    backward = F.struct(*[F.col(n[:-1] + ("b" if n[-1] == "a" else "a")).alias(n) for n in names])
    both = F.when(reverses, F.array(forward, backward)).otherwise(F.array(forward))
    from_store = stored.select("assoc_type", F.explode(both).alias("r")).select("assoc_type", "r.*")

    biweeks = dim.where(F.col("type") == BIWEEK)
    self_b = [F.col(own[p]).alias(f"{p}_b") for p in SIDE]
    one = F.lit(1).cast(assoc.schema["assoc_type"].dataType).alias("assoc_type")
    to_even = biweeks.where(F.col("even_bimonth_type") == EVEN_BIMONTH).select(one, *_side("even_bimonth_", "a"), *self_b)
    to_month = biweeks.where(F.col("month_class") == MONTH_CLASS).select(one, *_side("month_", "a"), *self_b)
    return from_store.unionByName(to_even).unionByName(to_month).distinct()


def retention_date(end: Column, period_class: Column, periods: Column) -> Column:
    """End date minus n periods of the class; null when n is null or not positive."""
    n = periods.cast("int")
    name = F.upper(period_class)
    months = F.when(name == "MTH", n).when(name == "BIMTH", n * 2).when(name == "QTR", n * 3)
    back = F.when(months.isNotNull(), F.add_months(end, -months)).otherwise(F.date_sub(end, n * 7))
    return F.when(n > 0, back)


def five_week_factor(associations: DataFrame, weekly_run: bool) -> DataFrame:
    """Month end -> 4/5 where the month has exactly five weeks and the run is weekly, else 1.

    Weeks per month are counted once and joined, instead of a subquery per row.
    """
    weeks = associations.where((F.col("type_a") == MONTH_TYPE) & (F.col("type_b") == MONTH_WEEK_TYPE))
    counted = weeks.groupBy(F.col("end_a").alias("period_end")).agg(F.countDistinct("id_b").alias("weeks"))
    factor = F.when(F.lit(weekly_run) & (F.col("weeks") == 5), F.lit(0.8)).otherwise(F.lit(1.0))
    return counted.select("period_end", "weeks", factor.alias("time_factor"))


def attach_period(facts: DataFrame, period_map: DataFrame, currency: str) -> DataFrame:
    """Inner join with the resolved periods, plus the contract currency."""
    found = period_map.select(F.col("code").alias("period_code"), "period_id", "period_end")
    return facts.join(found, "period_code").withColumn("currency", F.lit(currency))
