"""Measure mapping and scaling (PRJ-8..12, FCT-1, TIM-6)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrain.functions.numbering import ordered_numbers
from panelgrain.operators.lookup import Layer, layered
from panelgrain.spec import MAX_COLUMNS

VALUE, FACTOR = "decimal(38,10)", "decimal(18,8)"


SPLIT = 14  # digits


def _literal(number: Decimal) -> Column:
    """A decimal literal with as many decimals as the number needs."""
    plain = number.normalize()
    return F.lit(plain.quantize(1) if plain.as_tuple().exponent > 0 else plain)


def scaled(col: Column, factor: str | Decimal | float) -> Column:
    """col * factor, rounded to ten decimals; null only where the product has over 27 digits before the point.

    Spark types a product of 38 digits with fewer decimals. Values of up to 17 digits before the point
    and factors of up to eight decimals multiply in one step, (27,10) by (18,8); others in two parts,
    above and below 10 ** 14.
    """
    exact = Decimal(str(factor))
    value = col.try_cast(VALUE)
    unit = F.lit(Decimal(10**SPLIT))
    upper = F.call_function("div", value, unit).cast("decimal(14,0)")
    high = F.try_multiply(upper, _literal(exact.scaleb(SPLIT))).try_cast("decimal(37,10)")
    low = F.try_multiply(value % unit, _literal(exact)).try_cast("decimal(37,10)")
    wide = F.try_add(high, low).try_cast(VALUE)
    if -exact.normalize().as_tuple().exponent > 8 or abs(exact) >= Decimal(10) ** 10:
        return wide
    near = F.try_multiply(value.try_cast("decimal(27,10)"), F.lit(str(exact)).cast(FACTOR)).try_cast(VALUE)
    return F.when(F.abs(value) < F.lit(Decimal(10**17)), near).otherwise(wide)


def apply_multipliers(df: DataFrame, multipliers: dict[str, str]) -> DataFrame:
    """Multiply mapped measures; a comma list of columns shares one factor; other columns pass."""
    factors = {name.strip().lower(): f for names, f in multipliers.items() for name in names.split(",")}
    return df.select(*[scaled(F.col(c), factors[c.lower()]).alias(c) if c.lower() in factors else F.col(c) for c in df.columns])


def read_multipliers(column_map: DataFrame, contract_id: int, dimension: str = "(?i)fct") -> dict[str, str]:
    """Column -> factor of one contract's fact rows; bounded by the map's width."""
    rows = (
        column_map.where(F.col("dimension").rlike(dimension) & (F.col("contract_id") == contract_id))
        .where(F.length("multiplier") > 0)
        .select("target_column", "multiplier")
        .distinct()
        .orderBy("target_column")
    )
    return {r.target_column: r.multiplier for r in rows.collect()}


def scale_precision(df: DataFrame, precision: dict[str, int]) -> DataFrame:
    """measure / 10^precision."""
    return df.withColumns({c: F.try_divide(F.col(c).try_cast(VALUE), F.lit(10**p).cast("decimal(20,0)")).try_cast(VALUE) for c, p in precision.items()})


@dataclass(frozen=True)
class MeasureColumn:
    """One mapped measure: slot column, physical name, factors and use flag."""

    slot: str
    physical: str
    contract_factor: str | None = None
    vendor_factor: str | None = None
    in_use: bool = True

    def column(self) -> Column:
        factor = self.contract_factor or self.vendor_factor
        col = F.col(self.slot).try_cast(VALUE)
        return (col if factor is None else scaled(col, factor)).alias(self.physical)


def map_measures(
    measures: DataFrame, layers: Sequence[Layer], lookup: DataFrame, vendor_factors: DataFrame, contract_factors: DataFrame
) -> DataFrame:
    """Vendor measures with id (contract, then country, then default layer), physical name, factors,
    and ordinal by source line. Factors are rows of this contract and its own vendor.

    The ordinal counts every source measure, mapped or not: it is the slot that the values sit in.
    """
    numbered = ordered_numbers(measures, ["line_num", "vendor_measure"], "ordinal")
    ranked = layered(numbered, layers, "measure_id").where(F.col("measure_id").isNotNull())
    return (
        ranked.join(lookup.select("measure_id", "physical_name", "in_use"), "measure_id")
        .join(vendor_factors.select("measure_id", F.col("factor").alias("vendor_factor")), "measure_id", "left")
        .join(contract_factors.select("measure_id", F.col("factor").alias("contract_factor")), "measure_id", "left")
    )


def slots_of_header(mapped: DataFrame, header: DataFrame, precision: DataFrame) -> DataFrame:
    """Delimited files: slot and precision of each mapped measure, from its place in the header row."""
    placed = header.withColumnRenamed("measure_code", "vendor_measure").join(precision, "vendor_measure")
    return mapped.join(placed, "vendor_measure").withColumn("slot", F.concat(F.lit("measure_"), F.col("position")))


def slots_of_order(mapped: DataFrame) -> DataFrame:
    """Fixed-width files: the slot is the measure's ordinal."""
    return mapped.withColumn("slot", F.concat(F.lit("measure_"), F.col("ordinal")))


def read_measure_columns(mapped: DataFrame) -> list[MeasureColumn]:
    """The mapped measures as column specs, in slot order. One slot may feed several names.

    All are collected, as they become the columns of a table; more than MAX_COLUMNS raise.
    """
    rows = mapped.select("slot", "physical_name", "contract_factor", "vendor_factor", "in_use", "ordinal").distinct()

    def text(v):
        return None if v is None or str(v) == "" else str(v)

    found = rows.orderBy("ordinal", "physical_name").limit(MAX_COLUMNS + 1).collect()
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"over {MAX_COLUMNS} mapped measures")
    return [MeasureColumn(r.slot, r.physical_name.lower(), text(r.contract_factor), text(r.vendor_factor), bool(r.in_use)) for r in found]


def apply_measure_columns(df: DataFrame, keys: Sequence[str], measures: Sequence[MeasureColumn]) -> DataFrame:
    """Keys plus the in-use measures under their physical names; contract factor before vendor factor."""
    return df.select(*keys, *[m.column() for m in measures if m.in_use])


def derive_measures(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    """Replace or add the named measures by expressions over the input columns, keep the rest.

    Called once per stage: the second stage may use what the first made. A division by zero is null
    when the formula uses try_divide.
    """
    kept = [F.col(c) for c in df.columns if c not in formulas]
    return df.select(*kept, *[F.expr(text).cast(VALUE).alias(name) for name, text in formulas.items()])
