"""A tier 1 delivery from text lines to the fact image, in one plan (SRC-1, EXT-1, RSH-3, FCT-1, PRJ-10, FCT-2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelgrain.functions.numbering import FILE_ORDER, file_order
from panelgrain.operators.extract import extract_fixed_width
from panelgrain.operators.layouts import FACT_KEYS
from panelgrain.operators.measures import MeasureColumn, apply_measure_columns
from panelgrain.operators.reshape import stitch_lines, surplus_lines
from panelgrain.plans.facts import fact_image
from panelgrain.spec import MAX_MEASURES, MEASURES_PER_LINE, ContractSpec, FixedLayout

SLOTS = tuple(f"slot_{i}" for i in range(1, MEASURES_PER_LINE + 1))


@dataclass(frozen=True)
class Delivery:
    """The image, and the lines that no record had a place for."""

    image: DataFrame
    surplus: DataFrame


def tier1_delivery(
    lines: DataFrame,
    layout: FixedLayout,
    measures: Sequence[MeasureColumn],
    markets: DataFrame,
    products: DataFrame,
    periods: DataFrame,
    target: T.StructType,
    contract: ContractSpec,
    stored: DataFrame | None = None,
    prefix_when: str | None = None,
) -> Delivery:
    """Raw fact lines -> one row a record -> mapped and scaled measures -> keyed image, followed by stored facts.

    `lines` is a text scan. The texts are shuffled once, to bring a record's lines together; the
    dimensions are joined as Spark sees fit.
    """
    facts = extract_fixed_width(file_order(lines), layout, prefix_when)
    last = max((int(m.slot.removeprefix("measure_")) for m in measures), default=MAX_MEASURES)
    numbers = range(1, max(last, MAX_MEASURES) + 1)
    stitched = stitch_lines(facts, FACT_KEYS, FILE_ORDER, SLOTS, numbers)
    named = apply_measure_columns(stitched, FACT_KEYS, measures)
    image = fact_image(named, markets, products, periods, target, contract, stored)
    return Delivery(image, surplus_lines(facts, FACT_KEYS, FILE_ORDER, SLOTS, numbers))
