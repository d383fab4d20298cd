"""Fact transformation: keys resolved, conformed, partitioned, joined by stored facts (FCT-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelgrain.operators.conform import add_partition_columns, conform, union_all
from panelgrain.operators.extract import add_ids
from panelgrain.operators.lookup import star
from panelgrain.spec import ContractSpec


def fact_image(
    facts: DataFrame,
    markets: DataFrame,
    products: DataFrame,
    periods: DataFrame,
    target: T.StructType,
    contract: ContractSpec,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Delivered facts as the target sees them, optionally followed by the stored facts.

    Dimensions are unique on their codes; an unknown code leaves a null key for the reference rules
    to report. Stored facts arrive already pruned to the contract's partitions.
    """
    keyed = star(
        facts,
        [(markets, ["market_code"]), (products, ["product_code"]), (periods, ["period_code"])],
    )
    image = add_partition_columns(conform(add_ids(keyed, contract), target), contract)
    return image if stored is None else union_all([image, stored])
