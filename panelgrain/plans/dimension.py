"""Tier 2 dimension load: conform, fill from stored, key the new, upsert, log (DIM-10)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelgrain.operators.conform import add_partition_columns, conform
from panelgrain.operators.extract import add_ids
from panelgrain.operators.keys import assign_keys
from panelgrain.sources.sinks import upserted
from panelgrain.spec import ContractSpec


@dataclass(frozen=True)
class DimensionLoad:
    """What one load produces; the caller decides where each frame is written."""

    rows: DataFrame
    dimension: DataFrame
    new_keys: DataFrame
    run_log: DataFrame
    conflicts: DataFrame


def fill_from_stored(rows: DataFrame, stored: DataFrame, code: str, columns: Sequence[str]) -> DataFrame:
    """Blank attributes of delivered rows take the stored value of the same code."""
    old = stored.select(code, *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = rows.join(old, code, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_old_{c}")) for c in columns}).drop(*[f"_old_{c}" for c in columns])


def load_dimension(
    delivered: DataFrame, stored: DataFrame, key_map: DataFrame, contract: ContractSpec, code: str, key: str
) -> DimensionLoad:
    """Delivered rows -> keyed rows, the dimension after the upsert, new key-map rows, and the run log.

    Rows without a code are dropped, duplicates removed. Of differing rows of one code the first in the
    order of their columns is loaded, the others are `conflicts`. Every code gets its key from the map, so a
    rerun returns the same keys. `stored` has one row per code.
    """
    attributes = [c for c in stored.columns if c in delivered.columns and c not in (code, key)]
    order = Window.partitionBy(code).orderBy(*[c for c in delivered.columns if c != code])
    ranked = delivered.where(F.col(code).isNotNull()).distinct().withColumn("_place", F.row_number().over(order))
    clean, conflicts = ranked.where("_place = 1").drop("_place"), ranked.where("_place > 1").drop("_place")
    filled = fill_from_stored(add_ids(clean, contract), stored, code, attributes)
    keyed, added = assign_keys(filled, [code], key_map, contract.run_id, key)
    rows = conform(add_partition_columns(keyed, contract), stored.schema)
    log = rows.select(F.lit(contract.run_id).cast("long").alias("run_id"), code, key).distinct()
    return DimensionLoad(rows, upserted(stored, rows, [key]), added, log, conflicts)
