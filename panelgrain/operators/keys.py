"""Surrogate keys (KEY-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrain.functions.numbering import hashed_numbers
from panelgrain.spec import FIRST_KEY


def new_keys(df: DataFrame, natural: Sequence[str], known: DataFrame, run_id: int, name: str = "surrogate_key") -> DataFrame:
    """Key-map rows for the natural keys that have none yet: dense numbers after the highest key.

    Only distinct new keys are numbered, in hash buckets, so no task sees more than its share.
    Order depends on the keys alone; a rerun over the stored map finds nothing new.
    """
    fresh = df.select(*natural).dropna("any").distinct().join(known.select(*natural), list(natural), "left_anti")
    highest = known.agg(F.coalesce(F.max(name), F.lit(FIRST_KEY - 1)).alias("highest")).scalar()
    numbered = hashed_numbers(fresh, natural, "_n")
    return numbered.select(*natural, (highest + F.col("_n")).cast("long").alias(name), F.lit(run_id).cast("long").alias("run_id"))


def assign_keys(
    df: DataFrame, natural: Sequence[str], known: DataFrame, run_id: int, name: str = "surrogate_key"
) -> tuple[DataFrame, DataFrame]:
    """(rows with their key, key-map rows to append)."""
    added = new_keys(df, natural, known, run_id, name)
    lookup = known.select(*natural, name).unionByName(added.select(*natural, name))
    return df.join(lookup, list(natural), "left"), added


def assign_keys_to_new(
    df: DataFrame, natural: Sequence[str], known: DataFrame, run_id: int, label: str, change: str = "change", name: str = "surrogate_key"
) -> tuple[DataFrame, DataFrame]:
    """Keys only for rows of one change class; the others keep the key they carry."""
    added = new_keys(df.where(F.col(change) == label), natural, known, run_id, name)
    made = added.select(*natural, F.col(name).alias("_made"))
    out = df.join(made, list(natural), "left").withColumn(name, F.coalesce(F.col(name), F.col("_made"))).drop("_made")
    return out, added
