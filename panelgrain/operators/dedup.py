"""Latest-per-key, unanimous values, duplicates (WIN-*, AGG-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], not_null: str | None = None) -> DataFrame:
    """One row per key, the first in `order`.

    `row_number() = 1` is planned as a window group limit: every task keeps one row per key before
    the shuffle, so a key holding a third of the rows costs no more than any other.
    """
    rows = df if not_null is None else df.where(F.col(not_null).isNotNull())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str, *tie: str, not_null: str | None = None) -> DataFrame:
    """The row with the highest `newest` per key; `tie` columns (ascending) make the choice total."""
    order = [F.col(newest).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]]
    return first_per_key(df, keys, order, not_null)


def unanimous(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: the value on which all non-null members agree, else null."""
    agreed = [F.when(F.min(c) == F.max(c), F.min(c)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*agreed)


def single_member_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n = 1").select(*keys)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many; counted map-side first."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of a repeated key with the number of copies.

    Counts are aggregated, then joined back on null-safe keys; adaptive execution splits a hot key
    of the join, which a window over the key could not do.
    """
    counts = repeated_keys(df, keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "copies")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(counts, same, "inner").drop(*[f"_{k}" for k in keys])


def max_per(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias(name))


def ordered_names(df: DataFrame, keys: Sequence[str], level: str, text: str, name: str, sep: str = " ", most: int = 1000) -> DataFrame:
    """The first `most` distinct (level, text) pairs of a group, texts joined in level order, and how many more there are.

    The number left out is in `{name}_left_out`. Pairs are ranked before the list is made, which keeps `most` of a group in each task
    ahead of the shuffle (window group limit), so a list is bounded whatever the group holds; pairs are counted apart, by
    partial aggregates. Null texts are counted and take no place in the joined text.
    """
    pairs = df.select(*keys, level, text).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(level, text))
    first = pairs.withColumn("_rank", rank).where(F.col("_rank") <= most)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_rank", F.col(text).alias("_text")))), lambda p: p["_text"])
    listed = first.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.array_join(ordered, sep).alias(name), F.count("*").alias("_listed"))
    counts = pairs.groupBy(*keys).agg(F.count("*").alias("_pairs"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return counts.join(listed, same).select(*keys, name, (F.col("_pairs") - F.col("_listed")).alias(f"{name}_left_out"))


def nth_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, n: int, prefix: str) -> DataFrame:
    """The first n values of a key, in order, as n columns.

    Ranks up to n are kept before the shuffle (window group limit), then one conditional aggregate.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_rank", rank).where(F.col("_rank") <= n)
    picks = [F.max(F.when(F.col("_rank") == i, F.col(column))).alias(f"{prefix}{i}") for i in range(1, n + 1)]
    return ranked.groupBy(*keys).agg(*picks)
