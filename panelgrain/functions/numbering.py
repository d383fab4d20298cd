"""Row numbers without a single-task window.

Four ways, by what the caller needs:
* `file_order`         - sort columns that follow the lines of a file, without a second read;
* `file_line_numbers`  - position of a line in its file, straight from the scan;
* `ordered_numbers`    - dense 1..n in a given order (buckets along fixed bounds + offsets);
* `hashed_numbers`     - dense numbers for distinct keys in a fixed pseudo-random order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _offsets(groups: DataFrame, within: list[str], order: str, size: str, name: str) -> DataFrame:
    """Running total of `size` before each group; one row per split/partition/bucket, so small."""
    window = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))


FILE_ORDER = ("_file", "_block", "_pos")


def file_order(df: DataFrame) -> DataFrame:
    """Sort columns (file, split start, place in the scan) of a text or csv scan.

    Enough wherever only the order of lines matters, such as stitching records: no numbers are
    handed out, so the file is read once. Files of one delivery sort by name.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def file_line_numbers(df: DataFrame, name: str = "line_num") -> DataFrame:
    """1-based line number within each file of a text or csv scan.

    Rows of one file split sit next to each other in one scan task, so the distance to the split's
    first row is the position within the split; split sizes give the offset. The numbers depend on
    the file content only, not on how splits are packed into tasks. Sizes take a second pass over the
    file; use `file_order` where order is enough.
    """
    tagged = file_order(df)
    splits = tagged.groupBy("_file", "_block").agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    offsets = _offsets(splits, ["_file"], "_block", "_n", "_before").drop("_n")
    return (
        tagged.join(offsets, ["_file", "_block"])
        .withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
        .drop("_file", "_block", "_pos", "_first", "_before")
    )


# Rows whose keys set the bounds of `ordered_numbers`, and buckets along 16 coarse and 16 fine bounds.
SKETCH_ROWS, COARSE, FINE = 4096, 16, 16


def _bounds(rows: DataFrame) -> Column:
    """255 keys that cut the rows into about equal buckets, as 16 lists in order: a scalar subquery, part of the plan.

    They are quantiles of the rows with the smallest hashes. A row's hash depends on its values only, so
    whoever evaluates the subquery, and however the rows are dealt, gets the same bounds.
    """
    sketch = rows.select("_key").orderBy("_key._hash", "_key").limit(SKETCH_ROWS)
    keys = sketch.agg(F.array_sort(F.collect_list("_key")).alias("_keys"))
    cut = COARSE * FINE
    at = lambda i: F.element_at("_keys", F.floor(i * F.size("_keys") / cut).cast("int") + 1)
    picks = F.when(F.size("_keys") > 0, F.transform(F.sequence(F.lit(1), F.lit(cut - 1)), at)).otherwise(F.slice("_keys", 1, 0))
    picked = keys.select(picks.alias("_picks"))
    lists = F.transform(F.sequence(F.lit(0), F.lit(COARSE - 1)), lambda g: F.slice("_picks", g * FINE + 1, FINE))
    return picked.select(F.filter(lists, lambda fine: F.size(fine) > 0)).scalar()


def ordered_numbers(df: DataFrame, order: list[str | Column], name: str = "line_num") -> DataFrame:
    """Dense 1..n over the whole frame in ascending order, nulls first, without a job of its own.

    Rows that are equal in all columns are counted, not carried, until they get their numbers. The others are dealt to 256
    buckets by fixed bounds (`_bounds`), ordered by the keys and then a hash of all columns, so that a
    hot key is spread over buckets as well; each bucket is ranked in a task and shifted by the
    sizes of the buckets before it. Numbers depend on the rows' values only, not on partitions, and every pass
    agrees. Equal keys are numbered in the order of the hash. Columns of map type cannot be compared. The bucket is never null,
    as Spark would otherwise look it up below the count of equal rows, once for each of them.
    """
    columns = df.columns
    keys = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    counted = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    keyed = counted.withColumn("_key", F.struct(*keys, F.xxhash64(F.lit(7), *columns).alias("_hash")))
    listed = keyed.withColumn("_lists", _bounds(keyed))
    coarse = F.size(F.filter("_lists", lambda fine: fine[0] <= F.col("_key")))
    inner = F.size(F.filter(F.get("_lists", F.col("_coarse") - 1), lambda bound: bound <= F.col("_key")))
    bucket = F.when(F.col("_coarse") < 1, 0).otherwise((F.col("_coarse") - 1) * FINE + inner)
    placed = listed.withColumn("_coarse", coarse).withColumn("_bucket", F.coalesce(bucket, F.lit(0))).drop("_lists", "_coarse")
    sizes = placed.groupBy("_bucket").agg(F.sum("_copies").alias("_n"))
    offsets = _offsets(sizes, [], "_bucket", "_n", "_before").drop("_n")
    earlier = Window.partitionBy("_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_start", F.coalesce(F.sum("_copies").over(earlier), F.lit(0)))
    first = F.col("_before") + F.col("_start") + 1
    return within.join(offsets, "_bucket").select(*columns, F.explode(F.sequence(first, first + F.col("_copies") - 1)).alias(name))


def hashed_numbers(keys: DataFrame, columns: Sequence[str], name: str, digits: int = 3) -> DataFrame:
    """Dense 1..n for rows that differ in `columns`, ordered by (md5 prefix, columns).

    The prefix makes 16^digits even buckets whatever the keys look like; each bucket is ranked in
    its own task, by the columns themselves, and shifted by the sizes of the buckets before it.
    Deterministic, no sampling.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    bucketed = keys.withColumn("_bucket", F.substring(F.md5(text), 1, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = _offsets(sizes, [], "_bucket", "_n", "_before").drop("_n")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*columns))
    return (
        bucketed.withColumn("_rank", rank)
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_before") + F.col("_rank"))
        .drop("_bucket", "_rank", "_before")
    )
