"""Unpivots, metadata pivots and multi-line stitching (RSH-*)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.functions.text import NOT_AVAILABLE, has_non_ascii, lead_zero, parse_measure
from panelgrain.spec import MAX_MEASURES


def unpivot_header(header: DataFrame, skip: int = 3) -> DataFrame:
    """Header row(s) to (position, measure code); the key columns are left out."""
    names = header.columns[skip:]
    return (
        header.unpivot([], [F.col(n) for n in names], "column", "measure_code")
        .withColumn("position", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("column")).cast("int"))
        .select("position", "measure_code")
        .where(F.col("measure_code").isNotNull())
    )


def pivot_by_metadata(
    df: DataFrame, names: Sequence[str], codes: Sequence[str], wanted: Sequence[str], prefix: str = ""
) -> DataFrame:
    """For each wanted attribute name: the code at whichever level carries that name.

    `names[i]` and `codes[i]` are the level's name and code columns. One select, no shuffle; wanted
    names are sorted so that the schema does not depend on the order of the metadata.
    """

    def at_any_level(attribute: str):
        return F.coalesce(*[F.when(F.col(n) == attribute, F.col(c)) for n, c in zip(names, codes)])

    return df.select("*", *[at_any_level(w).alias(f"{prefix}{w}") for w in sorted(wanted)])


def stitch_lines(
    facts: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slots: Sequence[str],
    measures: Sequence[int] = tuple(range(1, MAX_MEASURES + 1)),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Physical lines of 20 slots to one row per record; `keep` columns come from the first line.

    Measure k sits on the record's line ceil(k/20) in slot ((k-1) mod 20)+1. Lines are ranked per
    record; ranks beyond the last line that can hold a measure carry none (`surplus_lines` returns them), so
    the rank is bounded and every task keeps at most five lines of a record before the shuffle. The
    first line then looks ahead to the others in the same sorted partition: one shuffle, one sort.
    Texts are shuffled and only the cells that hold a measure are parsed.

    Whether a line has any measure is told before the sort, by the first of its texts that parses. So the slots
    that only this question needs, those of measures the caller drops, are neither shuffled nor sorted.
    """
    width = len(slots)
    last_line = (max(measures) - 1) // width + 1
    in_record = Window.partitionBy(*keys).orderBy(*order)
    wanted = [[slots[(k - 1) % width] for k in sorted(measures) if (k - 1) // width + 1 == i] for i in range(1, last_line + 1)]
    # Lines with the same wanted slots, all but the last one as a rule, share a column.
    kinds = sorted({tuple(w) for w in wanted if w})
    # A loop over the texts, not a test written out for each: the generated method would be too long for the JVM to compile.
    given = [F.exists(F.array(*kind), lambda text: parse_measure(text).isNotNull()).alias(f"_given_{j}") for j, kind in enumerate(kinds)]
    used = sorted({s for w in wanted for s in w}, key=list(slots).index)
    lines = facts.select(*keys, *[o for o in order if o not in keys], *keep, *[F.col(s).alias(f"_slot_{s}") for s in used], *given)
    ranked = lines.withColumn("_rank", F.row_number().over(in_record)).where(F.col("_rank") <= last_line)

    def ahead(column: str, line: int) -> Column:
        return (F.lead(column, line - 1).over(in_record) if line > 1 else F.col(column)).alias(f"{column}_line_{line}")

    cells = [ahead(f"_slot_{s}", i) for i, w in enumerate(wanted, 1) for s in w]
    marks = [ahead(f"_given_{kinds.index(tuple(w))}", i) for i, w in enumerate(wanted, 1) if w]
    records = ranked.select(*keys, *keep, "_rank", *cells, *marks).where("_rank = 1")
    has_any = reduce(or_, [F.coalesce(F.col(f"_given_{kinds.index(tuple(w))}_line_{i}"), F.lit(False)) for i, w in enumerate(wanted, 1) if w])

    def measure(k: int):
        text = F.col(f"_slot_{slots[(k - 1) % width]}_line_{(k - 1) // width + 1}")
        return parse_measure(text).alias(f"measure_{k}")

    return records.where(has_any).select(*keys, *keep, *[measure(k) for k in measures])


def surplus_lines(
    facts: DataFrame, keys: Sequence[str], order: Sequence[str], slots: Sequence[str], measures: Sequence[int] = tuple(range(1, MAX_MEASURES + 1))
) -> DataFrame:
    """The physical lines that `stitch_lines` has no place for, with their rank in the record.

    Records are counted first, so only those with too many lines are sorted.
    """
    last_line = (max(measures) - 1) // len(slots) + 1
    full = facts.groupBy(*keys).agg(F.count("*").alias("_lines")).where(F.col("_lines") > last_line).select(*keys)
    same = [facts[k].eqNullSafe(full[k]) for k in keys]
    ranked = facts.join(full, same, "left_semi").withColumn("line_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("line_rank") > last_line)


def clean_delimited_facts(facts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Leading-separator texts get a zero, measures become decimals, rows without any text go.

    A row whose texts are no numbers, such as `0,5`, stays with nulls; DQ-01 lists such cells.
    """
    given = facts.where(F.coalesce(*[F.when(~F.upper(F.trim(F.col(m))).isin(*NOT_AVAILABLE), True) for m in measures], F.lit(False)))
    return given.withColumns({m: parse_measure(lead_zero(F.trim(F.col(m)))) for m in measures})


def explode_list(df: DataFrame, column: str, name: str, sep: str = ",") -> DataFrame:
    return df.withColumn(name, F.explode(F.split(column, sep)))


def bad_values(df: DataFrame, ids: Sequence[str], columns: Sequence[str], is_bad: Callable[[Column], Column]) -> DataFrame:
    """One row per (column, value) cell that is bad. The cells of a row are tested in place; only bad ones become rows."""
    cells = [F.when(is_bad(F.col(c)), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))) for c in columns]
    if not cells:
        return df.select(*ids, F.lit("").alias("column_name"), F.lit("").alias("value")).where(F.lit(False))
    found = df.select(*ids, F.explode(F.array_compact(F.array(*cells))).alias("_cell"))
    return found.select(*ids, "_cell.column_name", "_cell.value")


def bad_cells(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per (column, value) cell with a non-ASCII character; string columns only."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ids]
    return bad_values(df, ids, texts, has_non_ascii)
