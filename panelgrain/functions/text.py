"""Text column helpers: null-safe parsing, code paths, character checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts vendors send for "no measurement".
NOT_AVAILABLE = ("", "NA", "N/A", "N.A.")

MEASURE_TYPE = "decimal(38,10)"


def lead_zero(col: Column) -> Column:
    """`.5` and `,5` become `0.5` and `0,5`; other texts are kept."""
    return F.when(F.substring(col, 1, 1).isin(".", ","), F.concat(F.lit("0"), col)).otherwise(col)


def parse_measure(col: Column, to: str = MEASURE_TYPE) -> Column:
    """Measure text to decimal; "not available" and unparsable texts become null.

    Blanks and markers are ruled out by comparison first: they are frequent, and a failed parse
    costs far more than a comparison. A leading separator needs no zero here: the parser takes `.5`;
    a text with a comma is no number.
    """
    return F.when(~F.trim(col).isin(*NOT_AVAILABLE), col).try_cast(to)


def is_bad_measure(col: Column, to: str = MEASURE_TYPE) -> Column:
    """True where a text is present, is not a "not available" marker, and does not parse."""
    text = F.trim(col)
    return col.isNotNull() & ~F.upper(text).isin(*NOT_AVAILABLE) & parse_measure(col, to).isNull()


def path_depth(path: Column) -> Column:
    """Number of space-separated codes in a path."""
    return F.size(F.split(path, " "))


def path_prefix(path: Column, depth: int | Column) -> Column:
    """The first `depth` codes of a path; a shorter path is returned whole."""
    if isinstance(depth, int):
        return F.substring_index(path, " ", depth)
    return F.array_join(F.slice(F.split(path, " "), F.lit(1), depth), " ")


def path_parent(path: Column) -> Column:
    """The path without its last code; null for a path of one code."""
    cut = F.length(path) - F.length(F.substring_index(path, " ", -1)) - 1
    return F.when(cut > 0, path.substr(F.lit(1), cut))


def has_non_ascii(col: Column) -> Column:
    """True where the text holds a character outside the 7-bit range."""
    return ~col.rlike(r"^[\x00-\x7F]*$")


def collapse_colons(col: Column) -> Column:
    """Trim blanks and reduce runs of `:` to one, without any at the ends."""
    return F.regexp_replace(F.regexp_replace(F.trim(col), r"\s*:[\s:]*", ":"), r"^:|:$", "")
