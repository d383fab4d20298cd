"""Row predicates (FLT-*)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrain.functions.text import has_non_ascii


def keep_any_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where at least one of the columns is not null."""
    return df.where(reduce(or_, [F.col(c).isNotNull() for c in columns]))


def by_record_letter(df: DataFrame, letter: str, line: str = "value") -> DataFrame:
    return df.where(F.col(line).startswith(letter))


def by_record_code(df: DataFrame, code: str, line: str = "value") -> DataFrame:
    """Two-character record code at position 7."""
    return df.where(F.substring(line, 7, 2) == code)


def is_fact_line(line: Column, width: int = 65) -> Column:
    """True where the first `width` characters, trimmed, are still that long and hold no space."""
    head = F.trim(F.substring(line, 1, width))
    return (F.length(head) == width) & (F.instr(head, " ") == 0)


def drop_tag_rows(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Keep rows where every key column is present and differs from its header word."""
    return df.where(reduce(and_, [F.col(name) != tag for name, tag in tags.items()]))


def bad_ascii_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(has_non_ascii(F.col(column)))


def status_contains(df: DataFrame, word: str, column: str = "status") -> DataFrame:
    return df.where(F.lower(F.col(column)).contains(word.lower()))


def within_months(df: DataFrame, column: str, as_of: str, months: int = 62) -> DataFrame:
    """Dates at or after the first of the as-of month minus `months`."""
    return df.where(F.col(column) >= F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), -months))


def not_listed(df: DataFrame, listed: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is absent from a metadata list."""
    return df.join(listed, on, "left_anti")


def safe_identifier(name: str) -> str:
    """A name usable in generated SQL, else an error."""
    if not re.fullmatch(r"[A-Za-z0-9_.]+", name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def split_assigned(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the key, rows without it)."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
