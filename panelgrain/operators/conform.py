"""Column maps, projections and schema conformance (MAP-*, PRJ-*). Every operator is one projection."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.functions.text import collapse_colons
from panelgrain.spec import DEFAULT_CONTRACT, MAX_MEASURES, ContractSpec, ExpressionSet

# ---------------------------------------------------------------- column names


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


# ---------------------------------------------------------------- column maps


def map_rows(column_map: DataFrame, dimension: str) -> DataFrame:
    """Distinct (file column, target column) rows of the dimensions whose name matches a pattern."""
    return column_map.where(F.col("dimension").rlike(dimension)).select("file_column", "target_column").distinct()


def targets_per_column(rows: DataFrame) -> DataFrame:
    """One row per file column with its sorted, comma-joined targets.

    A set is collected, so a column repeated in the map does not grow the group.
    """
    targets = F.array_sort(F.collect_set("target_column"))
    return rows.groupBy("file_column").agg(F.array_join(targets, ",").alias("targets"))


def read_map(rows: DataFrame) -> dict[str, list[str]]:
    """The map as a dict. A map names columns of one file, so it is bounded by the file's width."""
    found: dict[str, list[str]] = defaultdict(list)
    for row in targets_per_column(rows).orderBy("file_column").collect():
        found[row.file_column.strip()] = row.targets.split(",")
    return dict(found)


def apply_map(df: DataFrame, targets: dict[str, Sequence[str]]) -> DataFrame:
    """Rename mapped columns, copy one column to each of its targets, drop unmapped columns."""
    by_name = {c.strip().lower(): c for c in df.columns}
    picked = [
        F.col(f"`{by_name[source.lower()]}`").alias(target.lower())
        for source, names in targets.items()
        if source.lower() in by_name
        for target in names
    ]
    return df.select(*picked)


def drop_unmapped(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    wanted = {k.lower() for k in keep}
    return df.select(*[c for c in df.columns if c.lower() in wanted])


def drop_null_measures(df: DataFrame, measures: Sequence[str], how: str = "any") -> DataFrame:
    """Drop rows with a null in any (or in all) of the measures that are present."""
    present = [m for m in measures if m in df.columns]
    return df.dropna(how=how, subset=present) if present else df


def join_parts(df: DataFrame, clean: bool = False) -> DataFrame:
    """Join numbered columns `x#1`, `x#2`, ... to one `:`-separated column `x`, in number order."""
    parts: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for c in df.columns:
        found = re.fullmatch(r"(.+)#(\d+)", c)
        if found:
            parts[found.group(1)].append((int(found.group(2)), c))
    numbered = {c for group in parts.values() for _, c in group}
    joined = []
    for base, group in parts.items():
        text = F.concat_ws(":", *[F.col(f"`{c}`") for _, c in sorted(group)])
        joined.append((collapse_colons(text) if clean else text).alias(base))
    return df.select(*[c for c in df.columns if c not in numbered], *joined)


def finish_load(df: DataFrame, kind: str, market_column: str = "market_code") -> DataFrame:
    """Facts keep duplicates and get clean market ids; the other files become distinct."""
    if kind != "fact":
        return df.distinct()
    return df.withColumn(market_column, collapse_colons(F.col(market_column)))


def load_mapped(df: DataFrame, targets: dict[str, Sequence[str]], kind: str, measures: Sequence[str] = ()) -> DataFrame:
    """The contract-mapped load as one plan: map, join parts, null filter, lower names, finish."""
    mapped = lower_names(join_parts(apply_map(trim_names(df), targets), clean=kind == "market"))
    if kind != "fact":
        mapped = drop_null_measures(mapped, measures)
    return finish_load(mapped, kind)


# ---------------------------------------------------------------- conformance


def conform(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns, order and types of `target`: add missing as null, drop extra, cast the rest."""
    by_name = {c.lower(): c for c in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        source = by_name.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        col = F.col(f"`{source}`")
        if types[source] == field.dataType:
            return col.alias(field.name)
        if isinstance(types[source], T.StringType):
            return col.try_cast(field.dataType).alias(field.name)
        return col.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in target.fields])


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def empty_like(df: DataFrame) -> DataFrame:
    """A typed frame without rows."""
    return df.sparkSession.createDataFrame([], df.schema)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pad_measures(df: DataFrame, prefix: str = "measure_", to: str = "decimal(38,10)") -> DataFrame:
    """Typed nulls for the measures 1..100 that are absent; measures come last, in order."""
    names = [f"{prefix}{i}" for i in range(1, MAX_MEASURES + 1)]
    rest = [c for c in df.columns if c not in names]
    have = set(df.columns)
    padded = [(F.col(n) if n in have else F.lit(None)).cast(to).alias(n) for n in names]
    return df.select(*rest, *padded)


def add_partition_columns(df: DataFrame, contract: ContractSpec) -> DataFrame:
    """Typed copies of the source system and contract that the writer partitions by."""
    return df.withColumns(
        {
            "part_source_id": F.lit(contract.source_id).cast("short"),
            "part_contract_id": F.lit(contract.contract_id).cast("long"),
        }
    )


def add_security_key(df: DataFrame, keys: DataFrame, on: str = "contract_id", default: str = "public") -> DataFrame:
    """Row-security key of the contract, else the default one."""
    own = keys.select(on, F.col("security_key").alias("_key"))
    return df.join(own, on, "left").withColumn("security_key", F.coalesce("_key", F.lit(default))).drop("_key")


def minus(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def fill_placeholders(df: DataFrame, text: str, into: str, marker: str, sentinel: str) -> DataFrame:
    """Date text with a sentinel where the text says "not applicable"."""
    value = F.trim(F.col(text))
    return df.withColumn(into, F.date_format(F.when(value == marker, F.lit(sentinel)).otherwise(value).try_cast("date"), "yyyy-MM-dd"))


# ---------------------------------------------------------------- expressions


def choose_expressions(sets: Sequence[ExpressionSet], name: str, contract_id: int) -> ExpressionSet:
    """The contract's own set, else that of the default contract."""
    for wanted in (contract_id, DEFAULT_CONTRACT):
        for candidate in sets:
            if candidate.name == name and candidate.contract_id == wanted:
                return candidate
    raise LookupError(f"no expressions named {name!r} for contract {contract_id} or {DEFAULT_CONTRACT}")


def apply_expressions(df: DataFrame, chosen: ExpressionSet) -> DataFrame:
    """Replace or add the set's columns; every expression sees the input columns."""
    kept = [F.col(c) for c in df.columns if c not in chosen.columns]
    made = [F.expr(text).alias(c) for c, text in chosen.columns.items()]
    return df.select(*kept, *made)
