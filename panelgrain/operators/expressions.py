"""Stages of expressions from lookup rows (PRJ-7, PRJ-12, UDX-2): ordered by what they need, faults in one frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.spec import DEFAULT_CONTRACT, MAX_COLUMNS

REJECTED = "column_name string, expression string, reason string"


@dataclass(frozen=True)
class Staged:
    """Expressions in stages, each of which sees what the stages before it made, and those that cannot be applied."""

    stages: tuple[dict[str, str], ...]
    rejected: tuple[tuple[str, str, str], ...]

    def apply(self, df: DataFrame, cast: str | None = None) -> DataFrame:
        """One select a stage; replaced columns keep no old value, others stay."""
        for stage in self.stages:
            made = [F.expr(text) if cast is None else F.expr(text).cast(cast) for text in stage.values()]
            new = {name.lower() for name in stage}
            df = df.select(*[c for c in df.columns if c.lower() not in new], *[m.alias(n) for m, n in zip(made, stage, strict=True)])
        return df

    def faults(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rejected), REJECTED)


def expression_rows(lookup: DataFrame, name: str, contract_id: int) -> dict[str, str]:
    """column_name -> expression of the contract's own set, else of the default contract's, from rows of
    contract_id, set_name, column_name, expression. A set has a table's columns at most; more raise."""
    of_set = lookup.where((F.col("set_name") == name) & F.col("contract_id").isin(contract_id, DEFAULT_CONTRACT) & F.col("column_name").isNotNull())
    rows = of_set.select("contract_id", "column_name", "expression").distinct().limit(2 * MAX_COLUMNS + 1).collect()
    if len(rows) > 2 * MAX_COLUMNS:
        raise ValueError(f"over {MAX_COLUMNS} expressions in set {name!r}")
    own = [r for r in rows if r.contract_id == contract_id] or rows
    if not own:
        raise LookupError(f"no expressions named {name!r} for contract {contract_id} or {DEFAULT_CONTRACT}")
    found: dict[str, str] = {}
    for r in sorted(own, key=lambda r: (r.column_name.lower(), r.expression or "")):
        if r.column_name.lower() in {n.lower() for n in found}:
            raise ValueError(f"set {name!r} names the column {r.column_name!r} twice")
        found[r.column_name] = r.expression
    return found


def _needs(spark: SparkSession, text: str | None, known: dict[str, T.DataType]) -> tuple[set[str], str | None]:
    """Which of the known columns an expression reads, and why it cannot be applied, if so.

    Spark's analyzer says which column it misses; the column is added and the expression tried again, so there are
    as many tries as columns read. Columns yet to be made are of type null, which fits any use.
    """
    if text is None:
        return set(), "no expression"
    read: dict[str, T.DataType] = {}
    while True:
        frame = spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in read.items()] or [T.StructField("_none", T.LongType())]))
        try:
            frame.select(F.expr(text)).schema  # noqa: B018
            return set(read), None
        except ParseException:
            return set(read), "does not parse"
        except AnalysisException as error:
            condition = error.getCondition() or ""
            if not condition.startswith("UNRESOLVED_COLUMN"):
                return set(read), f"cannot be resolved: {condition}"
            missing = (error.getMessageParameters() or {}).get("objectName", "").lower()
            parts = [p.strip("`") for p in missing.split("`.`")]
            column = parts[0]
            if column not in known or column in read:
                return set(read), f"unknown column {column}"
            read[column] = known[column]


def _circle(start: str, needs: dict[str, set[str]]) -> list[str]:
    """The names of a circle that is reached from `start`, in order."""
    path, name = [], start
    while name not in path:
        path.append(name)
        name = min(n for n in needs[name] if n in needs)
    return path[path.index(name) :]


def stage_expressions(spark: SparkSession, expressions: dict[str, str], schema: T.StructType) -> Staged:
    """The fewest stages in which every expression finds what it reads.

    An expression that reads a column which another one makes comes after it; one that reads its own name reads
    the input. Expressions that do not parse or resolve, read an unknown column or run in a circle are
    rejected with the reason, as are those that need a rejected one; the others still apply. Column names are
    compared without case. Each name appears in one stage: 1 + the longest way to it.
    """
    inputs = {f.name.lower(): f.dataType for f in schema}
    made = {name.lower(): name for name in expressions}
    known = {**{name: T.NullType() for name in made}, **inputs}
    texts = {name.lower(): text for name, text in expressions.items()}
    reads, wrong = {}, {}
    for name, text in texts.items():
        usable = known if name in inputs else {k: t for k, t in known.items() if k != name}
        reads[name], fault = _needs(spark, text, {**usable, **{n: T.NullType() for n in made if n != name}})
        if fault:
            wrong[name] = fault
    needs = {name: {r for r in reads[name] if r in made and r != name} for name in texts}
    level: dict[str, int] = {}
    left = [name for name in texts if name not in wrong]
    while left:
        ready = [n for n in left if all(r in level for r in needs[n])]
        for n in ready:
            level[n] = 1 + max((level[r] for r in needs[n]), default=0)
        left = [n for n in left if n not in level]
        if left and not ready:
            broken = {n: sorted(r for r in needs[n] if r in wrong) for n in left}
            hit = {n: rs for n, rs in broken.items() if rs}
            if hit:
                wrong |= {n: f"needs {rs[0]}" for n, rs in hit.items()}
            else:
                inside = {n: {r for r in needs[n] if r in left} for n in left}
                circle = _circle(min(left), inside)
                wrong |= {n: "circle: " + " -> ".join([*circle[circle.index(n) :], *circle[: circle.index(n)], n]) for n in circle}
            left = [n for n in left if n not in wrong]
    stages = [{made[n]: texts[n] for n in texts if level.get(n) == k} for k in range(1, max(level.values(), default=0) + 1)]
    return Staged(tuple(stages), tuple((made[n], texts[n], wrong[n]) for n in sorted(wrong)))
