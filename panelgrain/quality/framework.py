"""Rule registry, evaluation, result merge, reports and gates (DQ-F*, UDX-1)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.operators.conform import union_all
from panelgrain.operators.dedup import latest_per_key
from panelgrain.operators.filters import status_contains

# Result words and the result groups.
PASSED, FAILED = "PASSED", "FAILED"
GROUPS = {
    1: "tier 2 file structure",
    2: "tier 2 reference",
    3: "tier 2 information",
    4: "tier 2 business",
    5: "tier 1 file structure",
    6: "tier 1 reference",
    7: "tier 1 information",
    8: "tier 1 business",
    9: "tier 1 vendor reference",
}

Frames = dict[str, DataFrame]
RuleFunction = Callable[[Frames, dict], DataFrame]
# How many offences a row of the rule's first frame holds.
RowCount = Callable[[DataFrame, dict], Column]

RESULT = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("group_id", T.IntegerType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("offending", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class RepeatedKey:
    """Says that a rule reports repeated keys of its first frame, so all such rules of a table are found together.

    `keys` are the key's columns (none: the rule's parameter "keys"); with `known` a key with a null is no key;
    `rows` counts every row of a repeated key, else the key counts once.
    """

    keys: tuple[str, ...] = ()
    known: bool = False
    rows: bool = False


@dataclass(frozen=True)
class Rule:
    """A named check. `find` returns the offending rows; `word` narrows them by their status text."""

    rule_id: str
    name: str
    groups: tuple[int, ...]
    find: RuleFunction
    needs: tuple[str, ...]
    word: str | None = None
    defaults: dict = field(default_factory=dict)
    per_row: RowCount | None = None
    per_key: RepeatedKey | None = None

    def key_columns(self, params: dict) -> tuple[str, ...]:
        return self.per_key.keys or tuple({**self.defaults, **params}["keys"])

    def offending(self, frames: Frames, **params) -> DataFrame:
        missing = [n for n in self.needs if n not in frames]
        if missing:
            raise LookupError(f"rule {self.rule_id} needs {missing}")
        rows = self.find(frames, {**self.defaults, **params})
        return status_contains(rows, self.word) if self.word else rows


REGISTRY: dict[str, Rule] = {}


def rule(
    rule_id: str, name: str, groups: Iterable[int], needs: Iterable[str], word: str | None = None, per_row: RowCount | None = None, per_key: RepeatedKey | None = None, **defaults
):
    """Register a rule function; users add their own the same way.

    A rule that looks at one row at a time may give `per_row` as well, one that looks for repeated keys
    `per_key`: all such rules of a table are counted in one scan of it, keys of all rules in one shuffle.
    """

    def add(find: RuleFunction) -> RuleFunction:
        if rule_id in REGISTRY:
            raise ValueError(f"rule {rule_id} exists")
        REGISTRY[rule_id] = Rule(rule_id, name, tuple(groups), find, tuple(needs), word, defaults, per_row, per_key)
        return find

    return add


def rules_of(group: int, active: Iterable[str] | None = None) -> list[Rule]:
    """Rules of a group, narrowed to those a contract has switched on."""
    chosen = None if active is None else set(active)
    return [r for r in REGISTRY.values() if group in r.groups and (chosen is None or r.rule_id in chosen)]


def result_row(found: DataFrame, rule_: Rule, run_id: int, group: int, at: Column) -> DataFrame:
    """One result row per rule: PASSED when nothing offends, else FAILED, with the number of rows."""
    counted = found.agg(F.count("*").alias("offending"))
    return counted.select(
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(rule_.rule_id).alias("rule_id"),
        F.lit(group).alias("group_id"),
        F.lit(rule_.name).alias("rule_name"),
        F.when(F.col("offending") == 0, PASSED).otherwise(FAILED).alias("result"),
        "offending",
        at.alias("created_at"),
    )


def _grouped(rules: Sequence[Rule], frame: DataFrame, params: dict, sums: Sequence[Column] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """Rows per key of all the rules' keys at once, and for each rule the condition under which a row is a repeated key of it.

    GROUPING SETS: the table is read once, each row is repeated in memory for each different key with the key's columns
    only, counted before the shuffle and shuffled once. `sums` are added up over the whole table, in the set without columns.
    """
    keys = {r.rule_id: r.key_columns(params.get(r.rule_id, {})) for r in rules}
    columns = list(dict.fromkeys(c for own in keys.values() for c in own))
    sets = list(dict.fromkeys(tuple(c for c in columns if c in own) for own in keys.values()))
    number = lambda own: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in own)
    if sums:
        sets.append(())
    grouped = frame.groupingSets([[F.col(c) for c in own] for own in sets], *[F.col(c) for c in columns])
    counted = grouped.agg(F.grouping_id().alias("_set"), F.count("*").alias("_copies"), *sums)
    found = {}
    for r in rules:
        own = keys[r.rule_id]
        found[r.rule_id] = (F.col("_set") == number(own)) & (F.col("_copies") > 1)
        for c in own if r.per_key.known else ():
            found[r.rule_id] = found[r.rule_id] & F.col(c).isNotNull()
    return counted.withColumn("_whole", F.col("_set") == number(())), found


def _weight(r: Rule) -> Column:
    return F.col("_copies") if r.per_key.rows else F.lit(1).cast("long")


def _counted(rules: Sequence[Rule], frame: DataFrame, params: dict) -> DataFrame:
    """rule_id, rule_name, offending of row-wise and key rules of one table; one scan, keys shuffled once."""
    by_row = [r for r in rules if r.per_row is not None]
    by_key = [r for r in rules if r.per_row is None]
    rows = [F.sum(r.per_row(frame, {**r.defaults, **params.get(r.rule_id, {})})).alias(r.rule_id) for r in by_row]
    totals = [F.col(f"`{r.rule_id}`") for r in by_row]
    if by_key:
        frame, found = _grouped(by_key, frame, params, rows)
        rows = [F.sum(F.when(F.col("_whole"), total)).alias(r.rule_id) for r, total in zip(by_row, totals, strict=True)]
        rows += [F.sum(F.when(found[r.rule_id], _weight(r))).alias(r.rule_id) for r in by_key]
    named = [
        F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.name).alias("rule_name"), F.coalesce(F.col(f"`{r.rule_id}`").cast("long"), F.lit(0).cast("long")).alias("offending"))
        for r in [*by_row, *by_key]
    ]
    return frame.agg(*rows).select(F.explode(F.array(*named)).alias("r")).select("r.*")


def evaluate(rules: Sequence[Rule], frames: Frames, run_id: int, group: int, at: Column, **params) -> DataFrame:
    """Results of several rules as one frame.

    Rules that look at single rows or at repeated keys are counted together, one scan for each table; others have a plan each.
    """
    alone = [r for r in rules if (r.per_row is None and r.per_key is None) or r.needs[0] not in frames]
    parts = [result_row(r.offending(frames, **params.get(r.rule_id, {})), r, run_id, group, at) for r in alone]
    by_table: dict[str, list[Rule]] = {}
    for r in rules:
        if r not in alone:
            by_table.setdefault(r.needs[0], []).append(r)
    for table, together in by_table.items():
        rows = _counted(together, frames[table], params)
        word = F.when(F.col("offending") == 0, PASSED).otherwise(FAILED)
        parts.append(rows.select(F.lit(run_id).cast("long").alias("run_id"), "rule_id", F.lit(group).alias("group_id"), "rule_name", word.alias("result"), "offending", at.alias("created_at")))
    return union_all(parts)


def repeated(rules: Sequence[Rule], frame: DataFrame, **params) -> DataFrame:
    """rule_id, key (JSON of its columns, nulls left out), copies, offending: every repeated key of key rules of one table.

    One scan and one shuffle for all of the rules; see `RepeatedKey`.
    """
    counted, found = _grouped(rules, frame, params)
    hits = [
        F.when(found[r.rule_id], F.struct(F.lit(r.rule_id).alias("rule_id"), F.to_json(F.struct(*r.key_columns(params.get(r.rule_id, {})))).alias("key"), _weight(r).alias("offending")))
        for r in rules
    ]
    held = counted.where("_copies > 1").select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"), "_copies")
    return held.select("h.rule_id", "h.key", F.col("_copies").alias("copies"), "h.offending")


def evaluate_and_save(rules: Sequence[Rule], frames: Frames, run_id: int, group: int, at: Column, path: str, **params) -> DataFrame:
    """Results of several rules; what offends is stored and counted by the same tasks.

    Counts are metrics observed while the rows are written, so nothing is computed twice. Repeated keys of one table
    are written together, to <path>/<table>_keys/rule_id=...; the rows of any other rule to <path>/<rule id>.
    Everything of an earlier run below these folders is replaced.
    """
    spark = next(iter(frames.values())).sparkSession
    by_table: dict[str, list[Rule]] = {}
    counts: dict[str, int] = {}
    for r in rules:
        if r.per_key is not None and r.needs[0] in frames:
            by_table.setdefault(r.needs[0], []).append(r)
            continue
        seen = Observation(f"{r.rule_id}-{run_id}")
        r.offending(frames, **params.get(r.rule_id, {})).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/{r.rule_id}")
        counts[r.rule_id] = seen.get["rows"]
    for table, together in by_table.items():
        seen = Observation(f"{table}-{run_id}")
        sums = [F.sum(F.when(F.col("rule_id") == r.rule_id, F.col("offending"))).alias(r.rule_id) for r in together]
        repeated(together, frames[table], **params).observe(seen, *sums).write.mode("overwrite").partitionBy("rule_id").parquet(f"{path}/{table}_keys")
        counts |= {rule_id: n or 0 for rule_id, n in seen.get.items()}
    rows = [(run_id, r.rule_id, group, r.name, FAILED if counts[r.rule_id] else PASSED, counts[r.rule_id]) for r in rules]
    schema = T.StructType([f for f in RESULT.fields if f.name != "created_at"])
    return spark.createDataFrame(rows, schema).withColumn("created_at", at)


def save_details(rule_: Rule, frames: Frames, path: str, **params) -> None:
    """Offending rows of one rule, written by the tasks that find them."""
    rule_.offending(frames, **params).write.mode("overwrite").parquet(path)


def merge_results(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Results keyed by (run, rule): new rows replace stored ones."""
    keys = ["run_id", "rule_id"]
    return stored.join(new.select(*keys), keys, "left_anti").unionByName(new)


def latest_results(results: DataFrame) -> DataFrame:
    """Newest result per (run, rule)."""
    return latest_per_key(results, ["run_id", "rule_id"], "created_at", "result")


def fail_flags(results: DataFrame, keys: Sequence[str] = ("run_id", "group_id")) -> DataFrame:
    """Any-failed flag and overall word per key."""
    any_failed = F.bool_or(F.col("result") == FAILED)
    flagged = results.groupBy(*keys).agg(any_failed.alias("_any"))
    return flagged.select(
        *keys, F.when(F.col("_any"), "Y").otherwise("N").alias("failed"), F.when(F.col("_any"), FAILED).otherwise(PASSED).alias("overall")
    )


def summary(results: DataFrame, group_order: Sequence[int]) -> DataFrame:
    """Report rows: a heading per group in the tier's order, then its rules by outcome and name."""
    spark = results.sparkSession
    order = spark.createDataFrame([(g, i, GROUPS[g]) for i, g in enumerate(group_order)], "group_id int, position int, heading string")
    rows = results.join(order, "group_id").select("position", F.lit(1).alias("line"), F.col("rule_name").alias("text"), "result", "offending")
    heads = order.join(results.select("group_id").distinct(), "group_id", "left_semi").select(
        "position", F.lit(0).alias("line"), F.col("heading").alias("text"), F.lit(None).cast("string").alias("result"), F.lit(None).cast("long").alias("offending")
    )
    return heads.unionByName(rows).orderBy("position", "line", "result", "text")


def delivery_header(results: DataFrame, periods: DataFrame, run: dict) -> DataFrame:
    """One row per run: overall result, run facts, and its new and redelivered periods in order.

    Periods of one run are few, so the joined text is bounded by the calendar.
    """
    overall = fail_flags(results, ["run_id"]).select("run_id", "overall")

    def listed(flag: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col(flag) == "Y", F.col("period_end").cast("string")))), ", ")

    spans = periods.groupBy("run_id").agg(listed("is_new").alias("new_periods"), listed("is_redelivered").alias("redelivered_periods"))
    named = [F.lit(v).alias(k) for k, v in run.items()]
    return overall.join(spans, "run_id", "left").select("*", *named)


def gate(flags: DataFrame, approvals: DataFrame, master_switch: bool = True, active_rules: int = 1, business: bool = False) -> DataFrame:
    """PASS, APPROVED or BLOCKED per (run, group).

    A failed group passes when approved. The business gate also asks for auto-approval, and is open
    when the master switch is off or no rule is active.
    """
    joined = flags.join(approvals, ["run_id", "group_id"], "left")
    approved = F.coalesce(F.col("approved"), F.lit(False))
    auto = F.coalesce(F.col("auto_approved"), F.lit(False)) if business else F.lit(True)
    runs = F.lit(master_switch and active_rules > 0) if business else F.lit(True)
    status = (
        F.when(~runs, "PASS").when((F.col("failed") == "N") & auto, "PASS").when(approved, "APPROVED").otherwise("BLOCKED")
    )
    return joined.select("run_id", "group_id", "failed", status.alias("gate"))
