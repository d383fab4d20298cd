"""Publication: facts, change logs, run logs, retention, cleanup (PUB-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.operators.conform import conform, union_all
from panelgrain.operators.lookup import newest_change, not_logged
from panelgrain.operators.periods import retention_date
from panelgrain.sources.sinks import drop_before, drop_partitions, exists, staged, write_partitions

FACT_PARTITIONS = ("part_source_id", "part_contract_id", "part_period_end")


def with_fact_partitions(facts: DataFrame) -> DataFrame:
    """Typed copies of the three keys a fact table is partitioned by."""
    return facts.withColumns(
        {
            "part_source_id": F.col("source_id").cast("short"),
            "part_contract_id": F.col("contract_id").cast("long"),
            "part_period_end": F.col("period_end").cast("date"),
        }
    )


def touched_partitions(facts: DataFrame, keys: Sequence[str] = FACT_PARTITIONS) -> DataFrame:
    return facts.select(*keys).distinct()


def publish_facts(spark: SparkSession, facts: DataFrame, path: str, limits: DataFrame | None = None) -> DataFrame | None:
    """Replace exactly the delivered partitions, then drop what each contract no longer keeps.

    `limits` has source_id, contract_id and keep_from: every contract has a date of its own (see
    `retention_limits`), and only contracts it names lose partitions. The plan of `facts` runs once, for the write. Returns the
    removed partitions if there are limits.
    """
    write_partitions(with_fact_partitions(facts), path, FACT_PARTITIONS)
    if limits is None:
        return None
    named = limits.select(F.col("source_id").alias("part_source_id"), F.col("contract_id").alias("part_contract_id"), F.col("keep_from").cast("date").alias("keep_from"))
    return drop_before(spark, path, named, FACT_PARTITIONS[:2], "part_period_end", "keep_from", FACT_PARTITIONS)


def expire(spark: SparkSession, path: str, source_id: int, contract_id: int, keep_from: str) -> DataFrame:
    """Retention delete of one contract; returns the removed partitions."""
    old = (
        (F.col("part_source_id") == source_id)
        & (F.col("part_contract_id") == contract_id)
        & (F.col("part_period_end") < F.lit(keep_from).cast("date"))
    )
    return drop_partitions(spark, path, old, FACT_PARTITIONS)


def purge(spark: SparkSession, path: str, source_id: int, contract_id: int) -> DataFrame:
    """Remove every fact of a contract; returns the removed partitions."""
    mine = (F.col("part_source_id") == source_id) & (F.col("part_contract_id") == contract_id)
    return drop_partitions(spark, path, mine, FACT_PARTITIONS)


def retention_limits(facts: DataFrame, contracts: DataFrame) -> DataFrame:
    """First period end each contract keeps, from its latest delivered period."""
    latest = facts.groupBy("contract_id").agg(F.max("period_end").alias("latest_end"))
    kept = latest.join(contracts.select("contract_id", "class", "periods"), "contract_id")
    return kept.withColumn("keep_from", retention_date(F.col("latest_end"), F.col("class"), F.col("periods")))


def expired_partitions(facts: DataFrame, limits: DataFrame) -> DataFrame:
    """(contract, period end) pairs that retention removes, with their row counts.

    Pairs are counted before the join, so the join sees partitions, not rows.
    """
    parts = facts.groupBy("contract_id", "period_end").agg(F.count("*").alias("rows"))
    return parts.join(limits.select("contract_id", "keep_from"), "contract_id").where(F.col("period_end") < F.col("keep_from"))


# ---------------------------------------------------------------- change logs


def _values(keys: Sequence[str]) -> Column:
    """Partition values as an array of (name, value)."""
    pairs = [F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("value")) for k in keys]
    return F.array(*pairs).alias("partitions")


def log_of_publisher(published: DataFrame, keys: Sequence[str], run_id: int, at: Column) -> DataFrame:
    """(run, partition values, time) per partition of a published frame; missing columns are an error."""
    missing = [k for k in keys if k not in published.columns]
    if missing:
        raise ValueError(f"published frame has no {missing}")
    return published.select(*keys).distinct().select(F.lit(run_id).cast("long").alias("run_id"), _values(keys), at.alias("changed_at"))


def log_of_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(version, partition values, time) per change of a row-change feed."""
    return changes.select("version", *keys, "changed_at").distinct().select("version", _values(keys), "changed_at")


COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("add", T.StructType([T.StructField("partitionValues", T.MapType(T.StringType(), T.StringType())), T.StructField("modificationTime", T.LongType())])),
        T.StructField("remove", T.StructType([T.StructField("partitionValues", T.MapType(T.StringType(), T.StringType())), T.StructField("deletionTimestamp", T.LongType())])),
    ]
)


def log_of_commits(commits: DataFrame) -> DataFrame:
    """(partition values, newest add or remove time) from commit-log rows.

    A map cannot be grouped, so its sorted entries are the key; no Python function is needed.
    """
    def entries(c: str) -> Column:
        as_pairs = F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
        return F.array_sort(as_pairs).alias("partitions")

    adds = commits.where("add IS NOT NULL").select(entries("add.partitionValues"), F.col("add.modificationTime").alias("at"))
    removes = commits.where("remove IS NOT NULL").select(entries("remove.partitionValues"), F.col("remove.deletionTimestamp").alias("gone"))
    newest = newest_change(adds, removes, ["partitions"], "at", "gone", "millis")
    return newest.select("partitions", F.timestamp_millis("millis").alias("changed_at"))


def partition_log(
    run_id: int, at: Column, keys: Sequence[str], published: DataFrame | None = None, changes: DataFrame | None = None, commits: DataFrame | None = None
) -> DataFrame:
    """Log rows from the first source there is: the published frame, a change feed, the commit log."""
    if published is not None:
        return log_of_publisher(published, keys, run_id, at)
    if changes is not None:
        source = log_of_changes(changes, keys).drop("version")
    elif commits is not None:
        source = log_of_commits(commits)
    else:
        raise ValueError("no source for the partition log")
    return source.select(F.lit(run_id).cast("long").alias("run_id"), "partitions", "changed_at")


# ---------------------------------------------------------------- run logs


def log_run(rows: DataFrame, log: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Rows shaped like the log, for runs (and keys) that it does not hold yet."""
    return not_logged(conform(rows, log.schema), log, keys)


def delivered_measures(in_use: DataFrame, delivered: DataFrame, run_id: int) -> DataFrame:
    """Measures of a run; those in use that were not delivered are flagged as calculated."""
    seen = delivered.select("measure_id").distinct().withColumn("_seen", F.lit(True))
    flagged = in_use.select("measure_id").distinct().join(seen, "measure_id", "left")
    return flagged.select(
        F.lit(run_id).cast("long").alias("run_id"), "measure_id", F.when(F.col("_seen"), "N").otherwise("Y").alias("calculated")
    )


# Key columns of the four logs that list what a delivery holds.
RUN_LOGS = {
    "periods": ("period_id", "period_end"),
    "partitions": ("contract_id", "period_end"),
    "markets": ("market_key",),
    "products": ("product_key",),
}
MEASURES = "measures"
MOST_MEASURES = 2000


def run_log_rows(delivery: DataFrame, logs: dict[str, Sequence[str]], measures: DataFrame, run_id: int) -> DataFrame:
    """What every run log has to say of a delivery, from one scan and one shuffle of it.

    One row per log and entry: `log`, `run_id`, the key columns of all logs (null where a log has none of them),
    `measure_id` and `calculated`. GROUPING SETS give the distinct keys of all logs at once, combined in each task before the
    shuffle; the set without keys counts the filled cells of each measure column. `measures` has measure_id and column, the measures in use:
    one without a filled cell, or without a column in the delivery, was not delivered and is flagged as calculated. Their list comes to the driver; more than 2000 raise. A null key is an entry like others; an
    empty delivery still logs its measures.
    """
    found = measures.select("measure_id", "column").distinct().limit(MOST_MEASURES + 1).collect()
    if len(found) > MOST_MEASURES:
        raise ValueError(f"more than {MOST_MEASURES} measures in use")
    keys = list(dict.fromkeys(k for columns in logs.values() for k in columns))
    filled = {c: F.count(c).alias(f"_n{i}") for i, c in enumerate(sorted({m.column for m in found} & set(delivery.columns)))}
    names = list(logs)
    # The place of a log in the order of bits that grouping_id gives: a bit is set for a key column left out.
    bits = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in logs[name]) for name in names}
    if len(set(bits.values())) < len(names):
        raise ValueError("two logs have the same key columns")
    sets = [[F.col(k) for k in logs[name]] for name in names] + [[]]
    # One row of nulls keeps the set without keys when a delivery is empty; it is no entry of a log.
    read = delivery.select(*dict.fromkeys([*keys, *filled]), F.lit(1).alias("_row"))
    read = read.unionByName(delivery.sparkSession.range(1).select(), allowMissingColumns=True)
    grouped = read.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.grouping_id().alias("_set"), F.count("_row").alias("_rows"), *filled.values())
    grouped = grouped.where(f"_rows > 0 OR _set = {(1 << len(keys)) - 1}")
    which = F.when(F.col("_set") == (1 << len(keys)) - 1, MEASURES)
    for name in names:
        which = which.when(F.col("_set") == bits[name], name)
    measure = T.StructType([T.StructField("measure_id", measures.schema["measure_id"].dataType), T.StructField("calculated", T.StringType())])
    flags = [F.struct(F.lit(m.measure_id), _calculated(F.col(f"_n{list(filled).index(m.column)}") if m.column in filled else F.lit(0))).cast(measure) for m in found]
    listed = F.when(which != MEASURES, F.array(F.lit(None).cast(measure))).otherwise(F.array(*flags).cast(T.ArrayType(measure)))
    return grouped.select(which.alias("log"), F.lit(run_id).cast("long").alias("run_id"), *keys, F.explode(listed).alias("_measure")).select("log", "run_id", *keys, "_measure.*")


def _calculated(filled: Column) -> Column:
    return F.when(filled > 0, "N").otherwise("Y")


def append_logs(spark: SparkSession, rows: DataFrame, base: str, run_id: int) -> None:
    """Append to the run logs below `base` what they do not hold yet of this run; safe to repeat.

    Logs are partitions of one table, by log and run, so all are written by one job and only
    this run's entries are read. Entries are compared null-safe over all columns. One writer a run at a time.
    """
    by = ["log", "run_id"]
    held = read_logs(spark, base, rows.schema).where(F.col("run_id") == run_id)
    other = held.select(*[F.col(c).alias(f"_{c}") for c in held.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in held.columns]
    fresh = staged(rows.join(other, same, "left_anti"), "run-log")
    write_partitions(fresh, base, by, mode="append")


def read_logs(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All run logs as one frame; a table that is not there yet is empty."""
    return spark.read.schema(schema).parquet(base) if exists(spark, base) else spark.createDataFrame([], schema)


def read_log(spark: SparkSession, base: str, name: str, logs: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One run log with its own columns."""
    columns = ("measure_id", "calculated") if name == MEASURES else (logs or RUN_LOGS)[name]
    return spark.read.parquet(base).where(F.col("log") == name).select(F.col("run_id").cast("long").alias("run_id"), *columns)


# ---------------------------------------------------------------- cleanup


def used_keys(facts: Sequence[DataFrame], key: str) -> DataFrame:
    """Distinct dimension keys used by the facts of any class; each class is reduced before the union."""
    return union_all([f.select(key).distinct() for f in facts]).distinct()


def orphan_keys(dimensions: Sequence[DataFrame], facts: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys of the dimensions that no fact uses."""
    return used_keys(dimensions, key).join(used_keys(facts, key), key, "left_anti")


def without_orphans(dimension: DataFrame, orphans: DataFrame, key: str) -> DataFrame:
    return dimension.join(orphans, key, "left_anti")


def expired_runs(runs: DataFrame, now: str, days: int) -> DataFrame:
    """Runs that ended more than `days` before now."""
    return runs.where(F.col("ended_at") < F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))


def failed_files(files: DataFrame, runs: DataFrame, status: str = "FAILED") -> DataFrame:
    """Files whose name carries the id of a failed run."""
    failed = runs.where(F.col("status") == status).select("run_id").distinct()
    return files.join(failed, "run_id", "left_semi")
