"""Delivery router (STR-1, STR-2): the same plan for a batch listing and a stream of arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelgrain.operators.lookup import like_hits

# Contract states that accept deliveries, and size limits in bytes.
ACTIVE_STATES = (2, 3)
SMALL_BELOW, MEDIUM_BELOW = 1 << 30, 3 << 30


def size_class(size: Column) -> Column:
    return F.when(size < SMALL_BELOW, "Small").when(size < MEDIUM_BELOW, "Medium").otherwise("Large")


def route(files: DataFrame, contracts: DataFrame) -> DataFrame:
    """Each file with exactly one matching contract is accepted with its job and size class; files with
    none or several matches are rejected.

    `files` holds name and size. Files meet only patterns that start like them, or end like them where a
    pattern starts with a wildcard (see `like_hits`). Matches are counted per name.
    """
    active = contracts.where(F.col("status").isin(*ACTIVE_STATES))
    rules = active.select(F.lower("file_pattern").alias("_pattern"), "contract_id", "job_id")
    names = files.select("name", F.lower("name").alias("_name")).distinct()
    hits = like_hits(names, rules, [], "_name", "_pattern")
    matched = hits.groupBy("name").agg(
        F.count("*").alias("matches"), F.min("contract_id").alias("contract_id"), F.min("job_id").alias("job_id")
    )
    one = F.col("matches") == 1
    return files.join(matched, "name", "left").select(
        *files.columns,
        F.coalesce("matches", F.lit(0)).alias("matches"),
        F.when(one, F.col("contract_id")).alias("contract_id"),
        F.when(one, F.col("job_id")).alias("job_id"),
        F.when(one, size_class(F.col("size"))).alias("size_class"),
        F.when(one, "accepted").otherwise("rejected").alias("decision"),
    )


def route_stream(arrivals: DataFrame, contracts: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Route arriving files into a parquet table, all that is there, then stop.

    Routing joins a batch with the contracts and counts matches per name, which is a plain batch
    plan, so each micro-batch runs it in foreachBatch. A batch writes its own folder and replaces it
    when repeated after a failure, so a file is routed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        route(batch, contracts).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# ---------------------------------------------------------------- arrivals that wait for a contract

DECIDED = "matches int, contract_id int, job_id int, size_class string, decision string"


def _decided(files: T.StructType, contracts: T.StructType) -> T.StructType:
    """Columns of a decision about a file: its own, then what `route` adds, with the contracts' types."""
    added = {"contract_id": contracts["contract_id"].dataType, "job_id": contracts["job_id"].dataType, "matches": T.LongType()}
    rest = [T.StructField(f.name, added.get(f.name, f.dataType)) for f in T.StructType.fromDDL(DECIDED)]
    return T.StructType([*files.fields, *rest])


def _newest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key, the newest; equal times go by the other values."""
    rest = [c for c in rows.columns if c not in (key, at)]
    newest = rows.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("_newest"))
    return newest.select(*[F.col(c) if c == key else F.col(f"_newest.{c}").alias(c) for c in rows.columns])


def route_arrivals(arrivals: DataFrame, contracts: DataFrame, folder: str, checkpoint: str, at: str = "arrived_at", changed: str = "changed_at", delay: str = "7 days") -> StreamingQuery:
    """Route a stream of files against a stream of contracts, all that is there, then stop.

    A name announced again within `delay` of its arrival time `at` is dropped by a watermark and
    `dropDuplicatesWithinWatermark`, so its state goes with the watermark; so is, uncounted in the tables but counted in the query's progress, an
    announcement older than the watermark: `at` has to be the time of the listing, and `delay` longer than a
    listing can be late. Contracts are added or replaced by `contract_id`, the newest `changed` wins.

    A file that is not accepted waits with its newest announcement and is routed again in each later batch, so it is accepted when
    its contract comes; an accepted one keeps its decision. Waiting files and current contracts are kept state: batch n
    reads slot n - 1 and overwrites slot n, modulo 2. A batch that is repeated after a failure thus reads what it
    read before and replaces its own rows; `folder` belongs to one `checkpoint`. Rows with a null name are never accepted
    and wait as one.
    """
    files, rules = arrivals.schema, contracts.schema
    decided = _decided(files, rules)
    first = arrivals.withWatermark(at, delay).dropDuplicatesWithinWatermark(["name"])
    events = first.select(F.struct(*first.columns).alias("file")).unionByName(contracts.select(F.struct(*contracts.columns).alias("contract")), allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, slot, before = batch.sparkSession, batch_id % 2, (batch_id + 1) % 2
        new, changes = batch.where("file IS NOT NULL").select("file.*"), batch.where("contract IS NOT NULL").select("contract.*")
        if batch_id:
            old = spark.read.schema(decided).parquet(f"{folder}/decided/slot={before}")
            new = new.unionByName(old.where("decision = 'rejected'").select(*files.names))
            changes = changes.unionByName(spark.read.schema(rules).parquet(f"{folder}/contracts/slot={before}"))
        _newest(changes, "contract_id", changed).write.mode("overwrite").parquet(f"{folder}/contracts/slot={slot}")
        now = spark.read.schema(rules).parquet(f"{folder}/contracts/slot={slot}")
        routed = route(_newest(new, "name", at), now).withColumn("batch_id", F.lit(batch_id).cast("long"))
        routed.write.mode("overwrite").parquet(f"{folder}/decided/slot={slot}")
        done = spark.read.schema(decided).parquet(f"{folder}/decided/slot={slot}")
        done.where("decision = 'accepted'").write.mode("overwrite").parquet(f"{folder}/accepted/batch_id={batch_id}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def accepted_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file accepted so far, with the batch that accepted it."""
    return spark.read.parquet(f"{folder}/accepted")


def waiting_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that wait for a contract, between two runs: the rejected rows of the last batch.

    A batch without any row follows only one that left none waiting, so the larger number is the last batch's.
    """
    both = spark.read.parquet(f"{folder}/decided")
    last = both.agg(F.max("batch_id")).scalar()
    return both.where((F.col("batch_id") == last) & (F.col("decision") == "rejected")).drop("slot", "batch_id")
