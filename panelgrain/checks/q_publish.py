"""Publication, change logs, cleanup and routing (PUB-*, STR-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelgrain.checks import panel as P
from panelgrain.checks.q_io import FACT_TYPES, commit_rows, stored_facts
from panelgrain.checks.registry import query
from panelgrain.operators import conform as C
from panelgrain.plans import publish as PUB
from panelgrain.session import scratch_path
from panelgrain.streaming import router as ST

SHOWN = ["contract_id", "market_key", "product_key", "period_end", "volume"]
AS_BIGINT = "contract_id::BIGINT AS contract_id, market_key::BIGINT AS market_key, product_key, period_end"


@query(
    "pub01_publish_facts",
    f"""SELECT {AS_BIGINT}, CASE WHEN year(period_end) = 1998 THEN volume + 1 ELSE volume END AS volume FROM facts
        WHERE contract_id NOT IN (2, 3) OR period_end >= CASE contract_id WHEN 2 THEN DATE '1997-01-01' ELSE DATE '1996-06-01' END""",
    (P.SALES, P.FACTS),
)
def pub01(spark, d):
    """Redelivers a year of all contracts; two of them keep from different dates on."""
    path = stored_facts(spark, d)
    again = P.facts(spark, d).where("year(period_end) = 1998").withColumn("volume", F.col("volume") + 1)
    limits = spark.createDataFrame([(4, 2, "1997-01-01"), (4, 3, "1996-06-01")], "source_id int, contract_id int, keep_from string")
    PUB.publish_facts(spark, C.cast_all(again, FACT_TYPES), path, limits)
    return spark.read.parquet(path).select(*SHOWN)


PARTS = "SELECT DISTINCT contract_id, period_end FROM facts"


def flat(log):
    """Partition values as `name=value` text, to compare with SQL."""
    text = F.array_join(F.transform("partitions", lambda p: F.concat(p["name"], F.lit("="), p["value"])), "/")
    return log.withColumn("partitions", text)


@query("pub02_log_of_publisher", "SELECT DISTINCT CAST(7 AS BIGINT) AS run_id, 'contract_id=' || contract_id || '/period_end=' || period_end AS partitions, '2024-01-01' AS changed_on FROM facts", (P.SALES, P.FACTS))
def pub02(spark, d):
    log = PUB.log_of_publisher(P.facts(spark, d), ["contract_id", "period_end"], 7, F.lit("2024-01-01").cast("timestamp"))
    return flat(log).select("run_id", "partitions", F.date_format("changed_at", "yyyy-MM-dd").alias("changed_on"))


@query("pub03_log_of_changes", "SELECT DISTINCT run_id AS version, 'contract_id=' || contract_id || '/period_end=' || period_end AS partitions, run_id * 10 AS changed_at FROM deliveries", (P.SALES, P.DELIVERIES))
def pub03(spark, d):
    feed = P.deliveries(spark, d).select(F.col("run_id").alias("version"), "contract_id", "period_end", (F.col("run_id") * 10).alias("changed_at"))
    return flat(PUB.log_of_changes(feed, ["contract_id", "period_end"]))


COMMITS = """SELECT 'contract_id=' || contract_id || '/period_end=' || period_end AS partitions, CAST(max(run_id) * 1000 + CASE WHEN month(period_end) <= 6 THEN 5 ELSE 0 END AS BIGINT) AS millis
  FROM deliveries GROUP BY contract_id, period_end"""


@query("pub04_log_of_commits", COMMITS, (P.SALES, P.DELIVERIES))
def pub04(spark, d):
    path = scratch_path(spark, "commit-log")
    commit_rows(spark, d).write.json(path)
    log = PUB.log_of_commits(spark.read.schema(PUB.COMMIT_SCHEMA).json(path))
    return flat(log).select("partitions", F.unix_millis("changed_at").alias("millis"))


@query("pub05_log_source", COMMITS.replace("SELECT ", "SELECT CAST(7 AS BIGINT) AS run_id, ", 1), (P.SALES, P.DELIVERIES))
def pub05(spark, d):
    path = scratch_path(spark, "commit-source")
    commit_rows(spark, d).write.json(path)
    log = PUB.partition_log(7, F.lit("2024-01-01").cast("timestamp"), ["contract_id", "period_end"], commits=spark.read.schema(PUB.COMMIT_SCHEMA).json(path))
    return flat(log).select("run_id", "partitions", F.unix_millis("changed_at").alias("millis"))


@query(
    "pub06_run_log",
    "SELECT CAST(run_id AS BIGINT) AS run_id, CAST(contract_id AS BIGINT) AS contract_id, period_end, CAST(NULL AS VARCHAR) AS note FROM deliveries WHERE run_id > 1998",
    (P.SALES, P.DELIVERIES),
)
def pub06(spark, d):
    rows = P.deliveries(spark, d)
    log = C.conform(rows.where("run_id <= 1998"), spark.createDataFrame([], "run_id long, contract_id long, period_end date, note string").schema)
    return PUB.log_run(rows, log)


@query("pub06_delivered_measures", "SELECT CAST(7 AS BIGINT) AS run_id, p_size AS measure_id, CASE WHEN p_size IN (SELECT p_size FROM part WHERE p_brand = 'Brand#5' AND p_type = 'SMALL') THEN 'N' ELSE 'Y' END AS calculated FROM (SELECT DISTINCT p_size FROM part)")
def pub06_measures(spark, d):
    part = P.table(spark, d, "part")
    used = part.select(F.col("p_size").alias("measure_id"))
    delivered = part.where("p_brand = 'Brand#5' AND p_type = 'SMALL'").select(F.col("p_size").alias("measure_id"))
    return PUB.delivered_measures(used, delivered, 7)


DELIVERED = """run AS (SELECT CAST(7 AS BIGINT) AS run_id), delivered AS (SELECT * FROM facts WHERE contract_id <> 2), held AS (SELECT * FROM facts WHERE contract_id = 3)"""


def run_logs_of(kind):
    """Log of one kind after a delivery whose run had partly been logged, and was logged twice."""

    def run(spark, d):
        base = scratch_path(spark, "run-logs")
        facts = P.facts(spark, d).where("contract_id <> 2").select("contract_id", "market_key", "product_key", "period_id", "period_end", "volume", "value", F.lit(None).cast("double").alias("price"))
        measures = spark.createDataFrame([(1, "volume"), (2, "value"), (3, "price")], "measure_id int, column string")
        part = PUB.run_log_rows(facts.where("contract_id = 3"), PUB.RUN_LOGS, measures, 7)
        PUB.append_logs(spark, part, base, 7)
        for _ in range(2):
            PUB.append_logs(spark, PUB.run_log_rows(facts, PUB.RUN_LOGS, measures, 7), base, 7)
        return PUB.read_log(spark, base, kind)

    return run


for _kind, _sql in {
    "periods": "SELECT DISTINCT run_id, period_id, period_end FROM run, delivered",
    "partitions": "SELECT DISTINCT run_id, contract_id, period_end FROM run, delivered",
    "markets": "SELECT DISTINCT run_id, market_key FROM run, delivered",
    "products": "SELECT DISTINCT run_id, product_key FROM run, delivered",
    "measures": "SELECT run_id, measure_id, calculated FROM run, (VALUES (1, 'N'), (2, 'N'), (3, 'Y')) AS m(measure_id, calculated)",
}.items():
    query(f"pub06_log_of_{_kind}", _sql, (P.SALES, P.FACTS, DELIVERED))(run_logs_of(_kind))


LIMITS = """limits AS (SELECT contract_id, max(period_end) AS latest_end, CAST(max(period_end) - to_months(CAST(12 + contract_id AS INTEGER)) AS DATE) AS keep_from FROM facts GROUP BY 1)"""


def limits(spark, d):
    contracts = P.table(spark, d, "region").select(F.col("r_regionkey").alias("contract_id"), F.lit("MTH").alias("class"), (F.col("r_regionkey") + 12).alias("periods"))
    return PUB.retention_limits(P.facts(spark, d), contracts)


@query("pub07_retention_limits", "SELECT contract_id, latest_end, keep_from FROM limits", (P.SALES, P.FACTS, LIMITS))
def pub07_limits(spark, d):
    return limits(spark, d).select("contract_id", "latest_end", "keep_from")


@query(
    "pub07_expired_partitions",
    "SELECT f.contract_id, period_end, count(*) AS rows FROM facts f JOIN limits l ON f.contract_id = l.contract_id WHERE period_end < keep_from GROUP BY 1, 2",
    (P.SALES, P.FACTS, LIMITS),
)
def pub07(spark, d):
    return PUB.expired_partitions(P.facts(spark, d), limits(spark, d)).select("contract_id", "period_end", "rows")


@query("pub07_retention_delete", "SELECT period_end AS part_period_end, count(*) AS rows FROM facts WHERE contract_id = 2 AND period_end < DATE '1998-01-01' GROUP BY 1", (P.SALES, P.FACTS))
def pub07_delete(spark, d):
    path = stored_facts(spark, d)
    return PUB.expire(spark, path, 4, 2, "1998-01-01").select("part_period_end", "rows")


@query("pub08_purge", f"SELECT {AS_BIGINT}, volume FROM facts WHERE contract_id <> 2", (P.SALES, P.FACTS))
def pub08(spark, d):
    path = stored_facts(spark, d)
    PUB.purge(spark, path, 4, 2)
    return spark.read.parquet(path).select(*SHOWN)


@query(
    "pub09_orphans",
    """SELECT p_partkey AS product_key FROM part WHERE p_partkey NOT IN (SELECT l_partkey * 2 FROM lineitem) AND p_partkey NOT IN (SELECT l_partkey * 3 FROM lineitem)""",
)
def pub09(spark, d):
    """Two fact tables, one with twice and one with three times the keys."""
    item = P.table(spark, d, "lineitem")
    dims = [P.products(spark, d), P.products(spark, d).where("size > 3")]
    return PUB.orphan_keys(dims, [item.select((F.col("l_partkey") * n).alias("product_key")) for n in (2, 3)], "product_key")


@query(
    "pub09_without_orphans",
    "SELECT p_partkey AS product_key FROM part WHERE p_partkey IN (SELECT l_partkey * 2 FROM lineitem)",
)
def pub09_rest(spark, d):
    used = P.table(spark, d, "lineitem").select((F.col("l_partkey") * 2).alias("product_key"))
    dim = P.products(spark, d).select("product_key")
    return PUB.without_orphans(dim, PUB.orphan_keys([dim], [used], "product_key"), "product_key")


@query("pub10_expired_runs", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-28 12:00:00' - INTERVAL 7 DAY")
def pub10(spark, d):
    runs = P.table(spark, d, "events").select("event_id", F.col("ts").alias("ended_at"))
    return PUB.expired_runs(runs, "2024-01-28 12:00:00", 7).select("event_id")


@query("pub10_failed_files", "SELECT o_orderkey AS file_id FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')")
def pub10_files(spark, d):
    files = P.table(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"), F.col("o_custkey").alias("run_id"))
    runs = P.table(spark, d, "events").select(F.col("user_id").alias("run_id"), F.when(F.col("event_type") == "error", "FAILED").otherwise("DONE").alias("status"))
    return PUB.failed_files(files, runs).select("file_id")


# ---------------------------------------------------------------- routing


def arrivals(events, *more):
    """Events as arriving files: type and user make the name, the value the size in bytes."""
    name = F.concat(F.upper("event_type"), F.lit("_"), "user_id", F.lit("_"), "event_id", F.lit(".zip"))
    return events.select(name.alias("name"), (F.col("value") * 100_000_000).cast("long").alias("size"), *more)


def contracts(spark):
    rows = [(1, 11, "click%", 2), (2, 12, "view_1%.zip", 3), (3, 13, "view_%", 2), (4, 14, "%_99_%", 3), (5, 15, "signup%", 1), (6, 16, "purchase_1__%.ZIP", 2)]
    return spark.createDataFrame(rows, "contract_id int, job_id int, file_pattern string, status int")


ROUTED = """WITH c AS (SELECT * FROM (VALUES (1, 11, 'click%', 2), (2, 12, 'view_1%.zip', 3), (3, 13, 'view_%', 2), (4, 14, '%_99_%', 3), (5, 15, 'signup%', 1), (6, 16, 'purchase_1__%.ZIP', 2)) AS t(contract_id, job_id, file_pattern, status)),
  f AS (SELECT upper(event_type) || '_' || user_id || '_' || event_id || '.zip' AS name, CAST(trunc(value * 100000000) AS BIGINT) AS size FROM events),
  m AS (SELECT name, count(*) AS n, min(contract_id) AS contract_id, min(job_id) AS job_id FROM f JOIN c ON lower(name) LIKE lower(file_pattern) AND status IN (2, 3) GROUP BY 1)
  SELECT f.name, size, coalesce(n, 0) AS matches, CASE WHEN n = 1 THEN contract_id END AS contract_id, CASE WHEN n = 1 THEN job_id END AS job_id,
    CASE WHEN n = 1 THEN CASE WHEN size < 1073741824 THEN 'Small' WHEN size < 3221225472 THEN 'Medium' ELSE 'Large' END END AS size_class,
    CASE WHEN n = 1 THEN 'accepted' ELSE 'rejected' END AS decision FROM f LEFT JOIN m ON f.name = m.name"""


@query("str01_route_batch", ROUTED)
def str01(spark, d):
    return ST.route(arrivals(P.table(spark, d, "events")), contracts(spark))


@query("str01_route_stream", ROUTED)
def str01_stream(spark, d):
    schema = P.table(spark, d, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    out, checkpoint = scratch_path(spark, "routed"), scratch_path(spark, "routing")
    ST.route_stream(arrivals(source), contracts(spark), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


ARRIVED = """WITH c AS (SELECT * FROM (VALUES (1, 11, 'click%', 2, 1), (2, 12, 'view_1%.zip', 3, 1), (3, 13, 'view_%', 2, 1), (4, 14, '%_99_%', 3, 2), (5, 15, 'signup%', 1, 2), (6, 16, 'purchase_1__%.ZIP', 2, 2)) AS t(contract_id, job_id, file_pattern, status, step)),
  f AS (SELECT upper(event_type) || '_' || user_id || '_' || event_id || '.zip' AS name, CAST(trunc(value * 100000000) AS BIGINT) AS size,
      CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS step, ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-16' AS again FROM events),
  m AS (SELECT name, f.step, count(*) FILTER (c.step = 1) AS n1, min(contract_id) FILTER (c.step = 1) AS c1, count(*) AS n2, min(contract_id) AS c2
      FROM f JOIN c ON lower(name) LIKE lower(file_pattern) AND status IN (2, 3) GROUP BY ALL),
  r AS (SELECT f.name, f.size, CASE WHEN f.step = 1 AND n1 = 1 THEN c1 WHEN n2 = 1 THEN c2 END AS contract_id, coalesce(CASE WHEN f.step = 1 AND n1 = 1 THEN 1 ELSE n2 END, 0) AS matches FROM f LEFT JOIN m ON f.name = m.name)
  SELECT name, size, matches, contract_id, contract_id + 10 AS job_id, CASE WHEN contract_id IS NULL THEN 'rejected' ELSE 'accepted' END AS decision FROM r"""


@query("str01_route_arrivals", ARRIVED)
def str01_arrivals(spark, d):
    """Two runs of one stream: half the files and three contracts, then the rest, two days of files announced again, three contracts more."""
    base = scratch_path(spark, "arrivals")
    events, late = P.table(spark, d, "events"), F.lit("2024-01-16").cast("timestamp")
    files = arrivals(events.withColumn("arrived_at", F.col("ts").cast("timestamp")), "arrived_at")
    again = files.where((F.col("arrived_at") >= F.lit("2024-01-14").cast("timestamp")) & (F.col("arrived_at") < late))
    second = files.where(F.col("arrived_at") >= late).unionByName(again.withColumn("arrived_at", F.col("arrived_at") + F.expr("INTERVAL 3 DAYS")).withColumn("size", F.col("size") + 1))
    rules = contracts(spark).withColumn("changed_at", F.lit("2024-01-01").cast("timestamp"))
    for part, which in ((files.where(F.col("arrived_at") < late), "contract_id <= 3"), (second, "contract_id > 3")):
        part.write.mode("append").parquet(f"{base}/files")
        rules.where(which).write.mode("append").parquet(f"{base}/rules")
        incoming = [spark.readStream.schema(df.schema).parquet(f"{base}/{name}") for df, name in ((files, "files"), (rules, "rules"))]
        ST.route_arrivals(*incoming, f"{base}/out", f"{base}/checkpoint", delay="10 days").awaitTermination()
    shown = ["name", "size", "matches", "contract_id", "job_id", "decision"]
    return ST.accepted_files(spark, f"{base}/out").select(*shown).unionByName(ST.waiting_files(spark, f"{base}/out").select(*shown))


@query("str02_size_class", "SELECT event_id, CASE WHEN value * 100000000 < 1073741824 THEN 'Small' WHEN value * 100000000 < 3221225472 THEN 'Medium' ELSE 'Large' END AS size_class FROM events")
def str02(spark, d):
    return P.table(spark, d, "events").select("event_id", ST.size_class(F.col("value") * 100_000_000).alias("size_class"))
