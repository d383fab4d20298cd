"""Plans and skew: what must hold when the data grows (see test_queries for every query's plan)."""

import re

import pytest
from pyspark.sql import functions as F

from panelgrain.checks import QUERIES
from panelgrain.operators import compare as C
from panelgrain.operators import dedup as D
from panelgrain.operators import reshape as R

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def hot(spark, n=4000):
    """Half of the rows share one key."""
    return spark.range(n).select(F.when(F.col("id") < n // 2, 0).otherwise(F.col("id")).alias("k"), "id", (F.col("id") % 7).alias("v"))


def test_latest_per_key_prunes_before_the_shuffle(spark):
    df = D.latest_per_key(hot(spark), ["k"], "id")
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
    got = {r.k: r.id for r in df.collect()}
    assert len(got) == 2001 and got[0] == 1999


def test_stitching_prunes_before_the_shuffle(spark):
    slots = [f"slot_{i}" for i in range(1, 21)]
    df = hot(spark).select("k", "id", *[F.col("v").cast("string").alias(s) for s in slots])
    out = R.stitch_lines(df, ["k"], ["id"], slots)
    assert "WindowGroupLimit" in plan(out)
    assert out.count() == 2001


def test_stitching_sorts_only_the_slots_that_are_asked_for(spark):
    """Measures the caller drops still decide whether a record has any, but their texts are not sorted, nor tested in one long method."""
    slots = [f"slot_{i}" for i in range(1, 21)]
    cells = [F.when((F.col("id") % 3 == i % 3), F.col("id").cast("string")).otherwise("N/A").alias(s) for i, s in enumerate(slots)]
    df = spark.range(30).selectExpr("id", "id DIV 2 AS k").select("k", "id", *cells)
    whole = R.stitch_lines(df, ["k"], ["id"], slots, measures=range(1, 41))
    some = whole.select("k", "measure_2", "measure_21")
    assert "exists(" in next(line for line in plan(some).splitlines() if "slot_7" in line)
    assert sorted(map(tuple, some.collect())) == sorted((r.k, r.measure_2, r.measure_21) for r in whole.collect())
    none = R.stitch_lines(df.withColumns({s: F.lit("N/A") for s in slots[1:]}), ["k"], ["id"], slots, measures=range(1, 41))
    assert {r.k for r in none.select("k", "measure_2").collect()} == {k for k in range(15) if any(i % 3 == 0 for i in (2 * k, 2 * k + 1))}


def test_totals_are_combined_before_the_shuffle(spark):
    text = plan(C.share_of_total(hot(spark), ["k"], ["v"]))
    assert "partial_sum" in text and "Window" not in text


def test_sides_read_the_facts_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    hot(spark).select("k", (F.col("id") + 1).cast("int").alias("period_id"), F.col("v").cast("double").alias("volume")).write.parquet(path)
    periods = spark.range(1, 4000).select(F.col("id").cast("int").alias("period_id"), (F.col("id") - 1).cast("int").alias("prev_id"), (F.col("id") - 12).cast("int").alias("year_ago_id"))
    text = plan(C.period_sides(spark.read.parquet(path), periods, ["k"], ["volume"]))
    assert text.count("FileScan parquet") == 1


def test_hot_key_of_a_join_is_split(spark, no_broadcast):
    """The rows of a repeated key are joined with their counts by several tasks."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    try:
        df = D.repeated_rows(hot(spark, 60000).repartition(8).withColumn("pad", F.md5(F.col("id").cast("string"))), ["k"])
        assert df.count() == 30000
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_filters_and_columns_reach_the_scan(spark):
    text = QUERIES["fct06_indexes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    wide = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "l_tax" in s or "l_returnflag" in s]
    assert wide == []
    text = QUERIES["src10_read_fact"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part_contract_id", text)


def test_writes_are_rebalanced(spark, tmp_path):
    """Few files per partition, whatever the number of tasks that hold its rows."""
    import os

    from panelgrain.sources.sinks import write_partitions

    path = str(tmp_path / "t")
    write_partitions(spark.range(5000).repartition(16).withColumn("part", F.col("id") % 2), path, ["part"])
    counts = [len([f for f in os.listdir(f"{path}/part={p}") if f.endswith(".parquet")]) for p in (0, 1)]
    assert max(counts) <= 2


def test_ordered_names_of_a_group_without_bound(spark):
    """One group holds 300,000 texts: the list keeps its first ones and says how many there are besides."""
    df = spark.range(300_000).select(F.lit("hot").alias("g"), (F.col("id") % 1000).alias("lvl"), F.col("id").cast("string").alias("t"))
    few = spark.createDataFrame([("few", 2, "b"), ("few", 1, "a"), ("few", 1, "a"), (None, 1, None), (None, 2, "x")], "g string, lvl long, t string")
    named = D.ordered_names(df.unionByName(few), ["g"], "lvl", "t", "names", ",", most=5)
    got = {r.g: r for r in named.collect()}
    assert got["hot"].names == "0,1000,10000,100000,101000" and got["hot"].names_left_out == 299_995
    assert (got["few"].names, got["few"].names_left_out) == ("a,b", 0) and (got[None].names, got[None].names_left_out) == ("x", 0)
    assert "WindowGroupLimit" in plan(named)


def test_retention_joins_partitions_not_rows(spark, tmp_path, no_broadcast, monkeypatch):
    """Rows are counted by partition in the scan's tasks; what meets the limits is a row a partition, however many rows it has."""
    from panelgrain.sources import sinks

    path = str(tmp_path / "t")
    rows = spark.range(20_000).select((F.col("id") % 2).alias("c"), F.expr("date_add(DATE '2024-01-01', CAST(id % 10 AS INT))").alias("day"), "id")
    sinks.write_partitions(rows, path, ["c", "day"])
    limits = spark.createDataFrame([(0, "2024-01-05")], "c int, keep string").select("c", F.col("keep").cast("date").alias("keep"))
    plans, staged = [], sinks.staged
    monkeypatch.setattr(sinks, "staged", lambda df, label: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or staged(df, label))
    removed = sinks.drop_before(spark, path, limits, ["c"], "day", "keep", ["c", "day"])
    assert sorted((r.c, str(r.day), r.rows) for r in removed.collect()) == [(0, "2024-01-01", 2000), (0, "2024-01-03", 2000)]
    assert spark.read.parquet(path).count() == 16_000
    names = [line.strip(" :+-").split(" ")[0] for line in plans[0].splitlines()]
    assert names[0] == "Join" and "Aggregate" in names
