"""Text helpers, ratios and row numbers."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelgrain.functions import numbering as N
from panelgrain.functions import ratios as R
from panelgrain.functions import text as X
from tests.conftest import rows


@pytest.mark.parametrize(
    "text, value",
    [("12.5", 12.5), (".5", 0.5), (",5", None), ("N/A", None), ("na", None), ("  7 ", 7.0), ("", None), ("abc", None), (None, None), ("-3", -3.0)],
)
def test_parse_measure(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(X.parse_measure(F.col("t")).cast("double")).head()[0]
    assert got == value


def test_bad_measure_ignores_markers(spark):
    df = spark.createDataFrame([("1x",), ("N/A",), ("",), ("2",), (None,), ("n/a",)], "t string")
    assert rows(df.where(X.is_bad_measure(F.col("t")))) == [("1x",)]


def test_lead_zero(spark):
    df = spark.createDataFrame([(".5",), (",5",), ("5",), ("-.5",)], "t string")
    assert [r[0] for r in df.select(X.lead_zero(F.col("t"))).collect()] == ["0.5", "0,5", "5", "-.5"]


def test_paths(spark):
    df = spark.createDataFrame([("1 A B",), ("1",)], "p string")
    got = rows(df.select("p", X.path_depth(F.col("p")), X.path_prefix(F.col("p"), 2), X.path_prefix(F.col("p"), F.lit(1)), X.path_parent(F.col("p"))))
    assert got == [("1", 1, "1", "1", None), ("1 A B", 3, "1 A", "1", "1 A")]


def test_collapse_colons(spark):
    df = spark.createDataFrame([(" :a :: b: ",), ("a",), (":",)], "t string")
    assert [r[0] for r in df.select(X.collapse_colons(F.col("t"))).collect()] == ["a:b", "a", ""]


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (6.0, 4.0)], "a double, b double")
    got = df.select(R.share(F.col("a"), F.col("b")), R.index(F.col("a"), F.col("b")), R.index(F.col("a"), F.col("b"), F.lit(0.8), F.lit(0.5))).collect()
    assert [tuple(r) for r in got[:2]] == [(None, None, None)] * 2
    assert tuple(got[2]) == pytest.approx((150.0, 50.0, 70.0))


def test_file_line_numbers_over_many_splits(spark, tmp_path):
    """Numbers follow the order in each file although a file is read in many pieces by several tasks."""
    for name, n in (("a", 900), ("b", 37), ("c", 1)):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        numbered = N.file_line_numbers(spark.read.text(str(tmp_path)))
        got = numbered.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 938
    assert all(int(r.value[1:]) == r.line_num for r in got)


def test_file_order_stitches_records_of_a_file(spark, tmp_path):
    """Lines of a record are found in file order although splits are read by different tasks."""
    from panelgrain.operators.reshape import stitch_lines

    text = "".join(f"r{i} {i * 10 + n}\n" for i in range(200) for n in (1, 2, 3))
    (tmp_path / "facts.txt").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = N.file_order(spark.read.text(str(tmp_path)))
        lines = raw.select(F.split("value", " ")[0].alias("record"), F.split("value", " ")[1].alias("slot_1"), *N.FILE_ORDER)
        got = stitch_lines(lines, ["record"], N.FILE_ORDER, ["slot_1"], measures=(1, 2, 3)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 200
    assert all([int(r[f"measure_{n}"]) for n in (1, 2, 3)] == [int(r.record[1:]) * 10 + n for n in (1, 2, 3)] for r in got)


def test_ordered_numbers_with_one_hot_value(spark):
    """Half of the rows share one order key; numbers stay dense and ordered."""
    df = spark.range(1000).select("id", F.when(F.col("id") < 500, 7).otherwise(F.col("id")).alias("k"))
    got = N.ordered_numbers(df, ["k"], "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 1001))
    by_number = [r.k for r in sorted(got, key=lambda r: r.n)]
    assert by_number == sorted(by_number)


def test_ordered_numbers_agree_at_any_partitioning(spark):
    """Nulls, a hot key and rows that are equal in all columns; the same numbers at 3 and at 200 partitions."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.md5(F.col("id").cast("string"))).alias("k"),
        F.when(F.col("id") % 6 == 0, None).otherwise(F.col("id")).alias("v"),
    )
    spark.sparkContext.setJobGroup("planned", "no job while the plan is made")
    plans = [N.ordered_numbers(df.repartition(n), ["k"], "n") for n in (3, 200)]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planned")
    spark.sparkContext.setJobGroup("run", "")
    one, other = (sorted(p.collect(), key=lambda r: r.n) for p in plans)
    assert [tuple(r) for r in one] == [tuple(r) for r in other]
    assert [r.n for r in one] == list(range(1, 6001))
    keys = [r.k for r in one]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or "")) and keys.count("hot") == 2000


def test_ordered_numbers_deal_a_hot_key_to_many_buckets(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    plan = N.ordered_numbers(df, ["k"], "n")
    assert plan.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 20000, 20000)
    keyed = df.withColumn("_key", F.struct(F.col("k").alias("_o0"), F.xxhash64(F.lit(7), "id", "k").alias("_hash")))
    bounds = [b for lists in keyed.limit(1).select(N._bounds(keyed).alias("b")).first().b for b in lists]
    assert len(bounds) == 255 and bounds == sorted(bounds) and 150 < sum(b._o0 == 7 for b in bounds) < 190


def test_ordered_numbers_place_distinct_rows_only(spark):
    """Buckets are looked up once for each distinct row, above the count of equal rows, not in a filter of its input."""
    df = spark.range(30_000).select((F.col("id") % 83).alias("k"))
    plan = N.ordered_numbers(df, ["k"], "n")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in text.splitlines() if "Filter " in line and "lambda" in line]
    assert sorted(r.n for r in plan.where("k = 1").collect()) == list(range(363, 725))


def test_ordered_numbers_of_nothing(spark):
    assert N.ordered_numbers(spark.range(0), ["id"]).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.text(alphabet="abc123", min_size=1, max_size=6), min_size=1, max_size=40))
def test_hashed_numbers_are_dense_and_stable(spark, keys):
    df = spark.createDataFrame([(k,) for k in sorted(keys)], "k string")
    first = rows(N.hashed_numbers(df, ["k"], "n"))
    again = rows(N.hashed_numbers(df.repartition(3), ["k"], "n"))
    assert first == again
    assert sorted(n for _, n in first) == list(range(1, len(keys) + 1))
