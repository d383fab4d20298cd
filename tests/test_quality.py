"""Rule framework and the rules whose semantics need a fixture."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelgrain.quality import framework as Q
from panelgrain.quality import rules  # noqa: F401
from panelgrain.quality.framework import REGISTRY
from tests.conftest import rows

AT = "2024-01-01 00:00:00"


def find(rule_id, **frames):
    return REGISTRY[rule_id].offending(frames)


def test_catalogue_is_complete():
    numbers = {r.split("-")[1] for r in REGISTRY if r.startswith("DQ-")}
    assert numbers == {f"{i:02d}" for i in range(1, 56)}
    assert all(g in Q.GROUPS for r in REGISTRY.values() for g in r.groups)


def test_missing_input_is_named():
    with pytest.raises(LookupError, match="markets"):
        find("DQ-09")


def test_rules_are_registered_once():
    with pytest.raises(ValueError):
        Q.rule("DQ-01", "again", (1,), [])(lambda f, p: None)


def test_switch_by_contract():
    assert [r.rule_id for r in Q.rules_of(8, {"DQ-52", "DQ-01"})] == ["DQ-52"]
    assert Q.rules_of(8, set()) == []


def test_evaluate_merge_and_flags(spark):
    frames = {"markets": spark.createDataFrame([("a",), ("a",)], "code string"), "products": spark.createDataFrame([("p",)], "code string")}
    results = Q.evaluate(Q.rules_of(5, {"DQ-09", "DQ-10"}), frames, 7, 5, F.lit(AT).cast("timestamp"))
    assert rows(results, "rule_id", "result", "offending") == [("DQ-09", "FAILED", 1), ("DQ-10", "PASSED", 0)]
    assert results.schema.names == Q.RESULT.names
    again = results.where("rule_id = 'DQ-09'").withColumn("result", F.lit("PASSED"))
    merged = Q.merge_results(results, again)
    assert rows(Q.fail_flags(merged), "failed", "overall") == [("N", "PASSED")]
    assert rows(Q.fail_flags(results), "failed", "overall") == [("Y", "FAILED")]


def test_latest_result(spark):
    data = [(1, "r", "FAILED", datetime.datetime(2024, 1, 1)), (1, "r", "PASSED", datetime.datetime(2024, 1, 2))]
    df = spark.createDataFrame(data, "run_id int, rule_id string, result string, created_at timestamp")
    assert rows(Q.latest_results(df), "result") == [("PASSED",)]


@pytest.mark.parametrize(
    "failed, approved, auto, expected",
    [("N", False, True, "PASS"), ("N", False, False, "BLOCKED"), ("N", True, False, "APPROVED"), ("Y", True, True, "APPROVED"), ("Y", False, True, "BLOCKED")],
)
def test_business_gate(spark, failed, approved, auto, expected):
    flags = spark.createDataFrame([(1, 4, failed)], "run_id int, group_id int, failed string")
    approvals = spark.createDataFrame([(1, 4, approved, auto)], "run_id int, group_id int, approved boolean, auto_approved boolean")
    assert Q.gate(flags, approvals, business=True).head().gate == expected
    assert Q.gate(flags, approvals, master_switch=False, business=True).head().gate == "PASS"
    assert Q.gate(flags, approvals, active_rules=0, business=True).head().gate == "PASS"


def test_plain_gate_needs_no_auto_approval(spark):
    flags = spark.createDataFrame([(1, 1, "N"), (1, 2, "Y")], "run_id int, group_id int, failed string")
    approvals = spark.createDataFrame([], "run_id int, group_id int, approved boolean, auto_approved boolean")
    assert rows(Q.gate(flags, approvals), "group_id", "gate") == [(1, "PASS"), (2, "BLOCKED")]


def test_summary_has_headings_in_tier_order(spark):
    results = spark.createDataFrame([(2, "b", "PASSED", 0), (1, "a", "FAILED", 3), (2, "c", "FAILED", 1)], "group_id int, rule_name string, result string, offending long")
    got = [r.text for r in Q.summary(results, [2, 1, 3]).collect()]
    assert got == ["tier 2 reference", "c", "b", "tier 2 file structure", "a"]


def test_details_are_saved(spark, tmp_path):
    path = str(tmp_path / "details")
    Q.save_details(REGISTRY["DQ-09"], {"markets": spark.createDataFrame([("a",), ("a",)], "code string")}, path)
    assert rows(spark.read.parquet(path)) == [("a", 2)]


def test_data_exists(spark):
    some, none = spark.range(1), spark.range(0)
    assert rows(find("DQ-14", facts=some, markets=none, periods=none)) == [("markets",), ("periods",)]


def test_period_gaps_count_the_deliveries_once(spark):
    """The deliveries, a join of large tables as a rule, are read by one branch of the plan; gaps, ends and unknown periods come from it."""
    day = lambda n: F.expr(f"date_add(DATE '2024-01-01', CAST({n} AS INT))")
    deliveries = spark.range(12, numPartitions=1).where("id NOT IN (3, 4, 7)").select((F.col("id") % 2).alias("contract_id"), F.lit("W").alias("class"), day("id * 7").alias("period_end"), F.col("id").alias("run_id"))
    periods = spark.range(0, 77, 7, 1).select(F.lit("W").alias("class"), day("id").alias("end_date"))
    found = find("DQ-37", deliveries=deliveries, periods=periods)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 12") == 1
    got = [(r.contract_id, (r.period_end - datetime.date(2024, 1, 1)).days // 7, r.status) for r in found.collect()]
    came = {0: [0, 2, 6, 8, 10], 1: [1, 5, 9]}
    want = [(k, n, "new" if n in own else "missing") for k, own in came.items() for n in range(own[0], own[-1] + 1)]
    assert sorted(got) == sorted([*want, (1, 11, "unknown")])


def test_period_gaps(spark):
    day = datetime.date
    weeks = [day(2024, 1, 7) + datetime.timedelta(7 * i) for i in range(6)]
    periods = spark.createDataFrame([("WK", w) for w in weeks] + [("MTH", day(2024, 1, 31))], "class string, end_date date")
    came = [(1, "WK", weeks[1], 1), (1, "WK", weeks[3], 1), (1, "WK", weeks[3], 2), (1, "WK", weeks[1], 1)]
    deliveries = spark.createDataFrame(came, "contract_id int, class string, period_end date, run_id int")
    got = rows(find("DQ-37", deliveries=deliveries, periods=periods), "period_end", "status")
    assert got == [(weeks[1], "new"), (weeks[2], "missing"), (weeks[3], "redelivered")]


def test_line_count_and_overflow(spark):
    facts = spark.createDataFrame([("m", "p", "t", 1, ""), ("m", "p", "t", 2, " x ")], "market_code string, product_code string, period_code string, line_num int, rest string")
    assert rows(REGISTRY["DQ-17"].offending({"facts": facts}, measures=41), "lines", "expected") == [(2, 3)]
    assert REGISTRY["DQ-17"].offending({"facts": facts}, measures=40).count() == 0
    assert rows(find("DQ-18", facts=facts)) == [(2, " x ")]


def test_thresholds_need_both_limits(spark):
    facts = spark.createDataFrame([("a", 1, 100.0, 60.0, None), ("b", 1, 5.0, 60.0, None), ("c", 1, 100.0, None, None), ("d", 1, -100.0, 10.0, -90.0)], "k string, level_id int, volume double, volume_ipp double, volume_iya double")
    limits = spark.createDataFrame([(1, 50.0, 50.0, 80.0)], "level_id int, absolute_limit double, previous_limit double, year_ago_limit double")
    assert rows(find("DQ-49", comparison=facts, thresholds=limits), "k") == [("a",), ("d",)]


def test_parent_rules(spark):
    data = [(1, 1, "T", None, "Y", 10.0), (1, 1, "T a", "T", "N", 4.0), (1, 1, "T b", "T", "N", 4.0), (1, 1, "U a", "U", "N", 1.0)]
    facts = spark.createDataFrame(data, "market_key int, period_id int, path string, parent_path string, is_top string, volume double")
    assert rows(REGISTRY["DQ-52"].offending({"facts": facts}, limit=5.0), "path", "children") == [("T", 8.0)]
    assert REGISTRY["DQ-52"].offending({"facts": facts}, limit=25.0).count() == 0
    assert rows(find("DQ-54", facts=facts), "path") == [("U",)]


def test_status_word_narrows_a_rule(spark):
    rule = Q.Rule("X", "x", (1,), lambda f, p: f["a"], ("a",), word="missing")
    df = spark.createDataFrame([("Missing",), ("new",)], "status string")
    assert rows(rule.offending({"a": df})) == [("Missing",)]


def key_frame(spark):
    data = [("a", "x", 1, None), ("a", "x", 1, None), ("a", "y", 2, 5), ("b", "x", 3, 5), (None, "z", 4, 6), (None, "z", 4, None)]
    return spark.createDataFrame(data, "code string, attributes string, line_num int, period_id int")


def test_key_rules_together_equal_each_alone(spark):
    """Null keys are keys unless the rule says otherwise; rules that share a key or a table with row-wise rules count alike."""
    frame = key_frame(spark)
    frames = {"products": frame, "mapped_periods": frame, "markets": frame.limit(0)}
    chosen = [REGISTRY[r] for r in ("DQ-09", "DQ-10", "DQ-12", "DQ-38", "DQ-40")]
    got = rows(Q.evaluate(chosen, frames, 1, 6, F.lit(AT).cast("timestamp")), "rule_id", "offending")
    assert got == sorted((r.rule_id, r.offending(frames).count()) for r in chosen)
    assert got == [("DQ-09", 0), ("DQ-10", 2), ("DQ-12", 2), ("DQ-38", 1), ("DQ-40", 3)]
    facts = frame.select(F.col("code").alias("market_code"), F.col("attributes").alias("product_code"), F.lit(1).alias("period_code"), "line_num")
    assert rows(Q.evaluate([REGISTRY["DQ-08"]], {"facts": facts}, 1, 1, F.lit(AT).cast("timestamp")), "result", "offending") == [("FAILED", 4)]


def test_key_rules_of_a_table_take_one_scan_and_one_shuffle(spark, tmp_path):
    key_frame(spark).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    chosen = [REGISTRY[r] for r in ("DQ-10", "DQ-12")]
    plan = Q.repeated(chosen, frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    mixed = [REGISTRY[r] for r in ("DQ-38", "DQ-40")]
    plan = Q.evaluate(mixed, {"mapped_periods": frame}, 1, 6, F.lit(AT).cast("timestamp"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_counts_and_details_are_stored_together(spark, tmp_path):
    frame = key_frame(spark)
    chosen = [REGISTRY[r] for r in ("DQ-09", "DQ-10", "DQ-12", "DQ-40")]
    frames = {"products": frame, "mapped_periods": frame, "markets": frame.limit(0)}
    path = str(tmp_path / "found")
    for _ in range(2):  # a repeated run replaces what it stored
        results = Q.evaluate_and_save(chosen, frames, 1, 5, F.lit(AT).cast("timestamp"), path)
        assert results.schema.names == Q.RESULT.names
        assert rows(results, "rule_id", "result", "offending") == [("DQ-09", "PASSED", 0), ("DQ-10", "FAILED", 2), ("DQ-12", "FAILED", 2), ("DQ-40", "FAILED", 3)]
        stored = spark.read.parquet(f"{path}/products_keys")
        assert sorted(tuple(r) for r in stored.select("rule_id", "key", "copies").collect()) == [
            ("DQ-10", '{"code":"a"}', 3), ("DQ-10", "{}", 2), ("DQ-12", '{"attributes":"x"}', 3), ("DQ-12", '{"attributes":"z"}', 2)]
        assert spark.read.parquet(f"{path}/DQ-40").count() == 3
