"""Period sides, shares, indexes, delivery status."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelgrain.operators import compare as C
from panelgrain.spec import PeriodPolicy
from tests.conftest import ordered, rows


def calendar(spark, n=30):
    return spark.createDataFrame([(i, i - 1, i - 12 if i > 12 else None) for i in range(1, n)], "period_id int, prev_id int, year_ago_id int")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(1, 3), st.integers(1, 29)), min_size=1, max_size=40))
def test_period_sides_equal_self_joins(spark, cells):
    data = pd.DataFrame([(m, p, float(m * 100 + p)) for m, p in cells], columns=["market", "period_id", "volume"])
    got = rows(C.period_sides(spark.createDataFrame(data), calendar(spark), ["market"], ["volume"]), "market", "period_id", "volume", "volume_pp", "volume_ya")
    known = {(m, p): m * 100.0 + p for m, p in cells}
    want = [(m, p, v, known.get((m, p - 1)), known.get((m, p - 12)) if p > 12 else None) for (m, p), v in known.items()]
    assert got == ordered(want)


def expected(facts, calendar_rows):
    """Period sides by definition: the one fact of the key at the period that the calendar points to."""
    pointers = {p: (prev, year) for p, prev, year in calendar_rows}
    out = []
    for k, p, v in facts:
        sides = []
        for i in (0, 1):
            target = pointers.get(p, (None, None))[i]
            there = [w for kk, q, w in facts if kk == k and q == target] if target is not None else []
            sides.append(there[0] if len(there) == 1 else None)
        out.append((k, p, v, *sides))
    return ordered(out)


CALENDARS = {
    "weeks": [(w, w - 1 if w > 200 else None, w - (53 if w > 260 else 52)) for w in range(200, 310)],
    "fiscal ids": [(p * 10, p * 10 - 10 if p > 1 else None, p * 10 - 120 if p > 12 else None) for p in range(1, 30)],
    "two share a year ago": [(p, p - 1, {25: 13, 26: 13, 27: 14}.get(p, p - 12)) for p in range(1, 30)],
    "circles and itself": [(1, 2, 1), (2, 3, 1), (3, 1, 3), (4, 4, 2), (5, 1, 2), (6, None, None)],
    "missing months": [(p, p - 1, p - 12) for p in range(1, 30) if p not in (5, 17, 18)],
}


@pytest.mark.parametrize("name", sorted(CALENDARS))
def test_sides_of_any_calendar(spark, name):
    rng = random.Random(name)
    ids = [p for p, _, _ in CALENDARS[name]] + [0, 5, 999, None]
    facts = [(k, rng.choice(ids), float(i)) for i in range(300) for k in [rng.choice("abc")]]
    df = spark.createDataFrame(facts, "k string, period_id int, volume double").repartition(3)
    periods = spark.createDataFrame(CALENDARS[name], "period_id int, prev_id int, year_ago_id int")
    assert rows(C.period_sides(df, periods, ["k"], ["volume"]), "k", "period_id", "volume", "volume_pp", "volume_ya") == expected(facts, CALENDARS[name])


def test_repeated_facts_come_back_as_a_frame(spark):
    facts = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, 4.0), ("b", None, 1.0), ("b", None, 1.0)], "k string, period_id int, volume double")
    got = rows(C.period_sides(facts, calendar(spark), ["k"], ["volume"]), "k", "period_id", "volume", "volume_pp")
    assert got == [("a", 1, 1.0, None), ("a", 1, 2.0, None), ("a", 2, 3.0, None), ("a", 3, 4.0, 3.0), ("b", None, 1.0, None), ("b", None, 1.0, None)]
    assert rows(C.repeated_facts(facts, ["k"])) == [("a", 1, 2)]


def test_null_measures_stay_null(spark):
    facts = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0)], "k string, period_id int, volume double")
    assert rows(C.period_sides(facts, calendar(spark), ["k"], ["volume"]), "period_id", "volume", "volume_pp") == [(1, None, None), (2, 5.0, None)]


def test_unknown_periods_and_markets_stay(spark):
    facts = spark.createDataFrame([("a", 99, 5.0), (None, 2, 6.0), ("a", None, 7.0)], "k string, period_id int, volume double")
    assert rows(C.period_sides(facts, calendar(spark), ["k"], ["volume"]), "k", "period_id", "volume", "volume_pp") == [(None, 2, 6.0, None), ("a", 99, 5.0, None), ("a", None, 7.0, None)]
    shares = rows(C.share_of_total(facts, ["k"], ["volume"]).withColumn("volume_share", F.round("volume_share", 6)), "k", "volume", "volume_share")
    assert shares == [(None, 6.0, None), ("a", 5.0, 41.666667), ("a", 7.0, 58.333333)]


def test_shares_are_null_without_a_total(spark):
    facts = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0), (2, "a", 1.0), (2, "b", 3.0)], "m int, path string, volume double")
    assert rows(C.share_of_total(facts, ["m"], ["volume"]), "m", "path", "volume_share") == [(1, "a", None), (1, "b", None), (2, "a", 25.0), (2, "b", 75.0)]


def test_share_of_top_level_row(spark):
    facts = spark.createDataFrame([(1, "T", "Y", 8.0), (1, "T a", "N", 2.0), (1, "U a", "N", 2.0)], "m int, path string, is_top string, volume double")
    assert rows(C.share_of_top(facts, ["m"], "path", 1, ["volume"]), "path", "volume_share") == [("T", 100.0), ("T a", 25.0), ("U a", None)]


def test_index_policies(spark):
    row = spark.createDataFrame([(10.0, 5.0, 4.0, 20.0, 0.8, 0.5)], "v double, v_pp double, v_ya double, v_pd double, time_factor double, time_factor_pp double")
    got = C.indexes(row, ["v"], PeriodPolicy(scale_previous=True, scale_year_ago=True)).head()
    assert (got.v_ipp, got.v_iya, got.v_ipd) == pytest.approx((110.0, 100.0, -50.0))
    plain = C.indexes(row, ["v"], PeriodPolicy(scale_previous=False)).head()
    assert (plain.v_ipp, plain.v_iya) == (60.0, 150.0)


def test_status_of_deliveries(spark):
    log = spark.createDataFrame([(1, "jan"), (2, "jan"), (2, "jan"), (2, "feb"), (1, "mar")], "run_id int, period string")
    counts = C.delivery_counts(log, ["period"])
    assert rows(C.period_status(counts), "period", "is_new", "is_redelivered") == [("feb", "Y", "N"), ("jan", "N", "Y"), ("mar", "Y", "N")]
    assert rows(C.period_status(counts, run_id=2), "period", "is_new", "is_redelivered") == [("feb", "Y", "N"), ("jan", "N", "Y"), ("mar", "N", "N")]


def test_comparison_keeps_products_without_history(spark):
    now = spark.createDataFrame([("jan", "p1", 5.0), ("jan", "p2", 6.0), ("feb", "p1", 7.0)], "period string, p string, volume double")
    old = spark.createDataFrame([("jan", "p1", 4.0), ("feb", "p1", 9.0)], "period string, p string, volume double")
    status = spark.createDataFrame([("jan", "N", "Y"), ("feb", "Y", "N")], "period string, is_new string, is_redelivered string")
    got = rows(C.comparison_set(now, status, old, ["period"], ["period", "p"], ["volume"]), "period", "p", "volume_pd")
    assert got == [("feb", "p1", None), ("jan", "p1", 4.0), ("jan", "p2", None)]


def test_threshold_snapshot_only_once(spark):
    limits = spark.createDataFrame([(-5, 1.0)], "level_id int, previous_limit double")
    log = spark.createDataFrame([(7,)], "run_id long")
    assert rows(C.snapshot_thresholds(limits, log, 8, "s"), "level_id", "run_id") == [(5, 8)]
    assert C.snapshot_thresholds(limits, log, 7, "s").count() == 0
