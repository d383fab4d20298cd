"""Expressions from lookup rows, in stages by what they need."""

import itertools

import pytest
from pyspark.sql import types as T

from panelgrain.operators import expressions as X
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("volume", T.DoubleType()), T.StructField("value", T.DecimalType(18, 4)), T.StructField("name", T.StringType()), T.StructField("s", T.StructType([T.StructField("x", T.LongType())]))])


def staged(spark, **expressions):
    return X.stage_expressions(spark, expressions, SCHEMA)


def test_fewest_stages_in_any_order(spark):
    given = {"d": "c + a", "a": "volume * 2", "c": "b - 1", "b": "a + value", "e": "s.x + 1"}
    for order in itertools.islice(itertools.permutations(given), 0, 120, 40):
        out = staged(spark, **{k: given[k] for k in order})
        assert [set(s) for s in out.stages] == [{"a", "e"}, {"b"}, {"c"}, {"d"}] and not out.rejected


def test_values(spark):
    df = spark.createDataFrame([(2.0, "5.5", "n", 7)], "volume double, value string, name string, x long").selectExpr("volume", "cast(value as decimal(18,4)) value", "name", "named_struct('x', x) s")
    out = staged(spark, price="total / volume", total="value * 2 + VOLUME", volume="volume + 1", label="upper(name)", w="s.x * price")
    assert [set(s) for s in out.stages] == [{"volume", "label"}, {"total"}, {"price"}, {"w"}]
    got = out.apply(df).head()
    assert (got.volume, float(got.total), float(got.price), got.label) == (3.0, 14.0, 14 / 3, "N") and got.w == pytest.approx(7 * 14 / 3)


def test_faults_come_in_one_frame(spark):
    out = staged(spark, a="b + 1", b="c * 2", c="a", own="own + 1", gone="nothing + 1", next="gone * 2", bad="1 +", fine="volume", odd="no_such_function(volume)", none=None, after="next + a")
    faults = {r[0]: r[2] for r in rows(out.faults(spark))}
    assert [set(s) for s in out.stages] == [{"fine"}]
    assert faults["a"] == "circle: a -> b -> c -> a" and faults["c"] == "circle: c -> a -> b -> c"
    assert faults["own"] == "unknown column own" and faults["gone"] == "unknown column nothing" and faults["next"] == "needs gone"
    assert faults["bad"] == "does not parse" and faults["odd"].startswith("cannot be resolved") and faults["none"] == "no expression"
    assert faults["after"] in ("needs a", "needs next") and set(faults) | {"fine"} == {"a", "b", "c", "own", "gone", "next", "bad", "odd", "none", "after", "fine"}


def test_own_set_or_the_default_one(spark):
    lookup = spark.createDataFrame(
        [(101, "m", "a", "1"), (101, "m", "b", "2"), (7, "m", "a", "3"), (7, "m", "a", "3"), (7, "n", "a", "4"), (8, "m", None, "5"), (9, "m", "A", "1"), (9, "m", "a", "2")],
        "contract_id int, set_name string, column_name string, expression string",
    )
    assert X.expression_rows(lookup, "m", 7) == {"a": "3"}
    assert X.expression_rows(lookup, "m", 8) == X.expression_rows(lookup, "m", 55) == {"a": "1", "b": "2"}
    with pytest.raises(LookupError):
        X.expression_rows(lookup, "x", 7)
    with pytest.raises(ValueError, match="twice"):
        X.expression_rows(lookup, "m", 9)
