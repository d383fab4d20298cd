"""Column maps and conformance."""

from decimal import Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.operators import conform as C
from panelgrain.operators import measures as M
from panelgrain.spec import ContractSpec, ExpressionSet
from tests.conftest import rows

TARGET = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType()), T.StructField("z", T.DecimalType(38, 10))])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(names=st.lists(st.sampled_from(["a", "B", "c", "Z", "q"]), unique=True, min_size=1))
def test_conform_is_idempotent_and_ordered(spark, names):
    df = spark.createDataFrame([tuple(str(i) for i in range(len(names)))], names)
    once = C.conform(df, TARGET)
    assert once.schema == C.conform(once, TARGET).schema
    assert once.columns == ["b", "a", "z"]
    assert rows(once) == rows(C.conform(once, TARGET))


def test_conform_nulls_unparsable_text(spark):
    assert rows(C.conform(spark.createDataFrame([("x", "1")], "b string, a string"), TARGET)) == [(None, "1", None)]


def test_apply_map_fans_out_and_ignores_absent(spark):
    df = C.trim_names(spark.createDataFrame([("1", "2")], [" Code ", "Kind"]))
    out = C.apply_map(df, {"code": ["Code_A", "code_b"], "absent": ["x"]})
    assert out.columns == ["code_a", "code_b"] and rows(out) == [("1", "1")]


def test_read_map_orders_targets(spark):
    column_map = spark.createDataFrame(
        [("PROD_DIM", "kind", "z"), ("PROD_DIM", "kind", "a"), ("PROD_DIM", "kind", "a"), ("MKT_DIM", "kind", "m")], "dimension string, file_column string, target_column string"
    )
    assert C.read_map(C.map_rows(column_map, "(?i)prod")) == {"kind": ["a", "z"]}


def test_null_measures_any_and_all(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None), (3, 1, 2)], "k int, a int, b int")
    assert [r.k for r in C.drop_null_measures(df, ["a", "b", "c"], "any").collect()] == [3]
    assert sorted(r.k for r in C.drop_null_measures(df, ["a", "b"], "all").collect()) == [2, 3]
    assert C.drop_null_measures(df, ["c"]).count() == 3


def test_join_parts_in_number_order(spark):
    df = spark.createDataFrame([("c", "a", "b", 1)], ["x#10", "x#1", "x#2", "k"])
    assert rows(C.join_parts(df), "k", "x") == [(1, "a:b:c")]


def test_pad_measures(spark):
    out = C.pad_measures(spark.createDataFrame([(1, "2")], "k int, measure_2 string"))
    assert out.columns == ["k", *[f"measure_{i}" for i in range(1, 101)]]
    assert out.schema["measure_100"].dataType == T.DecimalType(38, 10)


def test_security_key_default(spark):
    df = spark.createDataFrame([(1,), (2,)], "contract_id int")
    keys = spark.createDataFrame([(2, "own")], "contract_id int, security_key string")
    assert rows(C.add_security_key(df, keys), "contract_id", "security_key") == [(1, "public"), (2, "own")]


def test_expressions_fall_back_to_the_default_contract():
    sets = [ExpressionSet(101, "n", {"a": "1"}), ExpressionSet(5, "n", {"a": "2"})]
    assert C.choose_expressions(sets, "n", 5).columns == {"a": "2"}
    assert C.choose_expressions(sets, "n", 6).columns == {"a": "1"}
    with pytest.raises(LookupError):
        C.choose_expressions(sets, "other", 5)


def test_expressions_see_the_input(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(C.apply_expressions(df, ExpressionSet(1, "n", {"a": "b", "b": "a"})), "a", "b") == [(2, 1)]


def test_placeholder_sentinel(spark):
    df = spark.createDataFrame([(" NOT APPLICABLE",), ("2020-02-03",), ("x",)], "t string")
    assert [r.d for r in C.fill_placeholders(df, "t", "d", "NOT APPLICABLE", "1991-04-15").collect()] == ["1991-04-15", "2020-02-03", None]


def test_multipliers_share_a_factor_and_survive_overflow(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string").select(F.col("a").cast("decimal(38,10)"), F.col("b").cast("decimal(38,10)"), "c")
    out = M.apply_multipliers(df, {"A,b": "1000"})
    assert [float(v) for v in out.head()] == [1000.0, 2000.0, 3.0]
    huge = spark.createDataFrame([("9" * 18,)], "a string").select(F.col("a").cast("decimal(38,10)"))
    assert M.apply_multipliers(huge, {"a": "9999999999"}).head()[0] is None


def test_measure_columns_prefer_the_contract_factor(spark):
    df = spark.createDataFrame([("2", "3", "4")], "s1 string, s2 string, s3 string")
    specs = [M.MeasureColumn("s1", "v", "10", "100"), M.MeasureColumn("s2", "w", None, "100"), M.MeasureColumn("s3", "x", in_use=False)]
    out = M.apply_measure_columns(df, [], specs)
    assert out.columns == ["v", "w"] and [float(v) for v in out.head()] == [20.0, 300.0]


def test_read_multipliers(spark):
    m = spark.createDataFrame(
        [("FCT", 1, "a,b", "10"), ("FCT", 1, "c", None), ("FCT", 2, "a", "5"), ("PROD", 1, "d", "2")], "dimension string, contract_id int, target_column string, multiplier string"
    )
    assert M.read_multipliers(m, 1) == {"a,b": "10"}


def test_partition_columns_are_typed(spark):
    out = C.add_partition_columns(spark.range(1), ContractSpec(1, 2, 3))
    assert dict(out.dtypes)["part_source_id"] == "smallint" and dict(out.dtypes)["part_contract_id"] == "bigint"


def test_scaling_is_exact_for_the_whole_type(spark):
    """Large values, small factors, signs; a product beyond the type is null."""
    cases = [("123456789012345678.5", "2"), ("0.5", "0.000000001"), ("-98765432109876543210.25", "0.1"), ("1234567890123456789012345.1", "1.5"), ("7", "-0.25"), ("999", "1000000000000")]
    for value, factor in cases:
        got = spark.createDataFrame([(value,)], "a string").select(M.scaled(F.col("a"), factor).alias("a")).head()[0]
        with localcontext() as context:
            context.prec = 60
            assert got == (Decimal(value) * Decimal(factor)).quantize(Decimal("1e-10")), (value, factor)
    huge = spark.createDataFrame([("9" * 27,), ("x",), (None,)], "a string")
    assert [r[0] for r in huge.select(M.scaled(F.col("a"), "100")).collect()] == [None, None, None]


def test_unparsable_measures_become_null(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    assert [None if v is None else float(v) for v in M.scale_precision(df, {"a": 1, "b": 2}).head()] == [0.15, None]
