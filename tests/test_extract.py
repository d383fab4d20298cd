"""Extracts: record tests, positions, short lines, empty input, missing columns."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from panelgrain.operators import extract as E
from panelgrain.operators import layouts as L
from panelgrain.operators import reshape as R
from panelgrain.sources import readers as SRC
from panelgrain.spec import ContractSpec
from tests.conftest import rows

SPEC = ContractSpec(run_id=7, contract_id=101, source_id=3)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize("layout", L.FIXED.values(), ids=lambda x: x.name)
def test_layouts_do_not_overlap(layout):
    assert layout.overlaps() == []


@pytest.mark.parametrize("layout", L.FIXED.values(), ids=lambda x: x.name)
def test_empty_input_gives_no_rows_and_all_columns(spark, layout):
    out = E.extract_fixed_width(lines(spark).limit(0), layout)
    assert out.count() == 0
    assert {f.name for f in layout.all_fields()} - {layout.prefix_field} <= set(out.columns)


def test_market_line(spark):
    text = "G" + "M01".ljust(24) + "North".ljust(41) + "1 SOAP REG"
    out = E.extract_markets(lines(spark, text, "Lother", "G"), L.MARKET_A, SPEC)
    assert rows(out, "code", "name", "attribute_0", "attribute_2", "attribute_3", "level", "run_id") == [
        ("", "", "", None, None, 0, 7),
        ("M01", "North", "1", "REG", None, 2, 7),
    ]


def test_multi_byte_lines_are_cut_by_character(spark):
    text = "G" + "Mé1".ljust(24) + "Zürich".ljust(41) + "1 ß"
    assert rows(E.extract_markets(lines(spark, text), L.MARKET_A, SPEC), "code", "name", "attribute_1") == [("Mé1", "Zürich", "ß")]


def test_coded_market_prefix(spark):
    text = "AAAAAA02  " + "000123".ljust(38) + "Area".ljust(80) + "XY" + "1 A"
    assert rows(E.extract_fixed_width(lines(spark, text, text.replace("02", "04", 1)), L.MARKET_B), "code", "name") == [("XY000123", "Area")]


def test_fact_lines(spark):
    head = "U" + "N".ljust(9) + "P1".ljust(9) + "T1".ljust(9) + "K" + " " * 23
    out = E.extract_fixed_width(lines(spark, head + "".join(str(i).rjust(10) for i in range(1, 21)) + "tail"), L.FACT_A, prefix_when="N")
    assert rows(out, "market_code", "product_code", "period_code", "slot_1", "slot_20", "rest") == [("KN", "P1", "T1", "1", "20", "tail")]


def test_fact_line_detector(spark):
    good, spaced, short = "9" * 70, "9" * 30 + " " + "9" * 40, "9" * 60
    assert E.records(lines(spark, good, spaced, short), L.FACT_B).count() == 1


def test_measures_and_periods(spark):
    assert rows(E.extract_measures(lines(spark, "O1", "U1"), L.MEASURE_A)) == [("1", "")]
    text = "R2401".ljust(66) + " Jan 24 "
    assert rows(E.extract_periods(lines(spark, text, "X"), L.PERIOD_A)) == [("2401", "Jan 24", 0)]


def test_generated_order(spark):
    df = spark.createDataFrame([("b", "B"), ("a", "A")], "period_id string, period_long_description string")
    assert rows(E.extract_periods(df, L.PERIOD_D3), "code", "line_num") == [("a", 1), ("b", 2)]


def test_delimited_missing_column_raises(spark):
    with pytest.raises(AnalysisException):
        E.extract_markets(spark.createDataFrame([("a",)], "TAG string"), L.MARKET_D, SPEC).collect()


def test_delimited_product_roles(spark):
    df = spark.createDataFrame([("p", "1 A B", "Soap", "4")], "TAG string, SHORT string, LONG string, DISPLAY_ORDER string")
    assert rows(E.extract_products(df, L.PRODUCT_D2, SPEC, 2), "code", "name", "match_path", "line_num") == [("p", "Soap", "1 A B Soap", 4)]
    assert rows(E.extract_products(df, L.PRODUCT_D, SPEC, 9), "name", "attributes", "match_path") == [("1 A B", "Soap", "Soap")]


def test_product_text_is_cleaned(spark):
    text = "L" + "P1".ljust(25) + "Café ･x"
    assert rows(E.extract_products(lines(spark, text), L.PRODUCT_A, SPEC, 9), "name") == [("Caf__ ___x",)]


def test_delimited_facts(spark):
    columns = [f"col{i}" for i in range(1, 104)]
    blank = [None] * 100
    data = [["MKT_TAG", "PROD_TAG", "PER_TAG", *blank], ["m", "p", "t", "1", *blank[1:]], ["m", "bad", "t", "1", *blank[1:]], [None] * 103, ["m", "PROD_TAG", "t", *blank]]
    df = spark.createDataFrame([tuple(r) for r in data], ", ".join(f"{c} string" for c in columns))
    invalid = spark.createDataFrame([("bad",), ("bad",)], "product_code string")
    out = E.extract_delimited_facts(df, SPEC, invalid)
    assert rows(out, "market_code", "product_code", "period_code", "measure_1", "measure_100", "contract_id") == [("m", "p", "t", "1", None, 101)]
    assert E.extract_delimited_facts(df.limit(0), SPEC).count() == 0


def test_hierarchies(spark):
    products = spark.createDataFrame(
        [("p1", "2", "1", "p1 Soap", "A", " "), ("p2", "2", "1", "", "A", "B"), ("p3", "1", "1", "x", "A", "B"), ("p2", "2", "1", "", "A", "B")],
        "product_id string, hierarchy_number string, hierarchy_level string, name string, kind string, brand string",
    )
    definitions = spark.createDataFrame([("2", "2", "brand"), ("2", "1", "kind"), ("1", "1", "kind")], "hierarchy_number string, hierarchy_level string, column_name string")
    valid, invalid = E.products_from_hierarchies(products, definitions)
    assert rows(valid, "product_code", "attributes") == [("p1", "2 A X"), ("p2", "2 A B")]
    assert rows(invalid) == [("p3",)]


SLOTS = [f"slot_{i}" for i in range(1, 21)]


def physical(record, line, start, stop, **other):
    cells = [str(k) if start <= k <= stop else "" for k in range((line - 1) * 20 + 1, line * 20 + 1)]
    return (record, line, *cells)


def test_stitching_is_by_ordinal_not_by_presence(spark):
    """45 measures on three lines; one record lacks a measure in the middle, one has a line too many."""
    data = [physical("r1", n, 1, 45) for n in (1, 2, 3)] + [physical("r2", n, 1, 45) for n in (1, 2, 3)]
    data[4] = (*data[4][:3], "N/A", *data[4][4:])
    data += [("r1", 9, *["99"] * 20), ("empty", 1, *[""] * 20)]
    df = spark.createDataFrame(data, ["record", "line", *SLOTS])
    out = R.stitch_lines(df, ["record"], ["line"], SLOTS, measures=range(1, 61))
    got = {r.record: r for r in out.collect()}
    assert set(got) == {"r1", "r2"}
    assert [float(got["r1"][f"measure_{k}"]) for k in (1, 20, 21, 45)] == [1.0, 20.0, 21.0, 45.0]
    assert got["r1"]["measure_46"] is None
    assert got["r2"]["measure_22"] is None and float(got["r2"]["measure_23"]) == 23.0


def test_wide_facts_pass(spark):
    df = spark.createDataFrame([("k1", ".5", None), ("k2", None, "N/A"), ("k3", "x", "2")], "k string, measure_1 string, measure_2 string")
    out = R.clean_delimited_facts(df, ["measure_1", "measure_2"])
    assert [(r.k, r.measure_1 and float(r.measure_1), r.measure_2 and float(r.measure_2)) for r in out.orderBy("k").collect()] == [("k1", 0.5, None), ("k3", None, 2.0)]


def test_header_unpivot(spark):
    header = spark.createDataFrame([("a", "b", "c", "V1", None, "V3")], ", ".join(f"col{i} string" for i in range(1, 7)))
    assert rows(R.unpivot_header(header)) == [(1, "V1"), (3, "V3")]


def test_bad_cells(spark):
    df = spark.createDataFrame([(1, "ok", "né"), (2, None, "fine")], "id int, a string, b string")
    assert rows(R.bad_cells(df, ["id"])) == [(1, "b", "né")]


def test_raw_reads(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a|b\n1|2\n")
    assert rows(SRC.read_raw(spark, str(tmp_path / "p.csv"), "SFF2")) == [("1", "2")]
    assert SRC.read_raw(spark, str(tmp_path / "p.csv"), "Tape2").columns == ["value"]
    with pytest.raises(ValueError):
        SRC.read_raw(spark, str(tmp_path), "XLS")
    with pytest.raises(ValueError):
        SRC.read_wide_facts(spark, str(tmp_path), "FFS")
    (tmp_path / "w.csv").write_text("market_id,product_id,period_id,v\nm,p,t,1\n")
    assert rows(SRC.read_wide_facts(spark, str(tmp_path / "w.csv"), "SFF3"), "col1", "col3", "col5") == [("MKT_TAG", "PER_TAG", None), ("m", "t", None)]


def test_file_choice(spark, tmp_path):
    for name in ("Fact_1.csv", "prod_1.csv", "prod_2.csv"):
        (tmp_path / name).write_text("x")
    files = SRC.list_files(spark, str(tmp_path))
    assert SRC.choose_file(files, "*fact*") == "Fact_1.csv"
    for glob in ("*prod*", "*time*"):
        with pytest.raises(ValueError):
            SRC.choose_file(files, glob)
    assert SRC.files_like(files, "prod.1*").count() == 0


def test_settings_report_everything_missing(spark):
    contracts = spark.createDataFrame([(1, "f%", "s", 9), (2, None, "", 8)], "contract_id int, file_pattern string, step_pattern string, delimiter_id int")
    delimiters = spark.createDataFrame([(9, "|")], "delimiter_id int, delimiter string")
    assert SRC.load_settings(contracts, delimiters, 1)["delimiter"] == "|"
    with pytest.raises(ValueError, match="file_pattern, step_pattern, delimiter"):
        SRC.load_settings(contracts, delimiters, 2)
    with pytest.raises(ValueError, match="file_pattern"):
        SRC.load_settings(contracts, delimiters, 3)


def test_missing_step_is_none(spark, tmp_path):
    assert SRC.read_step(spark, str(tmp_path / "nothing")) is None


@pytest.mark.parametrize("name", ["wk", "MTH", "bimth", "qtr", "custm"])
def test_legal_classes(name):
    assert SRC.period_class(name) == name.lower()


@pytest.mark.parametrize("name", ["day", "", None, "mth "])
def test_illegal_classes(name):
    with pytest.raises(ValueError):
        SRC.period_class(name)


def test_jdbc_options():
    part = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    options = SRC.jdbc_options("jdbc:x", table="t", partition=part, fetchsize=10)
    assert options["dbtable"] == "t" and options["numPartitions"] == "3" and options["fetchsize"] == "10"
    assert SRC.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    for bad in ({}, {"table": "t", "query": "q"}, {"query": "q", "partition": part}):
        with pytest.raises(ValueError):
            SRC.jdbc_options("jdbc:x", **bad)


def test_deepest_level_is_a_scalar(spark):
    levels = spark.createDataFrame([("1",), ("4",)], "level string")
    df = spark.createDataFrame([(4,), (2,)], "level int").withColumn("d", E.deepest_level(levels))
    assert rows(df.where(F.col("level") == F.col("d")), "level") == [(4,)]


def test_deliveries_are_zipped_in_small_files(spark, tmp_path, monkeypatch):
    """A file of lines that are mostly blanks takes a fraction of their bytes, and no task has to read all of it."""
    from pathlib import Path

    from panelgrain.checks import q_extract as Q

    monkeypatch.setattr(Q, "scratch_path", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(Q, "FILE_LINES", 1000)
    lines = spark.range(5000).coalesce(1).select(F.rpad(F.concat(F.lit("U"), "id"), 262, " ").alias("value"))
    back = Q.delivered(spark, lines)
    files = sorted(Path(tmp_path / "delivery").glob("part-*"))
    assert len(files) == 5 and sum(f.stat().st_size for f in files) < 5000 * 262 // 10
    assert back.exceptAll(lines).isEmpty() and lines.exceptAll(back).isEmpty()


def test_market_codes_of_more_than_six_characters_come_back_whole(spark, tmp_path):
    from panelgrain.checks import QUERIES

    part = spark.createDataFrame([(7, "a ring", "Brand#1", "LARGE"), (1_234_567, "hot bolt", "Brand#2", "SMALL"), (123_456, "bolt", "Brand#2", "SMALL")], "p_partkey long, p_name string, p_brand string, p_type string")
    part.write.parquet(str(tmp_path / "part.parquet"))
    out = QUERIES["ext05_market_fixed_b"](spark, str(tmp_path))
    assert rows(out, "p_partkey", "code", "name") == [(123_456, "XY123456", "bolt"), (1_234_567, "XY1234567", "hot bolt"), (7, "XY7", "a ring")]
    # The vendor's own layout is read as before.
    line = "000000" + "02" + "00" + "123456" + " " * 32 + "bolt".ljust(80) + "XY" + "1 SMALL"
    own = E.extract_markets(spark.createDataFrame([(line,)], "value string"), L.MARKET_B, ContractSpec(7, 101, 3))
    assert rows(own, "code", "name", "attributes") == [("XY123456", "bolt", "1 SMALL")]
