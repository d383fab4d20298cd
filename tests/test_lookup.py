"""Joins, periods and keys."""

import datetime
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelgrain.operators import dedup as D
from panelgrain.operators import filters as FL
from panelgrain.operators import keys as K
from panelgrain.operators import lookup as J
from panelgrain.operators import periods as T
from tests.conftest import ordered, rows

DAY = datetime.date


def like(text, pattern):
    return re.fullmatch("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern), text, re.S) is not None


def best(code, patterns):
    hits = [p for p in patterns if like(code, p)]
    key = lambda p: (-len(re.match(r"[^%_]*", p).group()), bool(re.search("[%_]", p)), p)
    return min(hits, key=key) if hits else None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    codes=st.lists(st.text(alphabet="ab1", max_size=4), min_size=1, max_size=8),
    patterns=st.sets(st.text(alphabet="ab1%_", min_size=1, max_size=4), min_size=1, max_size=6),
)
def test_like_lookup_against_brute_force(spark, codes, patterns):
    df = spark.createDataFrame([(i, "g", c) for i, c in enumerate(codes)], "id int, g string, code string")
    pats = spark.createDataFrame([("g", p, p.upper()) for p in patterns], "g string, pattern string, label string")
    got = rows(J.like_lookup(df, pats, ["g"], "code", "pattern", ["label"]), "id", "pattern")
    assert got == ordered((i, best(c, patterns)) for i, c in enumerate(codes))


def test_like_lookup_keeps_other_groups_apart(spark):
    df = spark.createDataFrame([(1, "g", "abc"), (2, "h", "abc"), (3, "g", None)], "id int, g string, code string")
    pats = spark.createDataFrame([("g", "ab%", "x")], "g string, pattern string, label string")
    assert rows(J.like_lookup(df, pats, ["g"], "code", "pattern", ["label"]), "id", "label") == [(1, "x"), (2, None), (3, None)]


def test_patterns_wild_at_both_ends_meet_codes_under_their_rarest_gram(spark):
    """10,000 patterns: a code is paired only under a shared q-gram, far from all pairs."""
    rng = random.Random(1)
    text = lambda n: "".join(rng.choices("abcdefghij", k=n))
    names = [text(rng.randint(0, 12)) for _ in range(1500)]
    patterns = sorted({f"%{text(rng.randint(3, 5))}{rng.choice(['', '_' + text(2)])}%" for _ in range(13_000)} | {r"%a\%_b%", "%ab%", "%j%", "%%", "_%"})
    codes = spark.createDataFrame([(n,) for n in sorted(set(names))], "code string")
    rules = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    inner = rules.where(F.length(F.regexp_replace("pattern", "[%_]", "")) > 0)
    pairs = [tuple(r) for r in J.inner_pairs(codes, inner, [], "code", "pattern").select("code", "pattern").collect()]
    grams = lambda p: [lit for lit in re.split("[%_]", p.replace("\\%", "\x00")) if lit]
    shared = lambda c, p: any(g.replace("\x00", "%")[i : i + 3] in c for g in grams(p) for i in range(max(1, len(g) - 2)))
    assert len(patterns) > 10_000 and all(shared(c, p) for c, p in pairs)
    assert len(pairs) == len(set(pairs)) < 0.02 * len(patterns) * len(set(names))
    got = {tuple(r) for r in J.like_hits(codes, rules, [], "code", "pattern").select("code", "pattern").collect()}
    plain = [p for p in patterns if "\\" not in p]
    compiled = {p: re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in p)) for p in plain}
    assert got == {(c, p) for c in set(names) for p in plain if compiled[p].fullmatch(c)}


def test_layers_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "z")], "id int, m string, country string")
    own = spark.createDataFrame([("a", 10), ("a", 11)], "m string, v int")
    country = spark.createDataFrame([("x", 20)], "country string, v int")
    out = J.layered(df, [J.Layer(own, ("m",)), J.Layer(country, ("country",))], "v")
    assert rows(out, "id", "v") == [(1, 10), (2, 20), (3, None)]
    assert rows(J.layer_conflicts(J.Layer(own, ("m",)), "v")) == [("a", 10, 11)]


def test_star_keeps_unknown_codes(spark):
    fact = spark.createDataFrame([("m1", "p9")], "m string, p string")
    dims = [(spark.createDataFrame([("m1", 5)], "m string, mk int"), ["m"]), (spark.createDataFrame([("p1", 6)], "p string, pk int"), ["p"])]
    assert rows(J.star(fact, dims), "mk", "pk") == [(5, None)]


def test_status_words(spark):
    a, b = (spark.createDataFrame([(x,) for x in t], "k string") for t in ("ab", "bc"))
    assert rows(J.delivered_status(a, b, ["k"])) == [("a", "new"), ("b", "delivered"), ("c", "missing")]


def test_earlier_claims(spark):
    claims = spark.createDataFrame([("k", 1, 5), ("k", 2, 6), ("k", 1, 7), ("j", 3, 1)], "claim_key string, run_id int, claimed_at int")
    assert rows(J.earlier_claims(claims), "claim_key", "run_id", "holder") == [("k", 2, 1)]


def test_period_by_start_or_end(spark):
    dim = spark.createDataFrame([(1, DAY(2024, 1, 1), DAY(2024, 1, 31), "MH"), (2, DAY(2024, 1, 29), DAY(2024, 2, 4), "WK")], "period_id int, start_date date, end_date date, type string")
    given_ = spark.createDataFrame(
        [("a", DAY(2024, 1, 1), DAY(2024, 1, 30), "MH"), ("b", None, DAY(2024, 1, 31), "MH"), ("c", DAY(2024, 1, 1), DAY(2024, 1, 31), "WK"), ("d", DAY(2024, 1, 1), DAY(2024, 1, 31), "MH")],
        "period_code string, period_start date, period_end date, period_type string",
    )
    assert rows(T.resolve_by_start_or_end(given_, dim), "period_code", "period_id") == [("a", 1), ("b", 1), ("c", None), ("d", 1)]


@pytest.mark.parametrize(
    "name, n, expected",
    [("WK", 2, DAY(2024, 3, 17)), ("mth", 1, DAY(2024, 2, 29)), ("BIMTH", 1, DAY(2024, 1, 31)), ("QTR", 1, DAY(2023, 12, 31)), ("CUSTM", 1, DAY(2024, 3, 24)), ("WK", 0, None), ("WK", None, None), ("WK", -1, None)],
)
def test_retention(spark, name, n, expected):
    df = spark.createDataFrame([(DAY(2024, 3, 31), name, n)], "e date, c string, n int")
    assert df.select(T.retention_date(F.col("e"), F.col("c"), F.col("n"))).head()[0] == expected


def test_five_week_factor(spark):
    weeks = [("MH", "WKMS", DAY(2024, 3, 31), i) for i in range(5)] + [("MH", "WKMS", DAY(2024, 4, 30), i) for i in range(4)] + [("MH", "WK", DAY(2024, 4, 30), 9)]
    assoc = spark.createDataFrame(weeks, "type_a string, type_b string, end_a date, id_b int")
    assert [r[2] for r in rows(T.five_week_factor(assoc, True))] == [0.8, 1.0]
    assert [r[2] for r in rows(T.five_week_factor(assoc, False))] == [1.0, 1.0]


def test_keys_are_idempotent_and_dense(spark):
    empty = spark.createDataFrame([], "code string, surrogate_key long, run_id long")
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "code string")
    keyed, added = K.assign_keys(df, ["code"], empty, 1)
    assert sorted(r.surrogate_key for r in added.collect()) == [1_000_001, 1_000_002]
    assert [r for r in rows(keyed) if r[0] is None] == [(None, None)]
    again, none = K.assign_keys(df, ["code"], added, 2)
    assert none.count() == 0 and rows(again) == rows(keyed)
    more, third = K.assign_keys(spark.createDataFrame([("c",), ("a",)], "code string"), ["code"], added, 3)
    assert [r.surrogate_key for r in third.collect()] == [1_000_003] and more.count() == 2


def test_keys_with_one_hot_natural_key(spark):
    empty = spark.createDataFrame([], "code string, surrogate_key long, run_id long")
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("code"))
    keyed, added = K.assign_keys(df, ["code"], empty, 1)
    assert keyed.count() == 3000 and added.count() == 1001
    assert added.agg(F.max("surrogate_key")).head()[0] == 1_000_000 + 1001


def test_latest_and_unanimous(spark):
    df = spark.createDataFrame([("c", 1, "x", "a"), ("c", 2, "x", None), (None, 9, "y", "b")], "k string, at int, v string, w string")
    assert rows(D.latest_per_key(df, ["k"], "at", not_null="k"), "k", "at") == [("c", 2)]
    assert rows(D.unanimous(df, ["k"], ["v", "w"])) == [(None, "y", "b"), ("c", "x", "a")]


def test_repeated_rows_treat_null_as_a_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, v int")
    assert rows(D.repeated_rows(df, ["k", "v"])) == [(None, 1, 2), (None, 1, 2)]


def test_tag_rows_and_identifiers(spark):
    df = spark.createDataFrame([("M", "x"), ("m", "P"), ("m", "p"), (None, "p")], "a string, b string")
    assert rows(FL.drop_tag_rows(df, {"a": "M", "b": "P"})) == [("m", "p")]
    assert FL.safe_identifier("a_1.b") == "a_1.b"
    with pytest.raises(ValueError):
        FL.safe_identifier("a; drop")


def test_inner_patterns_meet_codes_under_whole_literals_and_are_not_broadcast(spark):
    codes = spark.createDataFrame([("123",), ("234",), ("345",), ("12345",), ("x12345y",), ("abcdefghijkl",), ("abcdefgh",), ("efghijkl",), ("a%b",)], "code string")
    rules = spark.createDataFrame([("%12345%",), ("%abcdefghij%",), ("%a\\%b%",), ("%1_3%",), ("%no such%",)], "pattern string")
    pairs = rows(J.inner_pairs(codes, rules.where("pattern = '%12345%'"), [], "code", "pattern"), "code", "pattern")
    assert pairs == [("12345", "%12345%"), ("x12345y", "%12345%")]  # not each code with one of its three-character pieces
    hits = J.like_hits(codes, rules, [], "code", "pattern")
    assert rows(hits, "code", "pattern") == ordered([("12345", "%12345%"), ("x12345y", "%12345%"), ("abcdefghijkl", "%abcdefghij%"), ("a%b", "%a\\%b%"), ("123", "%1_3%"), ("12345", "%1_3%"), ("x12345y", "%1_3%")])
    # A table that looks small is many filed codes: they are shuffled, whatever its size says.
    joins = [line for line in J.inner_pairs(codes, rules, [], "code", "pattern")._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in line and "_gram" in line]
    assert "SortMergeJoin" in joins[0]
