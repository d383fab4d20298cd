import math

import pytest
from pyspark.sql import functions as F

from panelgrain.llm import mixing as M


def test_shares_come_near_the_target(spark, documents):
    rows = [(i, "w" * (10 + i % 5), "big" if i % 4 else "small") for i in range(8000)]
    out = M.mix(documents(rows), weights={"big": 1.0, "small": 1.0, "absent": 3.0})
    sizes = {r.source: r.n for r in out.groupBy("source").agg(F.sum("n_chars").alias("n")).collect()}
    assert sizes["small"] / sum(sizes.values()) == pytest.approx(0.5, abs=0.03)
    assert sum(sizes.values()) == pytest.approx(sum(len(r[1]) for r in rows), rel=0.04)


def test_counts_are_poisson_and_repeatable(spark, documents):
    rows = [(i, "same size", "s") for i in range(20000)]
    docs = documents(rows)
    counts = {r.doc_id: r["count"] for r in M.mix(docs, epochs=1.7).groupBy("doc_id").count().collect()}
    again = {r.doc_id: r["count"] for r in M.mix(docs.repartition(7), epochs=1.7).groupBy("doc_id").count().collect()}
    assert counts == again
    for k in range(5):
        share = sum(counts.get(i, 0) == k for i in range(20000)) / 20000
        assert share == pytest.approx(math.exp(-1.7) * 1.7**k / math.factorial(k), abs=0.012)
    other = {r.doc_id for r in M.mix(docs, epochs=1.7, seed="x").select("doc_id").distinct().collect()}
    assert other != set(counts)


def test_copies_are_numbered_and_shuffled(spark, documents):
    out = M.mix(documents([(i, "t", "s") for i in range(3000)]), epochs=2.0)
    rows = out.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r.copy)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by_doc.values())
    ids = [r.doc_id for r in rows]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) == pytest.approx(len(ids) / 2, rel=0.1)


def test_edge_rows(spark, documents, clashing):
    rows = [(1, None, None), (2, "", "e"), (3, "", "e"), (None, "x", "s"), (4, "y", "s"), (4, "y", "s")]
    docs = documents(rows, clashing)
    out = M.mix(docs)
    assert set(docs.columns) == set(out.columns)
    assert {r.source: r.rate for r in out.select("source", "rate").distinct().collect()}.get("e", 1.0) == 1.0
    assert M.mix(docs.limit(0)).collect() == []
    assert M.mix(docs, weights={}).where("source = 's'").count() == 0
    drawn = M.mix(documents([(1, "a", "tiny")] + [(i, "b" * 900, "s") for i in range(2, 9)]), weights={"tiny": 1.0}).collect()
    assert {r.doc_id for r in drawn} == {1} and abs(len(drawn) - 6301) < 6 * 6301**0.5


def test_rows_without_an_id_are_drawn_one_by_one(spark, documents):
    """By their texts, so a corpus part without ids neither vanishes nor multiplies as one block."""
    docs = documents([(None, f"text {i}", "s") for i in range(3000)] + [(i, f"text {i}", "s") for i in range(3000)])
    out = M.mix(docs)
    unnamed = [r.n for r in out.where("doc_id IS NULL").groupBy("text").agg(F.count("*").alias("n")).collect()]
    assert sum(unnamed) == pytest.approx(3000, abs=6 * 3000**0.5) and 1800 < len(unnamed) < 2000


def test_any_rate_is_drawn(spark, documents):
    """A tiny source beside a very large one: rates of 900 (two draws) and 200,000 (400 draws, copies in many parts)."""
    rows = [(i, "a", "tiny") for i in range(40)] + [(100, "b" * 35960, "large")]
    out = M.mix(documents(rows), weights={"tiny": 1.0})
    counts = {r.doc_id: (r.n, r.most, r.rate) for r in out.groupBy("doc_id").agg(F.countDistinct("copy").alias("n"), F.max("copy").alias("most"), F.max("rate").alias("rate")).collect()}
    assert sorted(counts) == list(range(40)) and out.count() == sum(n for n, _, _ in counts.values())
    assert all(n == most and rate == 900 and abs(n - 900) < 6 * 30 for n, most, rate in counts.values())
    mean = sum(n for n, _, _ in counts.values()) / 40
    spread = sum((n - mean) ** 2 for n, _, _ in counts.values()) / 39
    assert mean == pytest.approx(900, abs=4 * 30 / 40**0.5) and 300 < spread < 2000
    one = M.mix(documents([(1, "a", "tiny"), (2, "b" * 199_999, "large")]), weights={"tiny": 1.0})
    found = one.agg(F.count("*"), F.countDistinct("copy"), F.max("copy")).first()
    assert found[0] == found[1] == found[2] and abs(found[0] - 200_000) < 6 * 200_000**0.5


def test_high_rates_follow_poisson(spark):
    """Up to MOST_RATE one draw, as before; above it the sum of two has the distribution of the whole rate."""
    rates = M.poisson_table(spark.createDataFrame([("a", 500.0), ("b", 501.0), ("c", 0.0)], "source string, rate double"))
    assert {r.source: r.draws for r in rates.collect()} == {"a": 1, "b": 2, "c": 1}
    counts = [r.n for r in spark.range(4000).withColumnRenamed("id", "doc_id").join(rates.where("source = 'b'")).select(M.drawn_count("s").alias("n")).collect()]
    mean = sum(counts) / len(counts)
    assert mean == pytest.approx(501, abs=1.8)
    assert sum((n - mean) ** 2 for n in counts) / len(counts) == pytest.approx(501, rel=0.12)
