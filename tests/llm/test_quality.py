import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelgrain.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Learns on two thirds of the labels, is right on the third."""
    got = Q.op5(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert len(rows) > 800
    right = sum(r.quality == r.predicted for r in rows) / len(rows)
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [1 - r.predicted for r in rows if r.quality == 0]
    assert right > 0.98 and np.mean(good) > 0.985 and np.mean(bad) > 0.9
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_held_out_labels_do_not_matter(spark, documents):
    rows = [(i, "plain words in a line " * (i % 7 + 1) if i % 3 else "###" * (i % 5 + 4)) for i in range(400)]
    docs = documents(rows)
    marks = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    other = marks.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert Q.learn(docs, marks) == Q.learn(docs, other)


def test_column_equals_arrays(spark, documents):
    """The compiled expression says what the rules say over the arrays."""
    rows = [(i, ("Ab c9 é " * (i % 11)) + "x!" * (i % 4) + "\nline" * (i % 3)) for i in range(60)]
    model = Q.RuleModel(0.25, ((1.5, (Q.Term(3, 0.1, True), Q.Term(8, 0.5, False))), (-2.0, (Q.Term(10, 0.8, True),))))
    names = [Q.PREFIX + s for s in Q.STATS]
    for r in Q.scored(documents(rows), model).collect():
        v = np.array([[r[n] for n in names]])
        total = model.bias + sum(w for w, terms in model.rules if all(t.holds(v)[0] for t in terms))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-total)))
        assert np.isfinite(v).all()


def test_edge_rows(spark, documents, clashing):
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "fine"), (2, None), (None, ""), (3, "y " * 200000), (1, "fine"), (4, "\n\n")]
    docs = documents(rows, clashing + ", score long, stat_upper long")
    assert Q.good_documents(docs, marks).count() == 6
    assert Q.good_documents(docs.limit(0), marks.limit(0)).collect() == []
    assert Q.good_documents(docs, marks).columns == docs.columns
    held = {r[0]: r[1] for r in documents([(i, "") for i in range(50)]).select("doc_id", Q.held_out()).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
