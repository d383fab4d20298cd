"""The pipeline against a brute-force version of each stage on what the stage before it kept."""

import hashlib
import zlib

import corpus_pipeline as C
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelgrain.llm import mixing, quality, tokens
from panelgrain.llm.shared import table, written
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_near_dedup import brute as brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        out.append((docs.columns, [tuple(r) for r in docs.collect()]))
    return out


def documents(spark):
    return [tuple(r) for r in table(spark, SF, "documents").collect()]


def test_stages_keep_the_columns(spark, stages):
    assert [len(s) for s in C.STAGES] == [2] * 5
    for columns, _ in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_what_is_accepted(spark, stages):
    frame = quality.scored(table(spark, SF, "documents"), quality.learn(table(spark, SF, "documents"), table(spark, SF, "labels")))
    accepted = {r.doc_id for r in frame.where("predicted = 1").collect()}
    assert sorted(stages[0][1]) == sorted(r for r in documents(spark) if r[0] in accepted)
    assert 0 < len(accepted) < len(documents(spark))


def test_one_of_each_group_stays(stages):
    kept = {r[0] for r in brute_groups([r[:2] for r in stages[0][1]]) if r[3]}
    assert sorted(stages[1][1]) == sorted(r for r in stages[0][1] if r[0] in kept)


def test_documents_with_items_go(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {d for d, _ in brute_leaks([r[:2] for r in stages[1][1]], items)}
    assert sorted(stages[2][1]) == sorted(r for r in stages[1][1] if r[0] not in leaked)


def test_copies_follow_the_draw(stages):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", stages[2][1])
    want = db.execute(f"SELECT doc_id, text, lang, source, n_chars FROM ({mixing.MIX_SQL})").fetchall()
    assert sorted(stages[3][1]) == sorted(want)


def test_tokens_of_all_copies(spark, stages):
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    seen, placed = {}, []
    for doc, text, *_ in stages[3][1]:
        seen[doc] = seen.get(doc, 0) + 1
        placed.append((hashlib.md5(f"order|{doc}|{seen[doc]}".encode()).hexdigest(), doc, text))
    want, start = [], 0
    for _, doc, text in sorted(placed):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(stages[4][1], key=lambda r: r[1]) == want
    assert sorted(tuple(r) for r in C.run(spark, SF).collect()) == sorted(want)


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        assert docs.count() == 0


def test_unnamed_and_repeated_ids_stay(spark):
    """A third of the rows without an id, and ids with several texts: what is unlike stays, by row, in every order of rows."""
    prose = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(i, prose(i)) for i in range(10)] + [(None, prose(100 + i)) for i in range(8)]  # all unlike
    rows += [(None, prose(3)), (None, prose(100)), (None, prose(100) + " more"), (None, ""), (None, None)]  # copies and a near copy
    rows += [(4, prose(200)), (4, prose(4)), (4, prose(5)), (4, prose(200) + " tail")]  # texts under one id
    frame = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [[tuple(r) for r in C.near_dedup(spark, f, SF).collect()] for f in (frame.repartition(5), frame.orderBy(F.col("text").desc()))]
    assert sorted(got[0], key=str) == sorted(got[1], key=str)
    # A near copy may stand for its group; cut it to what the group has in common.
    texts = sorted((t or "").removesuffix(" more").removesuffix(" tail") for _, t, *_ in got[0])
    assert texts == sorted(["", *[prose(i) for i in (*range(10), *range(100, 108), 200)]])
    assert all(d == i for d, t, *_ in got[0] for i in range(10) if t == prose(i) and i not in (4, 5))
    tokens = C.tokens(spark, frame.where("doc_id IS NULL"), SF).collect()
    assert len(tokens) == sum(d is None for d, _ in rows)


def test_clashing_columns_keep_their_values(spark):
    """Whatever the caller's columns are called, every stage and helper returns them as they came."""
    names = "_id _key _node _first _kept _i _k rate copy _mix _count _from _source _rate cdf draws score predicted stat_upper tkey node row key id place hub kept item_id n size text_ number".split()
    plain = table(spark, SF, "documents").limit(150)
    extra = [F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in names]
    repeated = plain.limit(30).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    docs = written(plain.unionByName(repeated).select("*", *extra), "test")
    for _, stage in C.STAGES[:-1]:
        want = [tuple(r) for r in stage(spark, docs.select(*plain.columns), SF).collect()]
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str) and got
        for r in got:
            assert list(r)[5:] == [f"{name}:{'none' if r.doc_id is None else r.doc_id}" for name in names]
    assert C.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in ("rate", "copy")] + ["rate", "copy"]
    assert all(r["_mix"].startswith("_mix:") and r.copy >= 1 for r in mixed.collect())
