import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from panelgrain.llm import substring_dedup as S


def brute(rows, width=50):
    """The definition, string by string."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - width + 1):
            if doc is not None:
                first[raw[i : i + width]] = min(doc, first.get(raw[i : i + width], doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if doc is not None and first[raw[i : i + width]] < doc:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def some_texts(seed):
    r = random.Random(seed)
    say = lambda n: " ".join("".join(r.choice("abcdeéß世") for _ in range(r.randint(1, 7))) for _ in range(n))
    passage, line, long = say(60), say(16), say(700)
    rows = [(i, say(r.randint(0, 80))) for i in range(1, 25)]
    rows += [(30, long), (31, long), (32, long[:900] + "XX" + long[900:]), (33, long[5:1500]), (29, "zz" + long[700:])]
    for i in range(40, 70):
        rows.append((i, say(r.randint(0, 30)) + line + "\n" + say(r.randint(0, 30)) + (passage if i % 3 == 0 else "")))
    rows += [(80, "a" * 400), (81, "a" * 49), (82, "a" * 50 + "b"), (79, "ab" * 90), (83, "ba" * 60)]
    rows += [(90, None), (91, ""), (92, passage[:30]), (None, passage + long), (None, None), (95, passage), (95, passage), (95, line + passage)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [4096, 3])
def test_equals_brute_force(spark, documents, clashing, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    rows = some_texts(hot)
    got = sorted((tuple(x) for x in S.without_repeats(documents(rows, clashing)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark, documents):
    assert S.without_repeats(documents([(1, "x")]).limit(0)).collect() == []


def test_refinement_separates_exactly():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1200] = data[100:300]
    places = np.arange(0, 3900)
    number = S.refined(data, places)
    strings = [data[p : p + 50].tobytes() for p in places]
    groups = {}
    for s, n in zip(strings, number.tolist(), strict=True):
        assert groups.setdefault(s, n) == n
    assert len(set(groups.values())) == len(groups)


def test_bucket_names_take_five_bytes():
    """Twice a bucket's name, as it is listed, has at most 40 bits; the other bytes of a row's name are zeros and pack away."""
    r = random.Random(5)
    text = "".join(r.choice("abcdefgh ") for _ in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([text]), pa.array([None], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=["doc_id", "tkey", "text", "pieces"])
    names = np.concatenate([np.asarray(b.column(2)) for b in S._anchor_buckets([batch], S.SPARE)])
    assert len(names) > 100 and names.min() >= 0 and int(names.max()) * 2 < 1 << 40


@pytest.mark.parametrize(("many", "spare", "wide"), [(1 << 28, 56, 16), (0, 56, 25)])
def test_names_that_clash_only_cost_work(spark, documents, monkeypatch, many, spare, wide):
    """With names of 8 bits most q-grams share one with others; over MANY pieces the wide names are taken."""
    monkeypatch.setattr(S, "MANY", many)
    monkeypatch.setattr(S, "SPARE", spare)
    monkeypatch.setattr(S, "WIDE_SPARE", wide)
    rows = some_texts(7)
    assert sorted((tuple(x) for x in S.without_repeats(documents(rows)).collect()), key=str) == brute(rows)


def test_runs_are_made_once(spark, documents):
    """What judges the runs and what asks for their bytes read one shuffle: one step of the plan takes the shared q-grams."""
    adaptive, wide = "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k) for k in (adaptive, wide)}
    try:
        spark.conf.set(adaptive, "false")
        spark.conf.set(wide, "-1")
        plan = S.without_repeats(documents(some_texts(3)))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum("MapInArrow" in line and "shared#" in line for line in plan.splitlines()) == 1


def test_buckets_number_codes_in_order():
    """Codes that leave no room for a place are numbered like those that do."""
    codes = np.random.default_rng(8).integers(0, 1 << 20, 5000).astype(np.uint64)
    want = np.unique(codes, return_inverse=True)[1]
    assert S.buckets(codes, 20).tolist() == want.tolist() == S.buckets(codes, 64).tolist()
