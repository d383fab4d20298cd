import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from panelgrain.llm import negatives as N

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, negatives=10, every=100):
    """By definition, in Python's whole numbers."""
    sound = []
    for vec_id, label, v in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            sound.append((vec_id, label, [math.floor(256 * x) for x in v]))
    place = lambda r: (r[1] is None, r[1] or 0)
    out = []
    for i, (a_id, a_label, a) in enumerate(sound):
        if a_id is None or a_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), vec_id, label) for j, (vec_id, label, v) in enumerate(sound) if j != i]
        scored.sort(key=lambda r: (-r[0], place(r)))
        for ps, p_id, _ in [r for r in scored if r[2] == a_label][:positives]:
            far = [r for r in scored if r[2] != a_label and 30 * ps <= 100 * r[0] <= 90 * ps][:negatives]
            out += [(a_id, p_id, k + 1, n_id, ps, ns) for k, (ns, n_id, _) in enumerate(far)]
    return sorted(out, key=repr)


def found(df, **more):
    out = N.hard_negatives(df, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "ANCHOR_ROWS", 3)
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), [float(x) for x in rng.normal(0.1, 0.3, 8)]) for i in range(700)]
    rows += [(700 + i, i % 3, rows[100][2]) for i in range(40)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows)
    assert len(want) > 200 and found(df) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.5, 0.2]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [1.0, None]),
        (6, 2, [nan, 1.0]), (7, 2, [1.0, inf]), (None, 1, [0.9, 0.5]), (None, 2, [0.5, 0.2]), (8, 2, [0.5, 0.2]), (9, 2, []),
        (100, 2, [0.4]), (100, 1, [0.4, 0.3]), (100, 1, [0.4, 0.3]), (-100, 2, [0.7, 0.7, 0.7]), (200, 3, [0.1, 0.1]), (300, 1, [-1.0, -1.0]),
    ]
    df = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], SCHEMA + ", row long, score long, c long").repartition(2)
    want = brute(rows)
    assert want and found(df) == want
    assert {r[1] for r in want} & {None} and any(r[0] == 100 and r[1] == 100 for r in want)
    assert found(df.limit(0)) == []


def test_scores_beyond_a_word(spark):
    rows = [(0, 1, [1e6, -3e5]), (1, 1, [1.1e6, 5.0]), (2, 2, [5e5, 1.0]), (3, 2, [9e5, -1e5]), (4, 2, [1.0, 1.0]), (100, 2, [-1e5, 7e5])]
    want = brute(rows)
    assert want and want[0][4] > N.WORD_BOUND and found(spark.createDataFrame(rows, SCHEMA)) == want
    huge = [(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [5e29])]
    assert all(abs(r[4]) <= 1 << 63 for r in found(spark.createDataFrame(huge, SCHEMA)))


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_packed_products_are_exact(data):
    width, most = data.draw(st.integers(0, 9)), data.draw(st.sampled_from([1, 200, 1 << 15, 1 << 40, 1 << 62]))
    side = lambda n: np.array(data.draw(st.lists(st.lists(st.integers(-most, most), min_size=width, max_size=width), min_size=n, max_size=n)), dtype=np.int64).reshape(n, width)
    a, r = side(3), side(data.draw(st.integers(1, 8)))
    assert N.exact_scores(a, r).tolist() == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in r] for p in a]


def test_several_rows_share_a_word():
    rng = np.random.default_rng(1)
    a, r = rng.integers(-60, 60, (4, 16)), rng.integers(-60, 60, (11, 16))
    u = r - r.min(axis=0)
    assert 64 // int(((a - a.min()) @ u.max(axis=0)).max()).bit_length() >= 3
    assert (N.exact_scores(a, r) == a @ r.T).all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_broadcast(spark, monkeypatch):
    """Equal vectors make small files, by which Spark would broadcast every copy of the anchors."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 20)
    plans, written = [], N.written
    monkeypatch.setattr(N, "written", lambda df, label: plans.append(_plan(df)) or written(df, label))
    rows = [(i, i % 3, [0.5, 0.25]) for i in range(300)]
    plans.append(_plan(N.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(2), every=10)))
    assert sum("SortMergeJoin" in p for p in plans) == 3 and not any("Broadcast" in p for p in plans)


def test_parts_of_rows_and_anchors(spark, monkeypatch):
    """Several blocks and several anchor groups in a lane, in several lanes of either; ties, and positives below 0."""
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    monkeypatch.setattr(N, "ANCHOR_ROWS", 5)
    rng = np.random.default_rng(8)
    rows = [(i % 310, int(rng.integers(0, 4)), [float(x) for x in rng.normal(0.05, 0.3, 3).round(1)]) for i in range(330)]
    rows += [(None, 1, rows[0][2]), (None, 2, rows[2][2]), (1000, 9, [-5.0, -5.0, -5.0]), (1002, 9, [5.0, 5.0, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute(rows, 3, 4, 2)
    assert len(want) > 500 and found(df, positives=3, negatives=4, every=2) == want


def test_lanes_follow_the_tasks():
    """Rows and anchors grow; the shuffled copies of either stay in proportion to the rows."""
    for n in (700_000, 7_000_000, 700_000_000):
        across, down = N._lanes(200, n, n // 4096, n // 100, n // 51200, 50)
        assert 180 <= across * down <= 220 and across <= 60 and down <= 5
    assert N._lanes(200, 0, 0, 0, 1, 5) == (1, 1) and N._lanes(200, 9000, 3, 90, 1, 5) == (3, 1)
    assert N._lanes(200, 9000, 3, 9000, 18, 50) == (3, 18)
