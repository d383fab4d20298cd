import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelgrain.llm import attention as A

LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, held boolean, block long, code int, word string, n long, data string, score double"


def tokens(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(LOW)) if w] + [""]


def base(rows):
    """(doc_id, held, tokens, known, N, log10 likelihood) by definition."""
    counts = Counter(t for _, text, held in rows if not held for t in tokens(text))
    whole, distinct = sum(counts.values()), len(counts)
    return [
        (i, bool(held), len(t := tokens(text)), sum(counts[x] > 0 for x in t), whole, sum(math.log10((counts[x] + 1) / (whole + distinct + 1)) for x in t))
        for i, text, held in rows
    ]


@pytest.fixture(scope="module")
def vocabulary():
    return A.default_vocabulary()


@pytest.fixture
def scored(spark, vocabulary):
    def run(rows):
        docs = spark.createDataFrame([(*r, 0, 0, "w", 0, "d", 0.0) for r in rows], SCHEMA).repartition(3)
        return A.text_likelihoods(docs, F.col("held"), vocabulary).collect()

    return run


def close(found, want):
    key = lambda r: (r[0] is None, r[0] or 0, round(r[5], 6))
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in found], [r[5] for r in want], rtol=1e-11)


def test_base_and_scores(scored):
    rng = np.random.default_rng(4)
    words = ["The", "a", "rivér", "of", "stone,", "and", "IT", "was", "語語", "it's", "#1"]
    follow = rng.permutation(len(words))

    def text():
        out, at = [], int(rng.integers(len(words)))
        for _ in range(int(rng.integers(1, 120))):
            out.append(words[at])
            at = int(follow[at]) if rng.random() < 0.9 else int(rng.integers(len(words)))
        return " ".join(out)

    rows = [(i, text(), i % 7 == 2) for i in range(600)]
    found = scored(rows)
    want = base(rows)
    close(found, want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_edge_rows(scored):
    rows = [
        (1, None, False), (2, "", True), (3, " \t\n", None), (None, "Alone", False), (4, "same text", False), (4, "same text", False), (5, "unseen", True),
        (6, "x" * 30_000, False), (7, "long " * 25_000, True), (8, "\xa0nb\xa0 \xa0x   \x1c 　", False), (9, "<|endoftext|> \x00", False),
    ]
    found = scored(rows)
    close(found, base(rows))
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    same = [r.score for r in found if r.doc_id == 4]
    assert len(same) == 2 and same[0] == pytest.approx(same[1], rel=1e-5)
    close(scored([(1, "a b", True)]), base([(1, "a b", True)]))


def test_empty_table(spark, vocabulary):
    assert A.text_likelihoods(spark.createDataFrame([], SCHEMA), F.col("held"), vocabulary).collect() == []


def test_learned_rows_only(scored):
    """The held-out rows' own texts change no count and no weight."""
    rows = [(i, f"w{i % 5} w{i % 3}", False) for i in range(50)]
    one = scored([*rows, (100, "w1 w2", True)])
    two = scored([*rows, (100, "w1 w2", True), (101, "w1 w1 w1", True)])
    pick = lambda found: {r.doc_id: (r.base_score, round(r.score, 4)) for r in found if r.doc_id != 101}
    assert pick(one) == pick(two)


def test_ids_are_the_tokenizers(vocabulary):
    import tiktoken  # noqa: F401

    encoding, _ = A._encoder(vocabulary)
    words = ["a", "it's", "\xa0nb\xa0", "x ", " y", "ß12!?", "z" * 999, "z" * 2500, "<|endoftext|>", "a\x1cb"]
    ids, at = A.word_ids(pa.array(words), vocabulary)
    for i, w in enumerate(words):
        own = ids[at[i] : at[i + 1]].tolist()
        assert encoding.decode(own) == " " + w
        if len(w) < 900:
            assert own == encoding.encode_ordinary(" " + w)


def test_each_id_is_scored_once():
    size = np.array([1, 16, 17, 40])
    ids = np.arange(size.sum())
    cells, count = A.windows(ids, size, 1000)
    assert count.tolist() == [1, 1, 2, 3]
    assert sorted(x for x in cells[:, A.STRIDE :].reshape(-1).tolist() if x < 1000) == ids.tolist()
    assert (cells[0, : A.STRIDE] == 1000).all() and cells[3, : A.STRIDE].tolist() == list(range(17, 33))


@pytest.fixture
def small(monkeypatch):
    for name, value in {"GROUPS": 4, "MEMBERS": 3, "CLASSES": 12, "SHARED": 3, "WIDTH": 6, "HEAD": 4}.items():
        monkeypatch.setattr(A, name, value)
    classes = A.Classes.fit(np.array([50, 3, 9, 0, 7, 1, 20, 0, 2, 6, 5, 4, 3, 2, 1, 8]))
    rng = np.random.default_rng(0)
    w = {k: x.astype(np.float64) + rng.normal(0, 0.2, x.shape) for k, x in A.first_weights(classes).items()}
    return classes, w


def test_shares_sum_to_one(small):
    classes, w = small
    w = {k: x.astype(np.float32) for k, x in w.items()}
    assert np.bincount(classes.of, weights=np.exp(classes.inside)) == pytest.approx(1)
    cells = np.full((A.CLASSES, 2 * A.STRIDE), 5)
    cells[:, A.STRIDE] = np.arange(A.CLASSES)
    assert np.exp(A.log_shares(w, cells)[:, 0]).sum() == pytest.approx(1, abs=1e-5)


def test_masked_like_a_loop(small):
    """Attention by definition, one place at a time; what comes later changes nothing."""
    classes, w = small
    cells = np.random.default_rng(2).integers(0, A.CLASSES, (3, 2 * A.STRIDE))
    got = A.log_shares({k: x.astype(np.float32) for k, x in w.items()}, cells)
    for b in range(3):
        x = w["embed"][cells[b, :-1]] + w["place"]
        for t in range(A.STRIDE):
            at = A.STRIDE - 1 + t
            a = np.exp((x[: at + 1] @ w["key"]) @ (x[at] @ w["query"]) / A.HEAD**0.5)
            h = x[at] + (a / a.sum()) @ (x[: at + 1] @ w["value"]) @ w["out"]
            goal = cells[b, A.STRIDE + t]
            group = np.exp(h @ w["group"] + w["group_bias"])
            member = np.exp(h @ w["member"][goal // A.MEMBERS] + w["member_bias"][goal // A.MEMBERS])
            assert got[b, t] == pytest.approx(math.log(group[goal // A.MEMBERS] / group.sum() * member[goal % A.MEMBERS] / member.sum()), abs=1e-4)


def test_gradient_like_differences(small):
    classes, w = small
    cells = np.random.default_rng(3).integers(0, A.CLASSES + 1, (4, 2 * A.STRIDE))
    _, g = A.gradient({k: x.astype(np.float32) for k, x in w.items()}, cells)
    loss = lambda v: -np.where(cells[:, A.STRIDE :] < A.CLASSES, A.log_shares(v, cells), 0).sum() / (cells[:, A.STRIDE :] < A.CLASSES).sum()
    rng = np.random.default_rng(9)
    for k, x in w.items():
        step = rng.normal(0, 1, x.shape)
        up, down = ({**w, k: x + s * step} for s in (1e-2, -1e-2))
        slope = (loss({a: b.astype(np.float32) for a, b in up.items()}) - loss({a: b.astype(np.float32) for a, b in down.items()})) / 2e-2
        assert slope == pytest.approx(float((g[k] * step).sum()), rel=0.03, abs=2e-3), k


def test_training_learns_what_counts_cannot_see(small):
    """Each id follows from the one three places before, so frequencies alone give log(8) an id."""
    classes, w = small
    rng = np.random.default_rng(6)
    cells = np.zeros((4000, 2 * A.STRIDE), dtype=np.int64)
    cells[:, :3] = rng.integers(0, 8, (4000, 3))
    for t in range(3, 2 * A.STRIDE):
        cells[:, t] = np.where(rng.random(4000) < 0.95, (cells[:, t - 3] * 3 + 1) % 8, rng.integers(0, 8, 4000))
    w = {k: x.astype(np.float32) for k, x in w.items()}
    for k in range(6):
        w = A.train(w, cells[:3500], k, 0.02)
    held = cells[3500:]
    assert -A.log_shares(w, held).mean() < 0.6 * math.log(8)
    assert A.text_scores(np.arange(8), np.array([3, 5]), w, classes).shape == (2,)


def test_the_query_holds_out_by_crc(spark):
    from panelgrain.llm.queries import QUERIES

    found = QUERIES["op12_attention_scores"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 200
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in found)


def test_every_training_window_is_learned_from(spark, vocabulary):
    """Each id of the rows that may be learned from is the goal of one window; no window is left out."""
    texts = [(1, False, "one two three four five six seven eight nine ten " * 20), (2, True, "held out " * 50), (3, False, ""), (4, False, "a few words")]
    docs = spark.createDataFrame(texts, "doc_id long, held boolean, text string").coalesce(1)
    staged = docs.mapInArrow(lambda b: A._stage(b, vocabulary), A.STAGED).where("kind = 'window'").collect()
    sizes = [len(A.word_ids(pa.array(t.split(), pa.string()), vocabulary)[0]) + 1 for _, held, t in texts if not held]
    assert len(staged) == sum(-(-n // A.STRIDE) for n in sizes)
    goals = np.concatenate([np.frombuffer(r["data"], dtype="<u4")[A.STRIDE :] for r in staged])
    assert int((goals <= vocabulary.size).sum()) == sum(sizes)


def test_windows_are_stored_packed(spark, vocabulary):
    """Rows of up to PACK windows of one round, two bytes a cell, hold the staged windows: each once and in its round."""
    docs = spark.createDataFrame([(i, False, f"one two three four five six seven w{i} " * 40) for i in range(30)], "doc_id long, held boolean, text string").coalesce(1)
    staged = docs.mapInArrow(lambda b: A._stage(b, vocabulary), A.STAGED).where("kind = 'window'").collect()
    packed = docs.mapInArrow(lambda b: A._packed(A._stage(b, vocabulary), vocabulary), A.STAGED).where("kind = 'window'").collect()
    want = sorted((r["n"], tuple(np.frombuffer(r["data"], dtype="<u4").tolist())) for r in staged)
    got = sorted((r["n"], tuple(w.tolist())) for r in packed for w in np.frombuffer(r["data"], dtype=A._cell_type(vocabulary.size)).reshape(-1, 2 * A.STRIDE))
    assert got == want
    assert 4 * len(packed) < len(staged) and 2 * sum(len(r["data"]) for r in packed) == sum(len(r["data"]) for r in staged)


def test_a_task_sends_one_mean_of_its_parts(small, monkeypatch):
    """Windows are learned from in even parts from the same weights; a task of several parts sends their mean once."""
    monkeypatch.setattr(A, "STEPS", 2)
    monkeypatch.setattr(A, "BATCH", 4)
    classes = A.Classes.fit(np.arange(40)[::-1].copy())
    rng = np.random.default_rng(4)
    kind = A._cell_type(39)
    cells = rng.integers(0, 39, (29, 2 * A.STRIDE)).astype(kind)
    batches = [pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in np.array_split(half, 5)], pa.binary())], names=["data"]) for half in (cells[:20], cells[20:])]
    parts = list(A._parts(batches, kind))
    assert [len(p) for p in parts] == [8, 8, 7, 6] and (np.concatenate(parts) == cells).all()
    w = A.first_weights(classes)
    want = sum(len(p) * A._flat(A.train(w, classes.cells(p), 1, 0.03)).astype(np.float64) for p in parts) / 29
    sent = list(A._train_task(batches, w, classes, 1, 0.03))
    assert len(sent) == A.PARTS and {b["n"][0].as_py() for b in sent} == {29}
    assert np.allclose(np.concatenate([np.frombuffer(b["data"][0].as_py(), "<f4") for b in sent]), want, atol=1e-6)


def test_windows_are_made_where_they_are_learned_from(spark, vocabulary, monkeypatch, tmp_path):
    """Nothing stored holds a window, and the rounds together learn from each window of the training rows once."""
    from panelgrain.llm import shared

    rows = [(i, f"one two three four five w{i} " * (i + 1), i % 5 == 0) for i in range(40)]
    docs = spark.createDataFrame([(*r, 0, 0, "w", 0, "d", 0.0) for r in rows], SCHEMA).repartition(3)
    sizes = [len(A.word_ids(pa.array(t.split(), pa.string()), vocabulary)[0]) + 1 for _, t, held in rows if not held]
    log = tmp_path / "learned"
    train_task = A._train_task

    def logged(batches, w, classes, seed, rate):
        with open(f"{log}-{seed}", "a") as file:
            for b in batches:
                file.write("".join(f"{len(x) // 64}\n" for x in b.column(0).to_pylist()))
                yield from train_task(iter([b]), w, classes, seed, rate)

    monkeypatch.setattr(A, "_train_texts", lambda b, v, w, classes, seed, rate: logged((x.select(["data"]) for x in A._packed(A._stage(b, v, ("window",)), v)), w, classes, seed, rate))
    kinds = []
    monkeypatch.setattr(A, "scratch", lambda s, label: kinds.append(shared.scratch(s, label)) or kinds[-1])
    assert A.text_likelihoods(docs, F.col("held"), vocabulary).count() == 40
    assert {r["kind"] for r in spark.read.parquet(kinds[0]).select("kind").distinct().collect()} == {"doc", "word"}
    assert sum(int(x) for f in tmp_path.iterdir() for x in f.read_text().split()) == sum(-(-n // A.STRIDE) for n in sizes)


def test_numbers_come_back():
    values = np.random.default_rng(1).integers(0, 1 << 20, 1000)
    assert A.loosened(A.squeezed(values)).tolist() == values.tolist() and A.loosened(A.squeezed(values[:0])).tolist() == []
