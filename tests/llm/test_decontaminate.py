import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelgrain.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def brute(docs, items):
    """Every passage against every item: BM25 over all terms, then the overlaps by definition."""
    token = {i: words(t) for i, t in items if t is not None and i is not None}
    token = {i: w for i, w in token.items() if w}
    n, mean = len(token), sum(map(len, token.values())) / max(1, len(token))
    df = Counter(w for own in token.values() for w in set(own))
    impact = {}
    for i, own in token.items():
        for w, tf in Counter(own).items():
            impact[i, w] = math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (D.K1 + 1) / (tf + D.K1 * (1 - D.B + D.B * len(own) / mean))
    full = {i: sum(impact[i, w] for w in set(own)) for i, own in token.items()}
    text = {i: t for i, t in items}
    longest = max(map(len, token.values()))
    out = {}
    for doc, body in docs:
        own = words(body)
        for a in range(0, max(1, len(own)), longest):
            passage = own[a : a + 2 * longest]
            bag = set(passage)
            for i, w in token.items():
                score = sum(impact[i, x] for x in set(w) & bag) / full[i]
                if score < D.THRESHOLD:
                    continue
                k = min(5, len(w))
                have = {tuple(passage[x : x + k]) for x in range(len(passage) - k + 1)}
                here = [tuple(w[x : x + k]) in have for x in range(len(w) - k + 1)]
                raw = text[i].encode()
                starts = np.array([m.start() for m in re.finditer(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw.lower())])
                cut = max(0, min(D.answer_start(raw, starts), len(here)))
                q = np.mean(here[:cut]) if cut else np.mean(here)
                ans = np.mean(here[cut:]) if cut < len(here) else float(here[-1])
                if np.mean(here) >= 0.75 and q >= 0.5 and ans >= 0.5:
                    out[doc, i] = max(out.get((doc, i), (0, 0, 0)), (score, q, ans))
    return {k: tuple(round(min(1.0, float(x)), 5) for x in v) for k, v in out.items()}


def found(df):
    return {(r["doc_id"], r["item_id"]): tuple(round(r[c], 5) for c in ("score", "question", "answer")) for r in df.collect()}


@pytest.mark.parametrize("most_bytes", [1 << 23, 2000])
def test_equals_brute_force(spark, most_bytes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    got = found(D.leaks(docs, bench, most_bytes))
    assert got.keys() == want.keys() and len(got) > 5
    for k in got:
        assert got[k] == pytest.approx(want[k], abs=2e-5)


def test_search_is_whole():
    """WAND returns what scoring every item for every window returns."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocabulary, weights=[1 / (k + 1) for k in range(60)], k=r.randint(1, 25)))) for i in range(40)]
    weights = {}
    for i, t in items:
        data = np.frombuffer(t.encode(), dtype=np.uint8)
        _, _, word = D._words(data, np.array([0, len(data)]))
        for w in word.view(np.int64).tolist():
            weights[i, w] = weights.get((i, w), 0) + r.random()
    index = D.build_index(items, weights)
    windows = [sorted(r.sample(range(len(index.terms)), r.randint(0, 25))) for _ in range(300)]
    window = np.array([k for k, own in enumerate(windows) for _ in own])
    term = np.array([t for own in windows for t in own], dtype=np.int64)
    for threshold in (0.3, 0.55, 0.9):
        a, b, s = D.search(index, window, term, len(windows), threshold)
        got = dict(zip(zip(a.tolist(), b.tolist(), strict=True), s.tolist(), strict=True))
        want = {}
        for k, own in enumerate(windows):
            total = np.zeros(len(items))
            for t in own:
                total[index.item[index.low[t] : index.low[t + 1]]] += index.impact[index.low[t] : index.low[t + 1]]
            want |= {(k, i): v for i, v in enumerate(total.tolist()) if v >= threshold - 1e-9}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in got)


@pytest.mark.parametrize("most_bytes", [1 << 23, 60])
def test_every_text_is_an_item(spark, documents, most_bytes):
    """Several texts under one id and texts without an id are all looked for, in one index or in many, with the same passages."""
    r = random.Random(12)
    say = lambda n: " ".join(f"v{r.randrange(400)}" for _ in range(n))
    pairs = [(i // 3, f"{say(r.randint(4, 30))}. {say(r.randint(2, 9))}.") for i in range(24)] + [(None, f"{say(20)}. {say(6)}.") for _ in range(4)]
    rows = [(k, f"{say(r.randint(0, 300))} {text} {say(r.randint(0, 300))}") for k, (_, text) in enumerate(pairs)]
    rows += [(100 + k, say(200)) for k in range(10)]
    numbered = list(enumerate(pairs))
    want = [(d, pairs[i][0]) for d, i in brute(rows, [(i, text) for i, (_, text) in numbered])]
    bench = spark.createDataFrame(pairs + pairs[:5], "item_id long, text string")
    got = [(x.doc_id, x.item_id) for x in D.leaks(documents(rows), bench, most_bytes).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) >= len(pairs)
    left = {x.doc_id for x in D.clean_documents(documents(rows), bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in want}


def test_edge_rows(spark, documents, clashing):
    item = "What is the name of the river that runs by the old mill town. The answer is the long grey Tarn river."
    bench = spark.createDataFrame([(1, item), (2, None), (None, "x y z"), (3, "..."), (4, "Tiny item"), (4, "Tiny item")], "item_id long, text string")
    pad = "other words come here again " * 3000
    rows = [(10, None), (11, ""), (12, item), (None, "so " + item), (13, pad + item.upper().replace(" ", "  ") + pad), (14, pad), (12, item), (12, "free"), (15, "a tiny, item!")]
    docs = documents(rows, clashing + ", item_id long, score long")
    assert set(found(D.leaks(docs, bench))) == {(12, 1), (None, 1), (13, 1), (15, 4)}
    left = D.clean_documents(docs, bench)
    assert sorted((r.doc_id, r.text[:4] if r.text else r.text) for r in left.collect()) == [(10, None), (11, ""), (12, "free"), (14, "othe")]
    assert left.columns == docs.columns
    assert D.leaks(docs.limit(0), bench).collect() == [] and D.leaks(docs, bench.limit(0)).collect() == []
    assert D.clean_documents(docs, bench.limit(0)).count() == len(rows)
