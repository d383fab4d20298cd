import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelgrain.llm import recount as R

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def brute(rows, min_docs=3, top=200):
    docs = [(la or "", so or "", TERM.findall((te or "").translate(LOW))) for la, so, te in rows]
    langs = defaultdict(lambda: defaultdict(Counter))
    seen = defaultdict(Counter)
    for lang, source, terms in docs:
        langs[lang][source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def shares(counts):
            whole = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // whole for t in kept}

        whole = shares(sum(sources.values(), Counter()))
        own = {s: shares(c) for s, c in sources.items()}
        f = lambda p, q: (p - q) ** 2 // q
        for s, counts in sources.items():
            pairs = [(x, sum(f(own[s][t], own[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, f(own[s][t], whole[t])) for t in kept if counts[t] and own[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéüß語", k=rng.randint(1, 6))) for _ in range(300)]
    rows = []
    for _ in range(n):
        source = f"s{min(rng.randint(0, 8), 5)}"  # one source has a third of the rows
        text = rng.choice([" ", "-", "7", "\x00"]).join(rng.choices(words, k=rng.randint(0, 60)))
        rows.append((rng.choice(["en", "de", None]), source, text if rng.random() < 0.5 else text.upper()))
    return rows


def found(docs, **more):
    return sorted(tuple(r) for r in R.divergences(docs, **more).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 0, 0, "x") for r in rows], "lang string, source string, text string, rank int, shard int, term string").repartition(4)

    return make


def test_like_brute_force(frame):
    rows = corpus()
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"}
    assert found(frame(rows)) == want


def test_many_shards_and_passes(frame, monkeypatch):
    monkeypatch.setattr(R, "SHARD_TERMS", 11)
    rows = corpus(200, 8)
    docs = frame(rows)
    hashes = docs.sparkSession.createDataFrame([("x", k, 100) for k in range(9)], "lang string, shard int, bytes long")
    assert R._rounds(hashes, 250)[0] >= 4
    assert found(docs, round_bytes=700, top=7) == brute(rows, top=7)


def test_edge_rows(frame):
    rows = [
        ("en", "a", None), ("en", "b", ""), ("en", None, "12 34 ?"), (None, None, None), ("de", "a", "Äpfel äpfel"), ("de", "a", "Äpfel äpfel"),
        ("de", "b", "Äpfel"), ("de", "", "Äpfel"), ("de", None, "x" * 100_000), ("fr", "z", "un deux"), ("it", "a", "t" * 70_000 + " uno"), ("it", "a", "uno " * 30_000), ("it", "b", "uno " + "t" * 70_000),
        ("it", "b", "t" * 70_000),
    ]
    want = brute(rows)
    assert found(frame(rows)) == want
    assert ("en", "a", "pair", "", 0, 1) in want and ("fr", "z") not in {r[:2] for r in want}
    assert found(frame(rows).limit(0)) == []


def test_collisions_are_told_apart_by_their_keys():
    terms = [f"t{i}" for i in range(50)]
    hashes = np.arange(50, dtype=np.uint64) // np.uint64(2)  # every hash twice: no level separates them
    sizes, words, slot = R.perfect_hash(hashes)
    assert sorted(slot.tolist()) == list(range(50))
    keys = [terms[i] for i in np.argsort(slot)]
    shards = R.Shards(1, [{"shard": 0, "terms": 50, "sizes": sizes.tolist(), "words": words.tobytes(), "keys": keys}])
    assert shards.find(pa.array(terms), hashes).tolist() == slot.tolist()
    assert shards.find(pa.array(["other"] * 50), hashes).tolist() == [-1] * 50


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1), max_size=300), st.integers(1, 5))
def test_perfect_hash_is_minimal(values, count):
    hashes = np.array(sorted(values), dtype=np.uint64)
    rows, want = [], {}
    for shard in range(count):
        own = hashes[hashes.view(np.int64) % count == shard]
        if not len(own) or shard == 3:  # one shard is not here
            continue
        sizes, words, slot = R.perfect_hash(own)
        assert sorted(slot.tolist()) == list(range(len(own)))
        rows.append({"shard": shard, "terms": len(own), "sizes": sizes.tolist(), "words": words.tobytes(), "keys": [str(h) for h in own[np.argsort(slot)]]})
        base = sum(r["terms"] for r in rows[:-1])
        want |= {int(h): base + int(s) for h, s in zip(own, slot)}
    if rows:
        shards = R.Shards(count, rows)
        probe = np.concatenate((hashes, hashes ^ np.uint64(1)))
        assert shards.find(pa.array([str(h) for h in probe]), probe).tolist() == [want.get(int(h), -1) for h in probe]


def test_slots_are_emptied_when_too_many(monkeypatch):
    sizes, words, slot = R.perfect_hash(np.arange(100, dtype=np.uint64) * np.uint64(7919))
    shards = R.Shards(1, [{"shard": 0, "terms": 100, "sizes": sizes.tolist(), "words": words.tobytes(), "keys": [str(i) for i in np.argsort(slot)]}])
    monkeypatch.setattr(R, "SLOT_BYTES", 1000)
    counter = R.Counter({"en": shards})
    assert not counter.full([("en", "a"), ("en", "b")], 5)
    counter.add([("en", "a"), ("en", "b")], np.array([0, 0, 1]), np.array([4, 4, 9]))
    assert counter.full([("en", "c")], 5) and not counter.full([("en", "a")], 5)
    assert {(r[2], r[6]) for r in counter.rows()} == {("a", 2), ("b", 1)}


@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=5), st.integers(1, 1 << 30))
def test_shares_are_exact(counts, more):
    whole = sum(counts) + more
    for scale in (1, 10**4):
        want = [1 + 10**9 * (c * scale + 1) // (whole * scale) for c in counts]
        assert R.shares(np.array([c * scale for c in counts]), whole * scale).tolist() == want
