import random
import re

import numpy as np
import pytest

from panelgrain.llm import kernels as K
from panelgrain.llm import near_dedup as N


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """Every pair of documents, then the smallest id each one reaches."""
    own = {}
    for doc, text in rows:
        own.setdefault(doc, []).append(shingle_set(text))
    ids = sorted(own)
    label = {d: d for d in ids}
    alike = lambda x, y: any(a and b and 100 * len(a & b) >= 75 * len(a | b) for a in own[x] for b in own[y])
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if alike(a, b)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(label[a], label[b])
            changed |= label[a] != least or label[b] != least
            label[a] = label[b] = least
    return sorted((d, len(shingle_set(t)), label[d], label[d] == d) for d, t in rows)


def edited(r, words, share):
    return [w if r.random() > share else f"x{r.randrange(10**6)}" for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, documents, clashing, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    say = lambda n: [word() for _ in range(n)]
    passage, rows = say(40), []
    for k in range(12):  # groups of near copies, from close to far
        base = say(r.randint(60, 300))
        for _ in range(r.randint(2, 14)):
            rows.append(edited(r, base, r.choice([0, 0.005, 0.02, 0.03, 0.05, 0.08])))
    chain = say(200)
    for k in range(10):  # each one near the next only
        rows.append(chain[k * 6 :] + say(k * 6))
    rows += [say(r.randint(0, 50)) + passage + say(r.randint(0, 60)) for _ in range(40)]
    rows += [say(n) for n in range(8)] + [["Same"], ["same"], ["a", "b"], ["a", "B"]] + [["dup"] * 30] * 3
    texts = [" ".join(w) for w in rows] + ["", None, " \n\t ", "É é", "É É", "one\x0btwo\x0cthree"]
    pairs = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(5, texts[3])]
    got = sorted(tuple(x) for x in N.near_duplicates(documents(pairs, clashing)).collect())
    assert got == brute(pairs)


def test_null_ids_and_empty_table(spark, documents):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (None, "alone in the world today"), (4, None)]
    got = {(r[0], r[1]): tuple(r)[2:] for r in N.near_duplicates(documents(rows)).collect()}
    assert got == {(None, 2): (3, False), (3, 2): (3, True), (None, 1): (None, True), (4, 0): (4, True)}
    assert N.near_duplicates(documents(rows).limit(0)).collect() == []


def test_rows_without_an_id_link_others(spark, documents):
    """Ids 1 and 3 are not near each other but both near a row without an id; two such rows make a group of their own."""
    words = [f"w{i}" for i in range(200)]
    bridge = words[20:] + [f"x{i}" for i in range(20)]
    far = words[40:] + [f"x{i}" for i in range(40)]
    lone = [f"y{i}" for i in range(100)]
    rows = [(1, words), (None, bridge), (3, far), (None, lone), (None, [*lone, "end"]), (None, [*lone, "end"]), (7, ["z"])]
    rows = [(d, " ".join(w)) for d, w in rows]
    assert {r[0]: r[2] for r in brute([(1, rows[0][1]), (3, rows[2][1])])} == {1: 1, 3: 3}
    got = N.near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(1, 1, True), (3, 1, False), (7, 7, True)]
    none = [(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None]
    assert (196, 1, False) in none and len(none) == 4
    kept = {n for n, c, k in none if c is None and k}
    assert len(kept) == 1 and all(k == (n in kept) for n, c, k in none if c is None)
    # As numbered rows the texts form the same groups.
    want = brute([(100 + i if d is None else d, t) for i, (d, t) in enumerate(rows)])
    assert sorted(n for _, n, _, _ in want) == sorted(r.n_shingles for r in got)
    assert {d: c for d, _, c, _ in want if d < 100} == {r.doc_id: r.component_id for r in got if r.doc_id}


def test_signature_estimates_and_stops_early():
    """Equal ranks are as frequent as the sets are alike, with less spread than independent ranks have."""
    r = np.random.default_rng(8)
    errors = []
    for _ in range(150):
        both, x, y = (r.integers(1, 1 << 63, k).astype(np.uint64) for k in (60, 10, 10))
        a, b = np.unique(np.concatenate((both, x))), np.unique(np.concatenate((both, y)))
        ranks = N.superminhash(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        errors.append(float((ranks[0] == ranks[1]).mean()) - 0.75)
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < (0.75 * 0.25 / N.SLOTS) ** 0.5
    one = N.superminhash(np.array([5], dtype=np.uint64), np.array([0, 1, 1]))
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(N.SLOTS))
    assert (one[1] == np.iinfo(np.uint64).max).all()


def test_shingles_by_definition():
    texts = ["", "A b", "a B c d e", "x y z x y z x y z", " lead and trail \n"]
    raw = "".join(texts).encode()
    at = np.cumsum([0, *[len(t.encode()) for t in texts]])
    values, offsets = K.shingles(np.frombuffer(raw, dtype=np.uint8), at)
    assert np.diff(offsets).tolist() == [len(shingle_set(t)) for t in texts]
