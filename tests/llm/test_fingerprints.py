import hashlib
import random
import re

import pytest
import xxhash

from panelgrain.llm import fingerprints as P


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def spark_hash(*values):
    """xxhash64 as Spark chains it: each value is hashed with the hash so far as seed."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return signed(seed)


def brute(text):
    words = re.findall(r"[^ \t\n\x0b\x0c\r]{1,16}", text)
    mers = [spark_hash(a, b) for a, b in zip(words, words[1:])] if len(words) >= 2 else [spark_hash(w) for w in words]  # noqa: B905
    if len(words) < P.K:
        return list(dict.fromkeys((spark_hash(h) & (1 << 64) - 1) >> 32 for h in mers))
    out = []
    for i in range(len(words) - P.K + 1):
        inner = mers[i : i + P.INNER]
        if min(inner) in (inner[0], inner[-1]):
            out.append((spark_hash(*inner[::2], i // P.STRETCH) & (1 << 64) - 1) >> 32)
    return list(dict.fromkeys(out))


def like(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, spark_hash(r[1] or ""))
    ordered = sorted(rows, key=key, reverse=True)
    out = []
    for i, (doc, text) in enumerate(ordered):
        text, follow = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + follow[:third]
        a, b, c = brute(text), brute(edited), brute(follow)
        show = lambda v: "".join(f"{x:08x}" for x in v)
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), round(like(a, b), 9), round(like(a, c), 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


@pytest.mark.parametrize("rows_a_bucket", [1000, 1])
def test_equals_brute_force(spark, documents, clashing, monkeypatch, rows_a_bucket):
    monkeypatch.setattr(P, "COARSE", 8)
    monkeypatch.setattr(P.with_next, "__defaults__", (rows_a_bucket,))
    r = random.Random(rows_a_bucket)
    say = lambda n: "".join(r.choice(["a", "be", "sea ", " é", "世界 ", "\n", "lemon "]) for _ in range(n))
    rows = [(r.randrange(5000) ** 2, say(r.choice([0, 1, 3, 9, 30, 200, 900]))) for _ in range(60)]
    rows += [(7, "x" * 500), (-4, None), (8, "same text here"), (8, "same text here"), (8, "other"), (None, "no id " * 20), (None, None), (10**15, "far")]
    assert got(P.fingerprints(documents(rows, clashing))) == expected(rows)


def test_one_row_and_none(spark, documents):
    rows = [(5, "only one document of ten words is here for now")]
    assert got(P.fingerprints(documents(rows))) == expected(rows)
    assert P.fingerprints(documents(rows).limit(0)).collect() == []


def test_likeness_on_documents(spark):
    rows = P.op2(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.45
    assert sum(r.near_next for r in rows) / len(rows) < 0.05
    plan = P.op2(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
