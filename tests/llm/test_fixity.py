import hashlib
import random
from collections import defaultdict

import pytest

from panelgrain.llm import fixity as W

SHAPE = "page_id long, url string, html string, idx long, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n") for r in rows], SHAPE).repartition(3)


def files(rows):
    """Records of each file in order, with offsets, by definition."""
    out = defaultdict(list)
    for page_id, url, html in rows:
        body = html or ""
        name = "" if page_id is None else page_id
        record = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Target-URI: {url or ''}\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n".encode()
        out[None if page_id is None else page_id // W.FILE_IDS].append((page_id, len(record), hashlib.sha256(record).hexdigest()))
    for own in out.values():
        own.sort(key=lambda r: (r[0] or 0, r[2]))
        at = 0
        for i, (page_id, size, digest) in enumerate(own):
            own[i] = (page_id, at, size, digest)
            at += size
    return out


def brute(a, b):
    left, right, found = files(a), files(b), []
    for file_no in {*left, *right}:
        x, y = left.get(file_no, []), right.get(file_no, [])
        for i in range(max(len(x), len(y))):
            p, q = (x[i] if i < len(x) else None), (y[i] if i < len(y) else None)
            if p and q and p[1:] == q[1:]:
                continue
            status = "extra" if not p else "missing" if not q else "moved" if p[3] == q[3] else "damaged"
            found.append((file_no, i, *(p or q)[:3], status, p and p[3], q and q[3]))
    return sorted(found, key=str)


def got(spark, a, b):
    return sorted((tuple(r) for r in W.audit(W.leaves(frame(spark, a)), W.leaves(frame(spark, b))).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    a = [(i, f"http://h/{i}", r.choice(["x", "é" * 5, "", "long " * 500])) for i in range(300)] + [(5000 + i, "u", "same") for i in range(40)]
    a += [(None, None, None), (None, "u", "n"), (7, "u", "same id"), (7, "u", "same id"), (9999, None, "last")]
    b = [(p, u, (h or "") + "!" if r.random() < 0.02 else h) for p, u, h in a if p not in (298, 299)] + [(5999, "new", "n"), (12345, "new file", "n")]
    r.shuffle(b)
    assert got(spark, a, b) == brute(a, b)


def test_same_bytes_moved(spark):
    a = [(1, "u", "abc"), (2, "u", "later")]
    rows = got(spark, a, [(1, "u", "abcd"), (2, "u", "later")])
    assert [(r[2], r[5]) for r in rows] == [(1, "damaged"), (2, "moved")]
    assert got(spark, a, a) == []


def test_only_differing_branches_are_read(spark):
    a = [(i, "u", f"page {i}") for i in range(600)]
    left, right = W.leaves(frame(spark, a)), W.leaves(frame(spark, [(i, u, "page 33X" if i == 333 else h) for i, u, h in a]))
    tops = W._differing(W.parents(W.parents(left)), W.parents(W.parents(right)), [])
    assert [r.idx for r in tops.collect()] == [333 // W.FAN**2]
    assert W._below(W.parents(left), tops).count() == W.FAN


def test_empty_tables(spark):
    some = [(1, "u", "h")]
    empty = frame(spark, some).limit(0)
    assert W.audit(W.leaves(empty), W.leaves(empty)).collect() == []
    assert [r.status for r in W.audit(W.leaves(frame(spark, some)), W.leaves(empty)).collect()] == ["missing"]
    assert [r.status for r in W.audit(W.leaves(empty), W.leaves(frame(spark, some))).collect()] == ["extra"]
