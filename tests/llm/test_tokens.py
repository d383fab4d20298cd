import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelgrain.llm import tokens as T
from panelgrain.llm.elias_fano import EliasFano


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(T.default_tokenizer())


def some_texts(seed, n=300):
    r = random.Random(seed)
    bits = ["it's", "'s", " 's", "!'re", "we'LL", "we'll", "''d", "  ", "\n", "\n\n", " \n ", "\t", "\xa0", "\x85", "a", "é", "ß", "12", "½", "²x", "...", "#!", "世界", "ɐ", "’s", "\x1c", " ", "<|endoftext|>", "don't've", "'", "' s", "ŉ", "ª", "​", "x'm'd"]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_encoder_equals_the_library(tokenizer):
    encoder = T.Encoder(T.default_tokenizer())
    for seed in range(4):
        texts = some_texts(seed)
        ids, count = encoder.encode(pa.array(texts + [None]))
        at = np.concatenate(([0], np.cumsum(count)))
        for i, text in enumerate([*texts, ""]):
            assert ids[at[i] : at[i + 1]].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], repr(text)


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], list(range(1000)), [3, 900, 10**12], sorted(random.Random(1).randrange(10**9) for _ in range(3000))])
def test_elias_fano(values):
    kept, end = EliasFano.from_bytes(b"xx" + EliasFano.of(np.array(values, dtype=np.uint64)).to_bytes(), 2)
    assert kept.all().tolist() == values
    assert [kept.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        kept.select(len(values))


def expected(rows, tokenizer):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, documents, clashing, tokenizer):
    texts = some_texts(9)
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)] + [(5000, "long " * 30000), (5001, None), (None, "no id"), (None, None), (5002, ""), (7, "same"), (7, "same")]
    got = [tuple(r) for r in T.token_index(documents(rows, clashing), T.default_tokenizer()).orderBy("start").collect()]
    assert got == expected(rows, tokenizer)


def test_other_order_and_selects(spark, documents, tokenizer):
    rows = [(i, t) for i, t in enumerate(some_texts(2, 60))] + [(None, "x")]
    manifest = T.write_tokens(documents(rows), T.default_tokenizer(), order=[F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))])
    got = {r[0]: tuple(r) for r in T.read_tokens(manifest).collect()}
    by_id = {d: (n, c) for d, _, n, c in expected(rows, tokenizer)}
    assert {d: r[2:] for d, r in got.items()} == by_id
    for line in manifest.collect():
        shard = T.Shard(line["file"])
        for k, doc in enumerate(shard.doc_ids):
            a, b = shard.bounds(k)
            assert (line["start"] + a, b - a) == got[doc][1:3]
            assert shard.ids(a, b)[-1] == 2


def test_empty_table(spark, documents):
    assert T.token_index(documents([(1, "x")]).limit(0), T.default_tokenizer()).collect() == []
