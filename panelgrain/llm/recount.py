"""Divergence of sources from their language: exact recount of frequent terms through minimal perfect hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, written

MIN_DOCS, SMOOTH, ONE, TOP = 3, 1, 1_000_000_000, 200
U64 = K.U64
# Texts are split in slices of this many bytes.
SLICE = 4 << 20
# Terms of a shard, on average; fewer where a language has very many sources, so that a matrix of sources and terms stays small.
SHARD_TERMS, MATRIX = 16384, 4 << 20
# Bytes of hashes and stored keys that one pass over the documents has broadcast, and of dense slots that a task holds.
ROUND_BYTES, SLOT_BYTES = 64 << 20, 128 << 20
# Bits a key in a level of a perfect hash; keys that no level separates are found by their bytes.
GAMMA, LEVELS = 1.7, 24

# A lower-cased term: letters a to z and every byte of a character beyond ASCII.
TERM = np.zeros(256, dtype=bool)
TERM[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True

HASHES = "lang string, shard int, terms int, sizes array<int>, words binary, keys array<string>, bytes long"
COUNTS = "lang string, shard int, source string, slots binary, item int, counts binary, total long"
DENSE = "lang string, shard int, source string, counts binary, total long"
ITEMS = "lang string, source string, part string, item string, value long"


class Terms:
    """The terms of some texts: `term` of each place, its text row, and the distinct terms with a 64-bit hash."""

    def __init__(self, column: pa.Array):
        data, at = K.text_bytes(column)
        lower = K._lower[data]
        starts, ends, first = K.words(lower, at, TERM)
        ends_at = np.concatenate(([0], np.cumsum(ends - starts)))
        flat = np.ascontiguousarray(lower[TERM[lower]])
        coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at.astype(np.int64)), pa.py_buffer(flat)).dictionary_encode()
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(first))
        self.term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.terms = coded.dictionary.cast(pa.string())
        place = np.zeros(len(self.terms), dtype=np.int64)
        place[self.term[::-1]] = np.arange(len(self.term))[::-1]
        self.hash = K.span_hash(K.prefix_hash(K.BYTE_VALUES[lower]), starts[place], ends[place])


def _slices(batches):
    """(lang, source, text) columns in slices of SLICE bytes of text; nulls as empty strings."""
    for batch in batches:
        _, at = K.text_bytes(batch.column(2))
        for i, j in K.slices(at, SLICE):
            part = batch.slice(i, j - i)
            yield [pc.fill_null(part.column(k), "") for k in range(3)]


def _document_counts(batches):
    """(lang, term, hash, docs) of each slice: in how many of its documents a term occurs."""
    for lang, _, text in _slices(batches):
        found = Terms(text)
        n = max(1, len(found.terms))
        once = np.unique(found.row * n + found.term)
        langs = lang.dictionary_encode()
        number = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        keys, docs = np.unique(number[once // n] * n + once % n, return_counts=True)
        term = keys % n
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(keys // n)), found.terms.take(pa.array(term)), pa.array(found.hash[term].view(np.int64)), pa.array(docs)], names=["lang", "term", "hash", "docs"]
        )


def frequent_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, hash): the terms that are in at least `min_docs` documents of the language; exact counts."""
    counts = docs.select("lang", "source", "text").mapInArrow(_document_counts, "lang string, term string, hash long, docs long")
    return counts.groupBy("lang", "term").agg(F.first("hash").alias("hash"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term", "hash")


def _spots(hashes: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (K.mixed(hashes ^ U64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) % np.asarray(size, dtype=np.uint64)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level sizes in bits, the bits of all levels as 64-bit words, and each key's slot below len(hashes).

    A key takes the bit where it is alone in the first level that has one; its slot is the number of
    bits before it. Keys that collide in every level take the last slots.
    """
    left, sizes, levels = np.arange(len(hashes)), [], []
    spot = np.full(len(hashes), -1, dtype=np.int64)
    base = 0
    while len(left) and len(sizes) < LEVELS:
        size = 64 * max(1, -(-int(GAMMA * len(left)) // 64))
        place = _spots(hashes[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(alone)
        spot[left[alone[place]]] = base + place[alone[place]]
        left = left[~alone[place]]
        sizes.append(size)
        base += size
    bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
    slot = (np.cumsum(bits) - 1)[spot] if len(bits) else spot
    slot[left] = len(hashes) - len(left) + np.arange(len(left))
    return np.array(sizes, dtype=np.int32), np.packbits(bits, bitorder="little").view("<u8"), slot


def _shard_hash(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The perfect hash of one shard with its keys in the order of their slots."""
    rows = rows.take(pc.sort_indices(rows["term"]))
    sizes, words, slot = perfect_hash(rows["hash"].to_numpy().astype(np.int64).view(np.uint64))
    keys = rows["term"].combine_chunks().take(pa.array(np.argsort(slot)))
    arrays = [
        pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([len(keys)], pa.int32()), pa.array([sizes], pa.list_(pa.int32())),
        pa.array([words.tobytes()], pa.binary()), pa.array([keys.to_pylist()], pa.list_(pa.string())), pa.array([words.nbytes + keys.nbytes], pa.int64()),
    ]
    return pa.Table.from_arrays(arrays, names=["lang", "shard", "terms", "sizes", "words", "keys", "bytes"])


class Shards:
    """Some shards of one language, laid end to end: `slots` of them; shard k has slots first[k] to first[k + 1]."""

    def __init__(self, count: int, rows: list):
        """`count` is how many shards the language has in all, rows those that are here."""
        rows = sorted(rows, key=lambda r: r["shard"])
        self.count, self.shard = count, np.array([r["shard"] for r in rows])
        self.number = np.full(count, -1, dtype=np.int64)
        self.number[self.shard] = np.arange(len(rows))
        self.first = np.concatenate(([0], np.cumsum([r["terms"] for r in rows]))).astype(np.int64)
        self.slots = int(self.first[-1])
        self.size = np.zeros((LEVELS, len(rows)), dtype=np.int64)
        self.base = np.zeros((LEVELS, len(rows)), dtype=np.int64)
        base = 0
        for k, r in enumerate(rows):
            for level, size in enumerate(r["sizes"]):
                self.size[level, k], self.base[level, k] = size, base
                base += size
        self.words = np.frombuffer(b"".join(bytes(r["words"]) for r in rows), dtype="<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))
        start = self.base[0] // 64
        self.placed = np.diff(np.append(self.before[start], self.before[-1])) if len(rows) else start
        self.keys = pa.array([k for r in rows for k in r["keys"]], pa.string())
        self.over = {}  # keys that no level separates
        for k in np.flatnonzero(self.placed < np.diff(self.first)).tolist():
            self.over |= {(k, rows[k]["keys"][i]): int(self.first[k]) + i for i in range(int(self.placed[k]), rows[k]["terms"])}

    def find(self, terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each term, -1 if it is not one of the stored keys."""
        own = self.number[(hashes.view(np.int64) % self.count)]
        slot = np.full(len(terms), -1, dtype=np.int64)
        left = np.flatnonzero(own >= 0)
        for level in range(LEVELS):
            left = left[self.size[level, own[left]] > 0]
            if not len(left):
                break
            k = own[left]
            spot = self.base[level, k] + _spots(hashes[left], level, self.size[level, k])
            word, bit = self.words[spot >> 6], (spot & 63).astype(np.uint64)
            hit = (word >> bit) & U64(1) == 1
            rank = self.before[spot >> 6] + np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            slot[left[hit]] = (self.first[k] + rank - self.before[self.base[0, k] // 64])[hit]
            left = left[~hit]
        there = np.flatnonzero(slot >= 0)
        same = pc.equal(self.keys.take(pa.array(slot[there])), terms.take(pa.array(there))).to_numpy(zero_copy_only=False)
        slot[there[~same.astype(bool)]] = -1
        if self.over:
            for i in np.flatnonzero((own >= 0) & (slot < 0)).tolist():
                slot[i] = self.over.get((int(own[i]), terms[i].as_py()), -1)
        return slot


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<i8")


class Counter:
    """Dense slots for each (lang, source) that a task meets, in one array; emptied when they get too large."""

    def __init__(self, shards: dict[str, Shards]):
        self.shards = shards
        self.clear()

    def clear(self) -> None:
        self.base, self.used, self.seen = {}, 0, 0
        self.flat = np.zeros(0, dtype=np.int32)

    def full(self, groups: list[tuple[str, str]], tokens: int) -> bool:
        more = sum(self.shards[g[0]].slots for g in groups if g not in self.base)
        return self.used > 0 and (4 * (self.used + more) > SLOT_BYTES or self.seen + tokens >= 1 << 31)

    def add(self, groups: list[tuple[str, str]], group: np.ndarray, slot: np.ndarray) -> None:
        """One more at `slot` of groups[group], for each place."""
        for g in groups:
            if g not in self.base:
                self.base[g] = self.used
                self.used += self.shards[g[0]].slots
        if self.used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(self.used - len(self.flat), min(len(self.flat), SLOT_BYTES // 16)), dtype=np.int32)))
        self.seen += len(slot)
        base = np.array([self.base[g] for g in groups], dtype=np.int64)
        np.add.at(self.flat, base[group] + slot, 1)

    def rows(self):
        """The slots that are not 0, for each group and shard."""
        for (lang, source), base in self.base.items():
            of = self.shards[lang]
            own = self.flat[base : base + of.slots]
            place = np.flatnonzero(own)
            edge = np.searchsorted(place, of.first)
            for k, shard in enumerate(of.shard.tolist()):
                slots = place[edge[k] : edge[k + 1]]
                if len(slots):
                    counts = _narrow(own[slots].astype(np.int64))
                    yield lang, shard, source, (slots - of.first[k]).astype("<u4").tobytes(), counts.itemsize, counts.tobytes(), int(counts.sum(dtype=np.int64))


def _as_batches(rows, schema: pa.Schema, size: int = 256):
    rows = list(rows)
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[i : i + size], strict=True), schema.types, strict=True)], schema=schema)


_COUNTS = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("source", pa.string()), ("slots", pa.binary()), ("item", pa.int32()), ("counts", pa.binary()), ("total", pa.int64())])


def _recount(batches, shards: dict[str, Shards]):
    """Occurrences of the stored terms in each (lang, source), counted in dense slots."""
    counter = Counter(shards)
    for lang, source, text in _slices(batches):
        found = Terms(text)
        n = max(1, len(found.terms))
        names = [f"{len(x)}|{x}{s}" for x, s in zip(lang.to_pylist(), source.to_pylist(), strict=True)]
        _, example, group = np.unique(np.array(names, dtype=object), return_index=True, return_inverse=True)
        groups = [(lang[i].as_py(), source[i].as_py()) for i in example.tolist()]
        here = [g in shards for g, _ in groups]
        by_lang: dict[str, list[int]] = {}
        for k, (name, _) in enumerate(groups):
            if here[k]:
                by_lang.setdefault(name, []).append(k)
        for name, members in by_lang.items():
            within = np.full(len(groups), -1, dtype=np.int64)
            within[members] = np.arange(len(members))
            mine = within[group[found.row]]
            place = np.flatnonzero(mine >= 0)
            used, which = np.unique(found.term[place], return_inverse=True)
            slot = shards[name].find(found.terms.take(pa.array(used)), found.hash[used])[which]
            hit = slot >= 0
            own = [groups[k] for k in members]
            if counter.full(own, int(hit.sum())):
                yield from _as_batches(counter.rows(), _COUNTS)
                counter.clear()
            counter.add(own, mine[place][hit], slot[hit])
    yield from _as_batches(counter.rows(), _COUNTS)


def _dense(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all tasks for one (lang, shard, source), added up batch by batch."""
    total = np.zeros(0, dtype=np.int64)
    for batch in batches:
        for slots, item, counts in zip(batch.column("slots"), batch.column("item"), batch.column("counts"), strict=True):
            place = np.frombuffer(slots.as_py(), dtype="<u4").astype(np.int64)
            if place[-1] >= len(total):
                total = np.concatenate((total, np.zeros(int(place[-1]) + 1 - len(total), dtype=np.int64)))
            total[place] += np.frombuffer(counts.as_py(), dtype="<i8" if item.as_py() == 8 else f"<u{item.as_py()}").astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k.as_py()], t) for k, t in zip(key, (pa.string(), pa.int32(), pa.string()), strict=True)] + [pa.array([total.tobytes()], pa.binary()), pa.array([int(total.sum())], pa.int64())],
        names=["lang", "shard", "source", "counts", "total"],
    )


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(ONE * (count + 1) / whole), exact, for whole below 9e17 and counts below it."""
    digits, step = (1, ONE) if whole < 9e9 else (3, 1000) if whole < 9e15 else (9, 10)
    out, rest = np.zeros(counts.shape, dtype=np.int64), counts.astype(np.int64) + 1
    for _ in range(digits):
        rest = rest * step
        digit = rest // whole
        out, rest = out * step + digit, rest - digit * whole
    return out + 1


def _compare(key, shard: pa.Table, counted: pa.Table, top: int) -> pa.Table:
    """Of one shard: the part of each pair's divergence, and the `top` terms of each source."""
    lang = key[0].as_py()
    sources, sums = shard["sources"][0].as_py(), [int(x) for x in shard["sums"][0].as_py()]
    keys, whole = shard["keys"][0].as_py() or [], int(shard["vocabulary"][0].as_py()) * SMOOTH
    n, place = len(keys), {s: i for i, s in enumerate(sources)}
    counts = np.zeros((len(sources), n), dtype=np.int64)
    for source, dense in zip(counted["source"].to_pylist(), counted["counts"].to_pylist(), strict=True):
        own = np.frombuffer(dense, dtype="<i8")
        counts[place[source], : len(own)] = own
    out = {"source": [], "part": [], "item": [], "value": []}

    def put(source, part, items, values):
        out["source"] += [source] * len(items)
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += values

    p = np.array([shares(c, s + whole) for c, s in zip(counts, sums, strict=True)], dtype=np.int64).reshape(len(sources), n) if n else counts
    for i, source in enumerate(sources):
        apart = ((p[i] - p) ** 2 // np.maximum(p, 1)).sum(axis=1) if n else np.zeros(len(sources), dtype=np.int64)
        put(source, "pair", sources[:i] + sources[i + 1 :], np.delete(apart, i).tolist())
    if n:
        q = shares(counts.sum(axis=0), sum(sums) + whole)
        order = np.argsort(np.array([k.encode() for k in keys], dtype=object), kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.arange(n)
        for i, source in enumerate(sources):
            over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            value = (p[i][over] - q[over]) ** 2 // q[over]
            first = np.lexsort((rank[over], -value))[:top]
            put(source, "term", [keys[k] for k in over[first].tolist()], value[first].tolist())
    types = {"source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}
    return pa.Table.from_arrays([pa.array([lang] * len(out["item"]), pa.string())] + [pa.array(out[c], t) for c, t in types.items()], names=["lang", *types])


def _rounds(hashes: DataFrame, most: int) -> tuple[int, DataFrame]:
    """How many passes the hashes take if each may broadcast about `most` bytes, and the hashes with their pass."""
    size = hashes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    rounds = -(-size[0] // most)
    while True:
        dealt = hashes.withColumn("round", F.pmod(F.xxhash64("lang", "shard"), F.lit(max(1, rounds))))
        if rounds <= 1 or dealt.groupBy("round").agg(F.sum("bytes").alias("b")).agg(F.max("b")).first()[0] <= max(most * 5 // 4, size[1]) or rounds > 64 * (size[0] // most + 1):
            return rounds, dealt
        rounds += -(-rounds // 4)


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): how a source's terms differ from its language's and other sources'.

    Reads lang, source and text, null as ''. Terms are runs of letters a to z (A-Z lower-cased) and of characters
    beyond ASCII; a language keeps the V terms that are in at least `min_docs` of its documents. With count the
    occurrences of a kept term in a (lang, source) or a lang and N their sum, p = 1 + floor(10^9 * (count + 1) / (N + V)) and
    f = floor((p - q)^2 / q). Part `pair`: the other sources of the language by the sum of f over all kept terms, 0
    if there are none. Part `term`: the terms that occur and have more than their share of the language, by f,
    the first `top`. Equal values are ranked by the UTF-8 bytes of the item. Repeated rows count each time; empty
    tables give no rows; extra columns are not read.

    The kept terms are cut in shards by hash; each shard becomes a minimal perfect hash that stores its keys. A
    pass over the documents has the hashes of about `round_bytes` broadcast, so more terms make more passes, never a
    larger broadcast. A task counts in one dense array a (lang, source) and sends what is not 0; the sums of a
    shard are compared in one task, all sources at once.
    """
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = written(read.select("lang", "source").distinct(), "groups")
    kept = written(frequent_terms(read, min_docs), "terms")
    wide = groups.groupBy("lang").agg(F.count("*").alias("width"))
    slots = F.greatest(F.lit(1), F.least(F.lit(SHARD_TERMS), F.lit(MATRIX) / F.col("width"))).cast("long")
    langs = kept.groupBy("lang").agg(F.count("*").alias("vocabulary")).join(wide, "lang").withColumn("shards", F.ceil(F.col("vocabulary") / slots))
    langs = written(langs.select("lang", "vocabulary", F.col("shards").cast("long").alias("shards")), "langs")
    sharded = kept.join(langs, "lang").select("lang", F.pmod("hash", "shards").cast("int").alias("shard"), "term", "hash")
    hashes = written(sharded.groupBy("lang", "shard").applyInArrow(_shard_hash, HASHES), "hashes")
    rounds, dealt = _rounds(hashes, round_bytes)
    counted = None
    for k in range(rounds):
        rows: dict[str, list] = {}
        for r in dealt.where(F.col("round") == k).join(langs, "lang").collect():
            rows.setdefault(r["lang"], []).append(r)
        sent = spark.sparkContext.broadcast({name: Shards(own[0]["shards"], own) for name, own in rows.items()})
        part = written(read.mapInArrow(lambda b, sent=sent: _recount(b, sent.value), COUNTS), "counts")
        sent.unpersist()
        counted = part if counted is None else counted.union(part)
    if counted is None:
        counted = spark.createDataFrame([], COUNTS)
    dense = written(counted.groupBy("lang", "shard", "source").applyInArrow(_dense, DENSE), "dense")
    sums = dense.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    known = groups.join(sums, ["lang", "source"], "left").select("lang", F.struct("source", F.coalesce("total", F.lit(0)).alias("total")).alias("s"))
    known = known.groupBy("lang").agg(F.array_sort(F.collect_list("s")).alias("s")).join(langs, "lang", "left")
    known = known.select("lang", F.col("s.source").alias("sources"), F.col("s.total").alias("sums"), F.coalesce("vocabulary", F.lit(0)).alias("vocabulary"))
    sides = known.join(hashes.select("lang", "shard", "keys"), "lang", "left").withColumn("shard", F.coalesce("shard", F.lit(-1)))
    items = sides.groupBy("lang", "shard").cogroup(dense.groupBy("lang", "shard")).applyInArrow(lambda key, a, b: _compare(key, a, b, top), ITEMS)
    items = written(items, "items")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = items.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))
    terms = items.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT n, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT n) >= 3
), v AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT DISTINCT lang, source FROM d
), n AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source
), m AS (
  SELECT lang, coalesce(sum(n), 0) AS n FROM n GROUP BY lang
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 1)) // (CAST(n.n AS HUGEINT) + v.v) AS p
  FROM g JOIN kept USING (lang) JOIN n ON n.lang = g.lang AND n.source = g.source JOIN v ON v.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), q AS (
  SELECT p.lang, p.term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(p.c) + 1)) // (CAST(any_value(m.n) AS HUGEINT) + any_value(v.v)) AS q
  FROM p JOIN m ON m.lang = p.lang JOIN v ON v.lang = p.lang GROUP BY p.lang, p.term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // q.q AS BIGINT)
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) <= 200
"""


@query("op13_source_divergence", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))
