"""Removal of repeated 50-byte strings by bucket-pointer refinement over dealt-out suffixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, texts, written

WIDTH = 50
GRAM = 26
CHOICE = WIDTH - GRAM + 1  # q-grams of one string
UNIT, LEAST_UNIT, ROLL = 512, 64, 16
# Fragments that one turn of refinement takes at least, and bytes of text that are worked on at once.
TURN, SLICE = 8000, 1 << 20
# A range of at most CHOICE starts as one number: start * PACK + count.
PACK = 64
# A bucket of more documents than this goes string by string, combined before the shuffle.
HOT = 4096
U64 = K.U64
SHIFT = U64(32)
# Buckets are named by 39 bits of the hash, by 48 if there are over MANY pieces (about 100 GB of text). Two of one name only
# cost work, as strings are told apart by their bytes; twice a name of 39 bits fits five bytes, and the rest packs to nothing.
MANY, SPARE, WIDE_SPARE = 1 << 28, 25, 16


def rolled(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` bytes from each place."""
    c = K.prefix_hash(K.BYTE_VALUES[data])
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return K.mixed((c[width:] - c[:-width]) * K.powers(len(c))[1][:n])


def unit_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, stops and rows of pieces of about UNIT bytes whose cuts depend on the bytes before them."""
    h = rolled(data, ROLL)
    cuts = np.flatnonzero((h & U64(UNIT - 1)) == 0) + ROLL
    row = np.searchsorted(at, cuts, "right") - 1
    sound = (cuts - ROLL >= at[row]) & (cuts < at[np.minimum(row + 1, len(at) - 1)])
    cuts = cuts[sound]
    if len(cuts):
        cuts = cuts[np.concatenate(([True], np.diff(cuts) >= LEAST_UNIT))]
    starts = np.unique(np.concatenate((at[:-1][np.diff(at) >= WIDTH], cuts)))
    row = np.searchsorted(at, starts, "right") - 1
    keep = at[row + 1] - at[row] >= WIDTH
    starts, row = starts[keep], row[keep]
    stops = at[row + 1].copy()
    if len(starts) > 1:
        stops[:-1] = np.minimum(stops[:-1], starts[1:])
    keep = starts <= at[row + 1] - WIDTH
    return starts[keep], stops[keep], row[keep]


def _units(batches):
    for batch in batches:
        data, at = K.text_bytes(batch.column(2))
        for i, j in K.slices(at, SLICE):
            part, own = np.ascontiguousarray(data[at[i] : at[j]]), at[i : j + 1] - at[i]
            starts, stops, row = unit_bounds(part, own)
            ends = np.minimum(stops + WIDTH - 1, own[row + 1])
            view = memoryview(part)
            digests = b"".join([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
            sums = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
            first = starts - own[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i).take(pa.array(row)),
                    batch.column(1).slice(i, j - i).take(pa.array(row)),
                    pa.array(first),
                    pa.array(stops - own[row]),
                    pa.array(sums[:, 0] ^ (stops - starts)),
                    pa.array(np.ascontiguousarray(sums[:, 1])),
                ],
                names=["doc_id", "tkey", "start", "stop", "u1", "u2"],
            )


def _ranges(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and stops of rows i to j of a list<struct<start, stop>> column."""
    part = column.slice(i, j - i).fill_null([])
    flat = part.flatten()
    return np.asarray(pa.compute.list_parent_indices(part)), np.asarray(flat.field(0)), np.asarray(flat.field(1))


def anchors(data: np.ndarray, at: np.ndarray, rows: np.ndarray, starts: np.ndarray, stops: np.ndarray):
    """For the strings that start in `data` outside the given ranges: their starts, and the q-gram each one is filed under.

    A string is filed under the q-gram of least hash (the leftmost of equals) among those inside it, so
    equal strings are filed under the same q-gram at the same distance.
    """
    g = rolled(data, GRAM)
    if len(g) < CHOICE:
        none = np.zeros(0, dtype=np.int64)
        return none, none, g
    place = (g >> SHIFT << SHIFT) | np.arange(len(g), dtype=np.uint64)
    low, have = place, 1
    while have * 2 <= CHOICE:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[: len(g) - CHOICE + 1], low[CHOICE - have :][: len(g) - CHOICE + 1])
    n = len(low)
    closed = np.zeros(len(data) + 2, dtype=np.int32)
    last = np.maximum(at[1:] - WIDTH + 1, at[:-1])
    np.add.at(closed, last, 1)
    np.add.at(closed, at[1:], -1)
    np.add.at(closed, at[rows] + starts, 1)
    np.add.at(closed, at[rows] + stops, -1)
    active = np.flatnonzero(np.cumsum(closed[:n]) == 0)
    return active, (low[active] & U64(0xFFFFFFFF)).astype(np.int64), g


def _slices(batch):
    """Slices of a batch of (doc_id, tkey, text, pieces, ...): rows, bytes, offsets, and `anchors` of them."""
    data, at = K.text_bytes(batch.column(2))
    for i, j in K.slices(at, SLICE):
        part, own = np.ascontiguousarray(data[at[i] : at[j]]), at[i : j + 1] - at[i]
        yield i, j, part, own, *anchors(part, own, *_ranges(batch.column(3), i, j))


def _anchor_buckets(batches, spare: int):
    """(doc_id, tkey, h): the q-grams that strings of the document are filed under, each once."""
    for batch in batches:
        for i, j, _, own, _, prime, g in _slices(batch):
            prime = prime[np.concatenate(([True], prime[1:] != prime[:-1]))] if len(prime) else prime
            row = np.searchsorted(own, prime, "right") - 1
            h = g[prime] >> U64(spare)
            if j - i <= 1 << spare:
                # Row and name fit one number.
                both = np.sort((row.astype(np.uint64) << U64(64 - spare)) | h)
                row, h = (both >> U64(64 - spare)).astype(np.int64), both & U64((1 << 64 - spare) - 1)
            else:
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
            if len(row):
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
                row, h = row[new], h[new]
            row = pa.array(row + i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(h.view(np.int64))], names=["doc_id", "tkey", "h"])


def _runs(own: np.ndarray, active: np.ndarray, prime: np.ndarray, g: np.ndarray, wanted: pa.Array, spare: int):
    """Runs of strings filed under one q-gram that the row's list names: first string, count, row, h, and the listed entry's place."""
    none = np.zeros(0, dtype=np.int64)
    wanted = wanted.fill_null([])
    rows, listed = np.asarray(pa.compute.list_parent_indices(wanted)), np.asarray(wanted.flatten())
    if len(active) == 0 or len(rows) == 0:
        return none, none, none, none, none
    head = np.flatnonzero(np.concatenate(([True], (prime[1:] != prime[:-1]) | (np.diff(active) != 1))))
    size = np.diff(np.concatenate((head, [len(active)])))
    low, h = active[head], (g[prime[head]] >> U64(spare)).view(np.int64)
    row = np.searchsorted(own, low, "right") - 1
    mark = K.mixed((listed >> 1).view(np.uint64)) ^ rows.astype(np.uint64) * K.BASE
    mine = K.mixed(h.view(np.uint64)) ^ row.astype(np.uint64) * K.BASE
    order = np.argsort(mark)
    spot = np.minimum(np.searchsorted(mark[order], mine), len(mark) - 1)
    found = mark[order][spot] == mine
    return low[found], size[found], row[found], h[found], listed[order][spot][found]


def _digests(batches, spare: int):
    """(doc_id, tkey, h, b, place): runs filed under a shared q-gram; b is a hash of their bytes and count, place start * PACK + count."""
    for batch in batches:
        for i, j, part, own, active, prime, g in _slices(batch):
            first, count, row, h, _ = _runs(own, active, prime, g, batch.column(4).slice(i, j - i), spare)
            b = K.span_hash(K.prefix_hash(K.BYTE_VALUES[part]), first, first + count + WIDTH - 1) ^ K.mixed(count.astype(np.uint64))
            spot = pa.array(row + i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(spot), batch.column(1).take(spot), pa.array(h), pa.array(b.view(np.int64)), pa.array((first - own[row]) * PACK + count)],
                names=["doc_id", "tkey", "h", "b", "place"],
            )


def _taken(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    place = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return data[place], offsets


def _fragments(batches, spare: int):
    """Runs of strings with their bytes, for the q-grams that the row's list names; strings of hot q-grams one by one.

    A hot string that a smaller doc_id of the same slice has as well is settled here (sure), so each slice
    sends one row for each hot string to where these meet; the settled rows go anywhere.
    """
    for batch in batches:
        doc, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        for i, j, part, own, active, prime, g in _slices(batch):
            runs = _runs(own, active, prime, g, batch.column(4).slice(i, j - i), spare)
            is_hot = (runs[4] & 1) == 1
            for pick, single in ((~is_hot, False), (is_hot, True)):
                if not pick.any():
                    continue
                first, count, rid, hid, _ = (r[pick] for r in runs)
                sure = np.zeros(len(first), dtype=bool)
                if single:
                    first = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
                    rid = np.repeat(rid, count)
                    view = memoryview(part)
                    digest = b"".join([hashlib.blake2b(view[a : a + WIDTH], digest_size=16).digest() for a in first.tolist()])
                    hid, second = (np.ascontiguousarray(x) for x in np.frombuffer(digest, dtype=np.int64).reshape(-1, 2).T)
                    hid = hid.copy()
                    _, which = np.unique(hid ^ (second * np.int64(3)), return_inverse=True)
                    least = np.full(which.max() + 1, np.iinfo(np.int64).max)
                    np.minimum.at(least, which, doc[i:j][rid])
                    sure = doc[i:j][rid] > least[which]
                    hid[sure] = K.mixed(first[sure].astype(np.uint64) + doc[i:j][rid[sure]].view(np.uint64)).view(np.int64)
                    body = pa.nulls(len(first), pa.binary())
                else:
                    second = np.zeros(len(first), dtype=np.int64)
                    raw, offsets = _taken(part, first, count + WIDTH - 1)
                    body = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[i:j][rid]), pa.array(keys[i:j][rid]), pa.array(hid), pa.array(second), pa.array(sure), pa.array(first - own[rid]), body],
                    names=["doc_id", "tkey", "h", "w", "sure", "start", "body"],
                )


def buckets(codes: np.ndarray, bits: int) -> np.ndarray:
    """Bucket numbers in sorted order of the codes, which have so many bits; code and place are sorted as one number where they fit."""
    low = max(1, len(codes) - 1).bit_length()
    if bits + low > 64:
        return np.unique(codes, return_inverse=True)[1].astype(np.uint64)
    code = np.sort((codes << U64(low)) | np.arange(len(codes), dtype=np.uint64))
    place = (code & U64((1 << low) - 1)).astype(np.int64)
    code >>= U64(low)
    number = np.empty(len(codes), dtype=np.uint64)
    number[place] = np.concatenate(([0], np.cumsum(code[1:] != code[:-1], dtype=np.int64)))
    return number


def refined(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The bucket of the WIDTH bytes from each place: equal buckets, equal bytes.

    The first buckets are 4-grams. A bucket is refined by sorting on the pair of its number and the
    bucket number at the offset where it ends; the new numbers are what the next turn points to, so the
    depth goes 4, 8, 16, 32 and, with the last two overlapping, 50.
    """
    n = len(data) - 3
    code = np.zeros(n, dtype=np.uint64)
    for k in range(4):
        code = (code << U64(8)) | data[k : k + n].astype(np.uint64)
    number, depth = buckets(code, 32), 4
    while depth * 2 <= WIDTH:
        bits = int(number.max()).bit_length()
        number = buckets((number[:-depth] << U64(bits)) | number[depth:], 2 * bits)
        depth *= 2
    bits = int(number.max()).bit_length()
    return buckets((number[places] << U64(bits)) | number[places + WIDTH - depth], 2 * bits)


def _later(tables: pa.Table) -> pa.RecordBatch:
    """The strings of the fragments that a smaller doc_id has as well, as ranges of starts."""
    body = tables.column("body").combine_chunks()
    raw, at = np.frombuffer(body.buffers()[2], dtype=np.uint8), None
    at = np.frombuffer(body.buffers()[1], dtype=np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
    raw, at = raw[at[0] : at[-1]], at - at[0]
    size = np.diff(at) - WIDTH + 1
    places = np.repeat(at[:-1] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    owner = np.repeat(np.arange(len(size)), size)
    number = refined(raw, places).astype(np.int64)
    doc = np.asarray(tables.column("doc_id").combine_chunks())[owner]
    least = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, number, doc)
    gone = np.flatnonzero(doc > least[number])
    head = np.concatenate(([True], (np.diff(places[gone]) != 1) | (np.diff(owner[gone]) != 0))) if len(gone) else np.zeros(0, dtype=bool)
    head = np.flatnonzero(head)
    count = np.diff(np.concatenate((head, [len(gone)])))
    row = owner[gone[head]]
    start = np.asarray(tables.column("start").combine_chunks())[row] + places[gone[head]] - at[row]
    return pa.RecordBatch.from_arrays(
        [tables.column("doc_id").combine_chunks().take(pa.array(row)), tables.column("tkey").combine_chunks().take(pa.array(row)), pa.array(start * PACK + count)],
        names=["doc_id", "tkey", "place"],
    )


def _settled(batch: pa.Table, gone: np.ndarray) -> pa.RecordBatch:
    start = np.asarray(batch.column("start").combine_chunks())[gone]
    docs, keys = (np.asarray(batch.column(c).combine_chunks())[gone] for c in ("doc_id", "tkey"))
    return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(keys), pa.array(start * PACK + 1)], names=["doc_id", "tkey", "place"])


def _refine(batches):
    """Rows in order of h, w, doc_id: whole buckets of fragments are refined together, many in one turn.

    Of a hot string only the first row's doc_id is held, as all later ones are compared with it.
    """
    held, count, turn, last = [], 0, TURN, (None, None, 0)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        whole = pa.Table.from_batches([batch])
        alone = pa.compute.is_null(whole.column("body"))
        hot = whole.filter(alone)
        if hot.num_rows:
            h, w, doc, sure = (np.asarray(hot.column(c).combine_chunks()) for c in ("h", "w", "doc_id", "sure"))
            open_rows = np.flatnonzero(~sure)
            gone = sure.copy()
            if len(open_rows):
                ho, wo, do = h[open_rows], w[open_rows], doc[open_rows]
                head = np.concatenate(([(ho[0], wo[0]) != last[:2]], (ho[1:] != ho[:-1]) | (wo[1:] != wo[:-1])))
                firsts = np.concatenate(([last[2]], do[head]))
                least = firsts[np.cumsum(head)]
                gone[open_rows] = do > least
                last = (ho[-1], wo[-1], int(least[-1]))
            yield _settled(hot, gone)
        cold = whole.filter(pa.compute.invert(alone))
        held.append(cold)
        count += cold.num_rows
        if count < turn or cold.num_rows == 0:
            continue
        full = pa.concat_tables(held)
        h = np.asarray(full.column("h").combine_chunks())
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield _later(full.slice(0, cut))
        held = [full.slice(cut)]
        count = full.num_rows - cut
        turn = TURN if cut else 2 * turn
    full = pa.concat_tables(held) if held else None
    if full is not None and full.num_rows:
        yield _later(full)


def _cut(batches):
    for batch in batches:
        data, at = K.text_bytes(batch.column(2))
        raw = memoryview(np.ascontiguousarray(data))
        n_bytes, n_removed, n_spans, sums = [], [], [], []
        rows, starts, stops = _ranges(batch.column(3), 0, batch.num_rows)
        lists = [batch.column(c).fill_null([]) for c in (4, 5)]
        place = np.concatenate([np.asarray(x.flatten()) for x in lists]).astype(np.int64)
        rows = np.concatenate((rows, *(np.asarray(pa.compute.list_parent_indices(x)) for x in lists)))
        starts = np.concatenate((starts, place // PACK)).astype(np.int64)
        stops = np.concatenate((stops, place // PACK + place % PACK)).astype(np.int64)
        size = np.diff(at)
        stops = np.minimum(stops, size[rows] - WIDTH + 1)
        sound = stops > starts
        rows, starts, ends = rows[sound], starts[sound], stops[sound] + WIDTH - 1
        order = np.lexsort((starts, rows))
        rows, starts, ends = rows[order], starts[order], ends[order]
        first = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        for r in range(batch.num_rows):
            a, b = int(at[r]), int(at[r + 1])
            gone, spans, kept, done = 0, 0, hashlib.sha256(), 0
            if first[r] == first[r + 1]:
                kept.update(raw[a:b])
            else:
                s, e = starts[first[r] : first[r + 1]], np.maximum.accumulate(ends[first[r] : first[r + 1]])
                new = np.concatenate(([True], s[1:] > e[:-1]))
                lows, highs = s[new], e[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))]
                for x, y in zip(lows.tolist(), highs.tolist(), strict=True):
                    kept.update(raw[a + done : a + x])
                    done, gone, spans = y, gone + y - x, spans + 1
                kept.update(raw[a + done : b])
            n_bytes.append(b - a)
            n_removed.append(gone)
            n_spans.append(spans)
            sums.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sums, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document after removal.

    A byte goes if a 50-byte string that covers it also starts in a document with a smaller doc_id, in
    the input as it was. Texts are UTF-8 bytes, null counts as empty; no string crosses documents. Rows
    of one doc_id are not smaller than each other, so repeats among them stay. A row with null doc_id
    neither loses bytes nor makes others lose any. Texts below 50 bytes stay whole. Extra columns are
    not read. An empty table gives no rows.

    Bytes are first cut into pieces at places their own bytes choose; a piece that a smaller doc_id
    has as well (with the 49 bytes after it) is settled by one comparison of digests, so copies end
    here. The strings of what remains are filed under one of their 26-byte q-grams; a q-gram of one
    document only is dropped. A run of strings under one q-gram that a smaller doc_id has whole is settled
    by its hash. Of the runs that are left the first of each kind sends its bytes to its q-gram's task,
    where bucket-pointer refinement sorts the strings apart exactly. Strings of a bucket of over 4096
    runs go one by one, by a digest of their bytes, and are combined before the shuffle.
    """
    whole = texts(docs)
    twice = written(whole.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "twice")
    # Rows of one doc_id are told apart by a hash of the text; others have 0, which costs nothing to move.
    keyed = whole.join(twice.withColumn("twice", F.lit(True)), "doc_id", "left")
    every = keyed.select("doc_id", F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("tkey"), "text")
    source, key = every.where("doc_id IS NOT NULL"), ["doc_id", "tkey"]
    units = written(source.mapInArrow(_units, "doc_id long, tkey long, start long, stop long, u1 long, u2 long"), "units")
    firsts = units.groupBy("u1", "u2").agg(F.min("doc_id").alias("first"))
    pieces = units.join(firsts, ["u1", "u2"]).where("doc_id > first").groupBy(*key).agg(F.collect_set(F.struct("start", "stop")).alias("pieces"))
    base = source.join(written(pieces, "pieces"), key, "left").select(*key, "text", "pieces")
    spare = SPARE if units.count() <= MANY else WIDE_SPARE

    # What follows is one plan, in which the texts are dealt by document once for all joins.
    bucket, run = Window.partitionBy("h"), Window.partitionBy("h", "b")
    filed = base.mapInArrow(lambda b: _anchor_buckets(b, spare), "doc_id long, tkey long, h long")
    filed = filed.select(*key, "h", F.min("doc_id").over(bucket).alias("lo"), F.max("doc_id").over(bucket).alias("hi"))
    shared = filed.where("lo < hi").groupBy(*key).agg(F.collect_list(F.col("h") * 2).alias("shared"))
    runs = base.join(shared, key).select(*key, "text", "pieces", "shared").mapInArrow(lambda b: _digests(b, spare), "doc_id long, tkey long, h long, b long, place long")
    runs = runs.repartition("h").withColumn("first", F.min("doc_id").over(run))
    runs = runs.withColumns({"several": F.min("b").over(bucket) != F.max("b").over(bucket), "c": F.count("*").over(bucket)})
    later, name = F.expr("doc_id > first"), F.col("h") * 2 + F.when(F.col("c") > HOT, 1).otherwise(0)
    judged = runs.where(later | F.col("several")).groupBy(*key).agg(
        F.collect_list(F.when(later, F.col("place"))).alias("settled"), F.collect_set(F.when(~later & F.col("several"), name)).alias("asked")
    )
    # Both readers of `judged` take all its columns: with fewer in one of them Spark would make and sort the runs once for each.
    parts = base.join(judged.where("size(asked) > 0"), key).select(*key, "text", "pieces", "asked", "settled")
    parts = parts.mapInArrow(lambda b: _fragments(b, spare), "doc_id long, tkey long, h long, w long, sure boolean, start long, body binary")
    parts = parts.repartition("h", "w").sortWithinPartitions("h", "w", "doc_id")
    found = parts.mapInArrow(_refine, "doc_id long, tkey long, place long").groupBy(*key).agg(F.collect_list("place").alias("found"))
    joined = base.join(judged, key, "left").join(found, key, "left").select(*key, "text", "pieces", "settled", "found", "asked")
    nameless = every.where("doc_id IS NULL").select(
        *key, "text", F.lit(None).cast("array<struct<start: bigint, stop: bigint>>").alias("pieces"), *(F.lit(None).cast("array<bigint>").alias(c) for c in ("settled", "found"))
    )
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_cut, shape).union(nameless.mapInArrow(_cut, shape))


@query("op9_without_repeats")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
