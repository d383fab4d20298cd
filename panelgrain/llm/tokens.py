"""Token ids of documents as binary shards with Elias-Fano document boundaries."""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.elias_fano import EliasFano
from panelgrain.llm.shared import query, scratch, table, texts, written

END = 2
MAGIC = b"EFTOKEN1"
TAIL = struct.Struct("<QQBB8s")  # place of the footer, ids, bytes an id, whether doc ids ascend, magic
READ = 8 << 20
# Distinct pieces that a worker remembers before it starts anew.
MOST_PIECES = 1 << 18

# The characters below U+0240 by the classes of the tokenizer's split pattern.
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
LIMIT = 0x240
NUMBERS = "0123456789²³¹¼½¾"
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
CLASS = np.array(
    [SPACE if chr(c) in SPACES else NUMBER if chr(c) in NUMBERS else LETTER if chr(c).isalpha() else OTHER for c in range(LIMIT)], dtype=np.uint8
)
CHAR_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, LIMIT, dtype=np.uint64)


def piece_starts(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the byte-level split pattern cuts the texts code[at[i]:at[i + 1]]; all code points below LIMIT.

    Runs of letters, numbers and other characters take one blank before them along; of white space
    before such a run the last character stands apart; 's 't 're 've 'm 'll 'd at the start of a run
    of others are pieces of their own.
    """
    n = len(code)
    kind = CLASS[code]
    start = np.zeros(n + 1, dtype=bool)
    start[at] = True
    first = start.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(start[:n])
    blank = run[kind[run] == SPACE]
    stop = np.append(run, n)[1:][kind[run] == SPACE] if len(run) else blank
    inner = ~first[stop] & (stop < n)
    last = stop[inner] - 1
    start[last] = True
    start[stop[inner][code[last] == 32]] = False
    quote = np.flatnonzero((code == 39) & first[:n] | (code == 39) & np.append(False, (kind[:-1] != OTHER) & (code[:-1] != 32)))
    if len(quote):
        ahead = np.append(code, [0, 0, 0])
        inside = lambda k: (quote + k < n) & ~np.logical_or.reduce([first[np.minimum(quote + j, n)] for j in range(1, k + 1)])
        one, two = ahead[quote + 1], ahead[quote + 2]
        single = inside(1) & np.isin(one, [ord(c) for c in "stmd"])
        double = inside(2) & ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for hit, size in ((single, 1), (double, 2)):
            place = quote[hit]
            start[place + 1] = False
            after = place + 1 + size
            start[after[after <= n]] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """The tokenizer with a memory of split pieces.

    The byte-level tokenizer encodes each piece of its split pattern by itself, so a piece's ids are
    asked for once and remembered under a 64-bit hash of its characters. Texts with characters from U+0240 on (where
    Unicode versions may split otherwise) or with a special token's string go to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.dtype("<u2") if self.small else np.dtype("<u4")
        self.forget()

    def forget(self) -> None:
        self.known, self.number = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.begin, self.size, self.flat = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=self.dtype)

    def ask(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids = self.ask(pieces)
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        begin = len(self.flat) + np.concatenate(([0], np.cumsum(size)[:-1])) if len(ids) else size
        self.flat = np.concatenate((self.flat, np.fromiter((x for own in ids for x in own), dtype=self.dtype)))
        number = np.arange(len(self.size), len(self.size) + len(size))
        self.begin, self.size = np.concatenate((self.begin, begin)), np.concatenate((self.size, size))
        known = np.concatenate((self.known, hashes))
        order = np.argsort(known, kind="stable")
        self.known, self.number = known[order], np.concatenate((self.number, number))[order]

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has; only characters below LIMIT."""
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))))
        start = piece_starts(code, at)
        end = np.append(start, len(code))[1:]
        hashes = K.span_hash(K.prefix_hash(CHAR_VALUES[code]), start, end) + (end - start).astype(np.uint64)
        each, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MOST_PIECES:
            self.forget()
        spot = np.minimum(np.searchsorted(self.known, each), max(0, len(self.known) - 1))
        new = self.known[spot] != each if len(self.known) else np.ones(len(each), dtype=bool)
        if new.any():
            self.learn(each[new], [joined[a:b] for a, b in zip(start[example[new]].tolist(), end[example[new]].tolist(), strict=True)])
            spot = np.searchsorted(self.known, each)
        number = self.number[spot][which] if len(each) else which
        size = self.size[number]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(self.begin[number] - total[:-1], size) + np.arange(total[-1])]
        return ids, np.diff(total[np.searchsorted(start, at)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids with the end id after each text, and how many each row has."""
        data, at = K.text_bytes(column)
        texts = column.to_pylist()
        wide = np.zeros(len(texts), dtype=bool)
        far = np.flatnonzero(data >= 0xC9)
        wide[np.searchsorted(at, far, "right") - 1] = True
        plain = [t or "" if not w and not any(s in (t or "") for s in self.special) else None for t, w in zip(texts, wide.tolist(), strict=True)]
        ids, sizes = self.plain([t for t in plain if t is not None])
        rest = [i for i, t in enumerate(plain) if t is None]
        count = np.zeros(len(texts), dtype=np.int64)
        easy = np.array([t is not None for t in plain], dtype=bool)
        count[easy] = sizes
        slow = dict(zip(rest, self.ask([texts[i] for i in rest]), strict=True)) if rest else {}
        for i in rest:
            count[i] = len(slow[i])
        place = np.concatenate(([0], np.cumsum(count + 1)))
        out = np.full(place[-1], END, dtype=self.dtype)
        row = np.flatnonzero(easy)
        before = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
        out[np.repeat(place[row] - before, sizes) + np.arange(len(ids))] = ids
        for i in rest:
            out[place[i] : place[i] + count[i]] = slow[i]
        return out, count + 1


_ENCODERS: dict[str, Encoder] = {}


def _write_shard(batches, tokenizer: str, folder: str, ascending: bool):
    """One range partition as one file; yields its manifest row."""
    encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(tokenizer))
    part = TaskContext.get().partitionId()
    files, path = pa.fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    own = f"{path}/.{part:06d}-{uuid.uuid4().hex}"
    docs, sizes = [], []
    with files.open_output_stream(own) as out:
        for batch in batches:
            _, at = K.text_bytes(batch.column(1))
            for i, j in K.slices(at):
                ids, count = encoder.encode(batch.column(1).slice(i, j - i))
                out.write(ids.tobytes())
                sizes.append(count)
                docs.extend(batch.column(0).slice(i, j - i).to_pylist())
        count = K.gathered(sizes, np.int64)
        total = int(count.sum())
        out.write(_footer(docs, count, ascending))
        out.write(TAIL.pack(total * encoder.dtype.itemsize, total, encoder.dtype.itemsize, ascending, MAGIC))
    encoder.forget()  # a worker lives on after its task
    if not docs:
        files.delete_file(own)
        return
    files.move(own, f"{path}/{part:06d}.tokens")
    yield pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([f"{folder}/{part:06d}.tokens"]), pa.array([len(docs)], pa.int64()), pa.array([total], pa.int64())],
        names=["shard", "file", "n_docs", "n_ids"],
    )


def _footer(docs: list, count: np.ndarray, ascending: bool) -> bytes:
    """Document ends as one Elias-Fano list; doc ids as another if they ascend, else as bits of one width."""
    named = np.array([d for d in docs if d is not None], dtype=np.int64)
    least = int(named.min()) if len(named) else 0
    nulls = len(docs) - len(named)
    ends = EliasFano.of(np.cumsum(count))
    head = struct.pack("<qQ", least, nulls)
    if ascending:  # nulls come first
        return head + EliasFano.of((named - least).astype(np.uint64)).to_bytes() + ends.to_bytes()
    over = np.array([0 if d is None else d - least + 1 for d in docs], dtype=np.uint64)
    width = max(1, int(over.max()).bit_length()) if len(over) else 1
    bits = ((over[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    return head + struct.pack("<BQ", width, len(packed)) + packed + ends.to_bytes()


class Shard:
    """One written file: `ends` selects document boundaries, `ids(a, b)` reads a range of ids."""

    def __init__(self, file: str):
        files, path = pa.fs.FileSystem.from_uri(file)
        self.file = files.open_input_file(path)
        size = self.file.size()
        place, self.n_ids, width, ascending, magic = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"not a token shard: {file}")
        self.dtype = np.dtype(f"<u{width}")
        raw = self.file.read_at(size - TAIL.size - place, place)
        least, nulls = struct.unpack_from("<qQ", raw)
        at = 16
        if ascending:
            named, at = EliasFano.from_bytes(raw, at)
            self.doc_ids = [None] * nulls + (named.all().astype(np.int64) + least).tolist()
            self.ends, at = EliasFano.from_bytes(raw, at)
        else:
            bits, size = struct.unpack_from("<BQ", raw, at)
            packed = np.frombuffer(raw, np.uint8, size, at + 9)
            self.ends, at = EliasFano.from_bytes(raw, at + 9 + size)
            over = np.unpackbits(packed, bitorder="little")[: self.ends.count * bits].reshape(-1, bits).astype(np.uint64)
            over = (over << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(np.int64)
            self.doc_ids = [None if v == 0 else v - 1 + least for v in over.tolist()]

    def bounds(self, i: int) -> tuple[int, int]:
        """Where document i begins and ends among the shard's ids."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, first: int, last: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((last - first) * self.dtype.itemsize, first * self.dtype.itemsize), dtype=self.dtype)


def _read(batches):
    for batch in batches:
        for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(file)
            ends = shard.ends.all().astype(np.int64)
            begins = np.concatenate(([0], ends[:-1]))
            step = READ // shard.dtype.itemsize
            i = 0
            while i < len(ends):
                j = max(i + 1, int(np.searchsorted(ends, begins[i] + step, "right")))
                raw = memoryview(shard.ids(int(begins[i]), int(ends[j - 1])).astype("<u4")).cast("B")
                a, b = (begins[i:j] - begins[i]) * 4, (ends[i:j] - begins[i]) * 4
                sums = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids[i:j], pa.int64()), pa.array(begins[i:j] + start), pa.array(ends[i:j] - begins[i:j]), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                i = j


def write_tokens(docs: DataFrame, tokenizer: str, order: list[Column] | None = None) -> DataFrame:
    """Write the ids of all texts to shards in the shared folder; returns the manifest (shard, file, n_docs, n_ids, start).

    Every text is encoded whole, null as empty, and followed by the end id. Documents lie in ascending
    doc_id (null first), equal ones by their text, or in the given order. Shards are the range
    partitions of that order; a task writes a file of its own and moves it to the shard's name, so a
    repeated task leaves one whole file. `start` counts the ids of all shards before.
    """
    spark = docs.sparkSession
    keys = order or [F.col("doc_id"), F.col("text")]
    ascending = order is None
    source = texts(docs, *[k.alias(f"_o{i}") for i, k in enumerate(order or [])])
    keys = [F.col(f"_o{i}") for i in range(len(order))] if order else keys
    dealt = source.repartitionByRange(keys[0]).sortWithinPartitions(*keys).select("doc_id", "text")
    folder = scratch(spark, "tokens")
    folder = folder if ":" in folder else "file://" + folder
    manifest = dealt.mapInArrow(lambda batches: _write_shard(batches, tokenizer, folder, ascending), "shard long, file string, n_docs long, n_ids long")
    manifest = written(manifest, "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; one task a shard."""
    shards = manifest.count()
    spread = manifest.select("file", "start").repartition(max(1, shards), "start")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str, order: list[Column] | None = None) -> DataFrame:
    """Encode, write and read back: one row (doc_id, start, n_tokens, ids_crc32) a document.

    An empty table gives no rows; extra columns are not read; repeated rows are encoded each.
    """
    return read_tokens(write_tokens(docs, tokenizer, order))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_token_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index(table(spark, sf_dir, "documents"), default_tokenizer())
