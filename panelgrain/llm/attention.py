"""Language-model scores: a causal self-attention model over subword ids, trained and run in numpy."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, scratch, table, written

# Bytes of text in a block; words of over LONG bytes are encoded in parts.
BLOCK, LONG = 12 << 20, 1000
# A window is two strides; the ids of its second half are scored, each with at least a stride of ids before it.
STRIDE = 16
# Classes of ids in groups, of them one for the end and SHARED that share out the rarer ids; width of the model and of its head.
GROUPS, MEMBERS, SHARED = 32, 32, 31
CLASSES = GROUPS * MEMBERS
WIDTH, HEAD = 24, 8
# One training window in SAMPLE is learned from, once, in ROUNDS parts; a task makes about STEPS steps of BATCH windows a round.
SAMPLE, ROUNDS, STEPS, BATCH, LEAST_BATCH, RATE = 1, 6, 64, 256, 128, 0.03
# Windows and tokens of whole texts that are worked on at a time, and the parts in which weights are averaged.
AT_ONCE, TOKENS, PARTS = 1024, 1 << 17, 16
# Windows of one row.
PACK = 32

STAGED = "kind string, block long, doc_id long, held boolean, code int, word string, n long, data binary"
_STAGED = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("code", pa.int32()), ("word", pa.string()), ("n", pa.int64()), ("data", pa.binary())])
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level tokenizer: the file of its ranks and its split pattern. Ids from `size` on: end, start, none."""

    path: str
    pattern: str
    size: int


_ENCODERS: dict[str, tuple] = {}


def _encoder(v: Vocabulary):
    """The tokenizer and the number of bytes of each id; read once a worker."""
    if v.path not in _ENCODERS:
        import tiktoken

        with open(v.path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        sizes = np.zeros(v.size, dtype=np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _ENCODERS[v.path] = tiktoken.Encoding("own", pat_str=v.pattern, mergeable_ranks=ranks, special_tokens={}), sizes
    return _ENCODERS[v.path]


def word_ids(words: pa.Array, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word with a blank before it, in a row, and the n + 1 offsets of the words.

    The words are encoded as one text. The split pattern keeps a blank with what follows it; where it
    does not (white space beyond ASCII beside the blank) and for very long words, the word is encoded alone.
    """
    encoding, sizes = _encoder(v)
    if not len(words):
        return np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
    length = pa.compute.binary_length(words).to_numpy().astype(np.int64) + 1
    short = length <= LONG
    at = np.concatenate(([0], np.cumsum(np.where(short, length, 0))))
    text = " ".join(["", *words.filter(pa.array(short)).to_pylist()])
    ids = encoding.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, dtype=np.uint32)
    ends = np.concatenate(([0], np.cumsum(sizes[ids])))
    place = np.searchsorted(ends, at)
    cut = ends[np.minimum(place, len(ends) - 1)] == at
    alone = np.flatnonzero(~(short & cut[:-1] & cut[1:]))
    if not len(alone):
        return ids, place
    own = {}
    for i in alone.tolist():
        part = " " + words[i].as_py()
        own[i] = np.array([x for k in range(0, len(part), LONG) for x in encoding.encode_ordinary(part[k : k + LONG])], dtype=np.uint32)
    parts = [own[i] if i in own else ids[place[i] : place[i + 1]] for i in range(len(words))]
    return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers, first all lowest bytes, then all second ones, and so on: the high bytes pack to almost nothing."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def numbers(data: bytes) -> np.ndarray:
    """What `planes` made bytes of."""
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def squeezed(values: np.ndarray) -> bytes:
    """`planes` of many numbers, compressed here, as a shuffle would do it less well; led by their length."""
    data = planes(values)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def loosened(data: bytes) -> np.ndarray:
    """What `squeezed` made bytes of."""
    return numbers(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))


def _cell_type(size: int) -> str:
    """The type that training windows are packed in: 16 bits if all ids, the end, start and none fit."""
    return "<u2" if size + 2 < 1 << 16 else "<u4"


def _gather(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[at[r]:at[r + 1]] for each r of rows, in a row, and their lengths."""
    size = at[rows + 1] - at[rows]
    before = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    return values[np.repeat(at[rows] - before, size) + np.arange(int(size.sum()))], size


def windows(ids: np.ndarray, size: np.ndarray, start: int, skip: int = 0, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Windows of 2 * STRIDE ids over texts that lie in a row, and the number of windows of each text.

    A text is led by STRIDE times `start` and filled with `start` + 1; window j holds its ids from
    STRIDE * (j - 1) on, so each id is in the second half of one window. Of all windows, only each `step`-th
    from the one after `skip` is made.
    """
    count = -(-size // STRIDE)
    first = np.concatenate(([0], np.cumsum(count + 1)))
    cells = np.full((int(first[-1]), STRIDE), start + 1, dtype=np.int32)
    cells[first[:-1]] = start
    before = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    cells.reshape(-1)[np.repeat((first[:-1] + 1) * STRIDE - before, size) + np.arange(len(ids))] = ids
    lead = np.ones(len(cells), dtype=bool)
    lead[first[1:] - 1] = False
    place = np.flatnonzero(lead)[skip::step]
    return np.concatenate((cells[place], cells[place + 1]), axis=1), count


def _rows(kind: str, block: int, rows: int, **columns) -> pa.RecordBatch:
    known = {"kind": [kind] * rows, "block": [block] * rows} | columns
    return pa.RecordBatch.from_arrays([c if isinstance(c := known.get(f.name), pa.Array) else pa.array(c if c is not None else [None] * rows, f.type) for f in _STAGED], schema=_STAGED)


def _stage(batches, v: Vocabulary, kinds: tuple[str, ...] = ("doc", "word", "window")):
    """Blocks of documents: each document as codes of its words, each distinct word with its ids, the training windows; the kinds that are asked for."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        _, whole = K.text_bytes(batch.column(2))
        for i, j in K.slices(whole, BLOCK):
            part = batch.slice(i, j - i)
            data, at = K.text_bytes(part.column(2))
            lower = K._lower[data]
            starts, ends, first = K.words(lower, at, K.NOT_SPACE)
            ends_at = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
            flat = np.ascontiguousarray(lower[K.NOT_SPACE[lower]])
            coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at), pa.py_buffer(flat)).dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False)
            # Frequent words get small codes; code 0 is the end.
            often = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
            place = np.empty(len(often), dtype=np.int64)
            place[often] = np.arange(1, len(often) + 1)
            words = coded.dictionary.take(pa.array(often)).cast(pa.string())
            held = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            n = np.diff(first) + 1
            stop = np.cumsum(n)
            codes = np.zeros(int(stop[-1]), dtype=np.int64)
            inner = np.ones(len(codes), dtype=bool)
            inner[stop - 1] = False
            codes[inner] = place[code]
            learned = np.repeat(~held, n)
            ids, ids_at = word_ids(words, v)
            ids, ids_at = np.concatenate(([v.size], ids)).astype(np.int64), np.concatenate(([0], np.asarray(ids_at) + 1))
            counts = np.bincount(codes[learned], minlength=len(words) + 1)
            del data, lower, flat, starts, ends, ends_at, coded, code, inner
            ends_of = stop.tolist()
            if "doc" in kinds:
                yield _rows("doc", number, len(n), doc_id=part.column(0), held=pa.array(held), code=pa.array(np.zeros(len(n)), pa.int32()), n=pa.array(n), data=[planes(codes[b - a : b]) for a, b in zip(n.tolist(), ends_of, strict=True)])
                # The block's dictionary is one row beside its documents: how many ids each code has, and the ids.
                yield _rows("doc", number, 1, code=pa.array([1], pa.int32()), n=pa.array([len(counts)]), data=[squeezed(np.concatenate((np.diff(ids_at), ids)))])
            if "word" in kinds:
                yield _rows("word", number, len(counts), code=pa.array(np.arange(len(counts)), pa.int32()), word=pa.concat_arrays([pa.array([""]), words]), n=pa.array(counts))
            keep, last = codes[learned], np.concatenate(([0], np.cumsum(n[~held])))
            seen, placed = 0, 0
            for a, b in K.slices(last, TOKENS) if "window" in kinds else ():
                text_ids, size = _gather(ids, ids_at, keep[last[a] : last[b]])
                made, count = windows(text_ids, np.add.reduceat(size, last[a:b] - last[a]), v.size + 1, -seen % SAMPLE, SAMPLE)
                seen += int(count.sum())
                # Window j of a block is of turn j modulo ROUNDS: those of one row are not neighbours. A slice's windows go at once, so no block's are held together.
                turn = (placed + np.arange(len(made))) % ROUNDS
                placed += len(made)
                flat = np.ascontiguousarray(made.astype("<u4"))
                ends = np.arange(len(made) + 1, dtype=np.int32) * (8 * STRIDE)
                cells = pa.BinaryArray.from_buffers(pa.binary(), len(made), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
                yield _rows("window", number, len(made), n=pa.array(turn, pa.int64()), data=cells)
            number += 1


def _packed(batches, v: Vocabulary):
    """What `_stage` yields, with up to PACK windows in a row, in the type of `_cell_type`; they go to training so."""
    for batch in batches:
        if not batch.num_rows or batch.column(0)[0].as_py() != "window":
            yield batch
            continue
        cells = np.frombuffer(b"".join(batch.column(7).to_pylist()), dtype="<u4").reshape(-1, 2 * STRIDE).astype(_cell_type(v.size))
        turn = batch.column(6).to_numpy()
        rounds, rows = [], []
        for k in range(ROUNDS):
            own = cells[turn == k]
            rows += [own[i : i + PACK].tobytes() for i in range(0, len(own), PACK)]
            rounds += [k] * (len(rows) - len(rounds))
        yield _rows("window", batch.column(1)[0].as_py(), len(rows), n=pa.array(rounds, pa.int64()), data=pa.array(rows, pa.binary()))


def _id_counts(batches, v: Vocabulary):
    """(id, n) of the words of a task, each encoded once."""
    total = np.zeros(v.size + 1, dtype=np.int64)
    for batch in batches:
        c = batch.column(1).to_numpy()
        ids, at = word_ids(batch.column(0).filter(pa.compute.not_equal(batch.column(0), "")), v)
        words = np.flatnonzero(pa.compute.not_equal(batch.column(0), "").to_numpy(zero_copy_only=False))
        np.add.at(total, ids, np.repeat(c[words], np.diff(at)))
        total[v.size] += int(np.delete(c, words).sum())
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["id", "n"])


@dataclass
class Classes:
    """The class of each id and the natural log of its share in the class, from counts plus one; GROUPS * MEMBERS classes in groups."""

    of: np.ndarray
    inside: np.ndarray
    counts: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray) -> Classes:
        """The most frequent ids and the end have a class of their own; the others are cut, by frequency, into classes of even mass."""
        n = len(counts)
        rest = np.argsort(-counts[:-1], kind="stable")
        own = min(CLASSES - SHARED - 1, n - 1)
        of = np.zeros(n, dtype=np.int64)
        of[rest[:own]] = np.arange(1, own + 1)
        far = rest[own:]
        mass = np.cumsum(counts[far] + 1.0)
        if len(far):
            of[far] = own + 1 + np.minimum(SHARED - 1, (mass - 1) * SHARED // mass[-1]).astype(np.int64)
        size = np.bincount(of, weights=counts + 1.0, minlength=CLASSES)
        return cls(of, np.log((counts + 1.0) / size[of]), size)

    def cells(self, ids: np.ndarray) -> np.ndarray:
        """Classes of ids; CLASSES for the start, and for cells that hold nothing."""
        return np.append(self.of, [CLASSES, CLASSES]).astype(np.int32)[ids]


def shapes() -> dict[str, tuple[int, ...]]:
    return {
        "embed": (CLASSES + 1, WIDTH), "place": (2 * STRIDE - 1, WIDTH), "query": (WIDTH, HEAD), "key": (WIDTH, HEAD), "value": (WIDTH, HEAD), "out": (HEAD, WIDTH),
        "group": (WIDTH, GROUPS), "group_bias": (GROUPS,), "member": (GROUPS, WIDTH, MEMBERS), "member_bias": (GROUPS, MEMBERS),
    }


# Which of a window's inputs a query may see: those up to its own place.
SEEN = np.arange(2 * STRIDE - 1) <= np.arange(STRIDE - 1, 2 * STRIDE - 1)[:, None]
MASK = np.where(SEEN, 0, -1e9).astype(np.float32)
# Scores before an exponential are held below this, so that sums stay finite.
MOST = np.float32(60)


def first_weights(classes: Classes) -> dict[str, np.ndarray]:
    """Small random weights; the biases make the untrained model the frequencies of the classes."""
    rng = np.random.Generator(np.random.PCG64(12))
    scale = {"embed": 0.3, "place": 0.1, "group": 0.2, "member": 0.2}
    w = {k: (rng.standard_normal(s) * scale.get(k, s[0] ** -0.5)).astype(np.float32) for k, s in shapes().items()}
    counts = np.maximum(classes.counts, 0.5).reshape(GROUPS, MEMBERS)
    w["group_bias"] = np.log(counts.sum(axis=1) / counts.sum()).astype(np.float32)
    w["member_bias"] = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return w


def _attend(w: dict, cells: np.ndarray):
    """Hidden states of the scored places, one row each, with what the gradient needs.

    Attention is a sum of values weighted by exponentials; a column of ones beside the values sums the weights.
    """
    x = np.take(w["embed"], cells[:, :-1], axis=0)
    x += w["place"]
    near = x[:, STRIDE - 1 :].reshape(-1, WIDTH)
    flat = x.reshape(-1, WIDTH)
    q = (near @ (w["query"] * np.float32(HEAD**-0.5))).reshape(len(cells), STRIDE, HEAD)
    k = (flat @ w["key"]).reshape(len(cells), -1, HEAD)
    v = np.empty((*k.shape[:2], HEAD + 1), dtype=np.float32)
    v[:, :, HEAD] = 1
    v[:, :, :HEAD] = (flat @ w["value"]).reshape(k.shape)
    a = q @ k.transpose(0, 2, 1)
    np.minimum(a, MOST, out=a)
    a += MASK
    np.exp(a, out=a)
    c = a @ v
    total = np.maximum(c[:, :, HEAD:], np.float32(1e-30))
    c = (c[:, :, :HEAD] / total).reshape(-1, HEAD)
    return flat, near, q, k, v, a, total, c, near + c @ w["out"]


def _shares(logits: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Turns logits into their exponentials; the sum of each row and the log of the goal's share of it."""
    np.minimum(logits, MOST, out=logits)
    own = logits[np.arange(len(goal)), goal]
    np.exp(logits, out=logits)
    total = np.maximum(logits @ np.ones(logits.shape[1], dtype=np.float32), np.float32(1e-30))
    return total, own - np.log(total)


def _by_group(goal: np.ndarray):
    """Places in order of the group of their class, and where each group begins."""
    group = goal // MEMBERS
    order = np.argsort(group, kind="stable")
    return group, order, np.searchsorted(group[order], np.arange(GROUPS + 1))


class Scorer:
    """Scores without a gradient: keys, values and queries of each class are looked up, biases are one more row of the weights."""

    def __init__(self, w: dict):
        ones = lambda n: np.ones((n, 1), dtype=np.float32)
        none = lambda n: np.zeros((n, 1), dtype=np.float32)
        wide = lambda *parts: np.ascontiguousarray(np.concatenate(parts, axis=1, dtype=np.float32))
        query, places = w["query"] * HEAD**-0.5, w["place"][STRIDE - 1 :]
        self.past, self.past_place = wide(w["embed"] @ w["key"], w["embed"] @ w["value"], ones(CLASSES + 1)), wide(w["place"] @ w["key"], w["place"] @ w["value"], none(2 * STRIDE - 1))
        self.near, self.near_place = wide(w["embed"], ones(CLASSES + 1), w["embed"] @ query), wide(places, none(STRIDE), places @ query)
        self.out = np.zeros((HEAD + 1, WIDTH + 1), dtype=np.float32)
        self.out[:HEAD, :WIDTH] = w["out"]
        self.group = np.concatenate((w["group"], w["group_bias"][None]), dtype=np.float32)
        self.member = np.concatenate((w["member"], w["member_bias"][:, None]), axis=1, dtype=np.float32)

    def __call__(self, cells: np.ndarray) -> np.ndarray:
        """Natural log of the probability of the class at each place of the second half of each window.

        The share of the class's group times its share within the group; only the logits of that one group are made.
        """
        past = np.take(self.past, cells[:, :-1], axis=0)
        past += self.past_place
        near = np.take(self.near, cells[:, STRIDE - 1 : -1], axis=0)
        near += self.near_place
        a = near[:, :, WIDTH + 1 :] @ past[:, :, :HEAD].transpose(0, 2, 1)
        a += MASK
        np.minimum(a, MOST, out=a)
        np.exp(a, out=a)
        c = a @ past[:, :, HEAD:]
        c /= np.maximum(c[:, :, HEAD:], np.float32(1e-30))
        h = c.reshape(-1, HEAD + 1) @ self.out
        h += near.reshape(-1, near.shape[2])[:, : WIDTH + 1]
        goal = np.minimum(cells[:, STRIDE:].reshape(-1), CLASSES - 1)
        group, order, edge = _by_group(goal)
        out = _shares(h @ self.group, group)[1]
        h, member = np.take(h, order, axis=0), (goal % MEMBERS)[order]
        inner = np.empty(len(goal), dtype=np.float32)
        for g in np.flatnonzero(np.diff(edge)).tolist():
            i, j = edge[g], edge[g + 1]
            inner[i:j] = _shares(h[i:j] @ self.member[g], member[i:j])[1]
        out[order] += inner
        return out.reshape(len(cells), STRIDE)


def log_shares(w: dict, cells: np.ndarray) -> np.ndarray:
    return Scorer(w)(cells)


def gradient(w: dict, cells: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the scored ids of some windows and its gradient."""
    flat, near, q, k, v, a, total, c, h = _attend(w, cells)
    goal = cells[:, STRIDE:].reshape(-1)
    valid = (goal < CLASSES).astype(np.float32)
    goal = np.minimum(goal, CLASSES - 1)
    n = max(1.0, float(valid.sum()))
    group, order, edge = _by_group(goal)

    def back(states, weights, bias, aim, weight):
        """Log shares of aims, and the loss's gradient by logits."""
        logits = states @ weights
        logits += bias
        total, own = _shares(logits, aim)
        logits /= total[:, None]
        logits[np.arange(len(aim)), aim] -= 1
        logits *= weight[:, None]
        return own, logits

    own, dl = back(h, w["group"], w["group_bias"], group, valid / np.float32(n))
    loss = float(-(own * valid).sum() / n)
    g = {"group": h.T @ dl, "group_bias": dl.sum(axis=0), "member": np.zeros_like(w["member"]), "member_bias": np.zeros_like(w["member_bias"])}
    dh = dl @ w["group"].T
    for one in np.flatnonzero(np.diff(edge)).tolist():
        rows = order[edge[one] : edge[one + 1]]
        own, dl = back(h[rows], w["member"][one], w["member_bias"][one], goal[rows] % MEMBERS, valid[rows] / np.float32(n))
        loss -= float((own * valid[rows]).sum() / n)
        g["member"][one], g["member_bias"][one] = h[rows].T @ dl, dl.sum(axis=0)
        dh[rows] += dl @ w["member"][one].T
    g["out"] = c.T @ dh
    dc = (dh @ w["out"].T).reshape(q.shape) / total
    da = dc @ v[:, :, :HEAD].transpose(0, 2, 1)
    ds = a * (da - (dc * c.reshape(q.shape)).sum(axis=2, keepdims=True))
    dv = (a.transpose(0, 2, 1) @ dc).reshape(-1, HEAD)
    dq = (ds @ k).reshape(-1, HEAD) * np.float32(HEAD**-0.5)
    dk = (ds.transpose(0, 2, 1) @ q).reshape(-1, HEAD)
    g["query"], g["key"], g["value"] = near.T @ dq, flat.T @ dk, flat.T @ dv
    dx = (dk @ w["key"].T + dv @ w["value"].T).reshape(len(cells), -1, WIDTH)
    dx[:, STRIDE - 1 :] += (dh + dq @ w["query"].T).reshape(len(cells), STRIDE, WIDTH)
    g["place"] = dx.sum(axis=0)
    g["embed"] = np.zeros_like(w["embed"])
    cell, where = np.unique(cells[:, :-1], return_inverse=True)
    sums = np.argsort(where.reshape(-1), kind="stable")
    first = np.searchsorted(where.reshape(-1)[sums], np.arange(len(cell)))
    g["embed"][cell] = np.add.reduceat(dx.reshape(-1, WIDTH)[sums], first, axis=0)
    return loss, g


def train(w: dict, cells: np.ndarray, seed: int, rate: float) -> dict[str, np.ndarray]:
    """One pass of Adam over batches of windows, in a fixed random order; a short pass takes smaller batches."""
    w = {k: x.copy() for k, x in w.items()}
    mean, square = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(cells))
    size = min(BATCH, max(LEAST_BATCH, -(-len(order) // STEPS)))
    for step in range(1, -(-len(order) // size) + 1):
        _, g = gradient(w, cells[order[(step - 1) * size : step * size]])
        for k in w:
            mean[k] += np.float32(0.1) * (g[k] - mean[k])
            square[k] += np.float32(0.01) * (g[k] * g[k] - square[k])
            w[k] -= np.float32(rate / (1 - 0.9**step)) * mean[k] / (np.sqrt(square[k] * np.float32(1 / (1 - 0.99**step))) + np.float32(1e-8))
    return w


def _flat(w: dict) -> np.ndarray:
    return np.concatenate([w[k].reshape(-1) for k in shapes()])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes().items():
        out[k] = flat[at : at + int(np.prod(s))].reshape(s).astype(np.float32)
        at += int(np.prod(s))
    return out


def _parts(batches, kind: str) -> Iterator[np.ndarray]:
    """The windows of a task in parts of STEPS * BATCH; what is left over makes even parts of about as many. Two parts and a batch are held."""
    most, held = STEPS * BATCH, np.zeros((0, 2 * STRIDE), dtype=kind)
    for batch in batches:
        held = np.concatenate((held, np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=kind).reshape(-1, 2 * STRIDE)))
        while len(held) >= 2 * most:
            yield held[:most]
            held = held[most:]
    if len(held):
        yield from np.array_split(held, max(1, round(len(held) / most)))


def _train_task(batches, w: dict, classes: Classes, seed: int, rate: float):
    """The mean of the weights that the task's parts end with, all trained from the same weights, in PARTS parts, each with the number of windows."""
    total, whole = 0.0, 0
    for part in _parts(batches, _cell_type(len(classes.of) - 1)):
        total, whole = total + len(part) * _flat(train(w, classes.cells(part), seed, rate)).astype(np.float64), whole + len(part)
    if not whole:
        return
    for part, own in enumerate(np.array_split(total / whole, PARTS)):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([whole], pa.int64()), pa.array([own.astype("<f4").tobytes()], pa.binary())], names=["part", "n", "data"])


def _mean(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of one part of the weights, weighted by windows, batch by batch."""
    total, whole = 0.0, 0
    for batch in batches:
        for n, data in zip(batch.column("n").to_pylist(), batch.column("data").to_pylist(), strict=True):
            total, whole = total + n * np.frombuffer(data, dtype="<f4").astype(np.float64), whole + n
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([(total / whole).astype("<f4").tobytes()], pa.binary())], names=["part", "data"])


def _train_texts(batches, v: Vocabulary, w: dict, classes: Classes, seed: int, rate: float):
    """`_train_task` on the windows of a task's texts, made as they are learned from."""
    made = _packed(_stage(batches, v, ("window",)), v)
    return _train_task((b.select(["data"]) for b in made), w, classes, seed, rate)


def fit(learned: DataFrame, classes: Classes, n_ids: int, v: Vocabulary) -> dict[str, np.ndarray]:
    """Weights learned from all windows of some (doc_id, held, text): in each round every part starts from the same weights, and their mean is kept.

    A hash deals every document to one round, so each window is learned from once. A part is about STEPS * BATCH windows of one
    task, so more text makes more parts, not longer ones. Tasks read the texts where they lie and make the windows anew: no window
    is stored or shuffled, and a task sends one set of weights, whatever its number of parts. `n_ids` is about how many ids there are.
    """
    w = first_weights(classes)
    tasks = max(1, round(n_ids / (STRIDE * ROUNDS * STEPS * BATCH)))
    for k in range(ROUNDS):
        rate = RATE * (1 - k / ROUNDS)
        sent = learned.sparkSession.sparkContext.broadcast((w, classes))
        dealt = learned.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)) == k).select("doc_id", "held", "text").coalesce(tasks)
        ends = dealt.mapInArrow(lambda b, sent=sent, k=k, rate=rate: _train_texts(b, v, *sent.value, k, rate), "part int, n long, data binary")
        parts = {r["part"]: r["data"] for r in ends.groupBy("part").applyInArrow(_mean, "part int, data binary").collect()}
        if parts:
            w = _shaped(np.concatenate([np.frombuffer(parts[p], dtype="<f4") for p in range(PARTS)]))
        sent.unpersist()
    return w


def text_scores(ids: np.ndarray, size: np.ndarray, w: dict, classes: Classes) -> np.ndarray:
    """Natural log of the probability of each text of ids that lie in a row; every text ends with the end, so none is empty."""
    n = len(classes.of)
    cells, count = windows(ids, size, n)
    scorer = Scorer(w)
    out = np.zeros(len(cells), dtype=np.float64)
    for i in range(0, len(cells), AT_ONCE):
        own = cells[i : i + AT_ONCE]
        goal = own[:, STRIDE:]
        near = scorer(classes.cells(own)).astype(np.float64) + np.append(classes.inside, [0.0, 0.0])[goal]
        out[i : i + AT_ONCE] = np.where(goal < n, near, 0.0).sum(axis=1)
    return np.add.reduceat(out, np.concatenate(([0], np.cumsum(count)[:-1])))


def _score_block(docs: pa.Table, words: pa.Table, w: dict, classes: Classes, whole: int, distinct: int) -> pa.Table:
    """Both scores of the documents of one block."""
    kinds = docs["code"].to_numpy()
    cell = docs["data"]
    dictionary = loosened(cell[int(np.flatnonzero(kinds == 1)[0])].as_py())
    docs = docs.filter(pa.array(kinds == 0))
    size = dictionary[: len(words)]
    ids, at = dictionary[len(words) :], np.concatenate(([0], np.cumsum(size)))
    counts = np.zeros(len(words), dtype=np.int64)
    counts[words["code"].to_numpy()] = words["c"].combine_chunks().fill_null(0).to_numpy()
    shares = np.log10((counts + 1.0) / (whole + 1.0 * (distinct + 1)))
    n = docs["n"].to_numpy()
    first = np.concatenate(([0], np.cumsum(n)))
    base, known, scores = np.zeros(len(n)), np.zeros(len(n), dtype=np.int64), np.zeros(len(n))
    there = (counts > 0).astype(np.int64)
    for i, j in K.slices(first, TOKENS):
        codes, own = np.concatenate([numbers(x) for x in docs["data"].slice(i, j - i).to_pylist()]), first[i:j] - first[i]
        base[i:j], known[i:j] = np.add.reduceat(shares[codes], own), np.add.reduceat(there[codes], own)
        flat, size = _gather(ids, at, codes)
        scores[i:j] = text_scores(flat, np.add.reduceat(size, own), w, classes) / np.log(10)
    return pa.Table.from_arrays([docs["doc_id"], docs["held"], pa.array(n), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)


def text_likelihoods(docs: DataFrame, held_out: Column, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    A text (null: empty) is the sequence of its words, runs without white space with A-Z lower-cased, and an end;
    tokens are the words and the end. `held_out` says of a row that nothing is learned from it; a null counts as false.
    base_score is the log10 likelihood under the words' counts plus one; score the model's: each word with a
    blank before it becomes subword ids, the model gives the class of the next id and the id's share in its class.
    Both are of the same sequence. Rows without a doc_id and repeated rows are scored like any other; an empty table
    gives no rows; without training rows every count is 0 and the model is untrained; extra columns are not read.

    All counts are over all training rows. Texts are cut in blocks of about 12 MB; words are counted with a
    shuffle of each block's distinct words, and the counts come back to the block by a join, so no
    vocabulary is sent to a task whole. The model learns from all training windows (one in SAMPLE, which is 1), so what it
    learns from grows with the text: tasks read the texts once more, a sixth a round, and train in parallel; their weights are averaged. Only
    the counts of ids (no more than the tokenizer has) and the weights come to the driver.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    path = scratch(spark, "blocks")
    source.mapInArrow(lambda b: _stage(b, vocabulary, ("doc", "word")), STAGED).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    kind = lambda name: spark.read.schema(STAGED).parquet(path).where(F.col("kind") == name)
    words = kind("word")
    counted = words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0")
    counted = written(counted, "words")
    whole, distinct = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ids = counted.select("word", "c").mapInArrow(lambda b: _id_counts(b, vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary.size + 1, dtype=np.int64)
    for r in ids.collect():
        counts[r["id"]] = r["n"]
    classes = Classes.fit(counts)
    weights = fit(source.where("NOT held"), classes, int(counts.sum()), vocabulary)
    sent = spark.sparkContext.broadcast((weights, classes))
    known = words.join(counted.select("word", "c"), "word", "left").select("block", "code", "c")
    texts = kind("doc").select("block", "code", "doc_id", "held", "n", "data")
    out = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(lambda a, b: _score_block(a, b, *sent.value, whole, distinct), SCORED)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(whole).cast("long").alias("train_tokens"), "base_score", "score")


@query("op12_attention_scores")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return text_likelihoods(table(spark, sf_dir, "documents"), held, default_vocabulary())
