"""Benchmark decontamination: a BM25 index of test items with block-max WAND, then overlap checks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain.functions.numbering import hashed_numbers
from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, texts, written

K1, B = 1.2, 0.75
# A passage is a candidate for an item from this share of the score that the item has with itself.
THRESHOLD = 0.55
GRAM, LIKE, PART = 5, 0.75, 0.5
BLOCK = 8
# One index holds at most this many bytes of items; more items are searched index by index.
MOST_BYTES = 2 << 20
U64 = K.U64


def _words(data: np.ndarray, at: np.ndarray):
    """Places of the words among the rows, and their hashes (A-Z as lower case)."""
    lower = K._lower[data]
    starts, ends, first = K.words(lower, at, K.WORD)
    return starts, first, K.span_hash(K.prefix_hash(K.BYTE_VALUES[lower]), starts, ends)


def _item_terms(batches):
    for batch in batches:
        data, at = K.text_bytes(batch.column(1))
        _, first, word = _words(data, at)
        row = np.repeat(np.arange(len(at) - 1), np.diff(first))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row)), pa.array(np.diff(first)[row].astype(np.int64)), pa.array(word.view(np.int64))], names=["item", "words", "term"]
        )


@dataclass
class Index:
    """Postings by term, in blocks of items, with impacts as shares of an item's score with itself.

    terms are sorted; term t has postings low[t] to low[t + 1] (items, impacts) and blocks
    block_low[t] to block_low[t + 1] (block numbers, largest impact inside). `most` is a term's largest.
    """

    items: list
    terms: np.ndarray
    low: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    most: np.ndarray
    block_low: np.ndarray
    block: np.ndarray
    block_most: np.ndarray
    grams: list
    split: list
    longest: int


def build_index(items: list[tuple], weights: dict[tuple, float], longest: int = 0) -> Index:
    """`items`: (name, text), each name once; `weights`: (name, term) -> BM25 impact; `longest`: words of the longest item of all indexes."""
    kept, grams, split = [], [], []
    for name, text in items:
        raw = (text or "").encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        starts, _, word = _words(data, np.array([0, len(raw)]))
        if len(word) == 0:
            continue
        kept.append(name)
        k = min(GRAM, len(word))
        own = K.gram_hash(word, k)
        cut = answer_start(raw, starts)
        grams.append((k, own))
        split.append(max(0, min(cut, len(own))))
    spot = {name: i for i, name in enumerate(kept)}
    rows = sorted((t, spot[name], w) for (name, t), w in weights.items() if name in spot)
    term = np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64) if rows else np.zeros(0, dtype=np.uint64)
    item = np.array([r[1] for r in rows], dtype=np.int64)
    impact = np.array([r[2] for r in rows])
    total = np.bincount(item, impact, len(kept)) if rows else np.zeros(len(kept))
    impact = impact / np.maximum(total[item], 1e-12)
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    terms, low = np.unique(term, return_index=True)
    low = np.append(low, len(term))
    most = np.maximum.reduceat(impact, low[:-1]) if len(terms) else np.zeros(0)
    which = np.repeat(np.arange(len(terms)), np.diff(low))
    block = item // BLOCK
    head = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (which[1:] != which[:-1])))) if len(term) else np.zeros(0, dtype=np.int64)
    block_most = np.maximum.reduceat(impact, head) if len(head) else np.zeros(0)
    return Index(kept, terms, low, item, impact, most, np.searchsorted(which[head], np.arange(len(terms) + 1)), block[head], block_most, grams, split, max([longest, *(len(own) + k - 1 for k, own in grams)]))


def answer_start(raw: bytes, starts: np.ndarray) -> int:
    """The word the answer begins with: the last sentence's first, or two thirds in if there is one sentence."""
    ends = [i for i in range(len(raw) - 1) if raw[i] in b".?!\n" and raw[i + 1] in b" \n"]
    for end in reversed(ends):
        cut = int(np.searchsorted(starts, end))
        if 0 < cut < len(starts):
            return cut
    return len(starts) * 2 // 3


def _spread(low: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places low[w] to low[w + 1] of every w in `which`, and the number of the entry each belongs to."""
    size = low[which + 1] - low[which]
    before = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else size
    return np.repeat(low[which] - before, size) + np.arange(size.sum()), np.repeat(np.arange(len(which)), size)


def search(index: Index, window: np.ndarray, term: np.ndarray, n: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (window, item, score) with score >= threshold; `window` and `term` list each window's distinct index terms, window by window.

    Block-max WAND for many windows at once. A window's terms are taken by rising upper bound; the
    first ones whose bounds together stay below the threshold cannot lift an item over it alone, so only the
    postings blocks of the others (from the pivot on) name blocks to look at. A block is scored only if the
    block maxima of all the window's terms reach the threshold.
    """
    slack = 1e-9
    bound = index.most[term]
    total = np.bincount(window, bound, n)
    live = total[window] >= threshold - slack
    window, term, bound = window[live], term[live], bound[live]
    none = np.zeros(0, dtype=np.int64)
    if len(window) == 0:
        return none, none, np.zeros(0)
    order = np.lexsort((bound, window))
    window, term, bound = window[order], term[order], bound[order]
    run = np.cumsum(bound)
    head = np.searchsorted(window, window)
    rising = run - np.where(head > 0, run[head - 1], 0.0)
    pivot = rising >= threshold - slack
    blocks = int(index.block.max()) + 1
    place, entry = _spread(index.block_low, term[pivot])
    named = np.unique(window[pivot][entry] * blocks + index.block[place])
    wide, entry = np.isin(window, np.unique(named // blocks)), None
    window, term = window[wide], term[wide]
    place, entry = _spread(index.block_low, term)
    key = window[entry] * blocks + index.block[place]
    spot = np.minimum(np.searchsorted(named, key), len(named) - 1)
    hit = named[spot] == key
    most = np.bincount(spot[hit], index.block_most[place[hit]], len(named))
    named = named[most >= threshold - slack]
    if len(named) == 0:
        return none, none, np.zeros(0)
    wide = np.isin(window, np.unique(named // blocks))
    window, term = window[wide], term[wide]
    place, entry = _spread(index.low, term)
    item = index.item[place]
    inside = np.isin(window[entry] * blocks + item // BLOCK, named)
    pair, which = np.unique(window[entry][inside] * len(index.items) + item[inside], return_inverse=True)
    score = np.bincount(which, index.impact[place[inside]], len(pair))
    good = score >= threshold - slack
    return pair[good] // len(index.items), pair[good] % len(index.items), score[good]


def _leaks(batches, index: Index):
    """(doc_id, tkey, item, score, question, answer): an item verified in a document; its best passage."""
    longest = index.longest
    for batch in batches:
        data, at = K.text_bytes(batch.column(2))
        found = []
        for i, j in K.slices(at):
            _, first, word = _words(data[at[i] : at[j]], at[i : j + 1] - at[i])
            row = np.repeat(np.arange(j - i), np.diff(first))
            inside = np.arange(len(word)) - first[row]
            # Passages are two strides long and start every stride, so any span of one stride is in one whole.
            strides = np.maximum(1, -(-np.diff(first) // longest))
            base = np.concatenate(([0], np.cumsum(strides)))
            spot = np.minimum(np.searchsorted(index.terms, word), len(index.terms) - 1)
            known = index.terms[spot] == word
            stride = base[row[known]] + inside[known] // longest
            terms = spot[known]
            size = len(index.terms)
            both = np.concatenate((stride, np.where(inside[known] >= longest, stride - 1, stride))) * size + np.concatenate((terms, terms))
            both = np.unique(both)
            window, item, score = search(index, both // size, both % size, int(base[-1]))
            own = np.searchsorted(base, window, "right") - 1
            for r, w, it, s in zip(own.tolist(), window.tolist(), item.tolist(), score.tolist(), strict=True):
                a = int(first[r]) + (w - int(base[r])) * longest
                k, grams = index.grams[it]
                here = np.isin(grams, K.gram_hash(word[a : min(a + 2 * longest, int(first[r + 1]))], k))
                cut = index.split[it]
                question = float(here[:cut].mean()) if cut else float(here.mean())
                answer = float(here[cut:].mean()) if cut < len(here) else float(here[-1])
                if here.mean() >= LIKE and question >= PART and answer >= PART:
                    found.append((i + r, it, s, question, answer))
        best = {}
        for r, it, s, question, answer in found:
            best[r, it] = max(best.get((r, it), (0.0, 0.0, 0.0)), (s, question, answer))
        rows = sorted(best)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array([r for r, _ in rows], pa.int64())),
                batch.column(1).take(pa.array([r for r, _ in rows], pa.int64())),
                pa.array([index.items[it][1] for _, it in rows], pa.int64()),
                *[pa.array([min(1.0, round(best[k][x], 6)) for k in rows], pa.float64()) for x in range(3)],
            ],
            names=["doc_id", "tkey", "item_id", "score", "question", "answer"],
        )


LEAK = "doc_id long, tkey long, item_id long, score double, question double, answer double"


def indexes(benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> list[Index]:
    """Indexes that hold all items, each of about `most_bytes` of text; impacts and passages use counts over all items.

    An item is a distinct (item_id, text); what an index calls an item is the pair of its number and its item_id.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    items = written(hashed_numbers(items, ["item_id", "text"], "item"), "items")
    terms = written(items.select("item", "text").mapInArrow(_item_terms, "item long, words long, term long"), "terms")
    counts = terms.groupBy("item", "term").agg(F.count("*").alias("tf"), F.first("words").alias("words"))
    frequency = counts.groupBy("term").agg(F.count("*").alias("df"))
    sizes = counts.groupBy("item").agg(F.first("words").alias("words"))
    whole = sizes.agg(F.count("*").alias("n"), F.avg("words").alias("mean"), F.coalesce(F.max("words"), F.lit(0)).alias("longest")).first()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-size // most_bytes)
    idf = F.log1p((F.lit(whole["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("words") / F.lit(whole["mean"] or 1.0)))
    weighted = written(counts.join(frequency, "term").select("item", "term", weight.alias("weight")), "weights")
    found = []
    for part in range(parts):
        mine = F.pmod(F.xxhash64("item"), F.lit(parts)) == part
        own = [tuple(r) for r in items.where(mine).orderBy("item").select("item", "item_id", "text").collect()]
        ids = {number: item_id for number, item_id, _ in own}
        index = build_index([(number, text) for number, _, text in own], {(r[0], r[1]): r[2] for r in weighted.where(mine).collect()}, whole["longest"])
        if index.items:
            index.items = [(number, ids[number]) for number in index.items]
            found.append(index)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(doc_id, tkey, item_id, score, question, answer): the benchmark items found in each document.

    tkey is xxhash64 of the text, so rows of one doc_id are told apart. Every passage of every document
    (two longest items long, starting every longest item) is a query to the index. All items that reach
    0.55 of the score they have with themselves are retrieved, and stay if 0.75 of their five-word
    shingles, half of their question's and half of their answer's are in the passage. An item below five
    words must be there whole; one without words is never found. Null texts are empty and never hold an
    item; null ids of documents are kept; null items are left out; of items of one id the largest
    text counts. Extra columns are not read.

    Items are the stated query set: an index holds at most `most_bytes` of them and is sent to the tasks; more
    items make more indexes, each over all documents. Documents are not shuffled.
    """
    source = texts(docs).withColumn("tkey", F.xxhash64("text")).select("doc_id", "tkey", "text")
    out = None
    for index in indexes(benchmark, most_bytes):
        part = _over(source, index)
        out = part if out is None else out.union(part)
    return source.sparkSession.createDataFrame([], LEAK) if out is None else out


def _over(source: DataFrame, index: Index) -> DataFrame:
    sent = source.sparkSession.sparkContext.broadcast(index)
    return source.mapInArrow(lambda batches: _leaks(batches, sent.value), LEAK)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item was found, with their own columns, whatever their names; see `leaks`.

    Rows are told apart by doc_id and text; a null doc_id is a value like others, equal rows go or stay together.
    """
    found = written(leaks(docs, benchmark).select("doc_id", "tkey").distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("row.doc_id").cast("long")) & (F.col("tkey") == F.xxhash64(F.coalesce("row.text", F.lit(""))))
    return rows.join(found, same, "left_anti").select("row.*")


@query("op1_benchmark_leaks")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("score").alias("bm25_share"), F.col("question").alias("question_overlap"), F.col("answer").alias("answer_overlap"))
