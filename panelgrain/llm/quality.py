"""Quality scores from a sparse ensemble of rules over text statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, texts

# The classifier learns from at most about this many labelled rows, taken by a hash of doc_id.
SAMPLE = 20000
TREES, DEPTH, CUTS, LEAST_LEAF = 16, 3, 24, 20
PENALTY, STEPS = 0.002, 400
PREFIX = "stat_"
STATS = [
    "log_bytes", "log_words", "word_length", "upper", "digit", "stop", "symbol", "beyond_ascii",
    "distinct", "echo", "lines", "line_words", "line_repeat", "longest_word",
]

_UPPER, _DIGIT, _STOP, _SYMBOL = 1, 2, 3, 4
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[65:91] = _UPPER
_KIND[48:58] = _DIGIT
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _KIND[_c] = _STOP if chr(_c) in ".,;:'\"-()" else _SYMBOL
# A lead byte and the next one tell capitals among the two-byte letters; À to Þ are enough here.
_LATIN_LEAD, _LATIN_UPPER = 0xC3, np.zeros(256, dtype=bool)
_LATIN_UPPER[0x80:0x9F] = True

_NOT_BREAK = np.ones(256, dtype=bool)
_NOT_BREAK[[10, 13]] = False


def _per_row(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(places, at)).astype(np.float64)


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of STATS for each text; all of them finite, zeros for an empty text."""
    n = len(at) - 1
    size = np.diff(at).astype(np.float64)
    some = np.maximum(size, 1)
    out = np.zeros((n, len(STATS)))
    kind = _KIND[data]
    starts, ends, first = K.words(data, at, K.NOT_SPACE)
    count = np.diff(first).astype(np.float64)
    words = np.maximum(count, 1)
    length = ends - starts
    row = np.repeat(np.arange(n), np.diff(first))
    name = K.span_hash(K.prefix_hash(K.LOWER_VALUES[data]), starts, ends)
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(count)
    out[:, 2] = np.bincount(row, length, n) / words
    latin = np.flatnonzero((data[:-1] == _LATIN_LEAD) & _LATIN_UPPER[data[1:]]) if len(data) else np.zeros(0, dtype=np.int64)
    out[:, 3] = (_per_row(np.flatnonzero(kind == _UPPER), at) + _per_row(latin, at)) / some
    for k, what in ((4, _DIGIT), (5, _STOP), (6, _SYMBOL)):
        out[:, k] = _per_row(np.flatnonzero(kind == what), at) / some
    out[:, 7] = _per_row(np.flatnonzero(data >= 0xC2), at) / some
    order = np.lexsort((name, row))
    fresh = np.ones(len(name), dtype=bool)
    fresh[1:] = (name[order][1:] != name[order][:-1]) | (row[1:] != row[:-1])
    out[:, 8] = np.bincount(row, fresh, n) / words
    echo = np.zeros(len(name), dtype=bool)
    echo[1:] = (name[1:] == name[:-1]) & (row[1:] == row[:-1])
    out[:, 9] = np.bincount(row, echo, n) / words
    lines, line_ends, line_first = K.words(data, at, _NOT_BREAK)
    per = np.diff(line_first).astype(np.float64)
    out[:, 10] = np.log1p(per)
    out[:, 11] = np.log1p(count / np.maximum(per, 1))
    line_row = np.repeat(np.arange(n), np.diff(line_first))
    line_name = K.span_hash(K.prefix_hash(K.BYTE_VALUES[data]), lines, line_ends)
    order = np.lexsort((line_name, line_row))
    again = np.zeros(len(lines), dtype=bool)
    again[1:] = (line_name[order][1:] == line_name[order][:-1]) & (line_row[1:] == line_row[:-1])
    out[:, 12] = np.bincount(line_row, again, n) / np.maximum(per, 1)
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    out[:, 13] = np.log1p(longest)
    return out


def with_statistics(frame: DataFrame, text: str = "text") -> DataFrame:
    """All columns and one double column for each statistic (STATS, prefixed); null text counts as empty.

    Columns that already have the name of a statistic are replaced.
    """
    names = [PREFIX + s for s in STATS]
    frame = frame.drop(*names)
    place = frame.columns.index(text)
    schema = T.StructType([*frame.schema.fields, *[T.StructField(s, T.DoubleType()) for s in names]])
    columns = frame.columns

    def run(batches):
        for batch in batches:
            data, at = K.text_bytes(batch.column(place))
            for i, j in K.slices(at):
                values = statistics(data[at[i] : at[j]], at[i : j + 1] - at[i])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(np.ascontiguousarray(v)) for v in values.T]], names=[*columns, *names])

    return frame.mapInArrow(run, schema)


@dataclass(frozen=True)
class Term:
    """One comparison of a rule: statistic <= cut, or > cut."""

    stat: int
    cut: float
    above: bool

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values[:, self.stat] > self.cut if self.above else values[:, self.stat] <= self.cut

    def column(self) -> Column:
        stat = F.col(PREFIX + STATS[self.stat])
        return stat > F.lit(self.cut) if self.above else stat <= F.lit(self.cut)


@dataclass(frozen=True)
class RuleModel:
    """score = logistic(bias + sum of the weights of the rules that hold)."""

    bias: float
    rules: tuple[tuple[float, tuple[Term, ...]], ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for weight, terms in self.rules:
            held = terms[0].column()
            for term in terms[1:]:
                held = held & term.column()
            total = total + F.when(held, F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def _tree_paths(values: np.ndarray, target: np.ndarray, draw: np.random.Generator) -> list[tuple[Term, ...]]:
    """The paths from the root of one greedy tree to each of its nodes, as conjunctions."""
    found = []

    def grow(rows: np.ndarray, path: tuple[Term, ...]):
        if path:
            found.append(path)
        y = target[rows]
        if len(path) == DEPTH or len(rows) < 2 * LEAST_LEAF or y.min() == y.max():
            return
        best = None
        for stat in draw.choice(len(STATS), max(4, len(STATS) // 2), replace=False):
            v = values[rows, stat]
            for cut in np.unique(np.quantile(v, np.linspace(0.02, 0.98, CUTS))):
                low = v <= cut
                a = int(low.sum())
                if min(a, len(rows) - a) < LEAST_LEAF:
                    continue
                p, q = y[low].mean(), y[~low].mean()
                impurity = a * p * (1 - p) + (len(rows) - a) * q * (1 - q)
                if best is None or impurity < best[0] - 1e-12:
                    best = impurity, int(stat), float(cut), low
        if best is None or best[0] >= len(rows) * y.mean() * (1 - y.mean()) - 1e-9:
            return
        _, stat, cut, low = best
        grow(rows[low], (*path, Term(stat, cut, False)))
        grow(rows[~low], (*path, Term(stat, cut, True)))

    grow(draw.integers(0, len(target), len(target)), ())
    return found


def _lasso(held: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty, by accelerated proximal steps; the bias is free."""
    n, k = held.shape
    x = held.astype(np.float64)
    step = 4.0 / max(1e-9, np.linalg.norm(np.hstack([x, np.ones((n, 1))]), 2) ** 2 / n)
    w, b, vw, vb, t = np.zeros(k), float(np.log((target.sum() + 1) / (n - target.sum() + 1))), np.zeros(k), 0.0, 1.0
    vb = b
    for _ in range(STEPS):
        miss = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -40, 40))) - target
        nw = vw - step * (x.T @ miss) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * PENALTY, 0)
        nb = vb - step * miss.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb, w, b, t = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b), nw, nb, t2
    return b, w


def fit(values: np.ndarray, target: np.ndarray, seed: int = 5) -> RuleModel:
    """Rules from trees, weights by lasso. Fewer than two labels: the prior alone."""
    if len(target) == 0 or target.min() == target.max():
        good = float(target.sum()) if len(target) else 0.0
        return RuleModel(float(np.log((good + 1) / (len(target) - good + 1))), ())
    draw = np.random.default_rng(seed)
    paths = {}
    for _ in range(TREES):
        for path in _tree_paths(values, target, draw):
            held = np.logical_and.reduce([t.holds(values) for t in path])
            paths.setdefault(held.tobytes(), (path, held))
    if not paths:
        return RuleModel(float(np.log((target.sum() + 1) / (len(target) - target.sum() + 1))), ())
    rules = [p for p, _ in paths.values()]
    bias, weights = _lasso(np.column_stack([h for _, h in paths.values()]), target.astype(np.float64))
    kept = [(float(w), p) for w, p in zip(weights, rules, strict=True) if abs(w) > 1e-6]
    return RuleModel(float(bias), tuple(kept))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(3)) == 1


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """A model from the labelled rows that are not held out; nothing but the text is looked at.

    A doc_id with contradicting labels is left out. At most about `sample` rows are used, those with the
    smallest hashes of doc_id, so the join broadcasts a table of known size and the driver gets
    `sample` rows of numbers.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("target")).where("least = target")
    marks = marks.select(F.col("doc_id").alias("_id"), "target").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    chosen = texts(docs).join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "target")
    names = [PREFIX + s for s in STATS]
    rows = with_statistics(chosen).select("doc_id", "target", *names).limit(2 * sample).toPandas().sort_values(["doc_id", *names])
    return fit(rows[names].to_numpy(dtype=np.float64), (rows["target"].to_numpy() == 1).astype(np.int64))


def scored(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """All columns, the statistics, score (0 to 1, higher: better) and predicted (1 if score >= 0.5)."""
    frame = with_statistics(docs.drop("score", "predicted"), text)
    return frame.withColumn("score", model.score()).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their own columns, whatever their names.

    Null and empty texts are scored like others; rows of one doc_id each by their own text. Without
    usable labels every document gets the same score of 0.5 and stays. Statistics are counted in Arrow
    tasks, the rules are Spark column expressions; nothing is shuffled.
    """
    columns = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    good = scored(numbered, learn(docs, labels), f"c{columns.index('text')}").where("predicted = 1")
    return good.select(*numbered.columns).toDF(*columns)


@query("op5_rule_ensemble")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    frame = scored(texts(docs), learn(docs, table(spark, sf_dir, "labels")))
    return frame.select("doc_id", held_out().alias("held_out"), "score", "predicted")
