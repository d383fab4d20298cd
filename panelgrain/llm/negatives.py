"""Hard negatives by exact inner products, several candidates to one multiplication (Kronecker packing)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm.shared import query, table, written

SCALE, ANCHORS = 256, 100
POSITIVES, NEGATIVES = 5, 10
# A negative's score is between these hundredths of the positive's.
LEAST, MOST = 30, 90
# Rows of a candidate block and of an anchor block; wide vectors make smaller blocks, of about this many bytes.
BLOCK_ROWS, ANCHOR_ROWS, BLOCK_BYTES = 4096, 512, 4 << 20
# Sums below this go through 64-bit words, larger ones through Python's integers, by the same packing.
WORD_BOUND = 1 << 50
LARGEST = 1 << 62

ROWS = "rows array<long>, ids array<long>, labels array<long>, goals array<long>, item int, vectors binary"
ROW = "row long, id long, label long, item int, vector binary"
FOUND = "row long, anchor_id long, place int, other_id long, score long"


def _quantised(column: pa.ListArray) -> np.ndarray:
    """floor(SCALE * x) of each vector, as whole numbers; shorter vectors end in zeros."""
    sizes = column.value_lengths().to_numpy()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
    with np.errstate(over="ignore"):
        whole = np.floor(flat * SCALE)
    kept = np.arange(out.shape[1]) < sizes[:, None]
    out[kept] = np.where(np.abs(whole) < LARGEST, whole, np.sign(whole) * LARGEST).astype(np.int64)
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest of 16, 32 and 64 bits."""
    most = int(np.abs(matrix).max(initial=0))
    return matrix.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def _matrix(data: bytes, item: int, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<i{item}").reshape(n, -1).astype(np.int64)


def _packed(rows, ids: pa.Array, labels, matrix: np.ndarray, goals=()) -> list[pa.Array]:
    """One row of the ROWS schema."""
    small = _narrow(matrix)
    one = lambda values: pa.array([values], pa.list_(pa.int64()))
    return [one(rows), one(ids.to_pylist()), one(labels), one(goals), pa.array([small.itemsize], pa.int32()), pa.array([small.tobytes()], pa.binary())]


NAMES = ["rows", "ids", "labels", "goals", "item", "vectors"]


def _blocks(batches):
    """Blocks of rows in the order they come; the number of a row, and of a block, is its task's and its place there."""
    number = block = TaskContext.get().partitionId() << 40
    for batch in batches:
        vectors = batch.column(2)
        width = max(1, int(vectors.value_lengths().to_numpy().max(initial=0)))
        step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            rows = np.arange(number, number + part.num_rows)
            number += part.num_rows
            arrays = _packed(rows, part.column(0), part.column(1).to_pylist(), _quantised(part.column(2)))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *arrays], names=["block", *NAMES])
            block += 1


class Block:
    """Row numbers, ids, labels, goals and vectors of row i of a batch, from column `first` on."""

    def __init__(self, batch: pa.RecordBatch, first: int, i: int):
        rows, ids, labels, goals, item, vectors = (batch.column(first + k)[i] for k in range(6))
        self.rows, self.labels = (x.values.to_numpy(zero_copy_only=False) for x in (rows, labels))
        self.ids, self.goals = ids.values, goals.values
        self.matrix = _matrix(vectors.as_py(), item.as_py(), len(self.rows))


def _anchor_rows(batches, every: int):
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block(batch, 1, i)
            named = block.ids.is_valid().to_numpy(zero_copy_only=False)
            place = np.flatnonzero(named & (block.ids.fill_null(0).to_numpy() % every == 0))
            if len(place):
                small = _narrow(block.matrix[place])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.rows[place]), block.ids.take(pa.array(place)), pa.array(block.labels[place]), pa.array([small.itemsize] * len(place), pa.int32()), pa.array([v.tobytes() for v in small], pa.binary())],
                    names=["row", "id", "label", "item", "vector"],
                )


def _anchor_block(anchors: pa.Table, goals: int, part: int) -> pa.Table:
    """Anchors of one group as one block, with its part; the goals of each are the scores of its positives."""
    vectors = [_matrix(v, i, 1)[0] for v, i in zip(anchors["vector"].to_pylist(), anchors["item"].to_pylist(), strict=True)]
    matrix = np.zeros((len(vectors), max(map(len, vectors), default=0)), dtype=np.int64)
    for own, v in zip(matrix, vectors, strict=True):
        own[: len(v)] = v
    wanted = []
    if goals:
        wanted = [x for own in anchors["goals"].to_pylist() for x in [*own, *[None] * (goals - len(own))]]
    arrays = _packed(anchors["row"].to_pylist(), anchors["id"].combine_chunks(), anchors["label"].to_pylist(), matrix, wanted)
    return pa.Table.from_arrays([*arrays, pa.array([part], pa.int32())], names=[*NAMES, "part"])


def exact_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products of whole-number vectors, exact: one row an anchor, one column a row of `rows`.

    The components of `rows` are biased to start at 0, and those of several rows become separated fields
    of one wide integer; the fields are as wide as their largest sum needs, so none runs over into the next. Each
    anchor component multiplies the wide integer once for all rows in it.
    """
    width = max(anchors.shape[1], rows.shape[1])
    a, r = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, rows))
    n = len(r)
    if not len(a) or not n:
        return np.zeros((len(a), n), dtype=np.int64)
    reach = width * (2 * int(np.abs(a).max(initial=0)) + 1) * (2 * int(np.abs(r).max(initial=0)) + 1)
    kind = np.uint64 if reach < WORD_BOUND else object
    if kind is object:
        a, r = a.astype(object), r.astype(object)
    low, bias = r.min(axis=0), -a.min(axis=1, initial=0)
    u, v = (r - low).astype(kind), (a + bias[:, None]).astype(kind)
    field = max(1, int((v @ u.max(axis=0)).max()).bit_length())
    fields = max(1, 64 // field) if kind is np.uint64 else 4
    groups = -(-n // fields)
    packed = np.zeros((groups, width), dtype=kind)
    shifts = [kind(field * f) if kind is np.uint64 else field * f for f in range(fields)]
    for f, shift in enumerate(shifts):
        own = u[f * groups : (f + 1) * groups]
        packed[: len(own)] += own << shift
    total = v @ packed.T
    mask = kind((1 << field) - 1) if kind is np.uint64 else (1 << field) - 1
    sums = np.concatenate([(total >> shift) & mask for shift in shifts], axis=1)[:, :n]
    whole = np.int64 if kind is np.uint64 else object
    return sums.astype(whole) + (a @ low)[:, None] - bias[:, None] * u.sum(axis=1).astype(whole)


def _never(scores: np.ndarray) -> int:
    """Less than any key of such scores."""
    return -(1 << 63) if scores.dtype != object else -(1 << 200)


def first_places(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, column) of the k largest allowed scores of each line, equal ones by column; best first."""
    n, never = scores.shape[1], _never(scores)
    key = np.where(allowed, scores * n + (n - 1 - np.arange(n)), never)
    best = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), key.shape)
    own = np.take_along_axis(key, best, axis=1)
    order = np.argsort(own, axis=1)[:, ::-1]
    best, own = np.take_along_axis(best, order, axis=1), np.take_along_axis(own, order, axis=1)
    line, place = np.nonzero(own != never)
    return line, best[line, place]


def _clipped(scores: np.ndarray) -> pa.Array:
    return pa.array(scores if scores.dtype != object else [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores], pa.int64())


def _out(anchors: Block, line, place, rows: Block, column, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors.rows[line]), anchors.ids.take(pa.array(line)), pa.array(place, pa.int32()), rows.ids.take(pa.array(column)), _clipped(scores)],
        names=["row", "anchor_id", "place", "other_id", "score"],
    )


def _ordered(rows: Block) -> np.ndarray:
    """Places of a block's rows by id, those without an id last."""
    return pa.compute.sort_indices(rows.ids, null_placement="at_end").to_numpy()


def _meetings(batches):
    """Pairs of an anchor block and a candidate block of one lane, the candidates by id."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch, 0, i), Block(batch, 6, i)


def _positives(batches, k: int):
    """The first k other rows of an anchor's label in each block; only rows of that label are multiplied."""
    for anchors, rows in _meetings(batches):
        order = _ordered(rows)
        for label in np.intersect1d(anchors.labels, rows.labels):
            line, column = np.flatnonzero(anchors.labels == label), order[rows.labels[order] == label]
            scores = exact_scores(anchors.matrix[line], rows.matrix[column])
            i, j = first_places(scores, anchors.rows[line][:, None] != rows.rows[column], k)
            yield _out(anchors, line[i], np.zeros(len(i)), rows, column[j], scores[i, j])


def _ranges(goals: pa.Array, places: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and most score of a negative, one line an anchor, one column a positive; where there is none, nothing fits."""
    wanted = goals.to_pylist()
    low = np.array([1 if x is None else -(-least * x // 100) for x in wanted], dtype=object)
    high = np.array([0 if x is None else most * x // 100 for x in wanted], dtype=object)
    return low.reshape(-1, places), high.reshape(-1, places)


def _negatives(batches, k: int, goals: int, least: int, most: int):
    """For each positive of an anchor, the first k rows of other labels in a block with a score in its range.

    A block's scores are sorted once for all positives. Blocks of a lane follow each other with the same anchors; rows
    below the k-th best score that the blocks before have given are not among the first k and are not given.
    """
    before, unknown = None, np.iinfo(np.int64).min
    for anchors, rows in _meetings(batches):
        if before is None or not np.array_equal(before, anchors.rows):
            before, (low, high) = anchors.rows, _ranges(anchors.goals, goals, least, most)
            best = np.full((*low.shape, k), unknown)
        order = _ordered(rows)
        scores = exact_scores(anchors.matrix, rows.matrix[order])
        n, never = scores.shape[1], _never(scores)
        key = np.where(anchors.labels[:, None] != rows.labels[order], scores * n + (n - 1 - np.arange(n)), never)
        key.sort(axis=1)
        floor = np.where(best[:, :, 0] > unknown, np.maximum(low, best[:, :, 0].astype(object)), low)
        first, last = ((x if scores.dtype == object else np.clip(x, -WORD_BOUND, WORD_BOUND).astype(np.int64)) * n for x in (floor, high))
        start = np.array([np.searchsorted(own, x) for own, x in zip(key, first, strict=True)])
        end = np.array([np.searchsorted(own, x, side="right") for own, x in zip(key, last + n - 1, strict=True)])
        place = end[:, :, None] - 1 - np.arange(k)
        line, goal, rank = np.nonzero(place >= start[:, :, None])
        own = key[line, place[line, goal, rank]]
        out = _out(anchors, line, goal + 1, rows, order[(n - 1 - own % n).astype(np.int64)], own // n)
        given = np.full(best.shape, unknown)
        given[line, goal, rank] = out["score"].to_numpy()
        best = np.sort(np.concatenate([best, given], axis=2), axis=2)[:, :, k:]
        yield out


def _lanes(tasks: int, rows: int, blocks: int, anchors: int, groups: int, found: int) -> tuple[int, int]:
    """In how many parts the rows and the anchors are dealt, so that about `tasks` tasks meet a part of each.

    An anchor is sent to every part of the rows, and there up to `found` rows are found for it, eight of which take about
    as much as a vector; a row is sent to every part of the anchors. The parts make both take the same.
    """
    across = max(1, min(blocks, tasks, round((tasks * rows / max(1, anchors) / (1 + found / 8)) ** 0.5)))
    down = max(1, min(groups, round(tasks / across)))
    return max(1, min(blocks, round(tasks / down))), down


def _met(anchors: DataFrame, blocks: DataFrame, goals: int, k: int, work) -> DataFrame:
    """`work`, which finds k rows an anchor (k a goal), over every pair of an anchor block and a candidate block.

    A lane, one task, has a part of the candidate blocks, those of one writing task in turn, and a part of the
    anchors, which are grouped to blocks of about ANCHOR_ROWS. Spark would tell the sizes by the files, which do not
    show how often an anchor is sent, so the join is told to merge: it could broadcast all copies by way of the driver.
    """
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, rows = blocks.agg(F.count("*"), F.coalesce(F.sum(F.size("rows")), F.lit(0))).first()
    of = anchors.count()
    groups = max(1, -(-of // ANCHOR_ROWS))
    across, down = _lanes(tasks, rows, n, of, groups, k * max(1, goals))
    shared = anchors.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("of")).applyInArrow(lambda key, t: _anchor_block(t, goals, key[0].as_py() % down), f"{ROWS}, part int")
    sent = shared.select(F.explode(F.sequence("part", F.col("part") + (across - 1) * down, F.lit(down))).alias("lane"), F.struct(*NAMES).alias("a"))
    turn = F.pmod(F.xxhash64(F.shiftright("block", 40)), F.lit(across)) + F.pmod(F.col("block"), F.lit(across))
    first = F.pmod(turn, F.lit(across)).cast("int") * down
    dealt = blocks.select(F.explode(F.sequence(first, first + (down - 1))).alias("lane"), F.struct(*NAMES).alias("c"))
    met = sent.repartitionById(across * down, F.col("lane")).join(dealt.repartitionById(across * down, F.col("lane")).hint("merge"), "lane")
    return met.select("a.*", *[F.col(f"c.{n}").alias(f"c_{n}") for n in NAMES]).mapInArrow(work, FOUND)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k over all blocks; Spark keeps k a key in every task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, every: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    `vectors` has vec_id, label and embedding (any array of numbers). Components become floor(256 * x); a
    score is the exact whole inner product. Anchors are the rows whose vec_id is divisible by `every`; an anchor's
    positives are its first `positives` other rows of the same label, and for each of them the first `negatives`
    rows of other labels come whose score is between `least` and `most` hundredths of the positive's. Higher
    scores come first, equal ones by vec_id.

    Rows without a label or a vector, or with a null or non-finite component, take no part. A row without a
    vec_id is no anchor but may be found; among equal scores it comes last. Rows that repeat a vec_id
    are rows of their own: as anchors each gives its rows, and each may be the other's positive. Vectors of
    unlike lengths are met as if the shorter ended in zeros; an empty vector scores 0. Components beyond 2^62 after
    scaling count as 2^62, scores beyond 64 bits as the nearest long. Extra columns are not read.

    Every anchor meets every row, block by block, the anchors in groups of 512: a lane, one task, meets a part of either,
    about as many lanes as there are shuffle partitions. Nothing is broadcast, so the driver holds no rows.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    sound = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    rows = sound.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "embedding")
    blocks = written(rows.mapInArrow(_blocks, f"block long, {ROWS}"), "blocks")
    anchors = written(blocks.mapInArrow(lambda b: _anchor_rows(b, every), ROW), "anchors")
    near = _met(anchors, blocks, 0, positives, lambda b: _positives(b, positives))
    near = written(_ranked(near, ["row"], positives), "positives")
    goals = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("g")).select("row", F.col("g.score").alias("goals"))
    far = _met(written(anchors.join(goals.hint("merge"), "row"), "goals"), blocks, positives, negatives, lambda b: _negatives(b, negatives, positives, least, most))
    far = _ranked(far, ["row", "place"], negatives).select("row", "place", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = near.select("row", "anchor_id", F.col("rank").alias("place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(known.hint("merge"), ["row", "place"]).select("anchor_id", "positive_id", F.col("place").alias("positive_rank"), "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    found = hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
