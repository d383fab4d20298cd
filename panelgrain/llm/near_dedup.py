"""Near duplicates by SuperMinHash signatures, banding, exact verification and union-find."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain.functions.numbering import hashed_numbers
from panelgrain.llm import kernels as K
from panelgrain.llm.components import components
from panelgrain.llm.shared import query, table, texts, written

BANDS, ROWS, SHINGLE = 28, 3, 5
SLOTS = BANDS * ROWS
U64 = K.U64


def superminhash(values: np.ndarray, offsets: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """A row of `slots` ranks for each set of distinct hashes values[offsets[i]:offsets[i + 1]].

    Every element walks through its own random permutation of the slots; in step j it offers the rank
    j + u (u in [0, 1), 32 bits) to the j-th slot of its permutation, and each slot keeps the least
    offer. The ranks of one element are correlated, as no two of its offers share a slot or a whole
    part, which is what lowers the variance. A set is done as soon as all its ranks are below j + 1,
    as later steps cannot lower them. Empty sets keep the largest rank everywhere.
    """
    n = len(offsets) - 1
    ranks = np.full(n * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    seed = K.mixed(values ^ U64(0x5851F42D4C957F2D))
    order = None
    live = np.arange(len(values))
    open_sets = np.flatnonzero(sizes)
    for j in range(slots):
        draw = K.mixed(seed[live] + U64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        other = j + (((draw & U64(0xFFFFFFFF)) * U64(slots - j)) >> U64(32)).astype(np.int64)
        if order is None:
            slot = other
        else:
            row = np.arange(len(live))
            slot = order[row, other].astype(np.int64)
            order[row, other] = order[row, j]
        np.minimum.at(ranks, owner[live] * slots + slot, (U64(j) << U64(32)) | (draw >> U64(32)))
        open_next = open_sets[ranks.reshape(n, slots)[open_sets].max(axis=1) >= U64(j + 1 << 32)]
        if len(open_next) == 0:
            break
        still = np.zeros(n, dtype=bool)
        still[open_next] = True
        stay = still[owner[live]]
        if order is None:  # only sets that go on need their permutations
            order = np.tile(np.arange(slots, dtype=np.uint8), (int(stay.sum()), 1))
            order[np.arange(len(order)), other[stay]] = 0
        else:
            order = order[stay]
        live, open_sets = live[stay], open_next
    return ranks.reshape(n, slots)


def band_keys(ranks: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(ranks), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(ranks), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = K.mixed(key * K.BASE + ranks[:, b * rows + r])
        keys[:, b] = key
    return keys


def _signatures(batches):
    for batch in batches:
        data, at = K.text_bytes(batch.column(1))
        for i, j in K.slices(at):
            values, offsets = K.shingles(data[at[i] : at[j]], at[i : j + 1] - at[i], SHINGLE)
            sizes = np.diff(offsets)
            keys = band_keys(superminhash(values, offsets))
            sums = np.concatenate(([U64(0)], np.cumsum(K.mixed(values + U64(1)), dtype=np.uint64)))
            more = np.concatenate(([U64(0)], np.cumsum(K.mixed(values + U64(2)) >> U64(1), dtype=np.uint64)))
            full = sizes > 0
            starts = np.concatenate(([0], np.cumsum(np.where(full, BANDS, 0))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    pa.array(sizes.astype(np.int64)),
                    pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)),
                    pa.array((more[offsets[1:]] - more[offsets[:-1]]).view(np.int64)),
                    K.lists(keys[full].reshape(-1), starts),
                ],
                names=["doc_id", "n", "k1", "k2", "bands"],
            )


def _sets(batches):
    for batch in batches:
        data, at = K.text_bytes(batch.column(1))
        for i, j in K.slices(at):
            values, offsets = K.shingles(data[at[i] : at[j]], at[i : j + 1] - at[i], SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(np.diff(offsets).astype(np.int64)), K.lists(values, offsets)], names=["doc_id", "n", "items"]
            )


def _reaches() -> Column:
    """The largest set that a set of n can be 75 % like, if u of its shingles are in no other set.

    At most c = n - u are shared, and 7 shared >= 3 (n + m) is what the threshold asks for.
    """
    return F.floor((F.lit(7) * (F.col("n") - F.col("u"))) / 3).cast("long") - F.col("n")


ALIKE = "100 * shared >= 75 * (na + nb - shared)"


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their full shingle sets and how many shingles they share."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("items").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("items").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("shared"))


def _identified(source: DataFrame) -> tuple[DataFrame, int]:
    """Source with an id in every row, and the largest id it came with.

    Rows without one get a number above all ids, equal for equal texts. Only those rows are joined.
    """
    last = source.agg(F.coalesce(F.max("doc_id"), F.lit(0).cast("long"))).first()[0]
    nameless = source.where("doc_id IS NULL").select(F.xxhash64("text").alias("key"), "text")
    numbers = written(hashed_numbers(nameless.select("key").distinct(), ["key"], "number"), "numbers")
    named = nameless.join(numbers, "key").select((F.col("number") + F.lit(last)).alias("doc_id"), "text")
    return source.where("doc_id IS NOT NULL").unionByName(named), last


def near_duplicates(docs: DataFrame, identified: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents.

    Two documents are linked if their sets of distinct five-word shingles have a Jaccard likeness of
    0.75 or more; a component is named by its smallest doc_id, which is kept. Null text counts as
    empty; a document without words has no set, no links and is kept. Rows that share a doc_id are one
    document. Rows with null doc_id are documents of their own, told apart by their texts, and link others like any
    document: they join the component of what they are near to. Where no document of a component has an id
    component_id is null, and the rows of one of its texts are kept. `identified` says that no doc_id is null, which
    saves looking for them. Extra columns are not read. An empty table gives no rows.

    Steps: equal sets become one class, so copies never meet each other. Classes are banded
    (28 bands of 3 slots: a pair at exactly 0.75 misses all of them once in 5 million times).
    Shingles that no other class in any shared band has bound how like a class can be to another; this
    exact bound removes most chance collisions. In each band the member that collides most is the hub
    and is compared with the others, on full sets. What the hubs have not connected is compared with the
    other members under its hub, unless a second exact bound rules the pair out: two sets share at most
    what both share with the hub and what both have beside the hub and not alone. No list of a band's
    members is ever made.
    """
    source, last = (texts(docs), None) if identified else _identified(texts(docs))
    meta = written(source.mapInArrow(_signatures, "doc_id long, n long, k1 long, k2 long, bands array<long>"), "signatures")
    classes = meta.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    labelled = written(meta.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select("doc_id", "n", "rep"), "classes")

    firsts = meta.where("n > 0 AND doc_id IS NOT NULL").join(classes.where("rep IS NOT NULL"), ["k1", "k2"]).where("doc_id = rep")
    members = firsts.select("doc_id", "n", F.explode("bands").alias("band")).distinct()
    shared_bands = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = written(members.join(shared_bands, "band"), "members")

    wanted = members.select("doc_id").distinct()
    sets = source.join(wanted, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, n long, items array<long>")
    sets = written(sets.where("n > 0"), "sets")
    alone = sets.select("doc_id", F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("c"), F.min("doc_id").alias("doc_id")).where("c = 1")
    own = alone.groupBy("doc_id").agg(F.count("*").alias("u"))
    bounds = members.join(own, "doc_id", "left").withColumn("u", F.coalesce("u", F.lit(0))).withColumn("reach", _reaches())
    spans = bounds.groupBy("band").agg(F.min("n").alias("least"), F.max("reach").alias("most"))
    able = bounds.join(spans, "band").where("reach >= least AND n <= most").select("band", "doc_id", "n", "u", "reach", "size")
    crowd = able.groupBy("doc_id").agg(F.sum("size").alias("degree"))
    able = written(able.join(crowd, "doc_id"), "able")

    hubs = able.groupBy("band").agg(
        F.max_by(F.struct(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"), F.col("reach").alias("hub_reach")), F.struct("degree", -F.col("doc_id"))).alias("h")
    ).select("band", "h.*")
    ranked = able.join(hubs, "band").where("doc_id <> hub")
    pairs = ranked.where("n <= hub_reach AND hub_n <= reach").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    compared = written(_compared(pairs, sets), "compared")
    links = compared.where(ALIKE).select("a", "b")
    labels = written(components(links, "a", "b"), "labels")

    named = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    # What share a band share its hub, so the rest is paired by hub and each pair comes up once a hub.
    placed = ranked.select("hub", "doc_id", "n", "u", "reach").distinct()
    placed = placed.join(named, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    placed = placed.join(named.select(F.col("doc_id").alias("hub"), F.col("label").alias("hub_label")), "hub", "left")
    placed = placed.join(compared.select(F.col("a").alias("doc_id"), F.col("b").alias("hub"), F.col("shared").alias("of_hub")), ["doc_id", "hub"], "left")
    # Shared with the hub, and at most shared otherwise; unknown: all.
    placed = placed.withColumn("x", F.coalesce("of_hub", "n")).withColumn("y", F.col("n") - F.col("u") - F.coalesce("of_hub", F.lit(0)))
    placed = written(placed.withColumn("out", F.col("label") != F.coalesce("hub_label", "hub")), "placed")
    side = lambda d: [F.col("doc_id").alias(d), *[F.col(c).alias(c + d) for c in ("n", "reach", "label", "x", "y", "out")]]
    rest = placed.where("out").select("hub", *side("a")).join(placed.select("hub", *side("b")), "hub")
    rest = rest.where("labela <> labelb AND na <= reachb AND nb <= reacha AND (NOT outb OR a < b)")
    rest = rest.where("7 * (least(xa, xb) + least(ya, yb)) >= 3 * (na + nb)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    late = written(_compared(rest.distinct(), sets).where(ALIKE).select("a", "b"), "links")
    final = components(links.union(late), "a", "b")

    joined = labelled.join(final, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    own = lambda node: node if last is None else F.when(node <= last, node)
    return joined.select(
        own(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"), own(component).alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


NEAR_SQL = """
WITH RECURSIVE tokens AS (
  SELECT doc_id, LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(
    TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda v: v <> '') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, UNNEST(CASE WHEN LEN(w) = 0 THEN [] WHEN LEN(w) < 5 THEN [ARRAY_TO_STRING(w, ' ')]
    ELSE LIST_TRANSFORM(RANGE(1, LEN(w) - 3), lambda i: ARRAY_TO_STRING(w[i:i + 4], ' ')) END) AS s
  FROM tokens
), sizes AS (
  SELECT d.doc_id, COUNT(s.s) AS n FROM documents d LEFT JOIN shingle s ON d.doc_id = s.doc_id GROUP BY d.doc_id
), alike AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b WHERE 100 * p.c >= 75 * (m.n + n.n - p.c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, k.b FROM reach r JOIN alike k ON r.b = k.a
), named AS (
  SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sizes s JOIN named c ON s.doc_id = c.doc_id
"""


@query("op8_near_duplicates", NEAR_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
