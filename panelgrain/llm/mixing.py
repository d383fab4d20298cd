"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrain.llm.shared import query, table, written

SEED = "mix-1"
TEMPER = 0.5
# The largest rate of one draw; a larger one is the sum of several draws of equal rate. Copies of a row that are made at a time.
MOST_RATE, COPIES = 500.0, 4096


def uniform(seed: str, *columns: Column | str, draw: Column | None = None) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5; the same for the same values and number of the draw, if there is one."""
    more = [] if draw is None else [draw.cast("string")]
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns], *more)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, temper: float = TEMPER) -> DataFrame:
    """source, size, rate: the mean number of copies that brings each source to its share.

    Size is the code points of all texts of the source. With `weights` (need not sum to 1; a source
    that is not named gets 0) the share is the weight's; else it is size ** temper. The whole mix is
    as large as `epochs` times the corpus. A source whose texts are all empty has rate 1: no number
    of copies changes its share. A null source is a source of its own.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        goal = F.pow(F.col("size").cast("double"), F.lit(temper))
    else:
        pairs = [F.lit(v) for name, weight in weights.items() for v in (name, float(weight))]
        named = F.create_map(*pairs) if pairs else F.expr("map('', 0D)")
        goal = F.coalesce(F.element_at(named, F.coalesce("source", F.lit(""))), F.lit(0.0))
        goal = F.when(F.col("size") > 0, goal).otherwise(0.0)
    sizes = sizes.withColumn("goal", goal)
    totals = sizes.agg(F.sum("size").alias("all_size"), F.sum(F.round("goal", 6)).alias("all_goal"))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("all_goal") == 0, 0.0).otherwise(
        F.lit(epochs) * F.col("all_size") * F.col("goal") / F.col("all_goal") / F.col("size")
    )
    return sizes.join(totals).select(  # totals is one row
        "source", "size", F.round(rate, 9).alias("rate")
    )


def poisson_table(rates: DataFrame) -> DataFrame:
    """Adds `draws`, the fewest draws of equal rate up to MOST_RATE, and `cdf` of one of them.

    cdf is P(count <= k) for k = 0, 1, ... until doubles cannot tell it from 1. The sum of independent
    Poisson draws is a Poisson draw of the summed rate, so any rate has a table of bounded length.
    """
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST_RATE)).cast("int"))
    rate = F.col("rate") / F.col("draws")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))
    cdf = F.aggregate(
        F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * rate / k)).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return rates.withColumn("cdf", cdf)


def named(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The doc_id as text; of a row without one, a digest of its text."""
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("#"), F.md5(F.coalesce(text, F.lit("")))))


def drawn_count(seed: str, name: Column | str = "doc_id") -> Column:
    """How often a row with `draws` and `cdf` is taken: the first draw by seed and name, each further one by its number too."""
    below = lambda u: F.size(F.filter("cdf", lambda c: c <= u))
    first = below(uniform(seed, name)).cast("long")
    more = F.aggregate(F.sequence(F.lit(2), F.col("draws")), first, lambda acc, k: acc + below(uniform(seed, name, draw=k)))
    return F.when(F.col("draws") > 1, more).otherwise(first)


def _drawn(docs: DataFrame, weights: dict[str, float] | None, epochs: float, temper: float, seed: str) -> DataFrame:
    """The copies with the documents' columns under the names c0, c1, ... so that none clashes, then rate and copy."""
    chances = written(poisson_table(source_rates(docs, weights, epochs, temper)).select("source", "rate", "draws", "cdf"), "rates")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text, source = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text", "source"))
    drawn = rows.join(chances, F.col(source).eqNullSafe(chances["source"]))
    counted = drawn.select(*rows.columns, "rate", drawn_count(seed, named(doc_id, text)).alias("count")).where("count > 0")
    begun = counted.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"), F.lit(COPIES).cast("long"))))
    numbers = F.sequence(F.col("from"), F.least(F.col("count"), F.col("from") + (COPIES - 1)))
    out = begun.select(*rows.columns, "rate", F.explode(numbers.cast("array<int>")).alias("copy"))
    # Rows without a doc_id are dealt by their text, else all of them were in one part.
    place = F.xxhash64(F.lit(seed), doc_id, "copy", F.when(F.col(doc_id).isNull(), F.xxhash64(text)))
    return out.withColumn("place", place).repartition("place").sortWithinPartitions("place", doc_id, "copy").drop("place")


def copies_of(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, temper: float = TEMPER, seed: str = SEED) -> DataFrame:
    """The copies that `mix` makes with the documents' own columns only, whatever their names."""
    return _drawn(docs, weights, epochs, temper, seed).drop("rate", "copy").toDF(*docs.columns)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, temper: float = TEMPER, seed: str = SEED) -> DataFrame:
    """Every document as often as its draw says, all copies shuffled over the whole output.

    The draw inverts the Poisson distribution of the source's rate at a uniform number that depends
    on the seed and doc_id alone, so reruns and lost executors give the same copies. Adds `rate` and
    `copy` (1, 2, ...). Rows of equal doc_id get equal draws; a row without
    a doc_id is drawn by its text; null or empty texts are drawn like others. An empty table gives no rows. Columns `rate` and
    `copy` are replaced (`copies_of` keeps them); all other columns pass through, whatever their names.

    Any rate is drawn: above MOST_RATE as a sum of independent draws. MIX_SQL says the same up to there; from a
    rate of about 745 its EXP(-rate) is 0 and it cannot. A row's copies are made COPIES at a time; `copy` is
    an int.

    The rates have a row a source and are written first: Spark sees their size, so it broadcasts them
    below its threshold without moving a text, and above it splits a hot source. Copies are dealt
    by a hash of seed, doc_id and copy and sorted by it within each part: one shuffle of the texts.
    """
    docs = docs.drop("rate", "copy")
    return _drawn(docs, weights, epochs, temper, seed).toDF(*docs.columns, "rate", "copy")


MIX_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, SUM(COALESCE(LENGTH(text), 0))::BIGINT AS size FROM documents GROUP BY source
), goals AS (
  SELECT source, size, POW(size::DOUBLE, {TEMPER}) AS goal FROM sizes
), totals AS (
  SELECT SUM(size)::BIGINT AS all_size, SUM(ROUND(goal, 6)) AS all_goal FROM goals
), rates AS (
  SELECT source, ROUND(CASE WHEN size = 0 THEN 1.0::DOUBLE WHEN all_goal = 0 THEN 0.0::DOUBLE
         ELSE 1.0::DOUBLE * all_size * goal / all_goal / size END, 9) AS rate FROM goals, totals
), cdf AS (
  SELECT source, rate, 0 AS k, EXP(-rate) AS p, EXP(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), total + p * rate / (k + 1) FROM cdf
  WHERE k < CEIL(rate + 12 * SQRT(rate) + 20)
), drawn AS (
  SELECT *, ('0x' || SUBSTR(MD5('{SEED}|' || COALESCE(CAST(doc_id AS VARCHAR), '#' || MD5(COALESCE(text, '')))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.rate, COUNT(*) FILTER (WHERE c.total <= d.u) AS copies
  FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source
  GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, rate, UNNEST(RANGE(1, copies + 1))::INTEGER AS copy FROM counted
"""


@query("op3_poisson_mix", MIX_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
