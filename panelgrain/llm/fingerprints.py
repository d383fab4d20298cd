"""Document fingerprints from closed syncmers, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm.shared import query, table, texts, written

# Words are runs without white space, cut at 16 characters. A k-mer is 8 words, its inner s-mers 2.
WORD = r"\S{1,16}"
K, S = 8, 2
INNER = K - S + 1
# Anchors match if they lie in the same stretch of this many words.
STRETCH = 64
ROWS_A_BUCKET, COARSE = 1000, 256


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def s_mers(words: Column) -> Column:
    """Hashes of the two-word substrings, in order; of the only word if there is one.

    `words` must be a column of its own: an expression would be evaluated again for every place.
    """
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - S, F.lit(0))), lambda i: F.xxhash64(words[i], words[i + 1]))
    return F.when(F.size(words) >= S, pairs).otherwise(F.transform(words, lambda w: F.xxhash64(w)))


def marked(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the anchors of a text column; each step is a projection of its own, so each is evaluated once."""
    frame = frame.withColumn("_words", words(F.col(text)))
    frame = frame.withColumn("_mers", s_mers(F.col("_words"))).drop("_words")
    return frame.withColumn(name, anchors(F.col("_mers"))).drop("_mers")


def anchors(mers: Column) -> Column:
    """Fingerprint values from s-mer hashes: one for each closed syncmer, with the stretch it lies in.

    A k-mer is chosen if its least s-mer is its first or its last one, which the k-mer alone decides.
    Texts with fewer than eight words have all their s-mers as anchors.
    """
    edge = lambda i: F.least(mers[i], mers[i + INNER - 1])
    middle = lambda i: F.least(*[mers[i + j] for j in range(1, INNER - 1)])
    chosen = F.filter(F.sequence(F.lit(0), F.greatest(F.size(mers) - INNER, F.lit(0))), lambda i: edge(i) <= middle(i))
    part = lambda value: F.shiftrightunsigned(value, 32)
    long = F.transform(chosen, lambda i: part(F.xxhash64(*[mers[i + j] for j in range(0, K - 1, S)], F.floor(i / STRETCH))))
    short = F.transform(mers, lambda h: part(F.xxhash64(h)))
    return F.array_distinct(F.when(F.size(mers) >= INNER, long).otherwise(short))


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over all anchors of both; two texts without anchors are alike."""
    shared = F.size(F.array_intersect(a, b))
    everything = F.size(a) + F.size(b) - shared
    return F.when(everything == 0, 1.0).otherwise(shared / everything)


def shown(values: Column) -> Column:
    """The fingerprint as text: eight hex digits for each anchor."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


def with_next(docs: DataFrame, rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """doc_id, tkey, text, mark and those of the row after it in descending doc_id (null last), ties by tkey; after the last the first.

    Rows go to buckets of neighbouring doc_ids (256 sampled bounds, and even steps between two of them), so one
    shuffle brings neighbours together and no task needs all rows. The first row of each bucket
    is sent to the bucket above as well, whose last row it follows; those rows are found from ids alone.
    """
    source = docs.select("doc_id", "tkey", "text")
    ids = source.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", [x / COARSE for x in range(COARSE + 1)], 10000).alias("q")).first()
    bounds = sorted(set(ids["q"] or [0]))
    steps = max(1, -(-ids["n"] // (rows_a_bucket * max(1, len(bounds)))))
    held = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.size(F.filter(held, lambda b: b <= F.col("doc_id")))
    low, high = F.try_element_at(held, F.greatest(coarse, F.lit(1))), F.try_element_at(held, coarse + 1)
    share = (F.col("doc_id").cast("double") - low) / (high.cast("double") - low)
    fine = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * steps), F.lit(0)), F.lit(steps - 1))
    dealt = source.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(coarse.cast("long") * steps + fine).cast("long"))

    heads = dealt.groupBy("bucket").agg(F.max(F.struct("doc_id", "tkey")).alias("head"))
    around = Window.orderBy("bucket")
    whole = Window.partitionBy()
    heads = heads.select("head.*", F.coalesce(F.lead("bucket").over(around), F.min("bucket").over(whole)).alias("above"))
    heads = written(heads.select(F.col("doc_id").alias("h_id"), F.col("tkey").alias("h_key"), "above"), "heads")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("tkey") == F.col("h_key"))
    guests = source.join(heads, same).dropDuplicates(["doc_id", "tkey"]).select("doc_id", "tkey", "text", F.col("above").alias("bucket"), F.lit(True).alias("guest"))
    every = dealt.withColumn("guest", F.lit(False)).unionByName(guests).repartition("bucket")
    every = marked(every, "text", "mark")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tkey").desc())
    after = lambda c: F.lead(c).over(order).alias(f"next_{c}")
    return every.select("doc_id", "tkey", "text", "mark", "guest", after("text"), after("mark")).where("NOT guest").drop("guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The edited text has the last third of the code points (rounded down) replaced by as many from the
    start of the next document. Null text counts as empty: its fingerprint is empty. Rows of one doc_id
    follow each other in the order of a hash of their texts; a null doc_id comes after all others; the only
    row of a table is its own next. Extra columns are not read. An empty table gives no rows.
    """
    rows = with_next(texts(docs).withColumn("tkey", F.xxhash64("text")))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "mark", "next_mark", edited.alias("edited"))
    rows = marked(rows, "edited", "edited_mark")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("mark")).alias("fingerprint"),
        shown(F.col("edited_mark")).alias("edited_fingerprint"),
        likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
    )


@query("op2_syncmer_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
