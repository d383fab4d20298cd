"""From raw documents to token shards in five stages; each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.functions.numbering import hashed_numbers
from panelgrain.llm.decontaminate import clean_documents
from panelgrain.llm.mixing import copies_of
from panelgrain.llm.near_dedup import near_duplicates
from panelgrain.llm.quality import good_documents
from panelgrain.llm.shared import table, written
from panelgrain.llm.tokens import default_tokenizer, token_index


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def _nodes(docs: DataFrame) -> DataFrame:
    """(row, node): each row as a struct, and an id for its (doc_id, text).

    It is the doc_id; a row without one and the further texts under a repeated one get numbers above all
    ids, by a hash. The first text of an id is the one with the smallest hash.
    """
    text = F.xxhash64(F.coalesce("row.text", F.lit("")))
    keyed = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("id"), text.alias("key"))
    keys = keyed.select("id", "key").distinct()
    firsts = keys.where("id IS NOT NULL").groupBy("id").agg(F.min("key").alias("first"), F.count("*").alias("texts")).where("texts > 1")
    further = keys.join(firsts, "id").where("key <> first").select("id", "key")
    further = written(keys.where("id IS NULL").union(further), "further")
    numbered = hashed_numbers(further, ["id", "key"], "number").select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "number")
    last = keyed.agg(F.coalesce(F.max("id"), F.lit(0).cast("long"))).first()[0]
    numbered = written(numbered.withColumn("number", F.col("number") + F.lit(last)), "numbered")
    both = keyed.join(numbered, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    return both.select("row", F.coalesce("number", "id").alias("node"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, once: the one with the smallest doc_id.

    Documents are told apart by doc_id and text: rows without a doc_id and different texts under one
    doc_id are documents of their own, which go only if they are near a kept one; they come after all
    others. Null texts are empty; an empty text is near no other document. Of rows equal in both, the first by all
    columns in their order stays. Extra columns pass through, whatever their names. An empty table gives no rows.
    """
    noded = _nodes(docs)
    groups = near_duplicates(noded.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text")), identified=True)
    kept = groups.where("kept").select(F.col("doc_id").alias("kept")).distinct()
    one = noded.join(kept, F.col("node") == F.col("kept"), "left_semi")
    first = F.row_number().over(Window.partitionBy("node").orderBy("row"))
    return one.withColumn("first", first).where("first = 1").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item.

    Documents are told apart by doc_id and text; rows without a doc_id, without a text or repeated are judged by their
    text like others. Extra columns pass through, whatever their names; they are not read. An empty table gives no rows.
    """
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come to their target shares.

    Null sources are a source; a row without a doc_id is drawn by its text, rows of one doc_id share its draw, empty
    texts are drawn like others. Extra columns pass through, whatever their names. An empty table gives no rows.
    """
    return copies_of(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in an order that mixes all copies: (doc_id, start, n_tokens, ids_crc32) read back from them.

    The order is a hash of doc_id and the number of the copy, so it does not depend on how rows arrive. Copies
    without a doc_id are numbered and placed by their text too, so they are dealt like others.
    """
    unnamed = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    copies = docs.select("doc_id", "text", F.row_number().over(Window.partitionBy("doc_id", unnamed).orderBy("text")).alias("_copy"))
    place = F.md5(F.concat_ws("|", F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("_copy").cast("string"), unnamed.cast("string")))
    return token_index(copies, default_tokenizer(), order=[place, F.col("doc_id"), F.col("_copy")])


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mixing),
    ("token output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


# Neither the classifier nor the tokenizer can be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None
