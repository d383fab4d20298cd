"""Merkle fixity audit of WARC replicas: trees over records and their offsets, compared from the roots down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm.shared import query, table, written

# Children of a tree node, and page ids that share a WARC file.
FAN, FILE_IDS = 16, 1000
LEAF = ["file_no", "idx", "record_id", "record_offset", "record_bytes", "sha256", "node"]


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """One WARC/1.0 response record; nulls are empty."""
    body = F.coalesce(payload, F.lit(""))
    lines = ["WARC/1.0\\r\\nWARC-Type: response\\r\\nWARC-Record-ID: <urn:page:", "record_id", ">\\r\\nWARC-Target-URI: ", "url", "\\r\\nContent-Length: "]
    values = {"record_id": F.coalesce(record_id.cast("string"), F.lit("")), "url": F.coalesce(url, F.lit(""))}
    head = [values.get(part, F.lit(part.replace("\\r\\n", "\r\n"))) for part in lines]
    return F.concat(*head, F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def leaves(pages: DataFrame) -> DataFrame:
    """A leaf for each record of the files that `pages` make: place, offset range, hash of the record, hash of the leaf.

    A file holds the pages of 1000 consecutive ids in the order of page_id, then of their hashes (null ids
    are a file of their own), so offsets are sums within a file. Only hashes and lengths are moved.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    hashed = pages.select(F.col("page_id").cast("long").alias("record_id"), record.alias("record"))
    hashed = hashed.select("record_id", F.octet_length("record").cast("long").alias("record_bytes"), F.sha2("record", 256).alias("sha256"))
    placed = hashed.withColumn("file_no", F.floor(F.col("record_id") / FILE_IDS))
    order = Window.partitionBy("file_no").orderBy("record_id", "sha256")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumns({"idx": (F.row_number().over(order) - 1).cast("long"), "record_offset": F.coalesce(F.sum("record_bytes").over(before), F.lit(0)).cast("long")})
    node = F.sha2(F.concat_ws("|", F.col("record_offset").cast("string"), F.col("record_bytes").cast("string"), "sha256"), 256)
    return placed.withColumn("node", node).select(*LEAF)


def parents(nodes: DataFrame) -> DataFrame:
    """The next level of the trees: a node hashes the hashes of at most FAN neighbours, in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda c: c["node"])
    grouped = nodes.groupBy("file_no", F.floor(F.col("idx") / FAN).alias("idx")).agg(ordered.alias("children"))
    return grouped.select("file_no", "idx", F.sha2(F.concat_ws("|", "children"), 256).alias("node"))


def _differing(a: DataFrame, b: DataFrame, extra: list[str]) -> DataFrame:
    """Nodes of one level whose hashes are not the same in both, or that only one has."""
    left = a.select("file_no", "idx", *[F.col(c).alias(f"a_{c}") for c in ["node", *extra]])
    right = b.select(F.col("file_no").alias("b_file"), F.col("idx").alias("b_idx"), *[F.col(c).alias(f"b_{c}") for c in ["node", *extra]])
    same = F.col("file_no").eqNullSafe(F.col("b_file")) & (F.col("idx") == F.col("b_idx"))
    both = left.join(right, same, "full").where(~F.col("a_node").eqNullSafe(F.col("b_node")))
    place = F.when(F.col("a_node").isNull(), F.col("b_file")).otherwise(F.col("file_no"))
    return both.withColumns({"file_no": place, "idx": F.coalesce("idx", "b_idx")}).drop("b_file", "b_idx")


def _below(nodes: DataFrame, bad: DataFrame) -> DataFrame:
    """The children of differing nodes."""
    up = bad.select(F.col("file_no").alias("_file"), F.col("idx").alias("_idx"))
    same = F.col("file_no").eqNullSafe(F.col("_file")) & (F.floor(F.col("idx") / FAN) == F.col("_idx"))
    return nodes.join(up, same, "left_semi")


def audit(archive: DataFrame, replica: DataFrame) -> DataFrame:
    """The records in which a replica differs from the archive, both given as `leaves`.

    Rows: file_no, record_no, record_id, record_offset, record_bytes, status, expected_sha256,
    found_sha256. status is damaged (other bytes at the place), moved (the same bytes at another
    offset), missing or extra (only in the replica; its own values are shown). Records are lined up by their
    number in the file, so a record that goes from the middle shows as damage up to the file's end.

    The leaves are written once; then roots are compared, and of every level only the children of nodes that
    differ are joined. The number of levels follows the longest file. Two empty tables give no rows.
    """
    a, b = written(archive, "leaves"), written(replica, "leaves")
    most = a.select("idx").union(b.select("idx")).agg(F.max("idx")).first()[0]
    trees = [(a, b)]
    while most:
        trees.append(tuple(parents(t) for t in trees[-1]))
        most //= FAN
    trees = trees[:1] + [tuple(written(t, "nodes") for t in level) for level in trees[1:]]
    extra = ["record_id", "record_offset", "record_bytes", "sha256"]
    bad = _differing(*trees[-1], extra if len(trees) == 1 else [])
    for k in range(len(trees) - 2, -1, -1):
        bad = _differing(*(_below(t, bad) for t in trees[k]), extra if k == 0 else [])
    status = (
        F.when(F.col("a_node").isNull(), "extra").when(F.col("b_node").isNull(), "missing").when(F.col("a_sha256") == F.col("b_sha256"), "moved").otherwise("damaged")
    )
    shown = [F.when(F.col("a_node").isNull(), F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in extra[:3]]
    return bad.select("file_no", F.col("idx").alias("record_no"), *shown, status.alias("status"), F.col("a_sha256").alias("expected_sha256"), F.col("b_sha256").alias("found_sha256"))


def worn(pages: DataFrame) -> DataFrame:
    """A replica of the pages with faults: a changed letter, a lost letter, and records lost or added at the end of a file.

    Which pages are hit depends on a checksum of their id, so about one in fifty is, whatever the size.
    """
    mark = F.conv(F.substring(F.md5(F.concat(F.lit("wear"), F.col("page_id").cast("string"))), 1, 8), 16, 10).cast("long") % 200
    text = F.when(mark < 2, F.translate("html", "e", "3")).when(mark == 2, F.expr("left(html, length(html) - 1)")).otherwise(F.col("html"))
    last = F.pmod(F.col("page_id"), F.lit(FILE_IDS)) >= FILE_IDS - 3
    lost = last & (F.floor(F.col("page_id") / FILE_IDS) % 5 == 1)
    kept = pages.select("page_id", "url", text.alias("html")).where(~F.coalesce(lost, F.lit(False)))
    added = pages.where(F.pmod(F.col("page_id"), F.lit(5 * FILE_IDS)) == FILE_IDS - 1 + 2 * FILE_IDS).select("page_id", F.lit("~").alias("url"), "html")
    return kept.unionByName(added)


def _sql() -> str:
    record = (
        "'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Record-ID: <urn:page:' || page_id || '>' || nl || 'WARC-Target-URI: ' || url || nl"
        " || 'Content-Length: ' || STRLEN(html) || nl || nl || html || nl || nl"
    )

    def leaf(source: str) -> str:
        return f"""(
  SELECT page_id, file_no, record_bytes, sha256, ROW_NUMBER() OVER (PARTITION BY file_no ORDER BY page_id, sha256) - 1 AS idx,
         COALESCE(SUM(record_bytes) OVER (PARTITION BY file_no ORDER BY page_id, sha256 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record_offset
  FROM (SELECT page_id, page_id // {FILE_IDS} AS file_no, STRLEN(record)::BIGINT AS record_bytes, SHA256(record) AS sha256
        FROM (SELECT page_id, {record} AS record FROM (SELECT *, CHR(13) || CHR(10) AS nl FROM {source}))))"""

    return f"""
WITH marked AS (
  SELECT page_id, COALESCE(url, '') AS url, COALESCE(html, '') AS html, ('0x' || SUBSTR(MD5('wear' || page_id), 1, 8))::BIGINT % 200 AS mark FROM pages
), kept AS (
  SELECT page_id, url, CASE WHEN mark < 2 THEN TRANSLATE(html, 'e', '3') WHEN mark = 2 THEN LEFT(html, LENGTH(html) - 1) ELSE html END AS html
  FROM marked WHERE NOT (page_id % {FILE_IDS} >= {FILE_IDS - 3} AND (page_id // {FILE_IDS}) % 5 = 1)
  UNION ALL SELECT page_id, '~', html FROM marked WHERE page_id % {5 * FILE_IDS} = {FILE_IDS - 1 + 2 * FILE_IDS}
), a AS {leaf("marked")}, b AS {leaf("kept")}
SELECT COALESCE(a.file_no, b.file_no)::BIGINT AS file_no, COALESCE(a.idx, b.idx)::BIGINT AS record_no, COALESCE(a.page_id, b.page_id) AS record_id,
  CASE WHEN a.idx IS NULL THEN b.record_offset ELSE a.record_offset END::BIGINT AS record_offset,
  COALESCE(a.record_bytes, b.record_bytes)::BIGINT AS record_bytes,
  CASE WHEN a.idx IS NULL THEN 'extra' WHEN b.idx IS NULL THEN 'missing' WHEN a.sha256 = b.sha256 THEN 'moved' ELSE 'damaged' END AS status,
  a.sha256 AS expected_sha256, b.sha256 AS found_sha256
FROM a FULL JOIN b ON a.file_no = b.file_no AND a.idx = b.idx
WHERE a.idx IS NULL OR b.idx IS NULL OR a.sha256 <> b.sha256 OR a.record_offset <> b.record_offset
"""


@query("op6_warc_fixity", _sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return audit(leaves(pages), leaves(worn(pages)))
