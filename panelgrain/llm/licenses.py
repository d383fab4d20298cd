"""License scans: word k-grams joined with templates, voted by diagonal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelgrain.llm import kernels as K
from panelgrain.llm.shared import query, table, texts

GRAM = 3
# The phrases every scan looks for, with their labels.
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
# Further templates, found also with small changes.
MORE = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike international license"),
]
# Diagonals this near are one occurrence; a merged one counts from this share of the template's k-grams.
NEAR, SHARE = 4, 0.6


def _words(data: np.ndarray, at: np.ndarray):
    lower = K._lower[data]
    starts, ends, first = K.words(lower, at, K.WORD)
    return K.span_hash(K.prefix_hash(K.BYTE_VALUES[lower]), starts, ends), first


def template_grams(base: list[tuple[str, str]], more: list[tuple[str, str]]) -> list[tuple]:
    """(h, template, label, base, offset, grams) of every k-gram of the templates; each has GRAM words at least."""
    rows = []
    for number, (label, text, is_base) in enumerate([(*t, True) for t in base] + [(*t, False) for t in more]):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        word, _ = _words(raw, np.array([0, len(raw)]))
        if len(word) < GRAM:
            raise ValueError(f"a template needs {GRAM} words: {text}")
        grams = K.gram_hash(word, GRAM).view(np.int64).tolist()
        rows += [(h, number, label, is_base, offset, len(grams)) for offset, h in enumerate(grams)]
    return rows


def _grams(batches):
    """(doc_id, tkey, n_words, pos, h) of every rolling k-gram; one row without a k-gram (pos -1) for each document."""
    for batch in batches:
        data, at = K.text_bytes(batch.column(2))
        for i, j in K.slices(at):
            word, first = _words(data[at[i] : at[j]], at[i : j + 1] - at[i])
            grams = K.gram_hash(word, GRAM)
            count = np.diff(first)
            size = np.maximum(0, count - GRAM + 1)
            row = np.repeat(np.arange(j - i), size + 1)
            step = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(size + 1)[:-1])), size + 1) - 1
            h = np.zeros(len(row), dtype=np.int64)
            h[step >= 0] = grams[(first[row] + step)[step >= 0]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i).take(pa.array(row)),
                    batch.column(1).slice(i, j - i).take(pa.array(row)),
                    pa.array(count[row].astype(np.int64)),
                    pa.array(step),
                    pa.array(h, mask=step < 0),
                ],
                names=["doc_id", "tkey", "n_words", "pos", "h"],
            )


def scan(docs: DataFrame, base: list[tuple[str, str]] | None = None, more: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    A base phrase counts at each place where all its words stand in a row. A further template counts
    where diagonals at most 4 words apart hold 0.6 of its k-grams or more, each counted once and only in
    the template's order: a k-gram counts where its first place in the span lies behind those of all k-grams before
    it in the template. So a few changed, added or missing words do not hide it, and a part said twice
    does not stand for the whole. score is the best share of any template, 1 for a base phrase.

    All rolling three-word hashes are joined with the templates' (a constant table of a few hundred
    rows, broadcast); what matches is aggregated by document, template and diagonal (place in the text
    less place in the template); what a diagonal keeps is which k-grams of the template lie on it. Null text counts as empty: 0 words, no places, empty labels, score 0.
    Equal rows are scanned as one and returned as often as they came; null doc_id is kept. Extra columns are
    not read.
    """
    spark = docs.sparkSession
    rows = template_grams(BASE if base is None else base, MORE if more is None else more)
    templates = spark.createDataFrame(rows, "h long, template int, label string, base boolean, offset int, grams int")
    templates = templates.groupBy("h").agg(F.collect_list(F.struct("template", "label", "base", "offset", "grams")).alias("places"))
    source = texts(docs).withColumn("tkey", F.xxhash64("text")).select("doc_id", "tkey", "text")
    grams = source.mapInArrow(_grams, "doc_id long, tkey long, n_words long, pos long, h long")
    # The join keeps one row for each document (no k-gram) and every k-gram that a template has.
    joined = grams.join(F.broadcast(templates), "h", "left").where("places IS NOT NULL OR pos < 0")
    hits = joined.select("doc_id", "tkey", "n_words", "pos", F.explode_outer("places").alias("t"))
    # A row without a template stands for a copy of the document. A set of offsets is never longer than its template.
    voted = hits.groupBy("doc_id", "tkey", "t.template", (F.col("pos") - F.col("t.offset")).alias("diagonal")).agg(
        F.first("n_words").alias("n_words"), F.first("t.label").alias("label"), F.first("t.base").alias("base"), F.first("t.grams").alias("grams"),
        F.count("*").alias("rows"), F.collect_set("t.offset").alias("offsets"),
    )
    copies = F.max(F.when(F.col("template").isNull(), F.col("rows"))).over(Window.partitionBy("doc_id", "tkey"))
    voted = voted.withColumn("copies", copies)
    line = Window.partitionBy("doc_id", "tkey", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > NEAR, F.lit(True)) | F.col("base")
    merged = voted.withColumn("apart", apart.cast("int")).withColumn("span", F.sum("apart").over(line))
    span = ["doc_id", "tkey", "template", "span"]
    found = merged.select("*", F.explode_outer("offsets").alias("offset")).groupBy(*span, "offset").agg(
        F.first("n_words").alias("n_words"), F.first("copies").alias("copies"), F.first("label").alias("label"), F.first("base").alias("base"),
        F.first("grams").alias("grams"), F.min("diagonal").alias("diagonal"),
    )
    # Verification: a span's k-grams at their first places, in the template's order.
    place = F.col("diagonal") + F.col("offset")
    behind = F.max(place).over(Window.partitionBy(*span).orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    spans = found.withColumn("in_order", F.when(behind.isNull() | (place > behind), 1).otherwise(0)).groupBy(*span).agg(
        F.first("n_words").alias("n_words"), F.first("copies").alias("copies"), F.first("label").alias("label"), F.first("base").alias("base"),
        F.min("diagonal").alias("start"), (F.sum("in_order") / F.first("grams")).alias("share"),
    )
    is_base = F.col("base") & (F.col("share") >= 1)
    is_more = ~F.col("base") & (F.col("share") >= SHARE)
    names = lambda kept: F.array_join(F.array_sort(F.collect_set(F.when(kept, F.col("label")))), ",")
    best = F.max(F.when(is_base | is_more, F.col("share")))
    out = spans.groupBy("doc_id", "tkey").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        names(is_base).alias("base_labels"),
        names(is_base | is_more).alias("labels"),
        F.round(F.coalesce(best, F.lit(0.0)), 6).alias("score"),
        F.max("copies").alias("copies"),
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("tkey", "copies", "copy")


def _sql() -> str:
    lines = [(n, label, text, b) for n, (label, text, b) in enumerate([(*t, "TRUE") for t in BASE] + [(*t, "FALSE") for t in MORE])]
    values = ", ".join(f"({n}, '{label}', '{text}', {b})" for n, label, text, b in lines)
    return f"""
WITH template AS (
  SELECT n, label, is_base, STRING_SPLIT(body, ' ') AS w FROM (VALUES {values}) t(n, label, body, is_base)
), piece AS (
  SELECT n, label, is_base, LEN(w) - 2 AS grams, UNNEST(RANGE(0, LEN(w) - 2)) AS off, w FROM template
), tgram AS (
  SELECT n, label, is_base, grams, off, ARRAY_TO_STRING(w[off + 1:off + 3], ' ') AS g FROM piece
), doc AS (
  SELECT doc_id, REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), place AS (
  SELECT doc_id, w, UNNEST(RANGE(0, LEN(w) - 2)) AS pos FROM doc WHERE LEN(w) > 2
), dgram AS (
  SELECT doc_id, pos, ARRAY_TO_STRING(w[pos + 1:pos + 3], ' ') AS g FROM place
), vote AS (
  SELECT d.doc_id, t.n, t.label, t.is_base, t.grams, d.pos - t.off AS diagonal, LIST(DISTINCT t.off) AS offs
  FROM dgram d JOIN tgram t ON d.g = t.g GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN is_base OR COALESCE(diagonal - LAG(diagonal) OVER l > {NEAR}, TRUE) THEN 1 ELSE 0 END AS apart
  FROM vote WINDOW l AS (PARTITION BY doc_id, n ORDER BY diagonal)
), numbered AS (
  SELECT *, SUM(apart) OVER (PARTITION BY doc_id, n ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked
), spread AS (
  SELECT doc_id, n, label, is_base, grams, span, diagonal, UNNEST(offs) AS off FROM numbered
), found AS (
  SELECT doc_id, n, label, is_base, grams, span, off, MIN(diagonal) AS diagonal, MIN(diagonal + off) AS place FROM spread GROUP BY doc_id, n, label, is_base, grams, span, off
), checked AS (
  SELECT *, COALESCE(place > MAX(place) OVER (PARTITION BY doc_id, n, span ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS in_order
  FROM found
), spans AS (
  SELECT doc_id, n, label, is_base, span, MIN(diagonal) AS start, COUNT(*) FILTER (WHERE in_order)::DOUBLE / MIN(grams) AS share
  FROM checked GROUP BY doc_id, n, label, is_base, span
), sound AS (
  SELECT *, is_base AND share >= 1 AS b FROM spans WHERE CASE WHEN is_base THEN share >= 1 ELSE share >= {SHARE} END
)
SELECT d.doc_id, LEN(d.w)::BIGINT AS n_words, COUNT(*) FILTER (WHERE s.b) AS n_base,
  MIN(s.start) FILTER (WHERE s.b) AS first_word, MAX(s.start) FILTER (WHERE s.b) AS last_word,
  COALESCE(STRING_AGG(DISTINCT CASE WHEN s.b THEN s.label END, ',' ORDER BY CASE WHEN s.b THEN s.label END), '') AS base_labels,
  COALESCE(STRING_AGG(DISTINCT s.label, ',' ORDER BY s.label), '') AS labels,
  ROUND(COALESCE(MAX(s.share), 0.0), 6)::DOUBLE AS score
FROM doc d LEFT JOIN sound s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.w
"""


@query("op4_license_scan", _sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
