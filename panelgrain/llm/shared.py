"""What the operators share: reading tables, the shared folder, null-safe inputs, registration."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_OWN: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL where SQL can say it."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, the text (null: empty) and the named columns; whatever else the table has is left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where it is unset (local tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if "folder" not in _OWN:
            path = tempfile.mkdtemp(prefix="llm-")
            atexit.register(shutil.rmtree, path, ignore_errors=True)
            _OWN["folder"] = "file://" + path
        folder = _OWN["folder"]
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder, read again. Survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
