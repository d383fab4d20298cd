"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


# Settings that matter for panel data on any cluster. Fact rows are a hundred columns wide, and a
# generated function above 8000 bytes is never compiled by the JVM; the limit makes Spark fall back
# to split functions there instead. Skewed joins are split even where that costs one more shuffle.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that a cluster provides."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "panelgrain", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master without the setting gets a folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        if "folder" not in _LOCAL:
            _LOCAL["folder"] = tempfile.mkdtemp(prefix="panelgrain-")
            atexit.register(shutil.rmtree, _LOCAL["folder"], ignore_errors=True)
        folder = _LOCAL["folder"]
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table inside the shared folder."""
    return f"{shared_folder(spark)}/panelgrain/{label}-{uuid.uuid4().hex}"
