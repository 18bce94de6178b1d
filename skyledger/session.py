"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Time zone in which batches are partitioned and days are counted.
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows a key may keep and still be limited before the shuffle: more than the longest history.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # HotSpot never compiles a method of more than 8000 bytes. Rule sets generate
    # larger ones, which then run as bytecode; split expressions are much faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = tempfile.mkdtemp(prefix="skyledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
