"""Small file-system steps that Spark writers do not cover."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _open(spark, path)
    return file_system.exists(hadoop_path)


def delete_folder(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _open(spark, path)
    file_system.delete(hadoop_path, True)


@contextmanager
def beside(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside a table, gone at the end."""
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        yield staging
    finally:
        delete_folder(spark, staging)
