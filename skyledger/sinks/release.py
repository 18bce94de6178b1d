"""Published payloads as JSON folders per id, the manifest, and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.plans.release import json_ready


def write_payloads(rows: DataFrame, key: str, path: str) -> None:
    """A JSON folder per id.

    Rebalancing keeps the files of an id few; a hot id is still split over
    several tasks.
    """
    json_ready(rows).hint("rebalance", key).write.mode("overwrite").partitionBy(key).json(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """Written last: a release without manifest is not complete."""
    json_ready(manifest).write.mode("overwrite").json(path)


def write_csv(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").option("header", True).csv(path)
