"""Grading of batches: row rules, batch checks, score and verdict."""

from __future__ import annotations

from copy import copy
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators import batch_checks, rules
from skyledger.schema import CLEAN_COLUMNS


class Grading:
    """Results of grading all batches of a table of readings, each planned when first asked for.

    A query that needs one result does not pay for the plans of the others.
    """

    def __init__(
        self,
        readings: DataFrame,
        points: DataFrame,
        locations: DataFrame,
        source: str,
        checked_at: Column,
        batch: str,
        hours: int,
        freshness_minutes: int,
        tolerance: float,
    ):
        self._readings, self._points, self._locations = readings, points, locations
        self._source, self._checked_at, self._batch = source, checked_at, batch
        self._hours, self._freshness, self._tolerance = hours, freshness_minutes, tolerance

    @cached_property
    def _checked(self) -> tuple[DataFrame, list[rules.Rule]]:
        return rules.check_readings(
            self._readings, self._points, self._locations, self._source, self._tolerance, self._batch
        )

    @cached_property
    def judged(self) -> DataFrame:
        """The readings with the positions of the rules they break; the other results follow from these rows."""
        return rules.judged(*self._checked)

    @property
    def batch(self) -> str:
        """Name of the column that holds the batch a row was loaded with."""
        return self._batch

    @property
    def rules(self) -> list[rules.Rule]:
        return self._checked[1]

    @cached_property
    def _split(self) -> tuple[DataFrame, DataFrame]:
        return rules.split(self.judged, self.rules, self._checked_at)

    @cached_property
    def _facts(self) -> DataFrame:
        return batch_checks.batch_facts(
            self._readings, self._points, self._batch, self._source, self._hours, self._freshness
        )

    @property
    def valid(self) -> DataFrame:
        return self._split[0]

    @property
    def bad(self) -> DataFrame:
        return self._split[1]

    @cached_property
    def row_report(self) -> DataFrame:
        return rules.report(self.judged, self.rules, [self._batch])

    @cached_property
    def batch_report(self) -> DataFrame:
        return batch_checks.batch_report(self._facts, self._batch, self._hours, self._freshness)

    @cached_property
    def summary(self) -> DataFrame:
        rows = batch_checks.row_facts(self.judged, self._batch)
        return batch_checks.score(self._facts, rows, len(self.rules), self._batch)

    def stored(self, path: str) -> Grading:
        """The same results from judged rows that are written to ``path`` once.

        Rules, duplicate counts and dimension joins run in that one job; what is
        asked of the returned grading reads the written rows.
        """
        self.judged.write.mode("overwrite").parquet(path)
        rows = self._readings.sparkSession.read.parquet(path)
        other = copy(self)
        for name in ("_facts", "_split", "row_report", "batch_report", "summary"):
            other.__dict__.pop(name, None)
        other.__dict__.update(judged=rows, _readings=rows.drop(rules.BROKEN))
        return other


def grade(
    readings: DataFrame,
    points: DataFrame,
    locations: DataFrame,
    source: str,
    checked_at: Column,
    batch: str = "load_id",
    hours: int = 24,
    freshness_minutes: int = 90,
    tolerance: float = 0.001,
) -> Grading:
    """Grade every batch in ``readings``; ``batch`` holds the id it was loaded with."""
    missing = [c for c in (*CLEAN_COLUMNS, batch) if c not in readings.columns]
    if missing:
        raise ValueError(f"readings lack columns: {', '.join(missing)}")
    if tolerance < 0:
        raise ValueError("tolerance must not be negative")
    return Grading(readings, points, locations, source, checked_at, batch, hours, freshness_minutes, tolerance)


def not_passed(row_report: DataFrame, batch_report: DataFrame, batch: str = "load_id") -> DataFrame:
    """All checks that did not pass, with their scope and count."""
    columns = [batch, "check_name", "check_scope", "status", "bad_records_count"]
    return (
        row_report.select(*columns)
        .union(batch_report.select(*columns))
        .where(F.col("status") != "PASSED")
    )
