"""Keep one or a few rows per key under an explicit total order.

Each operator is a ``row_number`` filter. Spark turns that into a limit per
key *before* the shuffle, so a key that holds a third of all rows sends at most
``n`` rows per input task to the task that finishes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_rank"


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return keep_top(df, keys, order, 1)


def latest_wins(
    df: DataFrame,
    keys: Sequence[str] = ("point_id", "forecast_time"),
    by: Sequence[str] = ("ingested_at", "batch_id"),
) -> DataFrame:
    """The newest version of each key."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in by])


def nearest_in_time(
    df: DataFrame,
    reference: Column,
    keys: Sequence[str] = ("point_id",),
    time: str = "forecast_time",
    tie: str = "future",
    then: Sequence[Column] = (),
) -> DataFrame:
    """The row of each key whose time is nearest to ``reference``.

    Two rows at the same distance are decided by ``tie``: the ``future`` one or
    the ``past`` one. Rows without a time come last. ``then`` breaks what is
    left.
    """
    if tie not in ("future", "past"):
        raise ValueError(f"tie must be 'future' or 'past', got {tie!r}")
    when = F.col(time)
    distance = F.abs(F.unix_micros(when) - F.unix_micros(reference))
    order = [distance.asc_nulls_last()]
    if tie == "future":
        order.append((when < reference).asc_nulls_last())
    order.append(when.asc_nulls_last())
    return keep_first(df, keys, [*order, *then])


def smallest(columns: Sequence[str], order: Sequence[Column]) -> Column:
    """Aggregate: the struct of ``columns`` of the first row in ``order``.

    Only ascending keys; negate a number to sort it downwards.
    """
    return F.min_by(F.struct(*columns), F.struct(*order))


def worst_first(index: str, *ties: str) -> list[Column]:
    """Order for :func:`smallest`: highest index, missing last, then the ties."""
    return [
        F.col(index).isNull().alias("missing"),
        (-F.col(index)).alias("descending"),
        *[F.col(tie) for tie in ties],
    ]
