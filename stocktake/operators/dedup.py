"""One row per key.

Top-1 picks are written as ``row_number() == 1`` so that Catalyst plans a
partial group limit: every map task sends at most one row per key, and a key
that holds a large share of all rows never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``by`` per key; NULL keys form one group."""
    order = [F.col(by).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ties)]
    return _top_one(df, keys, order)


def keep_first(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``by`` per key; NULL keys form one group."""
    return _top_one(df, keys, [F.col(c).asc_nulls_last() for c in (by, *ties)])


def earliest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows with the smallest ``by`` of their key, of which there may be several.

    For rows that are costly to prepare: this cut needs two columns as received
    and already happens before the shuffle, so ``keep_first`` with its other
    ordering columns sees, and the preparation is paid for, few repeats. Its
    window is on the same keys and moves nothing again.
    """
    ranked = df.withColumn("_rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.col(by).asc_nulls_last())))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies are merged map-side before the shuffle."""
    return df.dropDuplicates()


def last_with_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str],
    count_as: str,
) -> DataFrame:
    """Last row per key by ``order`` together with the key's row count.

    An aggregate instead of ``count() over`` plus a pick: both parts combine
    map-side, so the rows of a hot key are never gathered in one task. NULLs
    in ``order`` lose against any value.
    """
    payload = [c for c in keep if c not in order]
    last = F.max(F.struct(*order, *payload)).alias("_last")
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as), last)
    return grouped.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in keep), count_as)
