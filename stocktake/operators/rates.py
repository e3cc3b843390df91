"""Ratios of summed flags; a rate is never an average of rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; an empty whole gives NULL."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def totals(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str | Column],
    count_as: str | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Count and sums per key.

    ``counted`` names a column of partial counts, for totals of totals.
    Integer sums are bigint and decimal sums decimal(38,2).
    """
    types = dict(df.dtypes)
    aggregates = []
    if count_as:
        rows = F.sum(counted) if counted else F.count(F.lit(1))
        aggregates.append(rows.cast("bigint").alias(count_as))
    for alias, source in sums.items():
        kind = types.get(source, "int") if isinstance(source, str) else "int"
        column = F.col(source) if isinstance(source, str) else source
        target = "decimal(38,2)" if kind.startswith("decimal") else "bigint"
        aggregates.append(F.sum(column).cast(target).alias(alias))
    return df.groupBy(*keys).agg(*aggregates)
