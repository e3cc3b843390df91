"""Consecutive numbers over a whole DataFrame without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktake.session import shared_folder

_SLOT_BITS = 33  # monotonically_increasing_id keeps the position in the low 33 bits


def global_sequence(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Number the rows from ``start`` in the given order.

    Rows are range-partitioned and sorted, then numbered inside their
    partition; only the partition sizes (one row each) are summed up in order.
    The placement is checkpointed, so a lost executor cannot renumber rows.
    """
    spark = df.sparkSession
    shared_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    number = (position + F.col("_offset") + F.lit(start)).cast("int")
    # At most one offset row per partition, so this side is small by construction.
    return placed.join(F.broadcast(offsets), "_part").withColumn(name, number).select(*df.columns, name)
