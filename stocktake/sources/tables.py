"""Layer tables kept as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the table and return it as read back.

    Partitioned tables are rebalanced first: adaptive execution then splits a
    partition value that holds much of the data over several tasks and files,
    and merges small ones.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """With a schema, partition values keep their declared type and footers are not merged."""
    reader = spark.read.schema(schema) if schema else spark.read
    table = reader.parquet(path)
    return table.select(*schema.names) if schema else table
