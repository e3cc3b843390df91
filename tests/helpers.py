from __future__ import annotations

from pyspark.sql import functions as F


def rows(df, *columns):
    """Rows as sorted tuples, NULL first."""
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string")


def apply(spark, values, expression):
    """The function from text column to column over each value, in order."""
    df = texts(spark, values).select("id", expression(F.col("t")).alias("r"))
    return [r["r"] for r in sorted(df.collect(), key=lambda r: r["id"])]
