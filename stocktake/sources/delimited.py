"""Delimited text read as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.sources.files import file_columns

MALFORMED = "_malformed"


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    separator: str = ";",
    charset: str = "ISO-8859-1",
    line_breaks_in_values: bool = False,
) -> DataFrame:
    """Every value as received text, an empty field as ``''``.

    Files scan in splits. A source whose quoted values hold line breaks has to
    say so, and then each file is read by one task; without that, a row that a
    line break leaves with an open quote is an error.
    """
    reader = (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("encoding", charset)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks_in_values)
        .option("enforceSchema", False)
    )
    columns = reader.csv(list(paths)).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, MALFORMED]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", MALFORMED).csv(list(paths))
    received = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns]
    return rows.filter(_fits(columns, separator)).select(*received, *file_columns())


def _fits(columns: Sequence[str], separator: str) -> Column:
    """True, or an error for a row with an open quote or more values than the header has names.

    Only rows that do not split evenly carry their text in ``MALFORMED``; short
    ones are filled up, long ones must not lose values silently. The message
    names all columns, which also makes every query parse whole rows.
    """
    wider = ", ".join(f"c{i} string" for i in range(len(columns) + 1))
    options = {"sep": separator, "quote": '"', "escape": '"'}
    surplus = F.from_csv(MALFORMED, F.lit(wider), options).getField(f"c{len(columns)}")
    values = F.concat_ws(separator, *(F.col(f"`{c}`") for c in columns))
    message = F.concat(F.lit("more values than columns: "), F.col(MALFORMED), F.lit(" after "), values)
    quotes = F.length(MALFORMED) - F.length(F.translate(MALFORMED, '"', ""))
    broken = F.raise_error(F.concat(F.lit("open quote in: "), F.col(MALFORMED), F.lit(" after "), values))
    surplus_error = F.when(surplus.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)
    return F.when(quotes % 2 == 1, broken.cast("boolean")).otherwise(surplus_error)
