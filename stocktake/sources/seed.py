"""Small typed lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The received reading origins, their official name and capture type.
READING_ORIGINS = (
    ("leitor_codigo_barras", "leitor_codigo_barras", "Leitura automática"),
    ("celular", "celular", "Leitura automática"),
    ("scanner", "celular", "Leitura automática"),
    ("mobile_celular", "celular", "Leitura automática"),
    ("mobile_scanner", "celular", "Leitura automática"),
    ("manual", "manual", "Digitação"),
    ("mobile_manual", "manual", "Digitação"),
    ("nao_informada", "nao_informada", "Não informado"),
)
READING_ORIGIN_COLUMNS = ("origem_recebida", "origem_leitura", "tipo_captura")


def text_seed(spark: SparkSession, rows: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """A lookup given as literals in the code, every column text.

    A VALUES list has an exact size, so Catalyst knows that it can broadcast it.
    """

    def quoted(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS seed({', '.join(columns)})")


def read_seed(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A lookup kept as a CSV file, every column text."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def reading_origins(spark: SparkSession) -> DataFrame:
    return text_seed(spark, READING_ORIGINS, READING_ORIGIN_COLUMNS)
