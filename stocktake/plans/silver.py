"""Bronze text to typed, cleaned tables without repeats, and the quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.functions.numbers import digits_key, mixed_decimal, safe_int
from stocktake.functions.text import (
    blank_to_null,
    drop_leading_words,
    label_by_prefix,
    normal_upper,
    proper_name,
    squeeze,
    strip,
    token_or,
)
from stocktake.functions.times import flexible_date, flexible_timestamp
from stocktake.operators.dedup import distinct_rows, earliest, keep_first, keep_latest
from stocktake.operators.joins import left_lookup, unmatched

# Area types by the start of the word, and the register status counted.
AREA_TYPES = {"jud": "Judicial", "adm": "Administrativa"}
ACTIVE = "ATIVO"
NO_ORIGIN = "nao_informada"
# Why a reading is quarantined.
NO_NUMBER, NOT_IN_REGISTER = "patrimonio_ausente", "fora_da_carga"

ASSET = ["exercicio", "numero_patrimonio"]
# The same as a join and group key: sorts compare by the first column's prefix,
# so the one with many values goes first.
ASSET_KEY = ["numero_patrimonio", "exercicio"]


def type_areas(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        safe_int(F.col("codigo_area")).alias("codigo_area"),
        squeeze(F.col("nome_area")).alias("nome_area"),
        label_by_prefix(F.col("tipo_area"), AREA_TYPES).alias("tipo_area"),
        blank_to_null(proper_name(drop_leading_words(F.col("comarca"), "comarca", "de"))).alias("comarca"),
        blank_to_null(strip(F.col("regiao"))).alias("regiao"),
        flexible_date(F.col("atualizado_em")).alias("atualizado_em"),
    )


def stg_areas(bronze: DataFrame) -> DataFrame:
    """One row per area code, the most recently updated; ties go by the other columns."""
    ties = ["nome_area", "tipo_area", "comarca", "regiao"]
    return keep_latest(type_areas(bronze), ["codigo_area"], "atualizado_em", ties)


def type_register(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        safe_int(F.col("exercicio")).alias("exercicio"),
        digits_key(F.col("numero_patrimonio")).alias("numero_patrimonio"),
        strip(F.col("descricao_bem")).alias("descricao_bem"),
        safe_int(F.col("codigo_area_carga")).alias("codigo_area_carga"),
        mixed_decimal(F.col("valor_atual")).alias("valor_atual"),
        normal_upper(F.col("situacao_bem")).alias("situacao_bem"),
    )


def stg_register(bronze: DataFrame) -> DataFrame:
    """Typed register; rows that only differed in spelling are one row."""
    return distinct_rows(type_register(bronze))


def type_readings(bronze: DataFrame) -> DataFrame:
    """Typed readings. The operator's login is personal data and ends here."""
    return _typed_readings(bronze, strip(F.col("id_leitura")))


def _typed_readings(bronze: DataFrame, ident: Column) -> DataFrame:
    return bronze.select(
        ident.alias("id_leitura"),
        safe_int(F.col("exercicio"), any_blanks=False).alias("exercicio"),
        digits_key(F.col("numero_patrimonio")).alias("numero_patrimonio"),
        safe_int(F.col("local_codigo_area"), any_blanks=False).alias("codigo_area"),
        strip(F.col("local_espaco_fisico")).alias("espaco_fisico"),
        flexible_timestamp(F.col("coletado_em")).alias("coletado_em"),
        token_or(F.col("origem_leitura"), NO_ORIGIN).alias("origem_recebida"),
        F.col("_arquivo_origem").alias("lote"),
    )


def first_arrivals(bronze: DataFrame) -> DataFrame:
    """Typed readings without resends: per id the earliest batch; ties go by content.

    The rows are cut to the earliest batch as received and typed behind the
    shuffle, so repeats are never typed and one unsplit file is typed by many tasks.
    """
    named = bronze.withColumn("id_leitura", strip(F.col("id_leitura")))
    received = earliest(named, ["id_leitura"], "_arquivo_origem")
    ties = ["coletado_em", "espaco_fisico", "codigo_area", "numero_patrimonio", "origem_recebida"]
    return keep_first(_typed_readings(received, F.col("id_leitura")), ["id_leitura"], "lote", ties)


def stg_readings(bronze: DataFrame, origins: DataFrame) -> DataFrame:
    """Readings without resends, the received origin translated by the lookup."""
    arrived = first_arrivals(bronze)
    return arrived.join(origins, "origem_recebida", "left").select(
        "id_leitura",
        *ASSET,
        "codigo_area",
        "espaco_fisico",
        "coletado_em",
        "origem_recebida",
        "origem_leitura",
        "tipo_captura",
        "lote",
    )


def active(register: DataFrame) -> DataFrame:
    return register.filter(F.col("situacao_bem") == ACTIVE)


def tagged(readings: DataFrame, register: DataFrame) -> DataFrame:
    """Readings with ``ativo``: whether an active asset has their year and number.

    One pass from which accepted and rejected readings are split.
    """
    known = active(register).select(*ASSET_KEY).distinct().withColumn("_ativo", F.lit(True))
    marked = left_lookup(readings, known, ASSET_KEY, scatter_by=["id_leitura"])
    return marked.select(*readings.columns, F.col("_ativo").isNotNull().alias("ativo"))


def not_quarantined(readings: DataFrame, register: DataFrame) -> DataFrame:
    """Readings whose id is not in the quarantine; a NULL id equals no other, so its row stays.

    Ids are unique here, so the mark of the row itself decides and the
    quarantine need not be computed and joined by id.
    """
    return tagged(readings, register).filter(F.col("ativo") | F.col("id_leitura").isNull()).drop("ativo")


def quarantine(readings: DataFrame, register: DataFrame) -> DataFrame:
    """Readings of no active asset, kept with the reason."""
    reason = F.when(F.col("numero_patrimonio").isNull(), NO_NUMBER).otherwise(NOT_IN_REGISTER)
    rejected = unmatched(readings, active(register), ASSET_KEY, scatter_by=["id_leitura"])
    return rejected.select(
        "id_leitura",
        *ASSET,
        "codigo_area",
        "espaco_fisico",
        "coletado_em",
        "origem_leitura",
        reason.alias("motivo"),
        "lote",
    )
