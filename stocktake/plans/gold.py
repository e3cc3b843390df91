"""The star schema: two dimensions and one fact row per active asset and year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.operators.dedup import last_with_count
from stocktake.operators.joins import distinct_members, known_or_default, left_lookup, with_unknown_member
from stocktake.plans.silver import ASSET, ASSET_KEY, active

# Labels and the key of the unknown area.
UNKNOWN_AREA = -1
NOT_APPLICABLE, NOT_GIVEN = "Não se aplica", "Não informada"
UNKNOWN_ROW = {
    "area_id": UNKNOWN_AREA,
    "nome_area": "Área não cadastrada",
    "tipo_area": "Não informado",
    "comarca": NOT_GIVEN,
    "regiao": NOT_GIVEN,
}
ADMINISTRATIVE = "Administrativa"
LOCATED, ELSEWHERE, MISSING = "Localizado", "Localizado em outra área", "Não localizado"


def dim_area(areas: DataFrame) -> DataFrame:
    """Areas plus the unknown member; a blank district is told from one that cannot exist."""

    def place(name: str) -> Column:
        given = F.coalesce(F.col(name), F.lit(NOT_GIVEN))
        return F.when(F.col("tipo_area") == ADMINISTRATIVE, NOT_APPLICABLE).otherwise(given).alias(name)

    named = areas.select(
        F.col("codigo_area").alias("area_id"), "nome_area", "tipo_area", place("comarca"), place("regiao")
    )
    return with_unknown_member(named, **UNKNOWN_ROW)


def dim_origin(origins: DataFrame) -> DataFrame:
    return origins.select("origem_leitura", "tipo_captura").distinct()


def last_readings(readings: DataFrame) -> DataFrame:
    """Per asset the last reading and how many there were.

    All readings go in: one that is quarantined has no active asset, so its
    group meets no register row and needs no join to be kept out.
    """
    keyed = readings.filter(F.col("exercicio").isNotNull() & F.col("numero_patrimonio").isNotNull())
    return last_with_count(
        keyed,
        keys=ASSET_KEY,
        order=["coletado_em", "id_leitura"],
        keep=["codigo_area", "origem_leitura", "coletado_em"],
        count_as="quantidade_leituras",
    )


def assets_with_reading(register: DataFrame, readings: DataFrame) -> DataFrame:
    """Every active asset, with its last reading where there is one."""
    assets = active(register).select(*ASSET, "codigo_area_carga", "valor_atual")
    last = last_readings(readings).withColumnRenamed("codigo_area", "codigo_area_leitura")
    return left_lookup(assets, last, ASSET_KEY, scatter_by=["codigo_area_carga", "valor_atual"])


def status(read: Column, registered: Column) -> Column:
    """Three states; a reading that cannot be compared counts as elsewhere."""
    return F.when(read.isNull(), MISSING).when(read == registered, LOCATED).otherwise(ELSEWHERE)


def flag(condition: Column) -> Column:
    """1 or 0, where an undecided condition is 0."""
    return F.when(condition, 1).otherwise(0)


def asset_states(register: DataFrame, readings: DataFrame) -> DataFrame:
    """One row per active asset and year with state, flags and measures.

    The two area ids still hold the codes as received, which is also what the
    state compares: two unknown areas are only equal if their codes are.
    """
    read, registered = F.col("codigo_area_leitura"), F.col("codigo_area_carga")
    return assets_with_reading(register, readings).select(
        *ASSET,
        registered.alias("area_carga_id"),
        read.alias("area_leitura_id"),
        "origem_leitura",
        status(read, registered).alias("situacao_inventario"),
        flag(read == registered).alias("localizado_na_area"),
        flag(read != registered).alias("localizado_em_outra_area"),
        flag(read.isNull()).alias("nao_localizado"),
        F.coalesce("quantidade_leituras", F.lit(0)).cast("bigint").alias("quantidade_leituras"),
        F.col("coletado_em").cast("date").alias("data_ultima_leitura"),
        "valor_atual",
        F.when(read.isNull(), F.col("valor_atual"))
        .otherwise(F.lit(0).cast("decimal(14,2)"))
        .alias("valor_nao_localizado"),
    )


def fact(register: DataFrame, readings: DataFrame, areas: DataFrame) -> DataFrame:
    """The states with both area ids led to the dimension, its unknown row included."""
    rows = ["numero_patrimonio"]
    known, fetched = distinct_members(areas, "area_id")
    states = asset_states(register, readings)

    def led(df: DataFrame, key: str, keep_null: bool) -> DataFrame:
        return known_or_default(df, key, known, "area_id", UNKNOWN_AREA, keep_null, rows, fetched)

    return led(led(states, "area_carga_id", False), "area_leitura_id", True)
