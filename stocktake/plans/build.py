"""Bronze to Gold, every table written once and read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stocktake.plans import gold, silver
from stocktake.plans.bronze import VersionedTable
from stocktake.plans.quality import run_checks
from stocktake.plans.rules import ALL_CHECKS
from stocktake.sources.seed import reading_origins
from stocktake.sources.tables import read_table, write_table


@dataclass(frozen=True)
class Bronze:
    areas: DataFrame
    register: DataFrame
    readings: DataFrame


def current_bronze(spark: SparkSession, path: str) -> Bronze:
    """The latest version of the three ingested tables."""

    def latest(name: str) -> DataFrame:
        return VersionedTable(spark, f"{path}/{name}").snapshot()

    return Bronze(latest("areas"), latest("carga_patrimonial"), latest("leituras_coleta"))


# Layer tables in build order: name -> folder below the output path.
FOLDERS = {
    "stg_areas": "silver",
    "stg_carga_patrimonial": "silver",
    "stg_leituras": "silver",
    "qrt_leituras_rejeitadas": "quarentena",
    "dim_area": "gold",
    "dim_origem_leitura": "gold",
    "fato_bem_inventariado": "gold",
}
SEED = "de_para_origem_leitura"


def build_layers(bronze: Bronze, path: str) -> dict[str, DataFrame]:
    """Write Silver, quarantine and Gold below ``path``.

    A table that several later steps read is computed once, a lost executor
    costs one step and not the chain, and each join sees real table sizes.
    """
    origins = reading_origins(bronze.areas.sparkSession)
    tables: dict[str, DataFrame] = {SEED: origins}

    def keep(name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        tables[name] = write_table(df, f"{path}/{FOLDERS[name]}/{name}", partition_by)
        return tables[name]

    areas = keep("stg_areas", silver.stg_areas(bronze.areas))
    register = keep("stg_carga_patrimonial", silver.stg_register(bronze.register))
    readings = keep("stg_leituras", silver.stg_readings(bronze.readings, origins))
    keep("qrt_leituras_rejeitadas", silver.quarantine(readings, register))
    dimension = keep("dim_area", gold.dim_area(areas))
    keep("dim_origem_leitura", gold.dim_origin(origins))
    keep("fato_bem_inventariado", gold.fact(register, readings, dimension), "exercicio")
    return tables


def open_layers(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of an earlier build."""
    tables = {name: read_table(spark, f"{path}/{folder}/{name}") for name, folder in FOLDERS.items()}
    return {SEED: reading_origins(spark), **tables}


def check_layers(tables: dict[str, DataFrame]) -> DataFrame:
    """The report over all rules."""
    return run_checks(ALL_CHECKS, tables)
