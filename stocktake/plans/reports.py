"""The published questions.

Facts are summed per foreign key before they meet a dimension, so the join
handles one row per year and area instead of one per asset, whatever the share
of a single area. Area ids that are no member count as the unknown area, so the
reports give the same on the fact and on its states with codes as received.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.operators.joins import described, role
from stocktake.operators.rates import percent, totals
from stocktake.plans.gold import UNKNOWN_ROW

MEASURES = {
    "localizados": "localizado_na_area",
    "em_outra_area": "localizado_em_outra_area",
    "nao_localizados": "nao_localizado",
    "valor_nao_localizado": "valor_nao_localizado",
}
COUNT = "bens_em_carga"


def _with_rate(summed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return summed.select(
        *keys,
        COUNT,
        "localizados",
        "em_outra_area",
        "nao_localizados",
        percent(F.col("localizados"), F.col(COUNT)).alias("taxa_localizacao_pct"),
        "valor_nao_localizado",
    )


def rate_by_year(fact: DataFrame) -> DataFrame:
    """Location rate and value not located, per year."""
    summed = totals(fact, ["exercicio"], MEASURES, count_as=COUNT)
    return _with_rate(summed, ["exercicio"]).orderBy("exercicio")


def totals_by_area(fact: DataFrame, areas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per year and the given columns of the registered area."""
    per_area = totals(fact, ["exercicio", "area_carga_id"], MEASURES, count_as=COUNT)
    named = described(per_area, "area_carga_id", areas, "area_id", UNKNOWN_ROW)
    again = {alias: alias for alias in MEASURES}
    return totals(named, ["exercicio", *keys], again, count_as=COUNT, counted=COUNT)


def rate_by_region(fact: DataFrame, areas: DataFrame) -> DataFrame:
    """The rate per year, region and district, worst first."""
    keys = ["exercicio", "regiao", "comarca"]
    rated = _with_rate(totals_by_area(fact, areas, keys[1:]), keys)
    return rated.orderBy("exercicio", "taxa_localizacao_pct", "regiao", "comarca")


def rate_two_criteria(fact: DataFrame, areas: DataFrame) -> DataFrame:
    """Any place counts against only the right place counts, widest gap first."""
    summed = totals_by_area(fact, areas, ["comarca"])
    anywhere: Column = F.col("localizados") + F.col("em_outra_area")
    rated = summed.select(
        "exercicio",
        "comarca",
        COUNT,
        percent(anywhere, F.col(COUNT)).alias("taxa_criterio_antigo_pct"),
        percent(F.col("localizados"), F.col(COUNT)).alias("taxa_criterio_novo_pct"),
    )
    gap = F.col("taxa_criterio_antigo_pct") - F.col("taxa_criterio_novo_pct")
    return rated.orderBy("exercicio", gap.desc_nulls_last(), "comarca")


def misplaced_flow(fact: DataFrame, areas: DataFrame, top: int | None = 15) -> DataFrame:
    """From which area to which the misplaced assets went, largest flows first."""
    flows = totals(fact, ["exercicio", "area_carga_id", "area_leitura_id"], {"bens": "localizado_em_outra_area"})
    named = flows.filter(F.col("bens") > 0)
    for part in ("carga", "leitura"):
        unknown = {f"{part}_{column}": value for column, value in UNKNOWN_ROW.items()}
        named = described(named, f"area_{part}_id", role(areas, part), f"{part}_area_id", unknown)
    named = named.select(
        "exercicio",
        F.col("carga_nome_area").alias("area_da_carga"),
        F.col("leitura_nome_area").alias("area_onde_foi_lido"),
        "bens",
    )
    keys = ["exercicio", "area_da_carga", "area_onde_foi_lido"]
    ranked = totals(named, keys, {"bens": "bens"}).orderBy(
        "exercicio", F.desc("bens"), "area_da_carga", "area_onde_foi_lido"
    )
    return ranked if top is None else ranked.limit(top)


def capture_mix(fact: DataFrame, origins: DataFrame) -> DataFrame:
    """How the located assets were captured, per year."""
    counted = totals(fact, ["exercicio", "origem_leitura"], {}, count_as="bens")
    named = counted.join(origins, "origem_leitura")
    keys = ["exercicio", "tipo_captura", "origem_leitura"]
    return totals(named, keys, {}, count_as="bens", counted="bens").orderBy(
        "exercicio", F.desc("bens"), "tipo_captura", "origem_leitura"
    )


def quarantine_summary(rejected: DataFrame) -> DataFrame:
    """Quarantined readings per reason and batch."""
    return totals(rejected, ["motivo", "lote"], {}, count_as="leituras").orderBy("lote", "motivo")


def raw_defects(bronze: DataFrame, columns: Sequence[str], number: str, top: int | None = 5) -> DataFrame:
    """Raw rows whose number is masked or zero-padded, a few of them by default."""
    defect = F.col(number).contains(".") | F.col(number).startswith("00")
    found = bronze.filter(defect).select(*columns)
    return found if top is None else found.orderBy(*columns).limit(top)


def count_by_value(df: DataFrame, column: str, count_as: str) -> DataFrame:
    """Rows per raw value, NULL included, most frequent first."""
    return totals(df, [column], {}, count_as=count_as).orderBy(F.desc(count_as), F.asc_nulls_last(column))


FACT, AREAS, ORIGINS, REJECTED = (
    "fato_bem_inventariado",
    "dim_area",
    "dim_origem_leitura",
    "qrt_leituras_rejeitadas",
)

QUESTIONS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "rate_by_year": lambda t: rate_by_year(t[FACT]),
    "rate_by_region": lambda t: rate_by_region(t[FACT], t[AREAS]),
    "rate_two_criteria": lambda t: rate_two_criteria(t[FACT], t[AREAS]),
    "misplaced_flow": lambda t: misplaced_flow(t[FACT], t[AREAS]),
    "capture_mix": lambda t: capture_mix(t[FACT], t[ORIGINS]),
    "quarantine_summary": lambda t: quarantine_summary(t[REJECTED]),
}
