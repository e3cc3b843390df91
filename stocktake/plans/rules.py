"""The check list of the stock-take layers."""

from __future__ import annotations

from stocktake.plans.gold import ELSEWHERE, LOCATED, MISSING
from stocktake.plans.quality import WARN, Check
from stocktake.plans.silver import ASSET, NO_NUMBER, NOT_IN_REGISTER

# The accepted values of each coded column.
AREA_TYPE_VALUES = ("Judicial", "Administrativa")
REGISTER_STATUS_VALUES = ("ATIVO", "BAIXADO")
ORIGIN_VALUES = ("manual", "celular", "leitor_codigo_barras", "nao_informada")
CAPTURE_VALUES = ("Leitura automática", "Digitação", "Não informado")
INVENTORY_STATUS_VALUES = (LOCATED, ELSEWHERE, MISSING)
REASON_VALUES = (NO_NUMBER, NOT_IN_REGISTER)

FLAGS = ("localizado_na_area", "localizado_em_outra_area", "nao_localizado")


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, (c,)) for c in columns]


def _parent(table: str, column: str, parent: str, parent_column: str, **more) -> Check:
    return Check("relationships", table, (column,), parent=parent, parent_column=parent_column, **more)


SEED_CHECKS = [
    *_not_null("de_para_origem_leitura", "origem_recebida"),
    Check("unique", "de_para_origem_leitura", ("origem_recebida",)),
    Check("accepted_values", "de_para_origem_leitura", ("origem_leitura",), ORIGIN_VALUES),
]

SILVER_CHECKS = [
    *_not_null("stg_areas", "codigo_area", "tipo_area"),
    Check("unique", "stg_areas", ("codigo_area",)),
    Check("accepted_values", "stg_areas", ("tipo_area",), AREA_TYPE_VALUES),
    *_not_null("stg_carga_patrimonial", "exercicio", "numero_patrimonio", "valor_atual"),
    Check("accepted_values", "stg_carga_patrimonial", ("situacao_bem",), REGISTER_STATUS_VALUES),
    _parent("stg_carga_patrimonial", "codigo_area_carga", "stg_areas", "codigo_area", severity=WARN),
    *_not_null("stg_leituras", "id_leitura", "coletado_em", "codigo_area"),
    Check("unique", "stg_leituras", ("id_leitura",)),
    _parent("stg_leituras", "codigo_area", "stg_areas", "codigo_area", severity=WARN),
    _parent("stg_leituras", "origem_recebida", "de_para_origem_leitura", "origem_recebida"),
]

QUARANTINE_CHECKS = [
    *_not_null("qrt_leituras_rejeitadas", "id_leitura", "motivo"),
    Check("unique", "qrt_leituras_rejeitadas", ("id_leitura",)),
    Check("accepted_values", "qrt_leituras_rejeitadas", ("motivo",), REASON_VALUES),
]

GOLD_CHECKS = [
    *_not_null(
        "fato_bem_inventariado",
        "exercicio",
        "numero_patrimonio",
        "area_carga_id",
        "situacao_inventario",
        "valor_atual",
    ),
    _parent("fato_bem_inventariado", "area_carga_id", "dim_area", "area_id"),
    _parent("fato_bem_inventariado", "area_leitura_id", "dim_area", "area_id"),
    _parent("fato_bem_inventariado", "origem_leitura", "dim_origem_leitura", "origem_leitura"),
    Check("accepted_values", "fato_bem_inventariado", ("situacao_inventario",), INVENTORY_STATUS_VALUES),
    *_not_null("dim_area", "area_id", "comarca", "regiao"),
    Check("unique", "dim_area", ("area_id",)),
    *_not_null("dim_origem_leitura", "origem_leitura"),
    Check("unique", "dim_origem_leitura", ("origem_leitura",)),
    Check("accepted_values", "dim_origem_leitura", ("tipo_captura",), CAPTURE_VALUES),
]

LAYER_CHECKS = [
    Check("unique_key", "fato_bem_inventariado", tuple(ASSET)),
    Check("exclusive_flags", "fato_bem_inventariado", FLAGS),
    Check(
        "no_row_lost",
        "stg_leituras",
        ("id_leitura",),
        others=("fato_bem_inventariado", "qrt_leituras_rejeitadas"),
    ),
]

ALL_CHECKS = [*SEED_CHECKS, *SILVER_CHECKS, *QUARANTINE_CHECKS, *GOLD_CHECKS, *LAYER_CHECKS]
