"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import binding, drops
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
from stocktake.operators.dedup import keep_latest, last_with_count
from stocktake.operators.joins import matched
from stocktake.operators.sequence import global_sequence
from stocktake.plans import gold, quality, reports, rules, silver
from stocktake.plans.bronze import APPEND, OVERWRITE, VersionedTable, all_text, batch_summary, compare_versions
from stocktake.plans.build import Bronze, build_layers, check_layers
from stocktake.plans.ingest import AREAS, READINGS, REGISTER, ingest, land, run_bronze, unseen_append, unseen_overwrite
from stocktake.session import new_work_path
from stocktake.sources.delimited import read_delimited
from stocktake.sources.files import list_files
from stocktake.sources.json_envelope import read_envelopes
from stocktake.sources.seed import reading_origins
from stocktake.sources.sheet import sheets_to_rows
from stocktake.sources.tables import write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- layers over the given tables --------------------------------------------
# One handle per session and folder: a plan, not data; every query still runs it.


@cache
def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_areas(binding.bronze_areas(spark, sf_dir))


@cache
def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_register(binding.bronze_register(spark, sf_dir))


@cache
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_readings(binding.bronze_readings(spark, sf_dir), reading_origins(spark))


@cache
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quarantine(readings(spark, sf_dir), register(spark, sf_dir))


@cache
def area_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_area(areas(spark, sf_dir))


@cache
def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact without its area ids led to the dimension, which the reports do on their totals."""
    return gold.asset_states(register(spark, sf_dir), readings(spark, sf_dir))


@cache
def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact(register(spark, sf_dir), readings(spark, sf_dir), area_dimension(spark, sf_dir))


def built_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers, written anew by each query on them."""
    bronze = Bronze(
        binding.bronze_areas(spark, sf_dir),
        binding.bronze_register(spark, sf_dir),
        binding.bronze_readings(spark, sf_dir),
    )
    return build_layers(bronze, new_work_path(spark, "layers"))


# -- sources -------------------------------------------------------------------


@query
def src_sheet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["codigo", "nome", "segmento", "saldo", "atualizado_em"]
    return sheets_to_rows(binding.customer_workbooks(spark, sf_dir), columns).select(*columns)


@query
def src_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "csv")
    export = binding.customer_export(spark, sf_dir)
    (
        export.write.option("header", True)
        .option("sep", ";")
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )
    return read_delimited(spark, [path], line_breaks_in_values=True).drop("_arquivo_origem", "_path")


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_work_path(spark, "json")
    binding.reading_documents(spark, sf_dir).write.json(path)
    return read_envelopes(spark, [path], "leituras", one_per_line=True)


@query
def src_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(spark, sf_dir).select("id_leitura", "numero_patrimonio", "origem_leitura")


@query
def src_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(spark, sf_dir).select(
        "id_leitura", "local_codigo_area", "local_espaco_fisico", "confirmada", "valor"
    )


# -- ingestion -------------------------------------------------------------------


def _batch_day() -> Column:
    return F.substring("arquivo_origem", 14, 2).cast("int")


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.batch_listing(binding.daily_batches(spark, sf_dir))


@query
def ing_version_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = binding.daily_batches(spark, sf_dir).select(F.col("_arquivo_origem").alias("arquivo_origem")).distinct()
    return global_sequence(files, ["arquivo_origem"], "versao")


@query
def ing_file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listing(spark, sf_dir).select("arquivo_origem", "tamanho", "hash_arquivo")


@query
def ing_skip_seen_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half of the month already in; every file received again, also under a second name."""
    listing = _listing(spark, sf_dir)
    renamed = listing.withColumn("arquivo_origem", F.concat(F.lit("reenvio_"), "arquivo_origem"))
    history = listing.filter(_batch_day() <= 15).select("hash_arquivo")
    return unseen_append(listing.unionByName(renamed), history).select("arquivo_origem", "hash_arquivo")


@query
def ing_skip_seen_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A register whose content switches between two states; only switches are new."""
    weekend = F.dayofweek(F.substring("arquivo_origem", 6, 10).cast("date")).isin(1, 7)
    content = F.when(weekend, "fim de semana").otherwise("dia util")
    files = _listing(spark, sf_dir).select("arquivo_origem", content.alias("conteudo"))
    hashed = files.withColumn("hash_arquivo", F.sha2("conteudo", 256))
    history = spark.range(1).select(F.sha2(F.lit("dia util"), 256).alias("hash_arquivo"), F.lit(0).alias("versao"))
    return unseen_overwrite(hashed, history).select("arquivo_origem", "conteudo")


def _appended(spark: SparkSession, sf_dir: str) -> tuple[VersionedTable, list[DataFrame]]:
    """A table fed in three runs, and each run's listing: half a month, the whole month, the same again.

    The first half arrives without the ``props`` column.
    """
    table = VersionedTable(spark, new_work_path(spark, "append"))
    batches = binding.daily_batches(spark, sf_dir)
    listing = binding.batch_listing(batches).checkpoint()

    def rows(columns: list[str]) -> Callable[[DataFrame], DataFrame]:
        named = batches.select(*columns, "_arquivo_origem", F.col("_arquivo_origem").alias("_path"))
        return lambda files: _of_files(named, files)

    early = listing.filter(_batch_day() <= 15)
    narrow, wide = ["event_id", "user_id", "event_type"], ["event_id", "user_id", "event_type", "props"]
    runs = [(early, narrow), (listing, wide), (listing, wide)]
    for files, columns in runs:
        ingest(table, files, rows(columns), APPEND)
    return table, [files for files, _ in runs]


def _overwritten(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """A register delivered three times, each period of the month replacing the one before."""
    table = VersionedTable(spark, new_work_path(spark, "overwrite"))
    day = F.dayofmonth("ts")
    period = F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3)
    name = F.concat(F.lit("periodo_"), period, F.lit(".csv"))
    rows = binding.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", name.alias("_arquivo_origem"), name.alias("_path")
    )
    ingest(table, binding.batch_listing(all_text(rows)), lambda files: _of_files(rows, files), OVERWRITE)
    return table


def _of_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of one commit's files, whose number ``ingest`` bounds."""
    return rows.join(files.select(F.col("path").alias("_path")), "_path", "left_semi")


@query
def ing_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received files from the listings, written ones from the ledger, where a run without news has no entry."""
    table, listings = _appended(spark, sf_dir)
    numbered = [files.select(F.lit(number).alias("rodada")) for number, files in enumerate(listings, start=1)]
    received = reduce(DataFrame.unionAll, numbered).groupBy("rodada").agg(F.count("*").alias("recebidos"))
    runs = table.history().groupBy("execucao").agg(F.count("*").alias("gravados"), F.min("versao").alias("_first"))
    written = global_sequence(runs, ["_first"], "rodada", start=1).select("rodada", "gravados")
    counted = received.join(written, "rodada", "left").withColumn("gravados", F.coalesce("gravados", F.lit(0).cast("long")))
    return counted.withColumn("ignorados", F.col("recebidos") - F.col("gravados"))


def _landed_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, VersionedTable, int, int]:
    """Daily batch files written, listed by their bytes and landed, and the same folder once more."""
    folder, bronze = new_work_path(spark, "drop"), new_work_path(spark, "bronze")
    binding.write_daily_documents(spark, sf_dir, folder)
    listing = list_files(spark, folder, READINGS.glob)
    first, second = (land(spark, READINGS, listing, bronze) for _ in range(2))
    return listing, VersionedTable(spark, f"{bronze}/{READINGS.table}"), first, second


@query
def ing_real_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per received file: its size, the SHA-256 of its bytes, its version and rows; and what either run wrote."""
    listing, table, first, second = _landed_twice(spark, sf_dir)
    versions = table.history().select("arquivo_origem", "hash_arquivo", "versao", "num_linhas")
    found = listing.select("arquivo_origem", "tamanho", "hash_arquivo").join(versions, ["arquivo_origem", "hash_arquivo"], "left")
    return found.withColumns({"primeira_rodada": F.lit(first), "segunda_rodada": F.lit(second)})


@query
def ing_real_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of those files as the table shows them: nested fields flattened, all text, with their file."""
    columns = ["id_leitura", "exercicio", "numero_patrimonio", "local_codigo_area", "local_espaco_fisico", "origem_leitura", "coletor", "coletado_em"]
    return _landed_twice(spark, sf_dir)[1].snapshot().select("_versao", *columns, "_arquivo_origem")


@query
def pipeline_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ingestion of a drop of all three sources, run twice: versions and rows per table, commits per run."""
    raw, bronze = new_work_path(spark, "raw"), new_work_path(spark, "bronze")
    binding.raw_drop(spark, sf_dir, raw)
    first, second = (run_bronze(spark, raw, bronze) for _ in range(2))
    tables = []
    for source in (AREAS, REGISTER, READINGS):
        history = VersionedTable(spark, f"{bronze}/{source.table}").history()
        counts = history.agg(F.count(F.lit(1)).alias("versoes"), F.sum("num_linhas").alias("linhas"))
        tables.append(counts.select(F.lit(source.table).alias("tabela"), "versoes", "linhas"))
    return reduce(DataFrame.unionAll, tables).withColumns({"primeira_rodada": F.lit(first), "segunda_rodada": F.lit(second)})


# -- versioned tables ----------------------------------------------------------------


@query
def bronze_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_text(binding.table(spark, sf_dir, "events"))


@query
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = F.col("_ingerido_em").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    snapshot = _appended(spark, sf_dir)[0].snapshot()
    return snapshot.select("event_id", "_arquivo_origem", stamped.alias("com_ingestao"))


@query
def bronze_append_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = _appended(spark, sf_dir)[0].snapshot()
    return snapshot.groupBy("_versao").agg(F.count(F.lit(1)).alias("linhas"), F.count("props").alias("com_props"))


@query
def bronze_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overwritten(spark, sf_dir).snapshot().select("event_id", "event_type", "_arquivo_origem")


@query
def bronze_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _appended(spark, sf_dir)[0].history()
    return history.select("versao", "operacao", "modo", "arquivo_origem", "hash_arquivo", "num_linhas")


@query
def bronze_latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, sf_dir)[0].latest()


@query
def bronze_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, sf_dir)[0].snapshot(10).select("event_id", "event_type", "_arquivo_origem")


def _event_summary(df: DataFrame) -> DataFrame:
    return batch_summary(df, ["event_type"], latest="_arquivo_origem", latest_as="ultimo_lote")


@query
def bronze_as_of_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_versions(_appended(spark, sf_dir)[0], _event_summary, version=10)


@query
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_summary(_appended(spark, sf_dir)[0].snapshot())


@query
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = write_table(fact(spark, sf_dir), new_work_path(spark, "fact"), ["exercicio"])
    return stored.groupBy("exercicio").agg(
        F.count(F.lit(1)).alias("bens"), F.sum("valor_atual").cast("decimal(38,2)").alias("valor")
    )


@query
def lookup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("id_leitura", "origem_recebida", "origem_leitura", "tipo_captura")


# -- filters and expressions ---------------------------------------------------------


@query
def filter_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.active(register(spark, sf_dir))


@query
def filter_like_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["numero_patrimonio", "valor_atual", "situacao_bem", "_arquivo_origem"]
    return reports.raw_defects(binding.bronze_register(spark, sf_dir), columns, "numero_patrimonio")


@query
def num_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.dirty_integers(spark, sf_dir).withColumn("inteiro", safe_int(F.col("texto")))


@query
def key_digits_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("numero_patrimonio")
    return binding.bronze_register(spark, sf_dir).select(text.alias("texto"), digits_key(text).alias("chave"))


@query
def num_br_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("valor_atual")
    return binding.bronze_register(spark, sf_dir).select(text.alias("texto"), mixed_decimal(text).alias("valor"))


@query
def date_two_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = binding.cycle(
        key,
        F.date_format(day, "yyyy-MM-dd 00:00:00"),
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "' 'd/M/yyyy' '"),
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.lit("31/02/"), F.year(day)),
    )
    return binding.table(spark, sf_dir, "orders").select(key.alias("id"), flexible_date(text).alias("dia"))


@query
def ts_two_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("coletado_em")
    return binding.bronze_readings(spark, sf_dir).select(
        "id_leitura", text.alias("texto"), flexible_timestamp(text).alias("momento")
    )


@query
def txt_squeeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.table(spark, sf_dir, "documents").select("doc_id", squeeze(F.col("text")).alias("texto"))


@query
def txt_proper_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.table(spark, sf_dir, "documents").select("doc_id", proper_name(F.col("text")).alias("texto"))


@query
def txt_strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = drop_leading_words(F.col("comarca"), "comarca", "de")
    return binding.dirty_names(spark, sf_dir).select("id", bare.alias("comarca"))


@query
def txt_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.dirty_names(spark, sf_dir).select("id", blank_to_null(strip(F.col("regiao"))).alias("regiao"))


@query
def txt_prefix_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = label_by_prefix(F.col("tipo_area"), silver.AREA_TYPES)
    return binding.dirty_names(spark, sf_dir).select("id", label.alias("tipo_area"))


@query
def txt_upper_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = normal_upper(F.col("situacao_bem"))
    return binding.bronze_register(spark, sf_dir).select("numero_patrimonio", cleaned.alias("situacao_bem"))


@query
def txt_default_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = token_or(F.col("origem_leitura"), silver.NO_ORIGIN)
    return binding.bronze_readings(spark, sf_dir).select("id_leitura", token.alias("origem_recebida"))


# -- one row per key -------------------------------------------------------------------


@query
def dedup_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = binding.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return keep_latest(events, ["user_id"], "ts", ties=["event_id"])


@query
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.first_arrivals(binding.bronze_readings(spark, sf_dir))


@query
def distinct_after_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register(spark, sf_dir)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched(readings(spark, sf_dir), silver.active(register(spark, sf_dir)), silver.ASSET_KEY)


@query
def last_event_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.last_readings(_accepted(spark, sf_dir)).drop("quantidade_leituras")


@query
def window_count_then_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["coletado_em", "id_leitura"]
    return last_with_count(_accepted(spark, sf_dir), silver.ASSET_KEY, order, ["id_leitura"], "quantidade_leituras")


# -- joins -------------------------------------------------------------------------------


@query
def join_left_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.assets_with_reading(register(spark, sf_dir), readings(spark, sf_dir))


@query
def quarantine_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(spark, sf_dir).select("id_leitura", "motivo")


@query
def anti_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.not_quarantined(readings(spark, sf_dir), register(spark, sf_dir))


@query
def semi_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("id_leitura", *silver.ASSET)


@query
def fk_or_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).select(*silver.ASSET, "area_carga_id", "area_leitura_id")


# -- layers --------------------------------------------------------------------------------


@query
def layer_stg_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas(spark, sf_dir)


@query
def layer_stg_carga(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register(spark, sf_dir)


@query
def layer_stg_leituras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir)


@query
def layer_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(spark, sf_dir)


@query
def dim_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_dimension(spark, sf_dir)


@query
def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The official origins that readings actually came with."""
    return gold.dim_origin(readings(spark, sf_dir))


@query
def layer_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir)


@query
def fact_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select(*silver.ASSET, "situacao_inventario")


@query
def fact_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select(
        *silver.ASSET, *rules.FLAGS, "quantidade_leituras", "data_ultima_leitura", "valor_nao_localizado"
    )


# -- questions -------------------------------------------------------------------------------


@query
def rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rate_by_year(states(spark, sf_dir))


@query
def rate_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rate_by_region(states(spark, sf_dir), area_dimension(spark, sf_dir))


@query
def rate_two_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rate_two_criteria(states(spark, sf_dir), area_dimension(spark, sf_dir))


@query
def role_playing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.misplaced_flow(states(spark, sf_dir), area_dimension(spark, sf_dir))


@query
def capture_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.capture_mix(states(spark, sf_dir), gold.dim_origin(reading_origins(spark)))


@query
def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quarantine_summary(rejected(spark, sf_dir))


@query
def count_by_raw_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by_value(binding.bronze_readings(spark, sf_dir), "origem_leitura", "leituras")


# -- quality -----------------------------------------------------------------------------------


def _labelled(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("tabela"), "coluna", "violacoes")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = quality.count_nulls(
        register(spark, sf_dir), ["exercicio", "numero_patrimonio", "valor_atual", "codigo_area_carga"]
    )
    read = quality.count_nulls(
        readings(spark, sf_dir), ["id_leitura", "numero_patrimonio", "codigo_area", "coletado_em", "origem_leitura"]
    )
    return _labelled(assets, "register").unionByName(_labelled(read, "readings"))


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before resends are dropped, so there is something to find."""
    return quality.repeated_values(silver.type_readings(binding.bronze_readings(spark, sf_dir)), "id_leitura")


@query
def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(states(spark, sf_dir), silver.ASSET)


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The received names against the official ones."""
    typed = silver.type_readings(binding.bronze_readings(spark, sf_dir))
    return quality.unexpected_values(typed, "origem_recebida", rules.ORIGIN_VALUES)


@query
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(register(spark, sf_dir), "codigo_area_carga", areas(spark, sf_dir), "codigo_area")


@query
def dq_exclusive_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_exclusive(states(spark, sf_dir), silver.ASSET, rules.FLAGS)


@query
def dq_no_row_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a quarantine that forgot the readings without a number.

    Readings and register are written once, as the layers are: the fact, the
    quarantine and the check would each make them again.
    """
    path = new_work_path(spark, "conservation")
    assets = write_table(register(spark, sf_dir), f"{path}/register")
    read = write_table(readings(spark, sf_dir), f"{path}/readings")
    incomplete = silver.quarantine(read, assets).filter(F.col("motivo") == silver.NOT_IN_REGISTER)
    return quality.lost_rows(read, gold.asset_states(assets, read), incomplete)


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_layers(built_layers(spark, sf_dir))
