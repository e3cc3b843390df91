"""The given tables presented as the three dirty sources.

Clean columns are rewritten as the kind of text the real sources deliver:
masked and padded numbers, two decimal conventions, two date formats, mixed
case, stray blanks, repeated and stale rows, codes nobody registered. Every
row of the tables is used; the key only decides which spelling a row gets.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog import drops, workbooks
from stocktake.sources.files import rows_digest

REGISTER_FILE = "carga_patrimonial.csv"
# Areas carry the nation key; register and readings are shifted against it, so
# the two highest codes they use are not registered.
AREA_SHIFT = 2


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def cycle(key: Column, *choices: Column | str) -> Column:
    """One of the choices, by the remainder of the key."""
    turn = F.pmod(key, F.lit(len(choices)))
    picked = F
    for i, choice in enumerate(choices[:-1]):
        picked = picked.when(turn == i, choice)
    return picked.otherwise(choices[-1])


def spelled_number(number: Column, key: Column) -> Column:
    text = number.cast("string")
    masked = F.concat(F.substring(text, 1, 3), F.lit("."), F.substring(text, 4, 20))
    return cycle(key, text, F.lpad(text, 8, "0"), F.concat(F.lit(" "), text, F.lit(" ")), masked)


def brazilian(amount: Column) -> Column:
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def bronze_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as areas, every seventh with a stale second row."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key, name, area_region = F.col("n_nationkey"), F.col("n_name"), F.col("r_name")
    office = area_region == "MIDDLE EAST"
    court = cycle(key, F.lit("Judicial"), F.lit("JUDICIAL"), F.lit("judicial "), F.lit(" judicial"))
    district = cycle(
        key,
        F.concat(F.lit("Comarca de "), F.lower(name)),
        F.concat(F.lit("  COMARCA   DE "), area_region, F.lit("  DO "), name),
        F.concat(F.lit(" "), F.lower(area_region), F.lit("  da   "), name),
    )
    day = F.date_add(F.lit("2026-01-01").cast("date"), key)
    current = F.struct(
        F.concat(F.lit("Área   de  "), name, F.lit(" ")).alias("nome_area"),
        F.when(office, cycle(key, F.lit("Adm."), F.lit("ADMINISTRATIVA"))).otherwise(court).alias("tipo_area"),
        F.when(office, "").otherwise(district).alias("comarca"),
        F.when(office, "").when(key == 7, "  ").otherwise(F.concat(F.lit(" "), area_region)).alias("regiao"),
        cycle(key, F.date_format(day, "yyyy-MM-dd 00:00:00"), F.date_format(day, "dd/MM/yyyy")).alias("atualizado_em"),
    )
    stale = F.struct(
        F.concat(F.lit("Area de "), name).alias("nome_area"),
        F.lit("Judicial").alias("tipo_area"),
        F.upper(name).alias("comarca"),
        F.lit(None).cast("string").alias("regiao"),
        F.lit("2024-11-08 00:00:00").alias("atualizado_em"),
    )
    versions = F.when(key % 7 == 0, F.array(current, stale)).otherwise(F.array(current))
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("codigo_area"), F.explode(versions).alias("v"))
        .select("codigo_area", "v.*", F.lit("areas.xlsx").alias("_arquivo_origem"))
    )


def bronze_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as registered assets.

    Every fiftieth order comes twice in another spelling; some come a second
    time with another value, which breaks the grain on purpose.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key, copy = F.col("o_orderkey"), F.col("copy")
    copies = F.concat(
        F.array(F.lit(0)),
        F.when(key % 50 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
        F.when(key % 300 == 7, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
    )
    year = F.year("o_orderdate").cast("string")
    amount = (F.col("o_totalprice").cast("decimal(14,2)") + F.when(copy == 2, 1).otherwise(0)).cast("decimal(14,2)")
    area = (F.col("c_nationkey") + AREA_SHIFT).cast("string")
    active = cycle(key + copy, F.lit("ATIVO"), F.lit("ATIVO"), F.lit("ATIVO"), F.lit("Ativo "))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("copy", F.explode(copies))
        .select(
            cycle(key, F.concat(F.lit(" "), year), year).alias("exercicio"),
            F.when(key % 401 == 0, "").otherwise(spelled_number(key, key + copy)).alias("numero_patrimonio"),
            F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("  ")).alias("descricao_bem"),
            F.when(key % 211 == 0, "N/D").otherwise(area).alias("codigo_area_carga"),
            F.when(key % 10 == 0, amount.cast("string")).otherwise(brazilian(amount)).alias("valor_atual"),
            F.when(F.col("o_orderstatus") == "P", "BAIXADO").otherwise(active).alias("situacao_bem"),
            F.lit(REGISTER_FILE).alias("_arquivo_origem"),
        )
    )


def raw_origin(part: Column, flag: Column, status: Column) -> Column:
    """What the app may have sent as the origin of a reading."""
    return (
        F.when(part % 53 == 0, F.lit(None))
        .when(part % 59 == 0, "  ")
        .when(part % 101 == 0, "drone")
        .when((flag == "A") & (status == "F"), "leitor_codigo_barras")
        .when(flag == "A", " Scanner")
        .when((flag == "N") & (status == "F"), "celular")
        .when(flag == "N", "mobile_celular")
        .when(status == "F", "manual")
        .otherwise("MOBILE_MANUAL ")
    )


def raw_moment(text: Column, key: Column) -> Column:
    """Cut out of the plain text, which no session time zone shifts."""
    day, clock = F.substring(text, 1, 10), F.substring(text, 12, 8)
    turned = F.concat_ws("/", F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4))
    return F.when(key % 3 == 0, F.concat_ws(" ", turned, F.substring(clock, 1, 5))).otherwise(F.concat_ws("T", day, clock))


def bronze_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as field readings; a repeated order line is a resend."""
    supplier = table(spark, sf_dir, "supplier")
    # The text of the moment by itself, as three columns are cut out of it.
    items = table(spark, sf_dir, "lineitem").withColumn("moment", F.col("l_shipdate").cast("string"))
    order, line, part, moment = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "moment"))
    number = F.when(part % 97 == 0, "").otherwise(spelled_number(order, order + line))
    area = F.when(part % 89 == 0, "S/N").otherwise((F.col("s_nationkey") + AREA_SHIFT).cast("string"))
    ident = F.concat_ws("-", order, line)
    return items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.when(line == 5, F.concat(F.lit(" "), ident, F.lit(" "))).otherwise(ident).alias("id_leitura"),
        F.year("l_shipdate").cast("string").alias("exercicio"),
        number.alias("numero_patrimonio"),
        raw_origin(part, F.col("l_returnflag"), F.col("l_linestatus")).alias("origem_leitura"),
        F.col("s_name").alias("coletor"),
        raw_moment(moment, line).alias("coletado_em"),
        area.alias("local_codigo_area"),
        F.concat(F.lit(" Sala "), F.lpad(part.cast("string"), 9, "0")).alias("local_espaco_fisico"),
        F.concat(F.lit("lote_"), F.substring(moment, 1, 7), F.lit(".json")).alias("_arquivo_origem"),
    )


def dirty_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with hand-typed district, region and type."""
    key, segment, name = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        cycle(
            key,
            F.concat(F.lit("Comarca de "), F.lower(name)),
            F.concat(F.lit("  COMARCA \t DE  "), segment, F.lit("  DOS "), name),
            F.concat(F.lower(segment), F.lit("   e   comarca de "), name),
            F.lit("   "),
        ).alias("comarca"),
        cycle(key, F.lit(""), F.lit("  "), F.concat(F.lit(" "), segment), segment).alias("regiao"),
        cycle(
            key,
            F.concat(F.lit("Judicial "), segment),
            F.lit(" ADMINISTRATIVA"),
            F.concat(F.lit("jud."), segment),
            F.lit("Adm."),
            segment,
            F.lit(None).cast("string"),
        ).alias("tipo_area"),
    )


def dirty_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    text = key.cast("string")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        cycle(
            key,
            text,
            F.concat(F.lit("  "), text, F.lit(" ")),
            F.concat(text, F.lit(".5")),
            F.concat(F.lit("-"), text, F.lit(".49")),
            F.concat(text, F.lit("e1")),
            F.concat(F.lit("x"), text),
            F.lit(""),
            F.concat(text, F.lit("00000000000")),
            F.concat(F.lit("+"), text),
        ).alias("texto"),
    )


# -- received batches ------------------------------------------------------


def daily_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of one received file per day, all text."""
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "props",
        F.concat(F.lit("lote_"), day, F.lit(".csv")).alias("_arquivo_origem"),
    )


def batch_listing(batches: DataFrame) -> DataFrame:
    """The received files of such rows, as a file scan would list them."""
    return batches.groupBy(F.col("_arquivo_origem").alias("arquivo_origem")).agg(
        F.count(F.lit(1)).alias("tamanho"),
        rows_digest("event_id", "user_id", "event_type").alias("hash_arquivo"),
    ).select("arquivo_origem", F.col("arquivo_origem").alias("path"), "tamanho", "hash_arquivo")


def reading_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as envelope documents with two nested readings each."""

    def reading(turn: int, channel: str) -> Column:
        return F.struct(
            F.concat_ws("-", "event_id", F.lit(turn)).alias("id_leitura"),
            F.col("user_id").alias("numero_patrimonio"),
            F.struct(
                F.pmod("user_id", F.lit(25)).alias("codigo_area"),
                F.concat(F.lit("Sala "), F.col("event_type")).alias("espaco_fisico"),
            ).alias("local"),
            F.lit(channel).alias("origem_leitura"),
            (F.col("event_id") % 2 == turn % 2).alias("confirmada"),
            F.col("value").alias("valor"),
        )

    return table(spark, sf_dir, "events").select(
        F.lit("coleta").alias("sistema"),
        F.year("ts").alias("exercicio"),
        F.col("ts").cast("string").alias("gerado_em"),
        F.array(reading(1, "celular"), reading(2, "manual")).alias("leituras"),
    )


def daily_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as parts of one JSON document per day, under file names that patterns and URLs know other uses for: ``name, head, event_id, part``."""
    day, year = F.col("ts").cast("date"), F.year("ts")
    local = F.struct(F.pmod("user_id", F.lit(25)).alias("codigo_area"), F.concat(F.lit(" Sala "), "event_type").alias("espaco_fisico"))
    reading = F.struct(
        F.col("event_id").cast("string").alias("id_leitura"),
        year.alias("exercicio"),
        F.lpad(F.col("user_id").cast("string"), 8, "0").alias("numero_patrimonio"),
        local.alias("local"),
        F.lit("celular").alias("origem_leitura"),
        F.lit("login.x").alias("coletor"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("coletado_em"),
    )
    text = F.col("day").cast("string")
    name = cycle(
        F.dayofyear("day"),
        F.concat(F.lit("lote_["), text, F.lit("].json")),
        F.concat(F.lit("lote "), text, F.lit(".json")),
        F.concat(F.lit("lote+"), text, F.lit("%20.json")),
    )
    head = F.concat(F.lit('{"sistema":"coleta","exercicio":'), F.col("year").cast("string"), F.lit(',"leituras":['))
    events = table(spark, sf_dir, "events").select(day.alias("day"), year.alias("year"), "event_id", F.to_json(reading).alias("part"))
    return events.select(name.alias("name"), head.alias("head"), "event_id", "part")


def write_daily_documents(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Those documents as files; a day's events are one document, which one task writes from the shuffle on."""
    drops.write_parts(daily_documents(spark, sf_dir), folder, ["event_id", "part"], ",", "]}")


def raw_drop(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The three sources as files: a workbook, a register export and a folder of daily batches."""
    columns = ["codigo_area", "nome_area", "tipo_area", "comarca", "regiao", "atualizado_em"]
    areas = bronze_areas(spark, sf_dir).select(*columns).coalesce(1)
    book = areas.groupBy().applyInPandas(
        lambda rows: pd.DataFrame({"name": ["areas.xlsx"], "content": [workbooks.text_book(rows)]}), "name string, content binary"
    )
    drops.write_documents(book, folder)
    register = bronze_register(spark, sf_dir).drop("_arquivo_origem")
    drops.write_lines(register.select(F.concat_ws(";", *register.columns)), folder, REGISTER_FILE, ";".join(register.columns), "latin-1")
    write_daily_documents(spark, sf_dir, f"{folder}/leituras")


def customer_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a register export with separators, quotes and line breaks inside values."""
    key = F.col("c_custkey")
    note = F.when(key % 10 == 0, F.concat(F.lit('linha 1; "caixa"\nlinha 2 '), F.col("c_mktsegment"))).otherwise("")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("numero"),
        F.concat(F.lit("Descrição "), F.col("c_name")).alias("descricao"),
        brazilian(F.col("c_acctbal").cast("decimal(14,2)")).alias("valor"),
        note.alias("observacao"),
    )


# -- workbooks -------------------------------------------------------------


def customer_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as small workbooks, one per record batch: ``path, content``."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    return rows.mapInPandas(workbooks.write_books, "path string, content binary")
