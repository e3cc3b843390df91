"""Idempotent ingestion of received files into versioned tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.operators.sequence import global_sequence
from stocktake.plans.bronze import APPEND, OVERWRITE, VersionedTable
from stocktake.sources.delimited import read_delimited
from stocktake.sources.files import list_files, literal, local_names, same_files
from stocktake.sources.json_envelope import read_envelopes
from stocktake.sources.sheet import sheets_to_rows

# A slice of this many files is committed at once: its listing is small enough
# to broadcast and to name in one read, however many files arrive in total.
FILES_PER_COMMIT = 10_000
# Replaced files each have columns of their own, so each is a branch of the plan that writes them.
OVERWRITES_PER_COMMIT = 50


def unseen_append(listing: DataFrame, history: DataFrame) -> DataFrame:
    """Files whose content is in no commit; equal new files count once, by name."""
    first = listing.groupBy("hash_arquivo").agg(
        F.min(F.struct("arquivo_origem", *(c for c in listing.columns if c not in ("arquivo_origem", "hash_arquivo"))))
        .alias("_file")
    )
    fresh = first.select("hash_arquivo", "_file.*").select(*listing.columns)
    return fresh.join(history.select("hash_arquivo"), "hash_arquivo", "left_anti").select(*listing.columns)


def unseen_overwrite(listing: DataFrame, history: DataFrame) -> DataFrame:
    """Files that differ from what was the latest content when they arrived.

    Taken by name, a file is new unless it equals the file before it; the
    first one is compared with the last commit. Old content that comes back
    after a change is new again.
    """
    placed = global_sequence(listing, ["arquivo_origem"], "_ordem")
    last = history.agg(F.max_by("hash_arquivo", "versao").alias("_before")).withColumn("_ordem", F.lit(0))
    previous = placed.select(F.col("hash_arquivo").alias("_before"), (F.col("_ordem") + 1).alias("_ordem"))
    compared = placed.join(previous.unionByName(last), "_ordem", "left")
    return compared.filter(~F.col("hash_arquivo").eqNullSafe(F.col("_before"))).select(*listing.columns)


def unseen(listing: DataFrame, history: DataFrame, mode: str) -> DataFrame:
    return (unseen_append if mode == APPEND else unseen_overwrite)(listing, history)


def ingest(
    table: VersionedTable,
    listing: DataFrame,
    read_rows: Callable[[DataFrame], DataFrame],
    mode: str,
    files_per_commit: int = FILES_PER_COMMIT,
) -> int:
    """Commit the new files of a listing and return how many there were.

    ``read_rows`` turns a slice of the listing into rows with
    ``_arquivo_origem`` and ``_path``. An overwrite replaces the columns too,
    so each such file is read with its own, but one job writes a slice of them.
    """
    step = min(files_per_commit, OVERWRITES_PER_COMMIT) if mode == OVERWRITE else files_per_commit
    fresh = global_sequence(unseen(listing, table.history(), mode), ["arquivo_origem"], "_ordem").checkpoint()
    total = fresh.count()
    for begin in range(0, total, step):
        part = fresh.filter(F.col("_ordem").between(begin, begin + step - 1))
        part = part.withColumn("_ordem", F.col("_ordem") - begin)
        if mode == OVERWRITE:
            files = [part.filter(F.col("_ordem") == i) for i in range(min(step, total - begin))]
            table.commit_parts([(read_rows(one), one) for one in files], mode)
        else:
            table.commit(read_rows(part), part, mode)
    return total


@dataclass(frozen=True)
class Source:
    """A kind of received file and the table it lands in."""

    table: str
    glob: str
    mode: str
    read: Callable[[SparkSession, list[str]], DataFrame]
    subfolder: str = ""


def _read_books(spark: SparkSession, paths: list[str]) -> DataFrame:
    books = spark.read.format("binaryFile").load(paths)
    return sheets_to_rows(books.select(F.col("_metadata.file_path").alias("path"), "content")).drop("_linha")


AREAS = Source("areas", "areas.xlsx", OVERWRITE, _read_books)
REGISTER = Source("carga_patrimonial", "carga_patrimonial.csv", OVERWRITE, read_delimited)
# What every reading of a batch has; fields beyond these become columns of their own.
READING = """id_leitura string, exercicio string, numero_patrimonio string, origem_leitura string, coletor string,
    coletado_em string, local struct<codigo_area: string, espaco_fisico: string>"""


def _read_batches(spark: SparkSession, paths: list[str]) -> DataFrame:
    return read_envelopes(spark, paths, "leituras", record=T.StructType.fromDDL(READING))


READINGS = Source("leituras_coleta", "*.json", APPEND, _read_batches, "leituras")


def land(spark: SparkSession, source: Source, listing: DataFrame, bronze: str) -> int:
    """Ingest the listed files of a source; the number of versions written."""

    def read_rows(files: DataFrame) -> DataFrame:
        listed = [r["path"] for r in files.select("path").toLocalIterator()]  # one slice, see FILES_PER_COMMIT
        paths = [literal(p) for p in local_names(listed)]
        # by a scan of the same paths, as a source may read pieces of a file
        if not same_files(spark.read.format("binaryFile").load(paths).inputFiles(), listed):
            raise ValueError(f"the files read for {source.table} are not those listed")
        return source.read(spark, paths)

    return ingest(VersionedTable(spark, f"{bronze}/{source.table}"), listing, read_rows, source.mode)


def run_bronze(spark: SparkSession, raw: str, bronze: str) -> int:
    """Ingest all sources of a drop folder; the number of versions written. A source without a file is an error."""
    listings = []
    for source in (AREAS, REGISTER, READINGS):
        folder = f"{raw}/{source.subfolder}".rstrip("/")
        listing = list_files(spark, folder, source.glob)
        if listing.isEmpty():
            raise FileNotFoundError(f"{folder}/{source.glob}")
        listings.append((source, listing))
    return sum(land(spark, source, listing, bronze) for source, listing in listings)
