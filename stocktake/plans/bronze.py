"""Versioned all-text tables: one version per received file.

A table is a folder with ``data/execucao=<run>`` (Parquet, the version number a
column) and ``ledger`` (one row per version, appended to by each run in one
file). A run writes its data first and its ledger last; readers join the data to
the runs of the ledger, so a run that died half-way stays invisible. One folder
per run, not per file, keeps the number of directories and files small when many
files arrive. The ledger has one writer at a time; a second one is noticed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

APPEND, OVERWRITE = "Append", "Overwrite"
#: The version at which a row is seen, where several are read at once.
READ_AT = "_lida_em"

# ISO text in UTC to the second, from the epoch: the session time zone plays no part.
UTC_NOW = """concat(translate(cast(
    timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, unix_seconds(current_timestamp()))
    AS string), ' ', 'T'), '+00:00')"""

LEDGER = T.StructType(
    [
        T.StructField("versao", T.IntegerType()),
        T.StructField("momento", T.TimestampType()),
        T.StructField("operacao", T.StringType()),
        T.StructField("modo", T.StringType()),
        T.StructField("arquivo_origem", T.StringType()),
        T.StructField("hash_arquivo", T.StringType()),
        T.StructField("num_linhas", T.LongType()),
        T.StructField("colunas", T.ArrayType(T.StringType())),
        T.StructField("execucao", T.StringType()),
    ]
)


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


class VersionedTable:
    """Handle on one table folder; every read looks at the ledger anew."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- history ---------------------------------------------------------

    def history(self) -> DataFrame:
        """The ledger, one row per version; empty where no table exists yet."""
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER)

    def history_report(self) -> DataFrame:
        """The ledger for reading, oldest version first."""
        return (
            self.history()
            .orderBy("versao")
            .select(
                "versao",
                F.date_format("momento", "dd/MM/yyyy HH:mm:ss").alias("quando"),
                "operacao",
                F.coalesce("arquivo_origem", F.lit("")).alias("arquivo_origem"),
            )
        )

    def latest(self) -> DataFrame:
        """The greatest version as a one-row DataFrame, NULL without a table."""
        return self.history().agg(F.max("versao").alias("versao"))

    def latest_version(self) -> int | None:
        return self.latest().first()["versao"]

    # -- read ------------------------------------------------------------

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The rows visible at a version (the latest by default).

        Visible are the versions from the last overwrite on. The column list
        comes from the ledger, so no data footer is read to merge schemas, and
        columns an older version lacks are NULL.
        """
        last, first = self._bounds(version)
        return self._rows(first, last)

    def snapshots(self, versions: Sequence[int]) -> DataFrame:
        """The rows visible at each of some versions, from one scan, with the version in ``READ_AT``.

        A row that several of them show comes once for each; columns that only
        some have are NULL in the others.
        """
        bounds = {v: self._bounds(v) for v in versions}
        rows = self._rows(min(first for _, first in bounds.values()), max(last for last, _ in bounds.values()))
        shown = [F.when(F.col("_versao").between(first, last), F.lit(v)) for v, (last, first) in bounds.items()]
        return rows.select("*", F.explode(F.array_compact(F.array(*shown))).alias(READ_AT))

    def _bounds(self, version: int | None) -> tuple[int, int]:
        """The last and the first version that a snapshot shows."""
        upto = self.history() if version is None else self.history().filter(F.col("versao") <= version)
        overwritten = F.when(F.col("modo") == OVERWRITE, F.col("versao"))
        bounds = upto.agg(F.max("versao").alias("last"), F.coalesce(F.max(overwritten), F.lit(0)).alias("first"))
        last, first = bounds.first()
        if last is None or (version is not None and version > last):
            raise ValueError(f"no version {version} in {self.path}")
        return last, first

    def _rows(self, first: int, last: int) -> DataFrame:
        """Rows of committed versions; the runs that hold none of them are pruned when the ledger is joined."""
        visible = self.history().filter(F.col("versao").between(first, last))
        # One row per different column list, however many versions and runs there are.
        lists = visible.groupBy("colunas").agg(F.min("versao").alias("since")).orderBy("since").collect()
        columns = list(dict.fromkeys(c for row in lists for c in row["colunas"]))
        texts = [T.StructField(c, T.StringType()) for c in columns]
        schema = T.StructType([T.StructField("_versao", T.IntegerType()), *texts, T.StructField("execucao", T.StringType())])
        data = self.spark.read.schema(schema).parquet(f"{self.path}/data").filter(F.col("_versao").between(first, last))
        committed = visible.select("execucao").distinct()
        return data.join(committed, "execucao", "left_semi").select("_versao", *(f"`{c}`" for c in columns))

    # -- write -----------------------------------------------------------

    def commit(self, rows: DataFrame, files: DataFrame, mode: str) -> None:
        """Write the rows of new files, one version per file.

        ``files`` holds ``arquivo_origem, path, hash_arquivo, _ordem`` for a
        bounded number of files (see ``ingest``), ``_ordem`` counting from 0.
        ``rows`` carries ``_arquivo_origem`` and ``_path``; all other columns
        are kept as text.
        """
        self.commit_parts([(rows, files)], mode)

    def commit_parts(self, parts: Sequence[tuple[DataFrame, DataFrame]], mode: str) -> None:
        """The same for files whose rows have columns of their own: one job writes all parts, in one run.

        Each version keeps the column list of its part, so a version that a
        later one of the same run replaces stays readable as it was received.
        ``_ordem`` counts through all parts.
        """
        newest = self.latest_version()
        start = 0 if newest is None else newest + 1
        run = uuid.uuid4().hex
        target = f"{self.path}/data/execucao={run}"
        stray = F.raise_error(F.concat(F.lit("row of a file that is not listed: "), F.col("_path")))
        version = F.coalesce("versao", stray.cast("int")).alias("_versao")
        written, entries = [], []
        for rows, files in parts:
            numbered = files.withColumn("versao", (F.col("_ordem") + F.lit(start)).cast("int"))
            received = [c for c in rows.columns if c not in ("_arquivo_origem", "_path")]
            columns = [*received, "_arquivo_origem", "_ingerido_em"]
            stamped = all_text(rows).withColumn("_ingerido_em", F.expr(UTC_NOW))
            # as few as a run's files; rows joined by shuffling would meet in one task per file
            versions = F.broadcast(numbered.select(F.col("path").alias("_path"), "versao"))
            written.append(stamped.join(versions, "_path", "left").select(version, *(f"`{c}`" for c in columns)))
            entries.append(numbered.select("versao", "arquivo_origem", "hash_arquivo", F.array(*(F.lit(c) for c in columns)).alias("colunas")))
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written).write.parquet(target)

        stored = self.spark.read.schema("_versao int").parquet(target)
        counted = stored.groupBy(F.col("_versao").alias("versao")).agg(F.count(F.lit(1)).alias("num_linhas"))
        ledger = reduce(DataFrame.unionByName, entries).join(counted, "versao", "left").select(
            "versao",
            F.current_timestamp().alias("momento"),
            F.lit("WRITE").alias("operacao"),
            F.lit(mode).alias("modo"),
            "arquivo_origem",
            "hash_arquivo",
            F.coalesce("num_linhas", F.lit(0)).cast("bigint").alias("num_linhas"),
            "colunas",
            F.lit(run).alias("execucao"),
        )
        # one file, so that a run appears as a whole; its rows are as few as the run's files
        ledger.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        twice = self.history().groupBy("versao").count().filter("count > 1")
        if not twice.isEmpty():
            raise RuntimeError(f"another writer has written the same versions to {self.path}")


def compare_versions(
    table: VersionedTable, summary, version: int | None = None, label: str = "versao"
) -> DataFrame:
    """``summary`` of an earlier version and of the latest, stacked.

    The earlier version defaults to the one before the latest. A summary that
    groups by ``READ_AT`` where it finds it (see ``batch_summary``) costs one
    scan for both versions, any other one a scan each.
    """
    latest = table.latest_version()
    earlier = max(latest - 1, 0) if version is None else version
    compared = list(dict.fromkeys((earlier, latest)))
    both = summary(table.snapshots(compared))
    if READ_AT in both.columns:
        return both.select(*(c for c in both.columns if c != READ_AT), F.col(READ_AT).alias(label))
    return reduce(DataFrame.unionByName, [summary(table.snapshot(v)).withColumn(label, F.lit(v)) for v in compared])


def batch_summary(
    df: DataFrame, keys: Sequence[str], latest: str = "_ingerido_em", latest_as: str = "ultima_ingestao"
) -> DataFrame:
    """Rows, batches and the latest ingestion (or other text) per key, and per version read if there are several."""
    return df.groupBy(*keys, *(c for c in (READ_AT,) if c in df.columns)).agg(
        F.count(F.lit(1)).alias("leituras"),
        F.countDistinct("_arquivo_origem").alias("lotes"),
        F.max(latest).alias(latest_as),
    )
