"""Batch files ingested as they arrive, with the same rules as the batch run.

The stream only notices new paths; whether a file is new is still decided by
its content against the ledger, so a restart or a renamed copy adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stocktake.plans.bronze import APPEND
from stocktake.plans.ingest import FILES_PER_COMMIT, Source, land
from stocktake.sources.files import list_paths

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_arrivals(spark: SparkSession, source: Source, raw: str, bronze: str) -> StreamingQuery:
    """Take in every file that has arrived since the last call, then stop.

    New content under a known path goes unnoticed, so sources that are replaced
    in place have to be ingested in batch.
    """
    if source.mode != APPEND:
        raise ValueError(f"{source.table} is replaced in place; a stream sees new paths only")
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", source.glob)
        .option("maxFilesPerTrigger", FILES_PER_COMMIT)
        .load(f"{raw}/{source.subfolder}".rstrip("/"))
        .select("path")
    )

    def take(batch: DataFrame, _: int) -> None:
        paths = [row["path"] for row in batch.collect()]  # bounded by maxFilesPerTrigger
        if paths:
            land(batch.sparkSession, source, list_paths(batch.sparkSession, paths), bronze)

    return (
        arrived.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{bronze}/_arrivals/{source.table}")
        .trigger(availableNow=True)
        .start()
    )
