"""Incremental landing: new raw files -> persistent Parquet, exactly once.

The batch job (G5) re-reads a whole landing folder; here Spark's file stream
source remembers which files it has already taken (in the checkpoint), so
each run converts only files that arrived since - the "skip what is already
stored" step of the collector, done by the engine.  ``availableNow`` processes
everything present and stops, so the same code runs as a scheduled job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propmart.functions.conform import conform
from propmart.sources.raw import bind_by_header, header_lines, json_records, json_texts, listings_from_records
from propmart.sources.splitting import JsonArray, csv_records, fragments, json_elements, numbered


def persist_listing_stream(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str, json_lines: bool = False, max_files_per_trigger: int | None = None):
    """Append new listing files to the persistent zone, strictly typed (S2); returns the finished query.

    Every micro-batch holds whole files, whose arrays are cut into records by
    all tasks.  It is written to ``out_dir/batch=<id>`` (overwrite), so a
    replayed batch replaces its own output.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if json_lines:
        return _run(json_texts(reader, landing_dir, json_lines=True), out_dir, checkpoint, lambda lines: listings_from_records(json_records(lines)))
    pieces = fragments(reader, landing_dir, "*.json", JsonArray.separator.decode())
    return _run(pieces, out_dir, checkpoint, lambda batch: listings_from_records(json_records(json_elements(batch))))


def persist_csv_stream(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint: str, names: dict[str, list[str]], schema: T.StructType):
    """Append new headered CSV files (rent, income, lookup) bound by header name.

    Each micro-batch holds whole files, so a file's header line and data lines
    meet in the same batch; every batch is written to its own folder
    (overwrite), which makes a replayed batch idempotent.
    """

    def typed(pieces: DataFrame) -> DataFrame:
        lines = csv_records(numbered(pieces))
        return conform(bind_by_header(lines, header_lines(lines), names), schema, keep=["source_file"])  # strict

    return _run(fragments(spark.readStream, landing_dir, "*.csv"), out_dir, checkpoint, typed)


def _run(stream: DataFrame, out_dir: str, checkpoint: str, convert):
    root = out_dir.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = convert(batch).withColumn("ingest_ts", F.unix_timestamp().cast("bigint"))
        rows.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
