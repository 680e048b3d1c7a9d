"""Writers (K1-K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.session import scratch_path
from propmart.sources.footers import read_footers, totals

TARGET_FILE_BYTES = 128 << 20


def persist_landing(df: DataFrame, path: str, batch_ts: int | None = None) -> None:
    """K1: typed snappy Parquet of one landing dataset.

    The source file name is a column (``source_file``) and the batch time is
    ``ingest_ts`` instead of being baked into each output file name.
    """
    ts = F.unix_timestamp() if batch_ts is None else F.lit(batch_ts)
    out = df.withColumn("ingest_ts", ts.cast("bigint"))
    write_zone(out, path, rebalance=True)


def write_zone(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int | None = None,
    rebalance: bool = False,
    keep_other_partitions: bool = False,
) -> None:
    """K2/K3: replace one zone dataset with ``df`` as snappy Parquet.

    File sizes follow the last stage: after a shuffle, adaptive execution has
    already merged/split its partitions to about the advisory size; after a
    scan they follow the input splits.  ``rebalance=True`` adds a
    ``REBALANCE`` (one more shuffle) for outputs whose last stage is badly
    sized, e.g. a narrow plan over many tiny files, or ``partition_by`` on a
    column the data is not clustered by.  ``overwrite`` replaces this dataset
    only, so the rest of the zone stays readable while it is written.
    """
    out = df
    if rebalance:
        out = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if keep_other_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_sized(df: DataFrame, path: str, target_bytes: int = TARGET_FILE_BYTES) -> tuple[int, int]:
    """K2: replace one dataset with files of about ``target_bytes``; returns (files, rows per file).

    ``df`` is computed once, into the shared scratch folder.  The footers of
    those files tell the bytes that a row takes, and from that follow the
    number of files and the most rows per file.
    """
    staged = scratch_path(df.sparkSession, "staged")
    df.write.option("compression", "snappy").parquet(staged)
    _, n_rows, n_bytes = totals(read_footers(df.sparkSession, staged))
    n_files = max(1, -(-n_bytes // target_bytes))
    per_file = max(1, -(-n_rows // n_files))
    out = df.sparkSession.read.schema(df.schema).parquet(staged).repartition(n_files)
    out.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", per_file + per_file // 4).parquet(path)
    return n_files, per_file


def write_kpi_csv(df: DataFrame, path: str, sort_by: Sequence[Column] = ()) -> None:
    """K4: headered CSV of a KPI, replacing the previous one.

    A sorted KPI is range-partitioned, so its files in name order are in sort
    order at any size; adaptive execution merges the ranges of a small KPI
    into one file.
    """
    out = df.orderBy(*sort_by) if sort_by else df
    out.write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """K5: save a fitted pipeline, replacing an older one."""
    model.write().overwrite().save(path)
