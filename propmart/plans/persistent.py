"""Landing folder -> persistent zone (typed Parquet per dataset)."""

from __future__ import annotations

import re
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propmart.schemas import LISTING_OPTIONAL, LISTING_SCHEMA
from propmart.sources.files import inventory
from propmart.sources.raw import (
    absent_columns,
    json_records,
    json_texts,
    listings_from_records,
    quarantined_records,
    read_csv_inferred,
    read_income,
    read_json_inferred,
    read_listings,
    read_lookup,
    read_rent,
)
from propmart.sources.sinks import persist_landing


def dataset_folders(spark: SparkSession, landing_dir: str) -> list[str]:
    """Names of the dataset sub-folders that hold files (a handful of names)."""
    files = inventory(spark, landing_dir)
    root = landing_dir.rstrip("/")
    rel = F.regexp_extract(F.col("path"), re.escape(root.split(":", 1)[-1]) + "/([^/]+)/", 1)
    return sorted(r[0] for r in files.select(rel.alias("d")).where(F.col("d") != "").distinct().collect())


def read_landing_dataset(spark: SparkSession, folder: str, on_error: str = "raise") -> DataFrame:
    """Pick the reader by the folder-name suffix (fixed schema), else by each file's own suffix."""
    name = folder.rstrip("/")
    if name.endswith("idealista"):
        return read_listings(spark, folder, on_error)
    if name.endswith("lookup_tables"):
        return read_lookup(spark, folder, on_error)
    if name.endswith("opendata-rent"):
        return read_rent(spark, folder, on_error)
    if name.endswith("opendatabcn-income"):
        return read_income(spark, folder, on_error)
    return read_mixed(spark, folder)


def read_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """S3 + S7: the JSON and the CSV files of one folder, united by column name.

    A column whose type differs between the two is text in the result.
    """
    suffix = F.lower(F.regexp_extract("file_name", r"(\.[^.]*)$", 1))
    there = {r[0] for r in inventory(spark, folder).select(suffix).distinct().collect()}
    parts = []
    if ".json" in there:
        parts.append(read_json_inferred(spark, folder))
    if ".csv" in there:
        parts.append(read_csv_inferred(spark, folder))
    if not parts:
        raise ValueError(f"no JSON or CSV file in {folder}")
    types: dict[str, set[str]] = {}
    for df in parts:
        for c, t in df.dtypes:
            types.setdefault(c, set()).add(t)
    plain = [df.select(*[F.col(f"`{c}`").cast("string" if len(types[c]) > 1 else t).alias(c) for c, t in df.dtypes]) for df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), plain)


class MissingColumnsError(ValueError):
    """A landing file lacks a required column (reported per file and column)."""


def staged_listings(spark: SparkSession, folder: str, staged_dir: str) -> DataFrame:
    """The records of a listing folder, cut once for all that reads them; their texts are kept in ``staged_dir``."""
    return json_records(json_texts(spark.read, folder, staged=staged_dir))


def check_required_listing_columns(spark: SparkSession, records: DataFrame, report_dir: str, on_error: str = "raise") -> int:
    """T5: listing files of which no record has a required key; run before the dataset is written.

    The (file, column) pairs are written to ``report_dir``, not collected.
    Returns how many there are; in strict mode any raises.
    """
    required = [f.name for f in LISTING_SCHEMA.fields if f.name not in LISTING_OPTIONAL]
    report = absent_columns(records, required)
    report.write.mode("overwrite").parquet(report_dir)
    found = spark.read.parquet(report_dir).count()
    if found and on_error == "raise":
        raise MissingColumnsError(f"{found} (file, column) pairs miss required listing columns; see {report_dir}")
    return found


def quarantine_listings(spark: SparkSession, records: DataFrame, report_dir: str) -> int:
    """Write what the lenient reader cannot read, with file, reason and text; returns the count."""
    quarantined_records(records).write.mode("overwrite").parquet(report_dir)
    return spark.read.parquet(report_dir).count()


def build_persistent(
    spark: SparkSession, landing_dir: str, persistent_dir: str, on_error: str = "raise", check_required: bool = True
) -> dict[str, str]:
    """Convert every dataset folder of the landing zone; returns dataset -> output path.

    With ``check_required`` the listing files are first checked for absent
    required columns, before the old dataset is replaced.  With
    ``on_error="null"`` unreadable records go to ``_reports/<dataset>_quarantine``.
    Listing files are cut once, into ``_staged/<dataset>``, which the reports
    and the dataset are made from.
    """
    written = {}
    batch_ts = int(time.time())
    root = persistent_dir.rstrip("/")
    for d in dataset_folders(spark, landing_dir):
        out = f"{root}/{d}"
        src = f"{landing_dir.rstrip('/')}/{d}"
        if d.endswith("idealista"):
            records = staged_listings(spark, src, f"{root}/_staged/{d}")
            if on_error == "null":
                quarantine_listings(spark, records, f"{root}/_reports/{d}_quarantine")
            if check_required:
                check_required_listing_columns(spark, records, f"{root}/_reports/{d}_missing_columns", on_error)
            rows = listings_from_records(records, on_error)
        else:
            rows = read_landing_dataset(spark, src, on_error)
        persist_landing(rows, out, batch_ts)
        written[d] = out
    return written
