"""G1: persistent zone -> formatted zone (latest listings, reconciled names)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propmart.functions.dates import snapshot_date
from propmart.operators.reconcile import lookup_conflicts
from propmart.operators.snapshot import latest_snapshot, require_key
from propmart.operators.tables import format_income, format_listings, format_rent
from propmart.schemas import INCOME_SCHEMA, LISTING_SCHEMA, LOOKUP_SCHEMA, RENT_SCHEMA
from propmart.sources.parquet import read_zone
from propmart.sources.sinks import write_zone

PERSISTED_LISTING_SCHEMA = T.StructType(LISTING_SCHEMA.fields + [T.StructField("source_file", T.StringType())])


def persisted_listings(spark: SparkSession, path: str, strict_names: bool = True) -> DataFrame:
    """S11 + F1/F2 + X4/X5: persisted listing rows with a logical key and their snapshot date.

    One read with a fixed schema: files without a ``neighborhood`` column read
    it as null and drop with the null filter, which reaches the Parquet scan.
    The date comes from the original file name (``source_file``) or, for files
    written without that column, from the Parquet file's own name.
    """
    df = read_zone(spark, path, PERSISTED_LISTING_SCHEMA)
    df = df.withColumn("source_file", F.coalesce(F.col("source_file"), F.col("_metadata.file_name")))
    df = require_key(df, "neighborhood")
    return df.withColumn("date", snapshot_date(F.col("source_file"), strict=strict_names))


def formatted_listings(listings: DataFrame, lookup: DataFrame, keep_fanout: bool = False) -> DataFrame:
    """J1 + J4 + P1: latest snapshot of each listing, reconciled and projected."""
    latest = latest_snapshot(listings, "propertyCode", "date")
    return format_listings(latest, lookup, keep_fanout=keep_fanout)


def build_formatted(spark: SparkSession, persistent_dir: str, formatted_dir: str, keep_fanout: bool = False) -> None:
    """G1: write formatted ``idealista``, ``income`` and ``rent``."""
    src = persistent_dir.rstrip("/")
    dst = formatted_dir.rstrip("/")
    lookup = read_zone(spark, f"{src}/lookup_tables", LOOKUP_SCHEMA)
    # Q4: neighborhoods that reconcile to more than one name (one aggregate over the lookup)
    lookup_conflicts(lookup, ["neighborhood"]).write.mode("overwrite").parquet(f"{dst}/_reports/lookup_conflicts")
    listings = formatted_listings(persisted_listings(spark, f"{src}/idealista"), lookup, keep_fanout)
    write_zone(listings, f"{dst}/idealista")
    income = read_zone(spark, f"{src}/opendatabcn-income", INCOME_SCHEMA)
    write_zone(format_income(income, lookup, keep_fanout), f"{dst}/income")
    rent = read_zone(spark, f"{src}/opendata-rent", RENT_SCHEMA)
    write_zone(format_rent(rent, lookup, keep_fanout), f"{dst}/rent")
