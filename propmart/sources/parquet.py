"""Parquet readers (S9, S10, S11 source column, S12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of ``<name>.parquet`` files or directories."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_zone(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = "*.parquet") -> DataFrame:
    """Every Parquet file under ``path`` as one DataFrame.

    An explicit ``schema`` makes files that lack a column read it as null
    (schema drift, U1) instead of failing or depending on the first file; the
    glob skips non-Parquet files (F6).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def read_with_source(spark: SparkSession, path: str, schema: T.StructType | None = None, glob: str | None = None) -> DataFrame:
    """Parquet rows plus ``source_file`` = name of the file they came from.

    Uses the ``_metadata`` column, which is deterministic, so filters on data
    columns still reach the scan (unlike ``input_file_name()`` behind a UDF).
    """
    df = read_zone(spark, path, schema, glob)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"))
