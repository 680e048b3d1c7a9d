"""File inventory of a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propmart.functions.text import after_last, strip_extension


def inventory(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row per file under ``path``: path, folder, file name, base name,
    length and modification time.

    Uses the binary-file source without selecting ``content``, so file bodies
    are not read; the listing itself runs as a distributed job for large
    folders.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length", "modificationTime")
    name = after_last(F.col("path"), "/")
    return files.select(
        "path",
        F.regexp_replace(F.col("path"), r"/[^/]*$", "").alias("folder"),
        name.alias("file_name"),
        strip_extension(name).alias("base_name"),
        "length",
        "modificationTime",
    )


def inventory_counts(files: DataFrame) -> DataFrame:
    """Files and bytes per folder."""
    return files.groupBy("folder").agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (listing only, nothing is read)."""
    total = inventory(spark, path).agg(F.sum("length")).first()[0]
    return int(total or 0)
