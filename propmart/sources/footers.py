"""Parquet footers of a dataset, read by tasks: rows, bytes and columns per file.

No data page is read: a task opens a file and reads its last bytes.  What is
known from them: which files lack a column (schema drift), and how many bytes
a row takes, which sizes the files of the next write.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propmart.session import ship_package
from propmart.sources.files import inventory

FOOTER = "path string, folder string, file_name string, length long, n_rows long, n_row_groups int, columns array<struct<name:string,type:string>>"
FILES_PER_TASK = 256


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows, groups, columns = [], [], []
        for path in frame["path"]:
            filesystem, name = _open(path)
            with filesystem.open_input_file(name) as file:
                found = pq.ParquetFile(file)
                rows.append(found.metadata.num_rows)
                groups.append(found.metadata.num_row_groups)
                columns.append([{"name": f.name, "type": str(f.type)} for f in found.schema_arrow])
        yield frame.assign(n_rows=rows, n_row_groups=groups, columns=columns)


def read_footers(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per Parquet file under ``path``; a file that is no Parquet fails the job."""
    ship_package(spark)
    files = inventory(spark, path, glob).select("path", "folder", "file_name", "length")
    n_tasks = -(-files.count() // FILES_PER_TASK)
    return files.repartition(max(1, n_tasks)).mapInPandas(_read, FOOTER)


def lacking_in_files(footers: DataFrame, schema: T.StructType | Sequence[str]) -> DataFrame:
    """(path, file_name, column) of the files that lack a column of ``schema``."""
    names = schema.fieldNames() if isinstance(schema, T.StructType) else list(schema)
    wanted = F.array(*[F.lit(c) for c in names])
    there = F.transform("columns", lambda c: c["name"])
    return footers.select("path", "file_name", F.explode(F.array_except(wanted, there)).alias("column"))


def type_drift(footers: DataFrame) -> DataFrame:
    """(column, type, n_files, n_rows) of every column, for columns that files hold in more than one type."""
    seen = footers.select("n_rows", F.explode("columns").alias("c")).groupBy(F.col("c.name").alias("column"), F.col("c.type").alias("type"))
    seen = seen.agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))
    several = seen.groupBy("column").agg(F.count(F.lit(1)).alias("n_types")).where("n_types > 1")
    return seen.join(several.select("column"), "column", "left_semi")


def totals(footers: DataFrame) -> tuple[int, int, int]:
    """Files, rows and bytes of a dataset."""
    found = footers.agg(F.count(F.lit(1)), F.sum("n_rows"), F.sum("length")).first()
    return tuple(int(x or 0) for x in found)
