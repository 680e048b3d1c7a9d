"""Helpers shared by the operators: the shared folder, written tables, files."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propmart.session import checkpoint_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by themselves.

    They do where its folder is the working folder or on PYTHONPATH, or where
    the job was submitted with ``--py-files``.  Once per Spark context.
    """
    root = Path(__file__).resolve().parents[2]
    known = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    sc = spark.sparkContext
    if root.suffix == ".zip" or any(p.resolve() == root for p in known) or any("propmart" in f for f in sc.listFiles):
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='propmart-')}/propmart", "zip", root, "propmart")
    sc.addPyFile(made)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the setting is absent, a plain local session (one JVM) gets a
    temporary folder; any other session must name one.
    """
    found = checkpoint_dir(spark)
    if found is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="propmart-shared-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, as compressed Parquet; later plans
    also know its real size.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named as Spark names it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class OwnFile:
    """A file written under a name of this attempt alone.

    A repeated task writes another file; readers follow the manifest rows that
    the committed attempt returned, so a half-written file is never read.
    """

    def __init__(self, folder: str, prefix: str, suffix: str):
        self.fs, path = open_folder(folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{prefix}-{uuid.uuid4().hex}{suffix}"
        self._out = self.fs.open_output_stream(f"{path}/{self.name}", compression=None)
        self.offset = 0

    def write(self, data: bytes) -> int:
        at = self.offset
        self._out.write(data)
        self.offset += len(data)
        return at

    def close(self) -> None:
        self._out.close()


def open_input(folder: str, name: str) -> pa.NativeFile:
    filesystem, path = open_folder(folder)
    return filesystem.open_input_file(os.path.join(path, name))


def pieces(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slice record batches so that a slice holds about ``most_bytes`` of ``column``.

    Long texts come in ordinary batches; slices keep a task's memory bounded
    by the longest single text.
    """
    import numpy as np

    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if not len(col):
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(col):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The groups of rows that agree in the first ``n_keys`` columns.

    The rows must come sorted by those columns; a group may pass the end of a
    batch.  Memory is that of one batch and one group.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for i in range(n_keys):
            column = batch.column(i)
            new[1:] |= np.asarray(pc.not_equal(column[1:], column[:-1]))
        key = [batch.column(i)[0].as_py() for i in range(n_keys)]
        new[0] = key != last
        cuts = np.flatnonzero(new).tolist() + [batch.num_rows]
        if cuts[0] or not new[0]:
            held.append(batch.slice(0, cuts[0]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(a, b - a)]
        last = [batch.column(i)[batch.num_rows - 1].as_py() for i in range(n_keys)]
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for rows (a, b); a component is named by its least node.

    Alternating star contraction: every node's larger neighbours are hung to
    its least neighbour, then its smaller ones, until nothing changes.  Every
    round is a min per node and a join back, written to the shared folder; a
    star with very many leaves is an ordinary skewed join.
    """
    pairs = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    pairs = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        least = written(least, name)  # a table of its own, so that the join can split a node with very many edges
        large = both.join(least, F.col("u") == F.col("n")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = written(large.filter(F.col("u") != F.col("v")).distinct(), name)
        least = written(pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m"), name)
        hung = pairs.join(least, F.col("u") == F.col("n"))
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") != F.col("v"))
        pairs = written(small.union(least.select(F.col("n").alias("u"), F.col("m").alias("v"))).distinct(), name)
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
