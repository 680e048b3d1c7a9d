"""Session defaults and lineage helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution re-plans joins and shuffle
# sizes from runtime statistics (broadcast when a side turns out small,
# split skewed partitions, merge tiny ones); no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join side of at most this size, known at runtime, is broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # split a hot key's partition even when that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "propmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are left to the cluster when None.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the cluster, if one is configured.

    ``spark.checkpoint.dir`` is read from the session; when only the config is
    set, it is also handed to the SparkContext so ``DataFrame.checkpoint``
    works.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by themselves.

    They do where its folder is the working folder or on PYTHONPATH, or where
    the job was submitted with ``--py-files``.  Once per Spark context.
    """
    root = Path(__file__).resolve().parents[1]
    known = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    sc = spark.sparkContext
    if root.suffix == ".zip" or any(p.resolve() == root for p in known) or any("propmart" in f for f in sc.listFiles):
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp(prefix='propmart-')}/propmart", "zip", root, "propmart")
    sc.addPyFile(made)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; nothing is created yet.

    Where ``spark.checkpoint.dir`` is unset, a plain local session (one JVM)
    gets a temporary folder; any other session must name one.
    """
    shared = checkpoint_dir(spark)
    if shared is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="propmart-shared-"))
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss, unlike cached or locally checkpointed blocks.
    Raises when the cluster names no checkpoint folder: a machine-local
    fallback would not be reachable from other executors.
    """
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
        )
    return df.checkpoint(eager=True)


# Target bytes per shuffle partition, and the factor from input bytes on disk
# (compressed columnar) to shuffled bytes (uncompressed rows).
PARTITION_TARGET_BYTES = 128 * 1024 * 1024
SHUFFLE_EXPANSION = 3.0


def shuffle_partitions_for(
    input_bytes: int,
    target_bytes: int = PARTITION_TARGET_BYTES,
    expansion: float = SHUFFLE_EXPANSION,
    minimum: int = 200,
    maximum: int = 200_000,
) -> int:
    """Shuffle partitions so that one partition holds about ``target_bytes``.

    Adaptive execution merges partitions that turn out smaller, so this is an
    upper sizing: it keeps a partition of a large stage within executor memory
    (no spill) without hand-tuning per job.
    """
    wanted = int(input_bytes * expansion // target_bytes) + 1
    return max(minimum, min(maximum, wanted))


def tune_for_input(spark: SparkSession, input_bytes: int) -> int:
    """Set ``spark.sql.shuffle.partitions`` (a per-session runtime setting) for
    a job reading ``input_bytes``; returns the value set."""
    n = shuffle_partitions_for(input_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
