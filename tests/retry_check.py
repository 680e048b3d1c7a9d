"""Run registered queries with injected task failures; print OK when results equal a clean run.

Started by tests/test_retries.py in its own process, because task retries need
a session created with ``local[N,F]`` (F attempts per task).  The first
attempt of every even-numbered task fails, once while the driver tables are
read and once after the final shuffle, and Spark recomputes the lost work.
"""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import propmart.plans.analogs as analogs  # noqa: E402

QUERIES = ["A1_avg_by_group", "J1_latest_orders", "G3_roi", "W1_segment_avg", "J7_kpi_mart", "G1_formatted_listings", "P3_format_rent"]


MARKS = os.environ.get("RETRY_MARK_DIR", "")


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        if MARKS:
            open(os.path.join(MARKS, f"{ctx.stageId()}-{ctx.partitionId()}-{os.getpid()}-{id(batches)}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from batches


def norm(rows):
    return Counter(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)


def main() -> None:
    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    clean = {q: norm(analogs.QUERIES[q](spark, sf).collect()) for q in QUERIES}

    plain_t = analogs._t

    def flaky_table(spark_, sf_, name):
        df = plain_t(spark_, sf_, name)
        return df.repartition(4).mapInPandas(flaky, df.schema)

    analogs._t = flaky_table
    bad = []
    for q in QUERIES:
        df = analogs.QUERIES[q](spark, sf)
        got = norm(df.mapInPandas(flaky, df.schema).collect())
        if got != clean[q]:
            bad.append(q)
    analogs._t = plain_t
    spark.stop()
    injected = len(os.listdir(MARKS)) if MARKS else -1
    print(f"injected {injected}")
    print("OK" if not bad else f"MISMATCH {bad}")


if __name__ == "__main__":
    main()
