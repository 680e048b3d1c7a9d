"""Run operator queries with injected task failures; print OK when results equal a clean run.

Started by test_retries.py in its own process, because task retries need a
session created with ``local[N,F]``.  The first attempt of every even-numbered
task fails while a table is read, and with it the tasks that write files of
their own; the results must not see the files that failed attempts left.
"""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from propmart.llm import queries  # noqa: E402

QUERIES = ["op1_warc_index", "op2_line_tokens", "op5_jaccard_join", "op7_mix_sources", "op8_pack_ids", "op10_suffix_dedup", "op11_pair_counts", "op12_ranked_search", "op13_chat_windows"]
MARKS = os.environ["RETRY_MARK_DIR"]


def flaky(batches):
    """Fails after it has passed on rows, so that a file has been begun."""
    ctx = TaskContext.get()
    failing = ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0
    for batch in batches:
        for at in range(0, batch.num_rows, 5):
            yield batch.slice(at, 5)
    if failing:
        open(os.path.join(MARKS, f"{ctx.stageId()}-{ctx.partitionId()}-{os.getpid()}"), "w").close()
        raise RuntimeError("injected task failure")


def main() -> None:
    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[4,3]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", f"{MARKS}-shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    clean = {q: Counter(queries.QUERIES[q](spark, sf).collect()) for q in QUERIES}
    plain = queries._table

    def flaky_table(spark_, sf_, name):
        df = plain(spark_, sf_, name)
        return df.repartition(4).mapInArrow(flaky, df.schema)

    queries._table = flaky_table
    bad = [q for q in QUERIES if Counter(queries.QUERIES[q](spark, sf).collect()) != clean[q]]
    spark.stop()
    print(f"injected {len(os.listdir(MARKS))}")
    print("OK" if not bad else f"MISMATCH {bad}")


if __name__ == "__main__":
    main()
