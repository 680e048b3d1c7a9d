"""Plan shape of every registered query and skew handling of the key operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from propmart.operators.ml import segment_average
from propmart.operators.snapshot import latest_snapshot
from propmart.plans.registered import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Window ", "WindowGroupLimit")

# their windows run over a row or two per input split
SPLIT_READERS = {"S2_split_arrays", "S4_csv_line_breaks"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"M4_forest", "M7_forest_table", "G4_price_model"}))
def test_no_cross_products_udfs_or_windows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        if name in SPLIT_READERS and node == "Window ":
            continue
        assert node not in plan, f"{name} plans {node}"


def test_scans_read_only_used_columns(spark):
    df = QUERIES["A1_avg_by_group"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan.replace("\n", " ") or (
        "struct<o_custkey:bigint,o_totalprice:double>" in plan
    )


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_key_frame(spark):
    """Key 0 holds a third of the rows, all on one date (the worst case for the join back)."""
    n = 6000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("code"),
        F.when(F.col("id") % 3 == 0, F.lit(dt.date(2020, 1, 1))).otherwise(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 5).cast("int"))).alias("date"),
        F.col("id").alias("v"),
    ).repartition(8)


def test_latest_snapshot_hot_key_is_split(spark, skew_conf):
    df = _hot_key_frame(spark)
    out = latest_snapshot(df, "code", "date")
    rows = out.collect()
    assert sum(1 for r in rows if r.code == 0) == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_small_sides_are_broadcast_at_runtime(spark):
    df = _hot_key_frame(spark).select("code", "v")
    out = segment_average(df, ["code"], "v", "avg")
    out.collect()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["G3_roi", "X9_zero_rent", "G2_pipeline_roi", "J7_kpi_mart", "W1_segment_avg", "W1_segment_avg_listings", "G1_formatted_listings"])
def test_building_a_plan_runs_no_aggregate(spark, name):
    """Only the schemas of files are read (small jobs without a shuffle)."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    QUERIES[name](spark, SF_SMALL)
    for job in set(tracker.getJobIdsForGroup(None)) - before:
        assert len(tracker.getJobInfo(job).stageIds) == 1


def test_segment_average_hot_segment_is_split(spark, skew_conf):
    df = _hot_key_frame(spark)
    out = segment_average(df, ["code"], "v", "avg")
    rows = out.collect()
    assert len({r.avg for r in rows if r.code == 0}) == 1 and len(rows) == 6000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_kpi_mart_hot_neighborhood_is_split(spark, skew_conf):
    from propmart.operators.views import kpi_mart

    n = 6000
    roi = spark.range(n).select(
        F.lit(2020).cast("bigint").alias("year"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (F.col("id") % 50).cast("string"))).alias("neighborhood"),
        F.col("id").alias("propertyCode"),
        (F.col("id") / 7.0).alias("ROI/Year"),
    ).repartition(8)
    avg = spark.range(60).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("Neighborhood"),
        F.col("id").cast("double").alias("Average_Price"),
    )
    out = kpi_mart(roi, avg)
    rows = out.collect()
    assert len(rows) == n + 10  # names n50..n59 have no payback rows
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
