import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from propmart.operators.snapshot import latest_dates, latest_snapshot, require_key

D1, D2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ties_on_last_date_all_kept(spark):
    df = spark.createDataFrame([(1, D1, "a"), (1, D2, "b"), (1, D2, "c"), (2, D1, "d")], "code int, date date, v string")
    assert _rows(latest_snapshot(df, "code", "date")) == [(1, D2, "b"), (1, D2, "c"), (2, D1, "d")]


def test_null_key_is_its_own_group(spark):
    df = spark.createDataFrame([(None, D1, "a"), (None, D2, "b"), (3, D1, "c")], "code int, date date, v string")
    out = _rows(latest_snapshot(df, "code", "date").fillna(-1, ["code"]))
    assert out == [(-1, D2, "b"), (3, D1, "c")]


def test_all_null_dates_tie(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, None, "c"), (2, D1, "d")], "code int, date date, v string")
    out = sorted(r.v for r in latest_snapshot(df, "code", "date").collect())
    assert out == ["a", "b", "d"]


def test_equals_rank_window_and_is_idempotent(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("date")
    )
    w = Window.partitionBy("user_id").orderBy(F.col("date").desc())
    expected = ev.withColumn("r", F.rank().over(w)).where("r = 1").drop("r")
    got = latest_snapshot(ev, "user_id", "date")
    assert _rows(got) == _rows(expected)
    assert _rows(latest_snapshot(got, "user_id", "date")) == _rows(got)
    # the max date is unique per key after the operator
    assert got.groupBy("user_id").agg(F.countDistinct("date").alias("n")).where("n > 1").count() == 0


def test_latest_dates(spark):
    df = spark.createDataFrame([(1, D1), (1, D2), (2, D1)], "code int, date date")
    assert _rows(latest_dates(df, "code", "date")) == [(1, D2), (2, D1)]


def test_require_key_pushes_to_scan(spark, tmp_dir):
    df = spark.createDataFrame([("x", 1), (None, 2)], "neighborhood string, v int")
    df.write.parquet(f"{tmp_dir}/t")
    out = require_key(spark.read.parquet(f"{tmp_dir}/t"), "neighborhood")
    assert [r.v for r in out.collect()] == [1]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(neighborhood)" in plan
