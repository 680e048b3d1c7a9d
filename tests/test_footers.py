import glob
import os

import pytest
from pyspark.sql import functions as F

from propmart.sources.footers import lacking_in_files, read_footers, totals, type_drift
from propmart.sources.sinks import write_sized, write_zone


def test_drift_and_counts_come_from_footers(spark, tmp_dir):
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string").coalesce(1).write.parquet(f"{tmp_dir}/z/p1")
    spark.createDataFrame([(2, 1.5)], "a int, c double").coalesce(1).write.parquet(f"{tmp_dir}/z/p2")
    spark.createDataFrame([(3, "z")], "a long, b string").coalesce(1).write.parquet(f"{tmp_dir}/z/p 3")
    open(f"{tmp_dir}/z/notes.txt", "w").write("no Parquet")
    found = read_footers(spark, f"{tmp_dir}/z")
    assert totals(found) == (3, 4, sum(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/z/*/*.parquet")))
    lacking = {(r.path.split("/")[-2], r.column) for r in lacking_in_files(found, ["a", "b", "c"]).collect()}
    assert lacking == {("p1", "c"), ("p2", "b"), ("p 3", "c")}
    assert {tuple(r) for r in type_drift(found).collect()} == {("a", "int32", 2, 3), ("a", "int64", 1, 1)}
    assert totals(read_footers(spark, f"{tmp_dir}/nothing" if os.makedirs(f"{tmp_dir}/nothing") is None else "")) == (0, 0, 0)


def test_files_keep_to_the_target(spark, tmp_dir):
    df = spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("h")).repartition(1)
    n_files, per_file = write_sized(df, f"{tmp_dir}/s", 300_000)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/s/*.parquet")]
    assert len(sizes) == n_files > 5 and max(sizes) <= 1.5 * 300_000
    assert spark.read.parquet(f"{tmp_dir}/s").agg(F.count("*"), F.sum("id")).first()[:] == (60_000, sum(range(60_000)))
    write_sized(df.limit(0), f"{tmp_dir}/s", 300_000)
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 0


def test_a_failed_write_leaves_partitions_readable(spark, tmp_dir):
    zone = f"{tmp_dir}/zone"
    rows = spark.range(100).select("id", (F.col("id") % 4 + 2020).cast("int").alias("year"))
    write_zone(rows, zone, partition_by=["year"], keep_other_partitions=True)
    bad = rows.where("year = 2021").select(F.when(F.col("id") > 90, F.raise_error(F.lit("broken row"))).otherwise(F.col("id") + 1000).alias("id"), "year")
    with pytest.raises(Exception, match="broken row"):
        write_zone(bad, zone, partition_by=["year"], keep_other_partitions=True)
    assert sorted(r.id for r in spark.read.parquet(zone).collect()) == list(range(100))
    good = rows.where("year = 2021").select((F.col("id") + 1000).alias("id"), "year")
    write_zone(good, zone, partition_by=["year"], keep_other_partitions=True)
    assert sorted(r.id for r in spark.read.parquet(zone).collect()) == sorted(i + 1000 if i % 4 == 1 else i for i in range(100))
