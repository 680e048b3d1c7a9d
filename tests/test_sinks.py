import glob

from pyspark.sql import functions as F

from propmart.sources.sinks import write_kpi_csv, write_zone


def test_kpi_csv_is_sorted_over_its_files(spark, tmp_dir):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    write_kpi_csv(df, f"{tmp_dir}/small", [F.col("k").desc()])
    files = glob.glob(f"{tmp_dir}/small/part-*.csv")
    assert len(files) == 1
    assert open(files[0]).read().split("\n")[:3] == ["k,v", "99,1", "98,0"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_kpi_csv(df.repartition(4), f"{tmp_dir}/parts", [F.col("k")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(glob.glob(f"{tmp_dir}/parts/part-*.csv"))
    assert len(files) > 1
    assert [int(x.split(",")[0]) for f in files for x in open(f).read().split()[1:]] == list(range(100))


def test_write_zone_overwrites_and_partitions(spark, tmp_dir):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("y"))
    write_zone(df, f"{tmp_dir}/z", partition_by=["y"])
    write_zone(df, f"{tmp_dir}/z", partition_by=["y"])
    back = spark.read.parquet(f"{tmp_dir}/z")
    assert back.count() == 10 and sorted(r.y for r in back.select("y").distinct().collect()) == [0, 1]


def test_shuffle_partitions_for():
    from propmart.session import shuffle_partitions_for

    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(100 * 1024**4) == 200_000  # 100 TiB hits the cap
    assert shuffle_partitions_for(1024**4) == 24577  # 1 TiB * 3 / 128 MiB + 1
