import datetime as dt

import pytest
from pyspark.sql import functions as F

from propmart.functions.dates import snapshot_date, year_of
from propmart.functions.numbers import is_price_text, payback_years, round_half_up, text_to_double
from propmart.functions.text import file_name, name_prefix, resolve_link, strip_extension


def test_snapshot_date_strict_and_lenient(spark):
    good = spark.createDataFrame([("2020_03_01_idealista.json",)], "f string")
    assert good.select(snapshot_date(F.col("f")).alias("d")).first().d == dt.date(2020, 3, 1)
    bad = spark.createDataFrame([("latest.json",)], "f string")
    with pytest.raises(Exception, match="bad snapshot file name"):
        bad.select(snapshot_date(F.col("f"))).collect()
    assert bad.select(snapshot_date(F.col("f"), strict=False).alias("d")).first().d is None


def test_numbers(spark):
    df = spark.createDataFrame([(" 700 ",), ("nan",), ("NA",), ("--",), (None,), ("x",), ("1e3",)], "p string")
    rows = df.select(text_to_double(F.col("p")).alias("v"), is_price_text(F.col("p")).alias("ok")).collect()
    assert [r.v for r in rows] == [700.0, None, None, None, None, None, 1000.0]
    assert [r.ok for r in rows] == [True, False, False, False, False, False, True]
    r = spark.createDataFrame([(1.005, 0.0, 2.675)], "a double, z double, b double").select(
        round_half_up(F.col("a")).alias("a"), payback_years(F.lit(100), F.col("z")).alias("p"), round_half_up(F.col("b")).alias("b")
    ).first()
    assert (r.a, r.p, r.b) == (1.01, None, 2.68)
    assert spark.range(1).select(year_of(F.lit(dt.date(2021, 5, 1))).alias("y")).first().y == 2021


def test_text(spark):
    r = spark.createDataFrame([("https://a.org/x", "/d/2020_lloguer_preu_trim.csv")], "base string, href string").select(
        resolve_link(F.col("base"), F.col("href")).alias("u"),
        file_name(F.col("href")).alias("f"),
        strip_extension(file_name(F.col("href"))).alias("s"),
        name_prefix(F.lit("2020_01_02_x.json"), 10).alias("p"),
    ).first()
    assert (r.u, r.f, r.s, r.p) == ("https://a.org/x/d/2020_lloguer_preu_trim.csv", "2020_lloguer_preu_trim.csv", "2020_lloguer_preu_trim", "2020_01_02")


def test_round_exact_is_the_rounding_of_binary_values(spark):
    import random

    from pyspark.sql import functions as F

    from propmart.functions.numbers import round_exact

    rnd = random.Random(9)
    values = [2.675, 0.125, 1.005, -2.675, 0.375, 0.0, -0.125, 1e300, float(2**53 + 1), 5e-324, 0.005, 0.015, 1.115, 4.35, 1234567.885, None]
    values += [rnd.uniform(0, 10 ** rnd.randrange(-3, 9)) for _ in range(3000)] + [k / 2**j for k in range(1, 300, 7) for j in range(12)]
    values += [round(rnd.uniform(0, 1000), 2) + 0.005 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 5):
        for v, got in df.select("v", round_exact(F.col("v"), digits).alias("r")).collect():
            assert got == (None if v is None else round(v, digits)), v
