import datetime as dt

from pyspark.sql import functions as F

from fixtures import AREA_LABEL, RENT_LABEL
from propmart.operators.kpi import avg_price_by, avg_rent, roi, roi_from_avg_rent

LISTING = "neighborhood string, price bigint, propertyCode bigint, date date, operation string"


def test_avg_price_rounding_and_order(spark):
    df = spark.createDataFrame(
        [("A", 1, 1, None, "sale"), ("A", 2, 2, None, "rent"), ("B", 10, 3, None, "sale"), ("C", 10, 4, None, "sale"), ("C", None, 5, None, "sale")],
        LISTING,
    )
    out = avg_price_by(df).collect()
    assert [tuple(r) for r in out] == [("B", 10.0), ("C", 10.0), ("A", 1.5)]
    assert out[0].__fields__ == ["Neighborhood", "Average_Price"]
    assert [tuple(r) for r in avg_price_by(df, operation="rent").collect()] == [("A", 2.0)]


def test_avg_price_two_decimals(spark):
    df = spark.createDataFrame([("A", 1, 1, None, "s"), ("A", 1, 2, None, "s"), ("A", 2, 3, None, "s")], LISTING)
    assert avg_price_by(df).first().Average_Price == 1.33


def _rent(spark, rows):
    return spark.createDataFrame(rows, "year bigint, neighborhood string, Lloguer_mitja string, Preu string")


def test_price_text_and_label_filters(spark):
    rows = [(2020, "G", RENT_LABEL, p) for p in ["700", "--", "NA", "N/A", "nan", None, "abc"]]
    rows.append((2020, "G", AREA_LABEL, "15"))
    out = avg_rent(_rent(spark, rows)).collect()
    assert [tuple(r) for r in out] == [(2020, "G", 700.0)]


def test_quarters_weigh_equally(spark):
    rows = [(2020, "G", RENT_LABEL, "600"), (2020, "G", RENT_LABEL, "800"), (2020, "G", RENT_LABEL, "700")]
    assert avg_rent(_rent(spark, rows)).first().avg_rent == 700.0


def test_roi_of_three_years(spark):
    """price / (12 * average rent), each year and neighborhood by itself."""
    listings = spark.createDataFrame(
        [
            ("North", 120000, 11, dt.date(2019, 5, 1), "sale"),
            ("South", 90000, 12, dt.date(2020, 5, 1), "sale"),
            ("Hill", 210000, 13, dt.date(2021, 5, 1), "sale"),
        ],
        LISTING,
    )
    rents = spark.createDataFrame(
        [(2019, "North", 500.0), (2020, "South", 600.0), (2021, "Hill", 1000.0)],
        "year bigint, neighborhood string, avg_rent double",
    )
    got = {r.propertyCode: round(r["ROI/Year"], 6) for r in roi_from_avg_rent(listings, rents).collect()}
    assert got == {11: 20.0, 12: 12.5, 13: 17.5}


def test_roi_zero_rent_duplicates_and_missing(spark):
    listings = spark.createDataFrame(
        [
            ("G", 84000, 1, dt.date(2020, 3, 1), "sale"),
            ("G", 84000, 1, dt.date(2020, 3, 1), "sale"),  # tied duplicate -> one ROI row
            ("Z", 100, 2, dt.date(2020, 3, 1), "sale"),  # zero rent -> null
            ("X", 100, 3, dt.date(2020, 3, 1), "sale"),  # no rent figure -> dropped
        ],
        LISTING,
    )
    rent = _rent(spark, [(2020, "G", RENT_LABEL, "700"), (2020, "Z", RENT_LABEL, "0")])
    out = sorted((r.propertyCode, r["ROI/Year"]) for r in roi(listings, rent).collect())
    assert out == [(1, 10.0), (2, None)]
    assert [f.name for f in roi(listings, rent).schema.fields] == ["year", "neighborhood", "propertyCode", "ROI/Year"]


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], LISTING)
    out = avg_price_by(empty)
    assert out.count() == 0 and out.columns == ["Neighborhood", "Average_Price"]
    assert roi(empty, _rent(spark, [])).count() == 0


def test_kpi_invariant_under_partitioning(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderstatus").alias("neighborhood"), F.col("o_totalprice").alias("price")
    )
    a = [tuple(r) for r in avg_price_by(df).collect()]
    b = [tuple(r) for r in avg_price_by(df.repartition(7)).collect()]
    assert a == b


def test_tied_duplicate_counts_twice_in_average_once_in_roi(spark):
    listings = spark.createDataFrame(
        [("G", 100, 1, dt.date(2020, 3, 1), "sale"), ("G", 100, 1, dt.date(2020, 3, 1), "sale"), ("G", 400, 2, dt.date(2020, 3, 1), "sale")],
        LISTING,
    )
    assert avg_price_by(listings).first().Average_Price == 200.0  # (100 + 100 + 400) / 3
    rent = _rent(spark, [(2020, "G", RENT_LABEL, "10")])
    assert roi(listings, rent).count() == 2
