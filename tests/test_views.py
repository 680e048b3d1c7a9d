import math

from propmart.operators.views import kpi_mart, view_avg_price, view_roi

ROI = "year bigint, neighborhood string, propertyCode bigint, `ROI/Year` double"
AVG = "Neighborhood string, Average_Price double"


def test_view_avg_price(spark):
    avg = spark.createDataFrame([("A", 1.0), ("B", 3.0), ("C", 2.0)], AVG)
    assert [tuple(r) for r in view_avg_price(avg).collect()] == [("B", 3.0), ("C", 2.0), ("A", 1.0)]


def test_view_roi_hides_null_and_nan_and_dedupes(spark):
    roi = spark.createDataFrame(
        [(2020, "A", 1, 10.0), (2020, "A", 1, 10.0), (2020, "A", 2, None), (2020, "A", 3, float("nan"))], ROI
    )
    out = view_roi(roi).collect()
    assert [tuple(r) for r in out] == [("A", 1, 2020, 10.0)]


def test_kpi_mart_equals_full_outer_join(spark):
    roi = spark.createDataFrame([(2020, "A", 1, 10.0), (2020, "A", 2, 12.0), (2021, "B", 3, 5.0), (2021, None, 4, 1.0)], ROI)
    avg = spark.createDataFrame([("A", 100.0), ("C", 50.0), (None, 7.0)], AVG)
    got = sorted(map(lambda r: tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r), kpi_mart(roi, avg).collect()), key=str)
    roi.createOrReplaceTempView("roi_t")
    avg.createOrReplaceTempView("avg_t")
    want = spark.sql(
        "SELECT coalesce(r.neighborhood, a.Neighborhood) AS neighborhood, r.year, r.propertyCode, r.`ROI/Year`, a.Average_Price "
        "FROM roi_t r FULL OUTER JOIN avg_t a ON r.neighborhood = a.Neighborhood"
    ).collect()
    assert got == sorted(map(tuple, want), key=str)
    assert kpi_mart(roi, avg).columns == ["neighborhood", "year", "propertyCode", "ROI/Year", "Average_Price"]
