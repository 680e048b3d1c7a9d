"""Formatted zone -> the two KPI files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from propmart.operators.kpi import avg_price_by, roi
from propmart.operators.views import kpi_mart, view_avg_price, view_roi
from propmart.schemas import AVG_PRICE_SCHEMA, ROI_SCHEMA
from propmart.sources.raw import read_kpi_csv
from propmart.schemas import AVG_PRICE_COLUMNS, FORMATTED_LISTING_SCHEMA, FORMATTED_RENT_SCHEMA
from propmart.sources.parquet import read_zone
from propmart.sources.sinks import write_kpi_csv


def build_exploitation(spark: SparkSession, formatted_dir: str, out_dir: str, operation: str | None = None) -> dict[str, str]:
    """``avg_price`` (sorted desc) and ``ROI`` (payback table).

    Averages are sums without rounding, the same for every partitioning.  The payback table has a row per listing and is written unsorted, straight
    from the distinct stage, as the source wrote it.
    """
    src = formatted_dir.rstrip("/")
    dst = out_dir.rstrip("/")
    listings = read_zone(spark, f"{src}/idealista", FORMATTED_LISTING_SCHEMA)
    rent = read_zone(spark, f"{src}/rent", FORMATTED_RENT_SCHEMA)
    name, value = AVG_PRICE_COLUMNS
    write_kpi_csv(
        avg_price_by(listings, "neighborhood", "price", operation, sort=False, exact=True),  # the writer sorts
        f"{dst}/avg_price",
        sort_by=[F.col(value).desc(), F.col(name).asc()],
    )
    write_kpi_csv(roi(listings, rent, exact=True), f"{dst}/ROI")
    return {"avg_price": f"{dst}/avg_price", "ROI": f"{dst}/ROI"}


def dashboard_views(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """S14 + V1-V3: the published KPI files as typed tables and the chart queries
    as temporary SQL views (``avg_price``, ``roi``, ``v_avg_price``, ``v_roi``,
    ``kpi_mart``), for SQL clients of this session."""
    dst = out_dir.rstrip("/")
    avg = read_kpi_csv(spark, f"{dst}/avg_price", AVG_PRICE_SCHEMA)
    payback = read_kpi_csv(spark, f"{dst}/ROI", ROI_SCHEMA)
    views = {
        "avg_price": avg,
        "roi": payback,
        "v_avg_price": view_avg_price(avg),
        "v_roi": view_roi(payback),
        "kpi_mart": kpi_mart(payback, avg),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return {name: name for name in views}
