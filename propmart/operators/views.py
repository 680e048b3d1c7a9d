"""Queries behind the dashboard charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.schemas import AVG_PRICE_COLUMNS, ROI_COLUMNS


def view_avg_price(avg_kpi: DataFrame) -> DataFrame:
    """V1 = A6 + O4: ``SUM(Average_Price)`` per neighborhood, bars sorted desc."""
    name, value = AVG_PRICE_COLUMNS
    return (
        avg_kpi.groupBy(name)
        .agg(F.sum(value).alias(f"sum_{value}"))
        .orderBy(F.col(f"sum_{value}").desc(), F.col(name).asc())
    )


def view_roi(roi_kpi: DataFrame, already_distinct: bool = False) -> DataFrame:
    """V2 = F5 + A8: one mark per distinct (neighborhood, property, year, payback).

    Marks with a null or NaN payback are filtered out.  The payback KPI comes
    out distinct; ``already_distinct=True`` does not do it again.
    """
    y, n, code, roi_name = ROI_COLUMNS
    r = F.col(f"`{roi_name}`")
    marks = roi_kpi.where(r.isNotNull() & ~F.isnan(r)).select(n, code, y, roi_name)
    return marks if already_distinct else marks.distinct()


def kpi_mart(roi_kpi: DataFrame, avg_kpi: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Both KPI tables related on the neighborhood name.

    Same rows as a full outer join on ``roi.neighborhood = avg.Neighborhood``.
    The average table has one row per name, so it is written as
    ``roi LEFT JOIN avg`` plus the average rows no payback row names.  Unlike a
    full outer join, both parts keep a hot neighborhood splittable: the left
    join can be broadcast or skew-split, and the anti join reads the distinct
    names only.  The average side is renamed first (``neighborhood`` and
    ``Neighborhood`` differ only in case).

    ``names`` has the payback table's neighborhoods where they are known from
    its inputs (``kpi.roi_names``); otherwise that table is read twice, and
    should be a written one.
    """
    y, n, code, roi_name = ROI_COLUMNS
    name, value = AVG_PRICE_COLUMNS
    avg = avg_kpi.select(F.col(name).alias("__avg_name"), F.col(value).alias(value))
    matched = roi_kpi.join(avg, roi_kpi[n] == avg["__avg_name"], "left").select(
        roi_kpi[n].alias(n), roi_kpi[y], roi_kpi[code], roi_kpi[f"`{roi_name}`"], avg[value]
    )
    known = (roi_kpi if names is None else names).select(F.col(n).alias("__roi_name")).distinct()
    unmatched = avg.join(known, avg["__avg_name"] == known["__roi_name"], "left_anti").select(
        F.col("__avg_name").alias(n),
        F.lit(None).cast("bigint").alias(y),
        F.lit(None).cast("bigint").alias(code),
        F.lit(None).cast("double").alias(roi_name),
        F.col(value),
    )
    return matched.unionByName(unmatched)
