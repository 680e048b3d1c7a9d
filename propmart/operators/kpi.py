"""Exploitation-zone KPIs: average price (A1) and price-to-rent payback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.functions.dates import year_of
from propmart.functions.numbers import is_price_text, payback_years, round_exact, text_to_double
from propmart.operators.exact import exact_average, exact_sums
from propmart.schemas import AVG_PRICE_COLUMNS, PRICE_SENTINELS, RENT_MONTHLY_LABEL, ROI_COLUMNS


def price_partials(df: DataFrame, keys: str | Sequence[str], price: str = "price") -> DataFrame:
    """Partial sums for an average: (keys, price_sum, price_n), nulls ignored.

    Lets a caller aggregate at a fine grain *before* a join that adds the
    grouping column, so the join moves one row per fine key instead of every
    listing (see ``average_from_partials``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(
        F.sum(F.col(price).cast("double")).alias("price_sum"), F.count(price).alias("price_n")
    )


def average_from_partials(
    partials: DataFrame, by: str, names: Sequence[str] = AVG_PRICE_COLUMNS, sort: bool = True
) -> DataFrame:
    """A1 finish: ``round(sum / count, 2)`` per group, sorted by the average desc.

    The name is a tie-break so the order is total.  ``sort=False`` leaves the
    order open for callers that join or aggregate the KPI further.
    """
    group_name, avg_name = names
    out = partials.groupBy(F.col(by).alias(group_name)).agg(
        round_exact(F.try_divide(F.sum("price_sum"), F.sum("price_n")), 2).alias(avg_name)
    )
    return out.orderBy(F.col(avg_name).desc(), F.col(group_name).asc()) if sort else out


def avg_price_by(
    df: DataFrame, by: str = "neighborhood", price: str = "price", operation: str | None = None, sort: bool = True, exact: bool = False
) -> DataFrame:
    """A1 + O1 + X8: average listing price per ``by``, 2 decimals, desc.

    Sale and rent listings are mixed as in the source unless ``operation`` is
    given (Q11).  Null prices are ignored (Q12).  ``exact`` sums without
    rounding, so that the figure is the same for every partitioning.
    """
    if operation is not None:
        df = df.where(F.col("operation") == operation)
    if exact:
        df = df.withColumn("__by", F.col(by))
        partials = exact_sums(df, ["__by"], price).select(F.col("__by").alias(by), F.col("total").alias("price_sum"), F.col("n").alias("price_n"))
        return average_from_partials(partials, by, sort=sort)
    return average_from_partials(price_partials(df, by, price), by, sort=sort)


def monthly_rent_rows(rent: DataFrame, label: str = RENT_MONTHLY_LABEL, sentinels=PRICE_SENTINELS) -> DataFrame:
    """F3 + F4: rows of the monthly-rent measure whose price text is a number."""
    return rent.where((F.col("Lloguer_mitja") == label) & is_price_text(F.col("Preu"), sentinels))


def avg_rent(rent: DataFrame, label: str = RENT_MONTHLY_LABEL, sentinels=PRICE_SENTINELS, exact: bool = False) -> DataFrame:
    """A3: mean monthly rent per (year, neighborhood); quarters weigh equally.

    ``exact`` sums without rounding, as in ``avg_price_by``.

    Output: year (bigint), neighborhood, avg_rent.  Grouped by the measure as
    well, then the measure is dropped (it is constant after F3).
    """
    rows = monthly_rent_rows(rent, label, sentinels)
    if exact:
        rows = rows.select(F.col("year").cast("bigint").alias("year"), "neighborhood", text_to_double(F.col("Preu")).alias("price"))
        return exact_average(rows, ["year", "neighborhood"], "price", "avg_rent")
    return (
        rows.groupBy(F.col("year").cast("bigint").alias("year"), "neighborhood", "Lloguer_mitja")
        .agg(F.avg(text_to_double(F.col("Preu"))).alias("avg_rent"))
        .drop("Lloguer_mitja")
    )


def roi_from_avg_rent(listings: DataFrame, rents: DataFrame) -> DataFrame:
    """J5 + X9 + A4 on an already averaged rent table (year, neighborhood, avg_rent).

    The rent side has one row per (year, neighborhood); adaptive execution
    broadcasts it where its size, known at runtime, allows it.
    ``distinct`` (A4/U2) combines map-side.  Listings written in partitions by
    year (a column of that name) are joined on it, so that only the partitions
    of years with a rent are read.
    """
    y, n, code, roi_name = ROI_COLUMNS
    year = F.col(y).cast("bigint") if y in listings.columns else year_of(F.col("date"))
    l = listings.select(
        year.alias(y),
        F.col("neighborhood").alias(n),
        F.col("propertyCode").cast("bigint").alias(code),
        F.col("price"),
    )
    joined = l.join(rents, [y, n], "inner")
    return joined.select(y, n, code, payback_years(F.col("price"), F.col("avg_rent")).alias(roi_name)).distinct()


def roi_names(listings: DataFrame, rents: DataFrame) -> DataFrame:
    """The neighborhoods that ``roi_from_avg_rent`` has rows of, without computing those."""
    y, n = ROI_COLUMNS[:2]
    keys = listings.select(year_of(F.col("date")).alias(y), F.col("neighborhood").alias(n)).distinct()
    return keys.join(rents.select(y, n), [y, n], "left_semi").select(n).distinct()


def roi(listings: DataFrame, rent: DataFrame, label: str = RENT_MONTHLY_LABEL, sentinels=PRICE_SENTINELS, exact: bool = False) -> DataFrame:
    """Years of rent that pay back each listing's price.

    ``ROI/Year = price / (12 * mean monthly rent of its year and neighborhood)``
    (Q8: a payback period, the name is kept).  Listings without a rent figure
    for their (year, neighborhood) drop; zero rent gives null (Q7).
    """
    return roi_from_avg_rent(listings, avg_rent(rent, label, sentinels, exact))
