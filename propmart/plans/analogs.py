"""The operators run on the driver's synthetic tables, with DuckDB oracle SQL.

Each query reads whole tables from ``sf_dir`` and maps them onto the roles of
the property data (orders = listings with a price, nation = neighborhood,
region = district, lineitem prices = rent figures, pages = crawled portal
pages).  Floating results are rounded to 6 digits on both sides because the
engines sum doubles in different orders; the average-price KPI keeps its
2-digit form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propmart.functions.conform import conform
from propmart.functions.dates import snapshot_date
from propmart.operators.kpi import average_from_partials, avg_rent, price_partials, roi, roi_from_avg_rent, roi_names
from propmart.operators.links import extract_links, new_links, resolve_links
from propmart.operators.ml import (
    hash_split,
    linear_fit,
    one_hot_encoder,
    predict,
    price_pipeline,
    regression_metrics,
    segment_average,
    split_label,
    string_indexers,
)
from propmart.operators.reconcile import lookup_conflicts, reconcile
from propmart.operators.snapshot import latest_dates, latest_snapshot, require_key
from propmart.operators.tables import format_income, format_listings, format_rent, union_by_name
from propmart.operators.views import kpi_mart, view_avg_price, view_roi
from propmart.schemas import (
    INCOME_RANGES,
    INCOME_RAW_INDEX_HEADER,
    INCOME_SCHEMA,
    LOOKUP_COLUMNS,
    LOOKUP_SCHEMA,
    RENT_MONTHLY_LABEL,
    RENT_RANGES,
    RENT_SCHEMA,
    ROI_COLUMNS,
    struct_of,
)
from propmart.sources.parquet import read_table, read_with_source
from propmart.session import scratch_path, ship_package
from propmart.sources.raw import bind_by_header, income_names, json_records, listings_from_records, read_csv_inferred, read_listings, records_inferred

ROI = ROI_COLUMNS[3]
OTHER_RENT_LABEL = "Lloguer mitjà per superfície (Euros/m2 mes)"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def _r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# Shared analog inputs
# ---------------------------------------------------------------------------


def nation_names(spark, sf, with_district: bool = True) -> DataFrame:
    """(nationkey, neighborhood, district, district_code) from nation + region.

    ``with_district=False`` skips the region join for callers that only need
    the neighborhood name (the planner cannot drop an inner join by itself).
    """
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    if not with_district:
        return n.select("n_nationkey", F.col("n_name").alias("neighborhood"))
    r = _t(spark, sf, "region").select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey"),
        F.col("n_name").alias("neighborhood"),
        F.col("r_name").alias("district"),
        F.col("n_regionkey").alias("district_code"),
    )


def order_listings(spark, sf) -> DataFrame:
    """orders as listings: propertyCode, date, price, neighborhood."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf, with_district=False)
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(nn, F.col("c_nationkey") == nn.n_nationkey)
        .select(
            F.col("o_orderkey").alias("propertyCode"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_totalprice").alias("price"),
            "neighborhood",
        )
    )


def analog_lookup(spark, sf) -> DataFrame:
    """Lookup rows (district, neighborhood -> reconciled names) of the nations customers live in.

    The customer keys are reduced to their distinct nations before the joins
    (combined map-side), so the big table never reaches a join.
    """
    keys = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    nn = nation_names(spark, sf)
    return (
        keys.join(nn, keys.k == nn.n_nationkey)
        .select(
            "district",
            "neighborhood",
            F.lower("district").alias("district_n_reconciled"),
            F.lower("neighborhood").alias("neighborhood_n_reconciled"),
        )
    )


_LOOKUP_SQL = """
SELECT DISTINCT r.r_name AS district, n.n_name AS neighborhood,
       lower(r.r_name) AS district_n_reconciled, lower(n.n_name) AS neighborhood_n_reconciled
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

_ORDER_LISTINGS_SQL = """
SELECT o.o_orderkey AS propertyCode, CAST(o.o_orderdate AS DATE) AS date, o.o_totalprice AS price,
       n.n_name AS neighborhood, r.r_name AS district
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def monthly_rent_per_nation(spark, sf) -> DataFrame:
    """(year, neighborhood, avg_rent): mean line price per order year and nation.

    Pre-aggregated per order, then per (year, customer), before the joins that
    add the nation, so each join moves partial sums instead of line items.
    """
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    per_order = price_partials(li, "l_orderkey", "l_extendedprice")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("bigint").alias("year"))
    per_cust = (
        per_order.join(o, per_order.l_orderkey == o.o_orderkey)
        .groupBy("year", "o_custkey")
        .agg(F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"))
    )
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf, with_district=False)
    return (
        per_cust.join(c, per_cust.o_custkey == c.c_custkey)
        .join(nn, F.col("c_nationkey") == nn.n_nationkey)
        .groupBy("year", "neighborhood")
        .agg((F.sum("price_sum") / F.sum("price_n")).alias("avg_rent"))
    )


_RENT_PER_NATION_SQL = """
SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, n.n_name AS neighborhood, avg(l.l_extendedprice) AS avg_rent
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
"""


def line_rent_rows(spark, sf) -> DataFrame:
    """Rent-table rows from lineitem: year of shipping, return flag as the
    neighborhood, tax as the price text, and '0' for flag N (zero rent)."""
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("neighborhood"),
        F.lit(RENT_MONTHLY_LABEL).alias("Lloguer_mitja"),
        F.when(F.col("l_returnflag") == "N", F.lit("0"))
        .otherwise(F.col("l_tax").cast("decimal(6,2)").cast("string"))
        .alias("Preu"),
    )


def line_listings(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("neighborhood"),
        F.col("l_orderkey").alias("propertyCode"),
        F.col("l_extendedprice").alias("price"),
    )


_LINE_ROI_SQL = f"""
WITH rent AS (
  SELECT year(l_shipdate) AS year, l_returnflag AS neighborhood,
         '{RENT_MONTHLY_LABEL}' AS Lloguer_mitja,
         CASE WHEN l_returnflag = 'N' THEN '0' ELSE CAST(CAST(l_tax AS DECIMAL(6,2)) AS VARCHAR) END AS Preu
  FROM lineitem),
ar AS (
  SELECT year, neighborhood, avg(CAST(Preu AS DOUBLE)) AS avg_rent FROM rent
  WHERE Lloguer_mitja = '{RENT_MONTHLY_LABEL}' AND Preu NOT IN ('NA', 'N/A', '--')
  GROUP BY year, neighborhood, Lloguer_mitja),
lst AS (
  SELECT year(l_shipdate) AS year, l_returnflag AS neighborhood, l_orderkey AS propertyCode,
         l_extendedprice AS price FROM lineitem),
d AS (
  SELECT DISTINCT CAST(lst.year AS BIGINT) AS year, lst.neighborhood, CAST(lst.propertyCode AS BIGINT) AS propertyCode,
         CASE WHEN ar.avg_rent = 0 THEN NULL ELSE lst.price / (12 * ar.avg_rent) END AS payback
  FROM lst JOIN ar ON lst.year = ar.year AND lst.neighborhood = ar.neighborhood)
SELECT year, neighborhood, propertyCode, round(payback, 6) AS "ROI/Year" FROM d
"""


def part_rent_rows(spark, sf) -> DataFrame:
    """Rent-table rows from part with every kind of price text.

    Price text by size band: '--', 'NA', 'nan', 'N/A', null, else the retail
    price with 2 decimals; the SMALL type carries another measure label.
    """
    p = _t(spark, sf, "part")
    size = F.col("p_size")
    text = (
        F.when(size <= 3, F.lit("--"))
        .when(size <= 6, F.lit("NA"))
        .when(size <= 9, F.lit("nan"))
        .when(size <= 11, F.lit("N/A"))
        .when(size == 12, F.lit(None).cast("string"))
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    )
    return p.select(
        (F.lit(2019) + F.ceil(size / 17)).cast("int").alias("year"),
        F.col("p_brand").alias("neighborhood"),
        F.when(F.col("p_type") == "SMALL", F.lit(OTHER_RENT_LABEL)).otherwise(F.lit(RENT_MONTHLY_LABEL)).alias(
            "Lloguer_mitja"
        ),
        text.alias("Preu"),
    )


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


def q_avg_by_group(spark, sf, sort: bool = True) -> DataFrame:
    """A1 + O1 + X8: average order price per nation, 2 decimals, desc.

    Orders are summed per customer first; only those partials meet the
    customer table.
    """
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice")
    partial = price_partials(o, "o_custkey", "o_totalprice")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf, with_district=False)
    p = partial.join(c, partial.o_custkey == c.c_custkey).join(nn, F.col("c_nationkey") == nn.n_nationkey)
    return average_from_partials(p.select("neighborhood", "price_sum", "price_n"), "neighborhood", sort=sort)


_A1_SQL = """
SELECT n.n_name AS Neighborhood, round(avg(o.o_totalprice), 2) AS Average_Price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""


def q_top_n(spark, sf) -> DataFrame:
    """O3: the five most expensive nations of the A1 KPI."""
    return q_avg_by_group(spark, sf).limit(5)


_O3_SQL = _A1_SQL + " ORDER BY Average_Price DESC, Neighborhood LIMIT 5"


def q_latest_snapshot(spark, sf) -> DataFrame:
    """Latest day of events per user, ties kept."""
    ev = _t(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("date"), "event_type", "value"
    )
    return latest_snapshot(ev, "user_id", "date")


_J1_SQL = """
SELECT event_id, user_id, date, event_type, value FROM (
  SELECT event_id, user_id, CAST(ts AS DATE) AS date, event_type, value,
         rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) AS r
  FROM events) WHERE r = 1
"""


def q_latest_orders(spark, sf) -> DataFrame:
    """J1 on orders: each customer's orders of its last order day."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"), "o_totalprice"
    )
    return latest_snapshot(o, "o_custkey", "date")


_J1_ORDERS_SQL = """
SELECT o_orderkey, o_custkey, date, o_totalprice FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice,
         rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS r
  FROM orders) WHERE r = 1
"""


def q_latest_dates(spark, sf) -> DataFrame:
    """A2: last event day per user."""
    ev = _t(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("date"))
    return latest_dates(ev, "user_id", "date").withColumnRenamed("__latest", "latest_date")


_A2_SQL = "SELECT user_id, max(CAST(ts AS DATE)) AS latest_date FROM events GROUP BY user_id"


def q_required_key(spark, sf) -> DataFrame:
    """drop rows whose key (event type, 'error' meaning unknown) is null."""
    ev = _t(spark, sf, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_key"), "value"
    )
    return require_key(ev, "event_key")


_F2_SQL = """
SELECT event_id, user_id, event_key, value FROM (
  SELECT event_id, user_id, nullif(event_type, 'error') AS event_key, value FROM events)
WHERE event_key IS NOT NULL
"""


def q_source_file(spark, sf) -> DataFrame:
    """Every nation row with the name of the file it came from."""
    n = read_with_source(spark, f"{sf}/nation.parquet")
    return n.select("n_nationkey", "n_name", "source_file")


_S11_SQL = "SELECT n_nationkey, n_name, 'nation.parquet' AS source_file FROM nation"


def q_date_from_name(spark, sf) -> DataFrame:
    """X4 + X5: snapshot date parsed back from a yyyy_MM_dd_... file name."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit("_idealista.json")).alias("source_file"),
    )
    return o.select("o_orderkey", snapshot_date(F.col("source_file")).alias("date"))


_X5_SQL = """
SELECT o_orderkey,
       CAST(strptime(substr(strftime(o_orderdate, '%Y_%m_%d') || '_idealista.json', 1, 10), '%Y_%m_%d') AS DATE) AS date
FROM orders
"""


def q_lookup_distinct(spark, sf) -> DataFrame:
    """A5: distinct lookup rows."""
    return analog_lookup(spark, sf)


def _supplier_raw(spark, sf) -> DataFrame:
    """Supplier rows with raw names; suppliers in debt spell the nation in lower case."""
    s = _t(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    nn = nation_names(spark, sf)
    return s.join(nn, s.s_nationkey == nn.n_nationkey).select(
        "s_suppkey",
        "s_acctbal",
        F.col("district").alias("Nom_Districte"),
        F.when(F.col("s_acctbal") < 0, F.lower("neighborhood")).otherwise(F.col("neighborhood")).alias("Nom_Barri"),
    )


def q_reconcile_two_keys(spark, sf) -> DataFrame:
    """Reconcile on (district, neighborhood); misspelled rows drop."""
    rec = reconcile(
        _supplier_raw(spark, sf),
        analog_lookup(spark, sf),
        on=[("Nom_Districte", "district"), ("Nom_Barri", "neighborhood")],
        take={"district": "district_n_reconciled", "neighborhood": "neighborhood_n_reconciled"},
    )
    return rec.select("s_suppkey", "s_acctbal", "district", "neighborhood")


_J2_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}),
s AS (
  SELECT s.s_suppkey, s.s_acctbal, r.r_name AS Nom_Districte,
         CASE WHEN s.s_acctbal < 0 THEN lower(n.n_name) ELSE n.n_name END AS Nom_Barri
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT s.s_suppkey, s.s_acctbal, lk.district_n_reconciled AS district, lk.neighborhood_n_reconciled AS neighborhood
FROM s JOIN lk ON s.Nom_Districte = lk.district AND s.Nom_Barri = lk.neighborhood
"""


def _customer_raw(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nn = nation_names(spark, sf)
    return c.join(nn, c.c_nationkey == nn.n_nationkey).select("c_custkey", "c_acctbal", "neighborhood", "district")


_CUSTOMER_RAW_SQL = """
SELECT c.c_custkey, c.c_acctbal, n.n_name AS neighborhood, r.r_name AS district
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _reconcile_customers(spark, sf, lookup: DataFrame, keep_fanout: bool) -> DataFrame:
    rec = reconcile(
        _customer_raw(spark, sf),
        lookup,
        on=[("neighborhood", "neighborhood")],
        take={"neighborhood": "neighborhood_n_reconciled"},
        keep_fanout=keep_fanout,
    )
    return rec.select("c_custkey", "c_acctbal", "neighborhood", "district")


def q_reconcile_one_key(spark, sf) -> DataFrame:
    """J4 + P6: reconcile the neighborhood name only; the district stays raw."""
    return _reconcile_customers(spark, sf, analog_lookup(spark, sf), keep_fanout=False)


_J4_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}), c AS ({_CUSTOMER_RAW_SQL})
SELECT c.c_custkey, c.c_acctbal, l.neighborhood_n_reconciled AS neighborhood, c.district
FROM c JOIN (SELECT DISTINCT neighborhood, neighborhood_n_reconciled FROM lk) l ON c.neighborhood = l.neighborhood
"""


def _two_rows_per_name(spark, sf) -> DataFrame:
    """Lookup where each neighborhood appears under two district spellings."""
    lk = analog_lookup(spark, sf)
    return lk.unionByName(lk.withColumn("district", F.lower("district")))


def q_fanout(spark, sf) -> DataFrame:
    """Q4 with ``keep_fanout=True``: whole-row distinct lookup multiplies rows."""
    return _reconcile_customers(spark, sf, _two_rows_per_name(spark, sf), keep_fanout=True)


_LOOKUP2_SQL = f"SELECT * FROM ({_LOOKUP_SQL}) UNION ALL SELECT lower(district), neighborhood, district_n_reconciled, neighborhood_n_reconciled FROM ({_LOOKUP_SQL})"

_J4_FANOUT_SQL = f"""
WITH lk AS (SELECT DISTINCT * FROM ({_LOOKUP2_SQL})), c AS ({_CUSTOMER_RAW_SQL})
SELECT c.c_custkey, c.c_acctbal, lk.neighborhood_n_reconciled AS neighborhood, c.district
FROM c JOIN lk ON c.neighborhood = lk.neighborhood
"""


def q_fanout_dedup(spark, sf) -> DataFrame:
    """Q4 default: key + reconciled name distinct, no multiplication."""
    return _reconcile_customers(spark, sf, _two_rows_per_name(spark, sf), keep_fanout=False)


_J4_DEDUP_SQL = f"""
WITH lk AS ({_LOOKUP2_SQL}), c AS ({_CUSTOMER_RAW_SQL})
SELECT c.c_custkey, c.c_acctbal, l.neighborhood_n_reconciled AS neighborhood, c.district
FROM c JOIN (SELECT DISTINCT neighborhood, neighborhood_n_reconciled FROM lk) l ON c.neighborhood = l.neighborhood
"""


def q_lookup_conflicts(spark, sf) -> DataFrame:
    """Q4 report: neighborhoods that reconcile to two names (Asian nations get a variant)."""
    lk = analog_lookup(spark, sf)
    alt = lk.where(F.col("district") == "ASIA").withColumn(
        "neighborhood_n_reconciled", F.concat("neighborhood_n_reconciled", F.lit("_alt"))
    )
    return lookup_conflicts(lk.unionByName(alt), ["neighborhood"])


_Q4_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}),
lk3 AS (SELECT * FROM lk UNION ALL
        SELECT district, neighborhood, district_n_reconciled, neighborhood_n_reconciled || '_alt' FROM lk
        WHERE district = 'ASIA')
SELECT neighborhood, count(DISTINCT neighborhood_n_reconciled) AS n_names,
       min(neighborhood_n_reconciled) AS first_name, max(neighborhood_n_reconciled) AS last_name
FROM lk3 GROUP BY neighborhood HAVING count(DISTINCT neighborhood_n_reconciled) > 1
"""


def q_sentinel_avg(spark, sf) -> DataFrame:
    """F3 + F4 + X7 + A3: mean monthly rent without sentinel, NaN or null prices."""
    out = avg_rent(part_rent_rows(spark, sf))
    return out.select("year", "neighborhood", _r6(F.col("avg_rent")).alias("avg_rent"))


_F4_SQL = f"""
WITH r AS (
  SELECT CAST(2019 + ceil(p_size / 17) AS INTEGER) AS year, p_brand AS neighborhood,
         CASE WHEN p_type = 'SMALL' THEN '{OTHER_RENT_LABEL}' ELSE '{RENT_MONTHLY_LABEL}' END AS Lloguer_mitja,
         CASE WHEN p_size <= 3 THEN '--' WHEN p_size <= 6 THEN 'NA' WHEN p_size <= 9 THEN 'nan'
              WHEN p_size <= 11 THEN 'N/A' WHEN p_size = 12 THEN NULL
              ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS Preu
  FROM part)
SELECT CAST(year AS BIGINT) AS year, neighborhood, round(avg(TRY_CAST(Preu AS DOUBLE)), 6) AS avg_rent
FROM r
WHERE Lloguer_mitja = '{RENT_MONTHLY_LABEL}' AND Preu NOT IN ('NA', 'N/A', '--')
  AND TRY_CAST(Preu AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(Preu AS DOUBLE))
GROUP BY year, neighborhood, Lloguer_mitja
"""


def _roi_per_nation(spark, sf) -> DataFrame:
    return roi_from_avg_rent(order_listings(spark, sf), monthly_rent_per_nation(spark, sf))


def q_roi(spark, sf) -> DataFrame:
    """G3 + J5 + X6 + X9 + A4: payback years of each order against its nation's yearly mean."""
    out = _roi_per_nation(spark, sf)
    return out.select("year", "neighborhood", "propertyCode", _r6(F.col(f"`{ROI}`")).alias(ROI))


# paybacks are distinct before they are rounded, as in the operator
_G3_SQL = f"""
WITH rent AS ({_RENT_PER_NATION_SQL}), lst AS ({_ORDER_LISTINGS_SQL}),
d AS (SELECT DISTINCT CAST(year(lst.date) AS BIGINT) AS year, lst.neighborhood, CAST(lst.propertyCode AS BIGINT) AS propertyCode,
             lst.price / (12 * rent.avg_rent) AS payback
      FROM lst JOIN rent ON CAST(year(lst.date) AS BIGINT) = rent.year AND lst.neighborhood = rent.neighborhood)
SELECT year, neighborhood, propertyCode, round(payback, 6) AS "ROI/Year" FROM d
"""


def _line_roi(spark, sf) -> DataFrame:
    return roi(line_listings(spark, sf), line_rent_rows(spark, sf))


def q_zero_rent(spark, sf) -> DataFrame:
    """Q7/X9 through the whole G3 operator: a zero mean rent gives a null payback."""
    out = _line_roi(spark, sf)
    return out.select("year", "neighborhood", "propertyCode", _r6(F.col(f"`{ROI}`")).alias(ROI))


def q_segment_avg(spark, sf) -> DataFrame:
    """Mean retail price over each (brand, type) segment, on every part row."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    out = segment_average(p, ["p_brand", "p_type"], "p_retailprice", "segment_avg")
    return out.select("p_partkey", "p_brand", "p_type", "p_retailprice", _r6(F.col("segment_avg")).alias("segment_avg"))


_W1_SQL = """
SELECT p_partkey, p_brand, p_type, p_retailprice,
       round(avg(p_retailprice) OVER (PARTITION BY p_brand, p_type), 6) AS segment_avg
FROM part
"""


def q_bar_view(spark, sf) -> DataFrame:
    """V1 = A6 + O4 over the A1 KPI."""
    return view_avg_price(q_avg_by_group(spark, sf, sort=False))


_V1_SQL = f"SELECT Neighborhood, sum(Average_Price) AS sum_Average_Price FROM ({_A1_SQL}) GROUP BY Neighborhood"


def q_mark_view(spark, sf) -> DataFrame:
    """V2 = F5 + A8 over a payback table that has null values."""
    v = view_roi(_line_roi(spark, sf), already_distinct=True)
    return v.select("neighborhood", "propertyCode", "year", _r6(F.col(f"`{ROI}`")).alias(ROI))


_V2_SQL = f"""
SELECT neighborhood, propertyCode, year, "ROI/Year" FROM ({_LINE_ROI_SQL})
WHERE "ROI/Year" IS NOT NULL AND NOT isnan("ROI/Year")
"""


def _mart(roi_df: DataFrame, avg_df: DataFrame, names: DataFrame) -> DataFrame:
    m = kpi_mart(roi_df, avg_df, names)
    return m.select("neighborhood", "year", "propertyCode", _r6(F.col(f"`{ROI}`")).alias(ROI), "Average_Price")


def q_kpi_mart(spark, sf) -> DataFrame:
    """Payback rows related to the average-price KPI by neighborhood."""
    listings, rents = order_listings(spark, sf), monthly_rent_per_nation(spark, sf)
    return _mart(roi_from_avg_rent(listings, rents), q_avg_by_group(spark, sf, sort=False), roi_names(listings, rents))


_J7_SQL = f"""
SELECT coalesce(r.neighborhood, a.Neighborhood) AS neighborhood, r.year, r.propertyCode, r."ROI/Year", a.Average_Price
FROM ({_G3_SQL}) r FULL OUTER JOIN ({_A1_SQL}) a ON r.neighborhood = a.Neighborhood
"""


def q_kpi_mart_disjoint(spark, sf) -> DataFrame:
    """J7 where no name matches (return flags vs nations): both outer sides kept."""
    listings, rents = line_listings(spark, sf), avg_rent(line_rent_rows(spark, sf))
    return _mart(roi_from_avg_rent(listings, rents), q_avg_by_group(spark, sf, sort=False), roi_names(listings, rents))


_J7_DISJOINT_SQL = f"""
SELECT coalesce(r.neighborhood, a.Neighborhood) AS neighborhood, r.year, r.propertyCode, r."ROI/Year", a.Average_Price
FROM ({_LINE_ROI_SQL}) r FULL OUTER JOIN ({_A1_SQL}) a ON r.neighborhood = a.Neighborhood
"""


def q_links(spark, sf) -> DataFrame:
    """Every anchor href of every page."""
    return extract_links(_t(spark, sf, "pages").select("page_id", "url", "html"))


# written without a pattern: the given pages open every anchor in this one way
_HREFS_SQL = """
SELECT page_id, url, replace(split_part(piece, '"', 1), '&amp;', '&') AS href
FROM (SELECT page_id, url, unnest(str_split(html, '<a href="')[2:]) AS piece FROM pages)
"""


def q_link_suffix(spark, sf) -> DataFrame:
    """anchors whose href ends with a suffix."""
    return extract_links(_t(spark, sf, "pages").select("page_id", "url", "html"), suffix="s")


_F7_SQL = f"SELECT * FROM ({_HREFS_SQL}) WHERE suffix(href, 's')"


def _resolved(spark, sf) -> DataFrame:
    return resolve_links(q_links(spark, sf))


def q_resolve(spark, sf) -> DataFrame:
    """X2 + X3: download URL and file name of every link."""
    return _resolved(spark, sf).select("page_id", "href", "link_url", "file_name")


_RESOLVED_SQL = f"""
WITH l AS ({_HREFS_SQL}),
j AS (SELECT page_id, url, href, url || href AS joined FROM l),
u AS (SELECT page_id, url, href,
             'https://' || CASE WHEN strpos(joined, '//') > 0 THEN regexp_extract(joined, '(?s).*//(.*)$', 1)
                                ELSE joined END AS link_url FROM j)
SELECT page_id, url, href, link_url, regexp_extract(link_url, '[^/]*$') AS file_name FROM u
"""

_X2_SQL = f"SELECT page_id, href, link_url, file_name FROM ({_RESOLVED_SQL})"


def q_new_links(spark, sf) -> DataFrame:
    """Links whose file is not stored yet; stored = files linked from English pages."""
    links = _resolved(spark, sf)
    stored = links.where(F.col("url").contains("/en/"))
    return new_links(links, stored).select("page_id", "href", "link_url", "file_name")


_J6_SQL = f"""
WITH r AS ({_RESOLVED_SQL})
SELECT page_id, href, link_url, file_name FROM r
WHERE NOT EXISTS (SELECT 1 FROM r s WHERE strpos(s.url, '/en/') > 0 AND s.file_name = r.file_name)
"""


def q_formatted_listings(spark, sf) -> DataFrame:
    """G1 listing path F2 + J1 + J4 + P1: each customer's orders of its last
    order day as listings, neighborhood reconciled, 15 formatted columns."""
    o = _t(spark, sf, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf)
    raw = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(nn, F.col("c_nationkey") == nn.n_nationkey)
        .select(
            "neighborhood",
            "district",
            F.col("o_custkey").alias("propertyCode"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.floor("o_totalprice").cast("bigint").alias("price"),
            F.col("o_totalprice").alias("size"),
            F.lit(None).cast("int").alias("rooms"),
            F.lit(None).cast("int").alias("bathrooms"),
            F.lit(None).cast("float").alias("latitude"),
            F.lit(None).cast("float").alias("longitude"),
            F.col("o_orderstatus").alias("operation"),
            F.col("o_orderpriority").alias("propertyType"),
            F.lit(None).cast("string").alias("floor"),
            F.col("o_orderstatus").alias("status"),
            (F.col("o_orderpriority") == "1-URGENT").alias("hasLift"),
        )
    )
    latest = latest_snapshot(require_key(raw, "neighborhood"), "propertyCode", "date")
    return format_listings(latest, analog_lookup(spark, sf))


_G1_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}),
raw AS (
  SELECT n.n_name AS neighborhood, r.r_name AS district, o.o_custkey AS propertyCode,
         CAST(o.o_orderdate AS DATE) AS date, CAST(floor(o.o_totalprice) AS BIGINT) AS price,
         o.o_totalprice AS size, o.o_orderstatus AS operation, o.o_orderpriority AS propertyType,
         o.o_orderstatus AS status, o.o_orderpriority = '1-URGENT' AS hasLift
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE n.n_name IS NOT NULL),
latest AS (SELECT * FROM raw QUALIFY rank() OVER (PARTITION BY propertyCode ORDER BY date DESC) = 1)
SELECT l.neighborhood_n_reconciled AS neighborhood, latest.district, CAST(latest.propertyCode AS BIGINT) AS propertyCode,
       latest.date, latest.price, latest.size, CAST(NULL AS BIGINT) AS rooms, CAST(NULL AS BIGINT) AS bathrooms,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, latest.operation, latest.propertyType,
       CAST(NULL AS VARCHAR) AS floor, latest.status, latest.hasLift
FROM latest JOIN (SELECT DISTINCT neighborhood, neighborhood_n_reconciled FROM lk) l ON latest.neighborhood = l.neighborhood
"""


def income_rows(spark, sf) -> DataFrame:
    """Income-table rows: per order year and nation, customers as population and
    order count as the index text; 1995 rows spell the nation in lower case
    (so they do not reconcile).  Orders are counted per (year, customer) before
    the customer join."""
    o = _t(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("Any"))
    per_cust = o.groupBy("Any", "o_custkey").agg(F.count("*").alias("n_orders"))
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf)
    per_nation = (
        per_cust.join(c, per_cust.o_custkey == c.c_custkey)
        .groupBy("Any", "c_nationkey")
        .agg(F.count("*").alias("pop"), F.sum("n_orders").alias("n_orders"))
    )
    j = per_nation.join(nn, per_nation.c_nationkey == nn.n_nationkey)
    return j.select(
        F.col("Any").cast("int").alias("Any"),
        F.col("district_code").cast("smallint").alias("Codi_Districte"),
        F.col("district").alias("Nom_Districte"),
        F.col("n_nationkey").cast("smallint").alias("Codi_Barri"),
        F.when(F.col("Any") == 1995, F.lower("neighborhood")).otherwise(F.col("neighborhood")).alias("Nom_Barri"),
        F.col("pop").cast("bigint").alias("Població"),
        F.col("n_orders").cast("string").alias("Index_RFD_Barcelona_100"),
    )


def q_format_income(spark, sf) -> DataFrame:
    """P2 + J2: income rows reconciled on (district, neighborhood), formatted."""
    return format_income(income_rows(spark, sf), analog_lookup(spark, sf))


_P2_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}),
inc AS (
  SELECT year(o.o_orderdate) AS y, r.r_name AS Nom_Districte,
         CASE WHEN year(o.o_orderdate) = 1995 THEN lower(n.n_name) ELSE n.n_name END AS Nom_Barri,
         count(DISTINCT o.o_custkey) AS pop, count(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY year(o.o_orderdate), r.r_name, n.n_name)
SELECT lk.district_n_reconciled AS district, lk.neighborhood_n_reconciled AS neighborhood, CAST(inc.y AS BIGINT) AS year,
       CAST(inc.pop AS BIGINT) AS populatonBCN, CAST(inc.n_orders AS VARCHAR) AS Index_RFD_Barcelona_100
FROM inc JOIN lk ON inc.Nom_Districte = lk.district AND inc.Nom_Barri = lk.neighborhood
"""


def rent_rows(spark, sf) -> DataFrame:
    """Rent-table rows, one per line item: shipping year and quarter, the
    order's customer nation, line price as the price text; returned lines
    (flag R) carry the per-area measure label."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nn = nation_names(spark, sf)
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey).join(
        nn, F.col("c_nationkey") == nn.n_nationkey
    )
    return j.select(
        F.year("l_shipdate").alias("Any"),
        F.quarter("l_shipdate").cast("smallint").alias("Trimestre"),
        F.col("district_code").cast("smallint").alias("Codi_Districte"),
        F.col("district").alias("Nom_Districte"),
        F.col("n_nationkey").cast("smallint").alias("Codi_Barri"),
        F.col("neighborhood").alias("Nom_Barri"),
        F.when(F.col("l_returnflag") == "R", F.lit(OTHER_RENT_LABEL)).otherwise(F.lit(RENT_MONTHLY_LABEL)).alias("Lloguer_mitja"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("Preu"),
    )


_RENT_ROWS_SQL = f"""
SELECT year(l.l_shipdate) AS Any, quarter(l.l_shipdate) AS Trimestre, r.r_name AS Nom_Districte, n.n_name AS Nom_Barri,
       CASE WHEN l.l_returnflag = 'R' THEN '{OTHER_RENT_LABEL}' ELSE '{RENT_MONTHLY_LABEL}' END AS Lloguer_mitja,
       CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS Preu
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def q_format_rent(spark, sf) -> DataFrame:
    """P3 + J3: rent rows reconciled on (district, neighborhood), formatted."""
    return format_rent(rent_rows(spark, sf), analog_lookup(spark, sf))


_P3_SQL = f"""
WITH lk AS ({_LOOKUP_SQL}), rr AS ({_RENT_ROWS_SQL})
SELECT lk.district_n_reconciled AS district, lk.neighborhood_n_reconciled AS neighborhood, CAST(rr.Any AS BIGINT) AS year,
       CAST(rr.Trimestre AS BIGINT) AS Trimestre, rr.Lloguer_mitja, rr.Preu
FROM rr JOIN lk ON rr.Nom_Districte = lk.district AND rr.Nom_Barri = lk.neighborhood
"""


def q_pipeline_roi(spark, sf) -> DataFrame:
    """G1 + G2 chained: payback KPI from the formatted listing and rent analogs."""
    out = roi(q_formatted_listings(spark, sf), q_format_rent(spark, sf))
    return out.select("year", "neighborhood", "propertyCode", _r6(F.col(f"`{ROI}`")).alias(ROI))


def q_segment_avg_listings(spark, sf) -> DataFrame:
    """W1 with the source's seven segment columns over the formatted-listing analog,
    where floor, rooms and bathrooms are null: null segment keys group together."""
    out = segment_average(q_formatted_listings(spark, sf))
    return out.select("propertyCode", "date", "price", _r6(F.col("avg")).alias("avg"))


_W1_LISTINGS_SQL = f"""
SELECT propertyCode, date, price,
       round(avg(price) OVER (PARTITION BY neighborhood, propertyType, floor, status, size, rooms, bathrooms), 6) AS avg
FROM ({_G1_SQL})
"""


def q_union_by_name(spark, sf) -> DataFrame:
    """Customers and suppliers as one party table with differing columns."""
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("kind"),
    )
    s = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"),
        F.col("s_nationkey").alias("nationkey"),
        F.lit("supplier").alias("kind"),
    )
    return union_by_name([c, s])


_U1_SQL = """
SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment,
       'customer' AS kind, CAST(NULL AS INTEGER) AS nationkey FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR), 'supplier', s_nationkey FROM supplier
"""

ORDERS_TYPED = struct_of(
    [
        ("o_orderkey", T.LongType()),
        ("o_custkey", T.LongType()),
        ("o_orderstatus", T.StringType()),
        ("o_totalprice", T.DoubleType()),
        ("o_orderdate", T.DateType()),
        ("o_orderpriority", T.StringType()),
        ("price_whole", T.IntegerType()),
        ("beyond_double", T.LongType()),
    ]
)
BEYOND_DOUBLE = 2**53 + 1


def q_conform(spark, sf) -> DataFrame:
    """S8 + X10: orders as raw text (whole prices written as '123.0', codes that no
    double can hold), bound to fixed types."""
    o = _t(spark, sf, "orders")
    text = o.select(
        *[F.col(c).cast("string").alias(c) for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]],
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.col("o_orderpriority").cast("string").alias("o_orderpriority"),
        F.concat(F.floor("o_totalprice").cast("string"), F.lit(".0")).alias("price_whole"),
        F.concat((F.col("o_orderkey") + BEYOND_DOUBLE).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".00").otherwise("")).alias("beyond_double"),
    )
    return conform(text, ORDERS_TYPED)


_S8_SQL = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, CAST(floor(o_totalprice) AS INTEGER) AS price_whole, o_orderkey + {BEYOND_DOUBLE} AS beyond_double
FROM orders
"""


def q_string_index(spark, sf) -> DataFrame:
    """M1: part type -> index by frequency desc, then label."""
    p = _t(spark, sf, "part").select("p_partkey", "p_type")
    model = string_indexers(["p_type"])[0].fit(p)
    return model.transform(p).select("p_partkey", "p_type", F.col("p_type_index").cast("int").alias("p_type_index"))


_M1_SQL = """
WITH idx AS (
  SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS INTEGER) AS p_type_index
  FROM part GROUP BY p_type)
SELECT p.p_partkey, p.p_type, idx.p_type_index FROM part p JOIN idx ON p.p_type = idx.p_type
"""


def q_one_hot(spark, sf) -> DataFrame:
    """M2: one-hot slots of the brand fitted on the training split; unseen -> zeros (slot -1)."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand")
    train, _ = hash_split(p, "p_partkey")
    indexer = string_indexers(["p_brand"])[0].fit(train)
    indexed = indexer.transform(p)
    encoder = one_hot_encoder(["p_brand"]).fit(indexer.transform(train))
    slots = F.unwrap_udt("p_brand_encoded")  # the sparse vector's own fields: nothing is made dense
    return encoder.transform(indexed).select(
        "p_partkey",
        "p_brand",
        slots["size"].cast("int").alias("vec_size"),
        F.coalesce(F.get(slots["indices"], F.lit(0)), F.lit(-1)).cast("int").alias("hot_slot"),
    )


_M2_SQL = f"""
WITH tr AS (SELECT * FROM part WHERE substr(md5(CAST(p_partkey AS VARCHAR)), 1, 15) < '{int(0.8 * 16**15):015x}'),
idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS slot
        FROM tr GROUP BY p_brand)
SELECT p.p_partkey, p.p_brand, CAST((SELECT count(*) FROM idx) AS INTEGER) AS vec_size,
       CAST(coalesce(idx.slot, -1) AS INTEGER) AS hot_slot
FROM part p LEFT JOIN idx ON p.p_brand = idx.p_brand
"""


def q_hash_split(spark, sf) -> DataFrame:
    """M6: md5-bucket train/test label of every order."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    return o.select("o_orderkey", split_label(F.col("o_orderkey")).alias("split"))


_TRAIN_BELOW = f"{int(0.8 * 16**15):015x}"

_M6_SQL = f"""
SELECT o_orderkey, CASE WHEN substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) < '{_TRAIN_BELOW}' THEN 'train' ELSE 'test' END AS split
FROM orders
"""


def q_linear_fit(spark, sf) -> DataFrame:
    """M8: least-squares retail price ~ size per brand."""
    fit = linear_fit(_t(spark, sf, "part"), "p_retailprice", "p_size", by=["p_brand"])
    return fit.select("p_brand", _r6(F.col("slope")).alias("slope"), _r6(F.col("intercept")).alias("intercept"), "n")


_M8_SQL = """
SELECT p_brand, round(regr_slope(p_retailprice, p_size), 6) AS slope,
       round(regr_intercept(p_retailprice, p_size), 6) AS intercept,
       CAST(regr_count(p_retailprice, p_size) AS BIGINT) AS n
FROM part GROUP BY p_brand
"""


def q_metrics(spark, sf) -> DataFrame:
    """Rmse, mae, r2 of the per-brand linear fit; a group of one row has no r2."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    fit = linear_fit(p, "p_retailprice", "p_size", by=["p_brand"])
    pred = p.join(fit, "p_brand").withColumn("prediction", F.col("intercept") + F.col("slope") * F.col("p_size"))
    pred = pred.withColumn("p_brand", F.when(F.col("p_partkey") == 1, "one row").otherwise(F.col("p_brand")))
    m = regression_metrics(pred, "p_retailprice", "prediction", by=["p_brand"])
    return m.select("p_brand", *[_r6(F.col(c)).alias(c) for c in ("rmse", "mae", "r2")], "n")


_A7_SQL = """
WITH fit AS (SELECT p_brand, regr_slope(p_retailprice, p_size) AS slope, regr_intercept(p_retailprice, p_size) AS intercept
             FROM part GROUP BY p_brand),
pred AS (SELECT CASE WHEN p.p_partkey = 1 THEN 'one row' ELSE p.p_brand END AS p_brand, p.p_retailprice AS y, fit.intercept + fit.slope * p.p_size AS yhat
         FROM part p JOIN fit ON p.p_brand = fit.p_brand)
SELECT p_brand, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse, round(avg(abs(y - yhat)), 6) AS mae,
       round(1 - sum((y - yhat) * (y - yhat)) / nullif(var_pop(y) * count(y), 0), 6) AS r2, count(y) AS n
FROM pred GROUP BY p_brand
"""


def q_assembled(spark, sf) -> DataFrame:
    """M3: size, price and the one-hot brand of every part as one vector, slot by slot."""
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    stages = price_pipeline(categorical=["p_brand"], numeric=["p_size", "p_retailprice"], label="p_retailprice").getStages()[:-1]
    vector = vector_to_array(F.col("features"))
    return Pipeline(stages=stages).fit(p).transform(p).select(
        "p_partkey",
        F.size(vector).cast("int").alias("vec_size"),
        F.get(vector, F.lit(0)).alias("first_value"),
        F.get(vector, F.lit(1)).alias("second_value"),
        (F.array_position(F.slice(vector, 3, F.size(vector)), 1.0) - 1).cast("int").alias("hot_slot"),
    )


_M3_SQL = """
WITH idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS slot
             FROM part GROUP BY p_brand)
SELECT p_partkey, CAST(2 + (SELECT count(*) FROM idx) AS INTEGER) AS vec_size, CAST(p_size AS DOUBLE) AS first_value,
       p_retailprice AS second_value, slot AS hot_slot
FROM part JOIN idx ON part.p_brand = idx.p_brand
"""


def part_sales(spark, sf) -> DataFrame:
    """Per part: brand, type, lines and quantity sold, and the price paid for them (the label)."""
    sold = _t(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_extendedprice").alias("paid")
    )
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    return p.join(sold, p.p_partkey == sold.l_partkey).drop("l_partkey")


def q_forest(spark, sf) -> DataFrame:
    """M3-M5 + M7: random-forest model of the price paid per part, scored on the test split."""
    train, test = hash_split(part_sales(spark, sf), "p_partkey")
    pipe = price_pipeline(categorical=["p_brand", "p_type"], numeric=["quantity", "n_lines"], label="paid")
    return predict(pipe.fit(train), test).select("p_partkey", "paid", "prediction")


# ---------------------------------------------------------------------------
# Raw readers on texts made of whole tables
# ---------------------------------------------------------------------------


def order_records(spark, sf) -> DataFrame:
    """Two listing records (JSON texts ``plain`` and ``quoted``) per order: numbers plain, and quoted or with '.0'."""
    # one table file is one task; listing files come in many
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority").repartition(32)
    whole = F.floor("o_totalprice").cast("long")
    common = [
        F.struct(F.col("o_orderpriority").alias("typology"), F.lit(None).cast("string").alias("subTypology")).alias("detailedType"),
        F.struct(F.concat(F.col("o_orderstatus"), F.lit(', "quoted" é')).alias("title")).alias("suggestedTexts"),
    ]
    plain = F.to_json(F.struct(
        F.col("o_orderkey").alias("propertyCode"), whole.alias("price"), (whole % 4000 / 4).cast("decimal(18,2)").alias("size"),
        (F.col("o_orderkey") % 100).alias("floor"), (F.col("o_orderstatus") == "O").alias("hasLift"), *common,
    ))
    text = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("propertyCode"), F.concat(whole.cast("string"), F.lit(".0")).alias("price"),
        F.lit("12.5").alias("size"), F.col("o_orderstatus").alias("floor"), F.lit("true").alias("hasLift"),
        F.struct(F.concat((F.col("o_orderkey") % 9).cast("string"), F.lit(".5")).alias("parkingSpacePrice")).alias("parkingSpace"), *common,
    ))
    return o.select("o_orderkey", "o_orderstatus", plain.alias("plain"), text.alias("quoted"))


def order_texts(spark, sf) -> DataFrame:
    """One JSON array of both records per order."""
    value = F.concat(F.lit("["), F.col("plain"), F.lit(",\n "), F.col("quoted"), F.lit("]"))
    return order_records(spark, sf).select(value.alias("value"), F.concat(F.lit("orders_"), F.col("o_orderstatus")).alias("source_file"))


ARRAY_FILES = 4
ORDERS_PER_FILE = 1_000_000  # at most, on average: some 400 MB, several splits


def _text_files(rows: DataFrame, name: str, heads: Sequence[str], glue: str = "", tail: str | None = None) -> str:
    """Write rows (file number ``file``, ``value``) as one text file per number; returns the folder.

    A file begins with its ``heads`` entry and ends with ``tail``; all its
    values but the first follow ``glue``.  The values come in no set order: a
    task writes its file as the shuffle brings them, and holds a batch of it.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = lambda values: pa.RecordBatch.from_arrays([values.cast(pa.string())], ["value"])
        begun = False
        for batch in batches:
            values = batch.column("value")
            if not begun and len(values):
                yield rows_of(pa.array([heads[batch.column("file")[0].as_py()]]))
                yield rows_of(values[:1])
                values, begun = values[1:], True
            yield rows_of(pc.binary_join_element_wise(glue, values.cast(pa.string()), ""))
        if begun and tail is not None:
            yield rows_of(pa.array([tail]))

    path = scratch_path(rows.sparkSession, name)
    rows.repartitionById(len(heads), F.col("file")).select("file", "value").mapInArrow(run, "value string").write.text(path)
    return path


def q_split_arrays(spark, sf) -> DataFrame:
    """All orders in a few JSON array files, without a line break inside a record, cut by every task."""
    n_files = max(ARRAY_FILES, -(-_t(spark, sf, "orders").count() // ORDERS_PER_FILE))
    records = order_records(spark, sf).where(F.col("o_orderkey").isNotNull())
    file = F.pmod(F.xxhash64("o_orderkey"), F.lit(n_files)).cast("int").alias("file")
    path = _text_files(records.select(file, F.concat("plain", F.lit(", "), "quoted").alias("value")), "order-arrays", ["["] * n_files, ",", "]")
    listed = read_listings(spark, path, glob="part-*")
    return listed.select("propertyCode", "price", F.col("size").cast("double").alias("size"), "floor", "hasLift", F.col("suggestedTexts.title").alias("title"))


_S2_SPLIT_SQL = """
SELECT CAST(o_orderkey AS INTEGER) AS propertyCode, CAST(floor(o_totalprice) AS INTEGER) AS price,
       CASE WHEN x.quoted = 1 THEN 12.5 ELSE CAST(floor(o_totalprice) AS BIGINT) % 4000 / 4 END AS size,
       CASE WHEN x.quoted = 1 THEN o_orderstatus ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS floor,
       x.quoted = 1 OR o_orderstatus = 'O' AS hasLift, o_orderstatus || ', "quoted" é' AS title
FROM orders, (VALUES (0), (1)) x(quoted)
"""


def q_inferred_json(spark, sf) -> DataFrame:
    """S3: the same records with an inferred schema; the price is text in half of them."""
    texts = order_records(spark, sf).select(F.explode(F.array("plain", "quoted")).alias("value"), F.lit("orders.json").alias("source_file"))
    df = records_inferred(json_records(texts))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(
        "propertyCode", "price", F.col("size").cast("string").alias("size"), "hasLift", F.col("detailedType.typology").alias("typology"),
        *[F.lit(kinds[c]).alias(f"{c}_type") for c in ("propertyCode", "price", "floor", "detailedType", "parkingSpace")],
    )


_S3_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS propertyCode, CAST(floor(o_totalprice) AS BIGINT)::VARCHAR || CASE WHEN x.quoted = 1 THEN '.0' ELSE '' END AS price,
       CASE WHEN x.quoted = 1 THEN '12.5' ELSE rtrim(rtrim(CAST(CAST(CAST(floor(o_totalprice) AS BIGINT) % 4000 / 4 AS DECIMAL(18, 2)) AS VARCHAR), '0'), '.') END AS size,
       CASE WHEN x.quoted = 1 THEN 'true' WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS hasLift, o_orderpriority AS typology,
       'string' AS propertyCode_type, 'string' AS price_type, 'string' AS floor_type,
       'struct<typology:string>' AS detailedType_type, 'struct<parkingSpacePrice:string>' AS parkingSpace_type
FROM orders, (VALUES (0), (1)) x(quoted)
"""


def _json_listings(spark, sf) -> DataFrame:
    return listings_from_records(json_records(order_texts(spark, sf)))


def q_json_listings(spark, sf) -> DataFrame:
    """Listing records from JSON texts, every scalar exact."""
    return _json_listings(spark, sf).select("propertyCode", "price", F.col("size").cast("double").alias("size"), "floor", "hasLift", "neighborhood", "source_file")


_S2_SQL = """
SELECT CAST(o_orderkey AS INTEGER) AS propertyCode, CAST(floor(o_totalprice) AS INTEGER) AS price,
       CAST(floor(o_totalprice) AS BIGINT) % 4000 / 4 AS size, CAST(o_orderkey % 100 AS VARCHAR) AS floor,
       o_orderstatus = 'O' AS hasLift, CAST(NULL AS VARCHAR) AS neighborhood, 'orders_' || o_orderstatus AS source_file
FROM orders
UNION ALL
SELECT CAST(o_orderkey AS INTEGER), CAST(floor(o_totalprice) AS INTEGER), 12.5, o_orderstatus, true, NULL, 'orders_' || o_orderstatus
FROM orders
"""


def q_nested_fields(spark, sf) -> DataFrame:
    """Nested record fields addressed by name, absent structs null."""
    return _json_listings(spark, sf).select(
        "propertyCode",
        F.col("detailedType.typology").alias("typology"),
        F.col("detailedType.subTypology").alias("sub_typology"),
        F.col("suggestedTexts.title").alias("title"),
        F.col("suggestedTexts.subtitle").alias("subtitle"),
        F.col("parkingSpace").isNull().alias("no_parking"),
        F.col("parkingSpace.parkingSpacePrice").cast("double").alias("parking_price"),
    )


_X12_SQL = """
SELECT CAST(o_orderkey AS INTEGER) AS propertyCode, o_orderpriority AS typology, CAST(NULL AS VARCHAR) AS sub_typology,
       o_orderstatus || ', "quoted" é' AS title, CAST(NULL AS VARCHAR) AS subtitle, x.quoted = 0 AS no_parking,
       CASE WHEN x.quoted = 1 THEN o_orderkey % 9 + 0.5::DOUBLE END AS parking_price
FROM orders, (VALUES (0), (1)) x(quoted)
"""


def q_csv_line_breaks(spark, sf) -> DataFrame:
    """Customers as CSV files with their own headers, line breaks, commas and quotes inside cells."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    said = F.concat(F.lit('says "'), "c_name", F.lit('",\n\nthen, '), "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, '\n"').otherwise(""))
    cells = {"key": F.col("c_custkey").cast("string"), "said": said, "balance": F.col("c_acctbal").cast("string")}
    second = F.coalesce(F.col("c_custkey") % 2 == 1, F.lit(False))
    line = lambda order: F.to_csv(F.struct(*[cells[x].alias(x) for x in order]), {"escape": '"'})
    one, two = ["key", "said", "balance"], ["balance", "key", "said"]
    rows = c.select(second.cast("int").alias("file"), F.when(second, line(two)).otherwise(line(one)).alias("value"))
    path = _text_files(rows, "customer-csv", [",".join(one), ",".join(two)])
    return read_csv_inferred(spark, path, glob="part-*").select("key", "said", F.col("balance").cast("double").alias("balance"))


_S4_BREAKS_SQL = """
SELECT c_custkey AS key, 'says "' || c_name || '",' || chr(10) || chr(10) || 'then, ' || c_mktsegment || CASE WHEN c_custkey % 5 = 0 THEN chr(10) || '"' ELSE '' END AS said,
       c_acctbal AS balance
FROM customer
"""


def _csv_files(spark, rows: DataFrame, second: Column, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Lines and headers of two CSV files made of ``rows``.

    Rows where ``second`` holds go to a file whose columns come in reverse
    order and with one more; ``names`` maps column -> header spelling.
    """
    first = list(names)
    other = [*reversed(first), "more"]
    rows = rows.withColumn("more", F.lit('extra, "column"'))
    value = F.when(second, F.to_csv(F.struct(*other), {"escape": '"'})).otherwise(F.to_csv(F.struct(*first), {"escape": '"'}))
    lines = rows.select(value.alias("value"), F.when(second, "b.csv").otherwise("a.csv").alias("__file"))
    headers = [("a.csv", "﻿" + ",".join(names.values())), ("b.csv", ",".join(names.get(c, c) for c in other))]
    return lines, spark.createDataFrame(headers, "__file string, header string")


def q_lookup_csv(spark, sf) -> DataFrame:
    """Lookup rows bound by each file's header."""
    nn = nation_names(spark, sf)
    rows = nn.select(
        "district", "neighborhood", F.lower("district").alias("district_n_reconciled"), F.concat(F.left("district", F.lit(1)), F.lower(F.substring("district", 2, 100))).alias("district_n"),
        F.col("district_code").cast("string").alias("district_id"), F.lower("neighborhood").alias("neighborhood_n_reconciled"),
        F.concat("neighborhood", F.lit(", "), "district").alias("neighborhood_n"), F.col("n_nationkey").cast("string").alias("neighborhood_id"),
    )
    names = {c: c for c in LOOKUP_COLUMNS}
    lines, headers = _csv_files(spark, rows, F.col("neighborhood_id").cast("int") % 2 == 1, names)
    return conform(bind_by_header(lines, headers, {c: [c] for c in names}), LOOKUP_SCHEMA, keep=["source_file"])


_S4_SQL = """
SELECT r_name AS district, n_name AS neighborhood, lower(r_name) AS district_n_reconciled,
       upper(r_name[1]) || lower(r_name[2:]) AS district_n, CAST(n_regionkey AS VARCHAR) AS district_id,
       lower(n_name) AS neighborhood_n_reconciled, n_name || ', ' || r_name AS neighborhood_n,
       CAST(n_nationkey AS VARCHAR) AS neighborhood_id, CASE WHEN n_nationkey % 2 = 1 THEN 'b.csv' ELSE 'a.csv' END AS source_file
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def q_rent_csv(spark, sf) -> DataFrame:
    """Rent rows of every line item bound by each file's header, typed and range-checked."""
    li = _t(spark, sf, "lineitem")
    rows = li.select(
        F.year("l_shipdate").alias("Any"), F.quarter("l_shipdate").alias("Trimestre"), F.col("l_linenumber").alias("Codi_Districte"),
        F.col("l_returnflag").alias("Nom_Districte"), (F.col("l_suppkey") % 256).alias("Codi_Barri"),
        F.concat("l_linestatus", F.lit(", "), "l_returnflag").alias("Nom_Barri"), F.lit(RENT_MONTHLY_LABEL).alias("Lloguer_mitja"),
        F.col("l_quantity").cast("int").cast("string").alias("Preu"),
    )
    names = {f.name: f.name for f in RENT_SCHEMA.fields}
    lines, headers = _csv_files(spark, rows, F.col("Codi_Districte") % 2 == 1, names)
    return conform(bind_by_header(lines, headers, {c: [c] for c in names}), RENT_SCHEMA, keep=["source_file"], ranges=RENT_RANGES)


_S5_SQL = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS Any, CAST(quarter(l_shipdate) AS SMALLINT) AS Trimestre,
       CAST(l_linenumber AS SMALLINT) AS Codi_Districte, l_returnflag AS Nom_Districte, CAST(l_suppkey % 256 AS SMALLINT) AS Codi_Barri,
       l_linestatus || ', ' || l_returnflag AS Nom_Barri, '{RENT_MONTHLY_LABEL}' AS Lloguer_mitja,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS Preu, CASE WHEN l_linenumber % 2 = 1 THEN 'b.csv' ELSE 'a.csv' END AS source_file
FROM lineitem
"""


def q_income_csv(spark, sf) -> DataFrame:
    """Income rows of every customer, the index under its raw header."""
    c = _t(spark, sf, "customer")
    rows = c.select(
        (F.col("c_custkey") % 20 + 2000).alias("Any"), (F.col("c_nationkey") % 10).alias("Codi_Districte"), F.col("c_mktsegment").alias("Nom_Districte"),
        F.col("c_nationkey").alias("Codi_Barri"), F.col("c_name").alias("Nom_Barri"),
        F.concat((F.col("c_custkey") + 3_000_000_000).cast("string"), F.lit(".0")).alias("Població"),
        F.when(F.col("c_nationkey") == 3, "-").otherwise(F.col("c_nationkey").cast("string")).alias("Index_RFD_Barcelona_100"),
    )
    names = {f.name: f.name for f in INCOME_SCHEMA.fields} | {"Index_RFD_Barcelona_100": INCOME_RAW_INDEX_HEADER}
    lines, headers = _csv_files(spark, rows, F.col("Codi_Barri") % 2 == 1, names)
    return conform(bind_by_header(lines, headers, income_names()), INCOME_SCHEMA, keep=["source_file"], ranges=INCOME_RANGES)


_S6_SQL = """
SELECT CAST(c_custkey % 20 + 2000 AS INTEGER) AS Any, CAST(c_nationkey % 10 AS SMALLINT) AS Codi_Districte, c_mktsegment AS Nom_Districte,
       CAST(c_nationkey AS SMALLINT) AS Codi_Barri, c_name AS Nom_Barri, c_custkey + 3000000000 AS "Població",
       CASE WHEN c_nationkey = 3 THEN '-' ELSE CAST(c_nationkey AS VARCHAR) END AS Index_RFD_Barcelona_100,
       CASE WHEN c_nationkey % 2 = 1 THEN 'b.csv' ELSE 'a.csv' END AS source_file
FROM customer
"""

_G2_SQL = f"""
WITH fl AS ({_G1_SQL}), fr AS ({_P3_SQL}),
ar AS (SELECT year, neighborhood, avg(TRY_CAST(Preu AS DOUBLE)) AS avg_rent FROM fr
       WHERE Lloguer_mitja = '{RENT_MONTHLY_LABEL}' AND Preu NOT IN ('NA', 'N/A', '--')
         AND TRY_CAST(Preu AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(Preu AS DOUBLE))
       GROUP BY year, neighborhood, Lloguer_mitja)
SELECT year, neighborhood, propertyCode, round(payback, 6) AS "ROI/Year"
FROM (SELECT DISTINCT CAST(year(fl.date) AS BIGINT) AS year, fl.neighborhood, fl.propertyCode,
             CASE WHEN ar.avg_rent = 0 THEN NULL ELSE fl.price / (12 * ar.avg_rent) END AS payback
      FROM fl JOIN ar ON CAST(year(fl.date) AS BIGINT) = ar.year AND fl.neighborhood = ar.neighborhood)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "A1_avg_by_group": q_avg_by_group,
    "O3_top_n": q_top_n,
    "J1_latest_snapshot": q_latest_snapshot,
    "J1_latest_orders": q_latest_orders,
    "A2_latest_dates": q_latest_dates,
    "F2_required_key": q_required_key,
    "S11_source_file": q_source_file,
    "X5_date_from_name": q_date_from_name,
    "A5_lookup_distinct": q_lookup_distinct,
    "J2_reconcile_two_keys": q_reconcile_two_keys,
    "J4_reconcile_one_key": q_reconcile_one_key,
    "J4_fanout": q_fanout,
    "J4_fanout_dedup": q_fanout_dedup,
    "Q4_lookup_conflicts": q_lookup_conflicts,
    "F4_sentinel_avg": q_sentinel_avg,
    "G3_roi": q_roi,
    "X9_zero_rent": q_zero_rent,
    "W1_segment_avg": q_segment_avg,
    "V1_bar_view": q_bar_view,
    "V2_mark_view": q_mark_view,
    "J7_kpi_mart": q_kpi_mart,
    "J7_kpi_mart_disjoint": q_kpi_mart_disjoint,
    "X1_links": q_links,
    "F7_link_suffix": q_link_suffix,
    "X2_resolve": q_resolve,
    "J6_new_links": q_new_links,
    "G1_formatted_listings": q_formatted_listings,
    "P2_format_income": q_format_income,
    "P3_format_rent": q_format_rent,
    "G2_pipeline_roi": q_pipeline_roi,
    "W1_segment_avg_listings": q_segment_avg_listings,
    "U1_union_by_name": q_union_by_name,
    "S8_conform": q_conform,
    "M1_string_index": q_string_index,
    "M2_one_hot": q_one_hot,
    "M6_hash_split": q_hash_split,
    "M8_linear_fit": q_linear_fit,
    "A7_metrics": q_metrics,
    "M3_assembled": q_assembled,
    "M4_forest": q_forest,
    "S2_json_listings": q_json_listings,
    "S2_split_arrays": q_split_arrays,
    "S3_inferred_json": q_inferred_json,
    "X12_nested_fields": q_nested_fields,
    "S4_csv_line_breaks": q_csv_line_breaks,
    "S4_lookup_csv": q_lookup_csv,
    "S5_rent_csv": q_rent_csv,
    "S6_income_csv": q_income_csv,
}

ORACLE_SQL: dict[str, str] = {
    "A1_avg_by_group": _A1_SQL,
    "O3_top_n": _O3_SQL,
    "J1_latest_snapshot": _J1_SQL,
    "J1_latest_orders": _J1_ORDERS_SQL,
    "A2_latest_dates": _A2_SQL,
    "F2_required_key": _F2_SQL,
    "S11_source_file": _S11_SQL,
    "X5_date_from_name": _X5_SQL,
    "A5_lookup_distinct": _LOOKUP_SQL,
    "J2_reconcile_two_keys": _J2_SQL,
    "J4_reconcile_one_key": _J4_SQL,
    "J4_fanout": _J4_FANOUT_SQL,
    "J4_fanout_dedup": _J4_DEDUP_SQL,
    "Q4_lookup_conflicts": _Q4_SQL,
    "F4_sentinel_avg": _F4_SQL,
    "G3_roi": _G3_SQL,
    "X9_zero_rent": _LINE_ROI_SQL,
    "W1_segment_avg": _W1_SQL,
    "V1_bar_view": _V1_SQL,
    "V2_mark_view": _V2_SQL,
    "J7_kpi_mart": _J7_SQL,
    "J7_kpi_mart_disjoint": _J7_DISJOINT_SQL,
    "X1_links": _HREFS_SQL,
    "F7_link_suffix": _F7_SQL,
    "X2_resolve": _X2_SQL,
    "J6_new_links": _J6_SQL,
    "G1_formatted_listings": _G1_SQL,
    "P2_format_income": _P2_SQL,
    "P3_format_rent": _P3_SQL,
    "G2_pipeline_roi": _G2_SQL,
    "W1_segment_avg_listings": _W1_LISTINGS_SQL,
    "U1_union_by_name": _U1_SQL,
    "S8_conform": _S8_SQL,
    "M1_string_index": _M1_SQL,
    "M2_one_hot": _M2_SQL,
    "M6_hash_split": _M6_SQL,
    "M8_linear_fit": _M8_SQL,
    "A7_metrics": _A7_SQL,
    "M3_assembled": _M3_SQL,
    "S2_json_listings": _S2_SQL,
    "S2_split_arrays": _S2_SPLIT_SQL,
    "S3_inferred_json": _S3_SQL,
    "X12_nested_fields": _X12_SQL,
    "S4_csv_line_breaks": _S4_BREAKS_SQL,
    "S4_lookup_csv": _S4_SQL,
    "S5_rent_csv": _S5_SQL,
    "S6_income_csv": _S6_SQL,
}
