"""End-to-end zone jobs on landing files derived from the driver tables.

Usage: python tools/zone_bench.py [sf_dir] [scratch_dir]

Builds a landing folder from ``sf_dir``:
* one listing-snapshot JSON array file per order month (customer = listing,
  so a listing appears in many snapshots), named ``YYYY_MM_01_idealista.json``;
* rent CSVs (mean line price per shipping year, quarter and nation), split into
  two files whose columns come in different orders;
* an income CSV with the raw index header, and a lookup CSV.

Then times the persistent, formatted and exploitation jobs, and checks the
average-price KPI against DuckDB computing the same figure from the tables.
Prints one JSON line.  The landing files are written to a local folder, one
month in one task, so this runs in local mode only and its figures say nothing
about a cluster.
"""

from __future__ import annotations

import csv
import glob
import json
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from propmart.plans.exploitation import build_exploitation  # noqa: E402
from propmart.plans.formatted import build_formatted  # noqa: E402
from propmart.plans.persistent import build_persistent  # noqa: E402
from propmart.schemas import RENT_MONTHLY_LABEL  # noqa: E402
from propmart.session import build_session  # noqa: E402

LISTING_OUT = "snap string, n long"


def write_snapshots(spark, sf: str, landing: str) -> int:
    """One JSON array file per order month, written by the task that holds the month."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = spark.read.parquet(f"{sf}/nation.parquet")
    r = spark.read.parquet(f"{sf}/region.parquet")
    rows = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.date_format("o_orderdate", "yyyy_MM_01").alias("snap"),
            F.col("o_custkey").cast("int").alias("propertyCode"),
            F.floor("o_totalprice").cast("int").alias("price"),
            F.col("n_name").alias("neighborhood"),
            F.col("r_name").alias("district"),
            F.round(F.col("o_totalprice") / 1000, 1).alias("size"),
            (F.col("o_orderkey") % 5 + 1).cast("int").alias("rooms"),
            (F.col("o_orderkey") % 3 + 1).cast("int").alias("bathrooms"),
            F.col("o_orderpriority").alias("floor"),
            F.col("o_orderstatus").alias("status"),
            F.col("c_mktsegment").alias("propertyType"),
            F.lit("sale").alias("operation"),
            (F.col("o_orderpriority") == "1-URGENT").alias("hasLift"),
        )
    )
    out_dir = f"{landing}/idealista"
    os.makedirs(out_dir, exist_ok=True)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        snap = pdf["snap"].iloc[0]
        rec = pdf.drop(columns=["snap"])
        code = rec["propertyCode"].astype(str)
        # the remaining listing fields, derived from the row so that none is empty
        rec["thumbnail"] = "img/" + code
        rec["externalReference"] = "ref" + code
        rec["numPhotos"] = rec["rooms"] * 3
        rec["exterior"] = rec["rooms"] % 2 == 0
        rec["address"] = "street " + code
        rec["province"] = rec["district"]
        rec["municipality"] = rec["neighborhood"]
        rec["country"] = "es"
        rec["latitude"] = 41.0 + rec["rooms"] / 10
        rec["longitude"] = 2.0 + rec["bathrooms"] / 10
        rec["showAddress"] = rec["hasLift"]
        rec["url"] = "https://listing.example/" + code
        rec["distance"] = rec["rooms"] * 100
        rec["hasVideo"] = ~rec["hasLift"]
        rec["newDevelopment"] = False
        rec["priceByArea"] = (rec["price"] / rec["size"].clip(lower=1)).round(1)
        rec["detailedType"] = [{"typology": t, "subTypology": None} for t in rec["propertyType"]]
        rec["suggestedTexts"] = [{"subtitle": n, "title": t} for n, t in zip(rec["neighborhood"], rec["propertyType"])]
        for flag in ("hasPlan", "has3DTour", "has360", "hasStaging", "topNewDevelopment"):
            rec[flag] = False
        rec.to_json(f"{out_dir}/{snap}_idealista.json", orient="records", force_ascii=False)
        return pd.DataFrame({"snap": [snap], "n": [len(pdf)]})

    written = rows.groupBy("snap").applyInPandas(write, LISTING_OUT).agg(F.sum("n")).first()[0]
    return int(written)


def write_csvs(con, landing: str) -> None:
    """Rent, income and lookup CSVs (aggregates: a few hundred rows)."""
    rent = con.sql(f"""
        SELECT year(l.l_shipdate) AS "Any", quarter(l.l_shipdate) AS Trimestre, r.r_regionkey AS Codi_Districte,
               r.r_name AS Nom_Districte, n.n_nationkey AS Codi_Barri, n.n_name AS Nom_Barri,
               '{RENT_MONTHLY_LABEL}' AS Lloguer_mitja, CAST(round(avg(l.l_extendedprice) / 100, 2) AS VARCHAR) AS Preu
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY ALL ORDER BY ALL""").df()
    os.makedirs(f"{landing}/opendata-rent", exist_ok=True)
    even = rent[rent["Any"] % 2 == 0]
    odd = rent[rent["Any"] % 2 == 1]
    even.to_csv(f"{landing}/opendata-rent/even_lloguer_preu_trim.csv", index=False)
    odd[list(reversed(odd.columns))].to_csv(f"{landing}/opendata-rent/odd_lloguer_preu_trim.csv", index=False)
    inc = con.sql("""
        SELECT year(o.o_orderdate) AS "Any", r.r_regionkey AS Codi_Districte, r.r_name AS Nom_Districte,
               n.n_nationkey AS Codi_Barri, n.n_name AS Nom_Barri, count(DISTINCT o.o_custkey) AS "Població",
               CAST(count(*) AS VARCHAR) AS "Índex RFD Barcelona = 100"
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY ALL ORDER BY ALL""").df()
    os.makedirs(f"{landing}/opendatabcn-income", exist_ok=True)
    inc.to_csv(f"{landing}/opendatabcn-income/income.csv", index=False)
    lk = con.sql("""
        SELECT r.r_name AS district, n.n_name AS neighborhood, r.r_name AS district_n_reconciled,
               lower(r.r_name) AS district_n, CAST(r.r_regionkey AS VARCHAR) AS district_id,
               'Barri ' || n.n_name AS neighborhood_n_reconciled, lower(n.n_name) AS neighborhood_n,
               CAST(n.n_nationkey AS VARCHAR) AS neighborhood_id
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey ORDER BY 1, 2""").df()
    os.makedirs(f"{landing}/lookup_tables", exist_ok=True)
    lk.to_csv(f"{landing}/lookup_tables/lookup.csv", index=False, quoting=csv.QUOTE_MINIMAL)


EXPECTED_AVG_SQL = """
WITH l AS (
  SELECT o.o_custkey AS code, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS d,
         CAST(floor(o.o_totalprice) AS BIGINT) AS price, 'Barri ' || n.n_name AS nb
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
latest AS (SELECT * FROM l QUALIFY rank() OVER (PARTITION BY code ORDER BY d DESC) = 1)
SELECT nb, round(avg(price), 2) AS avg_price FROM latest GROUP BY nb
"""


def run_zones(spark, sf: str, root: str) -> dict:
    """Build the landing folder under ``root``, run G5 -> G1 -> G2, check the KPI; returns the figures."""
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    landing = f"{root}/landing"
    n_rows = write_snapshots(spark, sf, landing)
    write_csvs(con, landing)
    n_files = len(glob.glob(f"{landing}/idealista/*.json"))

    timings = {}
    t0 = time.perf_counter()
    build_persistent(spark, landing, f"{root}/persistent")
    timings["persistent"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    build_formatted(spark, f"{root}/persistent", f"{root}/formatted")
    timings["formatted"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    build_exploitation(spark, f"{root}/formatted", f"{root}/exploitation")
    timings["exploitation"] = time.perf_counter() - t0

    got = spark.read.option("header", True).csv(f"{root}/exploitation/avg_price").collect()
    got = {r.Neighborhood: float(r.Average_Price) for r in got}
    want = {r[0]: float(r[1]) for r in con.sql(EXPECTED_AVG_SQL).fetchall()}
    return {
        "listing_rows": n_rows,
        "snapshot_files": n_files,
        "formatted_listings": spark.read.parquet(f"{root}/formatted/idealista").count(),
        "roi_rows": spark.read.option("header", True).csv(f"{root}/exploitation/ROI").count(),
        "seconds": {k: round(v, 3) for k, v in timings.items()},
        "listing_rows_per_sec_persistent": round(n_rows / timings["persistent"], 1),
        "listing_rows_per_sec_formatted": round(n_rows / timings["formatted"], 1),
        "avg_price_matches_duckdb": got == want,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    root = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="zones-", dir="/tmp")
    spark = build_session(
        app="propmart-zone-bench",
        master="local[8]",
        shuffle_partitions=16,
        conf={"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{root}/ckpt"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = run_zones(spark, sf, root)
    spark.stop()
    print(json.dumps({"sf": sf, **out}))


if __name__ == "__main__":
    main()
