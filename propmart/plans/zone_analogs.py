"""Rows that write zones and files into the shared scratch folder and read them back.

They map the driver's tables onto the property roles like ``analogs``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propmart.functions.numbers import round_exact
from propmart.functions.text import strip_extension
from propmart.operators.exact import exact_sums
from propmart.operators.kpi import avg_price_by, roi_from_avg_rent
from propmart.operators.links import bitmaps_for, name_filter, new_links_filtered
from propmart.operators.forest import forest_nodes, score_with_nodes
from propmart.operators.ml import hash_split, predict, price_pipeline, sgd_linear
from propmart.plans.analogs import _G1_SQL, _G3_SQL, _J6_SQL, _ORDER_LISTINGS_SQL, _RESOLVED_SQL, ROI, _r6, _TRAIN_BELOW, _resolved, _t, monthly_rent_per_nation, order_listings, part_sales, q_formatted_listings
from propmart.plans.exploitation import build_exploitation
from propmart.plans.formatted import build_formatted
from propmart.plans.model import train_price_model
from propmart.plans.persistent import build_persistent
from propmart.schemas import PREDICTION_COLUMNS, RENT_MONTHLY_LABEL
from propmart.session import scratch_path, ship_package
from propmart.sources.files import inventory, inventory_counts
from propmart.sources.footers import lacking_in_files, read_footers
from propmart.sources.parquet import read_zone
from propmart.sources.raw import read_kpi_csv
from propmart.sources.sinks import save_model, write_kpi_csv, write_sized, write_zone

# ---------------------------------------------------------------------------
# Footers, sizes, partitions
# ---------------------------------------------------------------------------


def q_inventory(spark, sf) -> DataFrame:
    """S1 + A9: the tables of the folder, their rows from the files' footers, and whether any file is empty."""
    table = lambda path: F.regexp_extract(path, r"([^/]+)\.parquet(?:/[^/]*)?$", 1)
    rows = read_footers(spark, sf).groupBy(table(F.col("path")).alias("table_name")).agg(F.sum("n_rows").alias("n_rows"))
    files = inventory(spark, sf, "*.parquet")
    counts = inventory_counts(files.withColumn("folder", table(F.col("path"))))
    return rows.join(counts, rows["table_name"] == counts["folder"]).select("table_name", "n_rows", (F.col("bytes") > 0).alias("has_bytes"))


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_A9_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS has_bytes FROM {t}" for t in TABLES)

DRIFT = {0: [], 1: ["c_acctbal"], 2: ["c_mktsegment", "c_name"], 3: ["c_acctbal", "c_mktsegment"]}


def q_footer_drift(spark, sf) -> DataFrame:
    """Customers in four files that lack different columns, found from the footers."""
    c, path = _t(spark, sf, "customer"), scratch_path(spark, "drift")
    for part, lacking in DRIFT.items():
        c.where(F.col("c_custkey") % len(DRIFT) == part).drop(*lacking).write.parquet(f"{path}/part{part}")
    footers = read_footers(spark, path)
    part = F.regexp_extract("path", r"/part(\d)/", 1).cast("int").alias("part")
    counts = footers.groupBy(part).agg(F.sum("n_rows").alias("n_rows"))
    lacking = lacking_in_files(footers, c.schema).select(part, "column").distinct().groupBy("part").agg(F.array_join(F.array_sort(F.collect_list("column")), ",").alias("lacking"))
    read = read_zone(spark, f"{path}/*", c.schema).groupBy((F.col("c_custkey") % len(DRIFT)).cast("int").alias("part")).agg(F.count("c_mktsegment").alias("segments"))
    return counts.join(lacking, "part", "left").join(read, "part").select("part", "n_rows", F.coalesce("lacking", F.lit("")).alias("lacking"), "segments")


_F1_SQL = """
SELECT CAST(c_custkey % 4 AS INTEGER) AS part, count(*) AS n_rows,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'c_acctbal' WHEN 2 THEN 'c_mktsegment,c_name' ELSE 'c_acctbal,c_mktsegment' END AS lacking,
       CASE WHEN c_custkey % 4 < 2 THEN count(*) ELSE 0 END AS segments
FROM customer GROUP BY c_custkey % 4
"""


def q_file_sizes(spark, sf) -> DataFrame:
    """K2: lineitem in files of a target size, whose footers are read back."""
    li = _t(spark, sf, "lineitem")
    whole = int(inventory(spark, sf, "lineitem.parquet").agg(F.sum("length")).first()[0] or 0)
    if not whole:  # a table of several files
        whole = int(inventory(spark, f"{sf}/lineitem.parquet").agg(F.sum("length")).first()[0])
    target, path = max(1, whole // 6), scratch_path(spark, "sized")
    write_sized(li, path, target)
    files = read_footers(spark, path)
    return files.agg(F.sum("n_rows").alias("n_rows"), (F.max("length") <= 1.5 * target).alias("none_too_large"), (F.count(F.lit(1)) >= 4).alias("several"))


_K2_SQL = "SELECT count(*) AS n_rows, true AS none_too_large, true AS several FROM lineitem"

LAST_YEARS = 1997


def pruned_roi(spark, sf) -> DataFrame:
    """Payback over a listing zone partitioned by year, for the rents of the last years only."""
    zone, rents = scratch_path(spark, "listing-zone"), scratch_path(spark, "rent-zone")
    listings = order_listings(spark, sf).withColumn("year", F.year("date"))
    write_zone(listings, zone, partition_by=["year"], rebalance=True, keep_other_partitions=True)
    write_zone(listings.where("year = 1995"), zone, partition_by=["year"], rebalance=True, keep_other_partitions=True)
    write_zone(monthly_rent_per_nation(spark, sf), rents)
    return roi_from_avg_rent(spark.read.parquet(zone), spark.read.parquet(rents).where(F.col("year") >= LAST_YEARS))


def q_pruned_roi(spark, sf) -> DataFrame:
    """Partitions that no rent row asks for are not read."""
    return pruned_roi(spark, sf).select("year", "neighborhood", "propertyCode", _r6(F.col(f"`{ROI}`")).alias(ROI))


_J5_SQL = f"SELECT * FROM ({_G3_SQL}) WHERE year >= {LAST_YEARS}"


def q_filtered_links(spark, sf) -> DataFrame:
    """J6/F8 with a Bloom filter of the stored names in front of the join."""
    links = _resolved(spark, sf)
    stored = links.where(F.col("url").contains("/en/"))
    n_bitmaps = bitmaps_for(_t(spark, sf, "pages").count())
    path = scratch_path(spark, "name-filter")
    name_filter(stored, n_bitmaps).write.parquet(path)
    return new_links_filtered(links, stored, spark.read.parquet(path), n_bitmaps).select("page_id", "href", "link_url", "file_name")


# ---------------------------------------------------------------------------
# Numbers
# ---------------------------------------------------------------------------


def q_exact_average(spark, sf) -> DataFrame:
    """A1, A3: average line price per flag and status, exact sums rounded once."""
    sums = exact_sums(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return sums.select("l_returnflag", "l_linestatus", "total", (F.col("total") / F.col("n")).alias("average"), "n")


# every price is at least 1, so that 2**52 of it is a whole number; both halves of the sum are exact doubles
_A1_EXACT_SQL = """
WITH s AS (
  SELECT l_returnflag, l_linestatus, sum(CAST(l_extendedprice * 4503599627370496.0::DOUBLE AS HUGEINT))::HUGEINT AS units, count(*) AS n
  FROM lineitem GROUP BY ALL
), t AS (
  SELECT *, (CAST(units // 4503599627370496 AS DOUBLE) + CAST(units % 4503599627370496 AS DOUBLE) / 4503599627370496.0::DOUBLE) AS total FROM s
)
SELECT l_returnflag, l_linestatus, total, total / n AS average, n FROM t
"""


def q_round_exact(spark, sf) -> DataFrame:
    """A seventh and an eighth of every line price, rounded as binary values."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return li.select("l_orderkey", "l_linenumber", round_exact(F.col("l_extendedprice") / 7.0).alias("seventh"), round_exact(F.floor("l_extendedprice") / 8.0).alias("eighth"))


_ROUND = """((m * 100) // 4503599627370496 + CASE WHEN (m * 100) % 4503599627370496 > 2251799813685248
  OR ((m * 100) % 4503599627370496 = 2251799813685248 AND ((m * 100) // 4503599627370496) % 2 = 1) THEN 1 ELSE 0 END)::DOUBLE / 100.0::DOUBLE"""

_X8_SQL = f"""
WITH v AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice / 7.0::DOUBLE * 4503599627370496.0::DOUBLE AS HUGEINT) AS m7,
                  CAST(floor(l_extendedprice) / 8.0::DOUBLE * 4503599627370496.0::DOUBLE AS HUGEINT) AS m8 FROM lineitem)
SELECT l_orderkey, l_linenumber, {_ROUND.replace("m *", "m7 *")} AS seventh, {_ROUND.replace("m *", "m8 *")} AS eighth FROM v
"""


def q_gradient_descent(spark, sf) -> DataFrame:
    """M8: 100 steps of gradient descent per brand, price on size and quantity sold."""
    p = _t(spark, sf, "part").select("p_brand", (F.col("p_size") / 50.0).alias("size"), (F.col("p_partkey") % 97 / 97.0).alias("place"), (F.col("p_retailprice") / 1000.0).alias("price"))
    fit = sgd_linear(p, "price", ["size", "place"], ["p_brand"])
    return fit.select("p_brand", _r6(F.get("weights", F.lit(0))).alias("w_size"), _r6(F.get("weights", F.lit(1))).alias("w_place"), "steps")


_M8_SGD_SQL = """
WITH RECURSIVE p AS (
  SELECT p_brand, p_size / 50.0::DOUBLE AS a, (p_partkey % 97) / 97.0::DOUBLE AS b, p_retailprice / 1000.0::DOUBLE AS y FROM part
), m AS (SELECT p_brand, avg(a * a) AS aa, avg(a * b) AS ab, avg(b * b) AS bb, avg(a * y) AS ay, avg(b * y) AS bt FROM p GROUP BY p_brand
), w AS (
  SELECT p_brand, 0 AS i, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, false AS done FROM m
  UNION ALL
  SELECT p_brand, i, na, nb, sqrt((na - wa) ** 2 + (nb - wb) ** 2) < 0.001 * greatest(sqrt(na * na + nb * nb), 1.0::DOUBLE)
  FROM (SELECT w.p_brand, w.i + 1 AS i, wa, wb, wa - (aa * wa + ab * wb - ay) / sqrt(w.i + 1) AS na, wb - (ab * wa + bb * wb - bt) / sqrt(w.i + 1) AS nb
        FROM w JOIN m ON w.p_brand = m.p_brand WHERE NOT w.done AND w.i < 100)
)
SELECT p_brand, round(wa, 6) AS w_size, round(wb, 6) AS w_place, CAST(i AS INTEGER) AS steps FROM w
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY i DESC) = 1
"""

def q_forest_table(spark, sf) -> DataFrame:
    """M4, M5, M7, K5: the forest of the part sales, saved; the loaded pipeline and its node table predict the same."""
    train, test = hash_split(part_sales(spark, sf), "p_partkey")
    path = scratch_path(spark, "forest")
    save_model(price_pipeline(categorical=["p_brand", "p_type"], numeric=["quantity", "n_lines"], label="paid").fit(train), path)
    scored = predict(PipelineModel.load(path), test)
    by_table = score_with_nodes(scored, forest_nodes(spark, path), "p_partkey", out="by_table")
    return scored.select("p_partkey", "prediction").join(by_table, "p_partkey").select("p_partkey", (F.col("prediction") == F.col("by_table")).alias("same"))


_M7_SQL = f"""
SELECT p_partkey, true AS same FROM part
WHERE p_partkey IN (SELECT l_partkey FROM lineitem) AND substr(md5(CAST(p_partkey AS VARCHAR)), 1, 15) >= '{_TRAIN_BELOW}'
"""

def q_price_model(spark, sf) -> DataFrame:
    """The price model on formatted listings; its test rows in their published columns."""
    listings = q_formatted_listings(spark, sf).withColumns({
        "rooms": F.col("price") % 5 + 1, "bathrooms": F.col("price") % 3 + 1, "floor": F.col("operation"),
    })
    _, predictions, _ = train_price_model(spark, listings)
    known = [c for c in PREDICTION_COLUMNS if c != "prediction"]
    bounds = listings.agg(F.min("price").alias("least"), F.max("price").alias("most"))
    low, high = bounds.first()
    return predictions.select(*known, F.col("prediction").between(float(low), float(high)).alias("in_range"))


_G4_SQL = f"""
SELECT neighborhood, district, date, size, price % 5 + 1 AS rooms, price % 3 + 1 AS bathrooms, propertyType, operation AS floor, status, hasLift, price, true AS in_range
FROM ({_G1_SQL}) WHERE substr(md5(CAST(propertyCode AS VARCHAR)), 1, 15) >= '{_TRAIN_BELOW}'
"""


def q_base_names(spark, sf) -> DataFrame:
    """X11: names of linked files without their extension."""
    return _resolved(spark, sf).select("page_id", "link_url", strip_extension(F.col("file_name")).alias("base_name"))


_X11_SQL = f"SELECT page_id, link_url, regexp_replace(file_name, '\\.[^./]*$', '') AS base_name FROM ({_RESOLVED_SQL})"

# ---------------------------------------------------------------------------
# All zones
# ---------------------------------------------------------------------------

FILES_PER_MONTH = 1


def write_named(rows: DataFrame, folder: str, head: str, glue: str, tail: str) -> int:
    """Write rows (name, place, value) as text files of these names, a file by the task that holds it; returns their number."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from propmart.sources.footers import _open

        filesystem, base = _open(folder)
        filesystem.create_dir(base, recursive=True)
        last, out, names = None, None, []
        for batch in batches:
            at = 0
            runs = pc.run_end_encode(batch.column(0))
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                text, at = glue.join(batch.column(1)[at:end].to_pylist()), end
                if name != last:
                    if out is not None:
                        out.write(tail.encode())
                        out.close()
                    out, last = filesystem.open_output_stream(f"{base}/{name}"), name
                    names.append(name)
                    out.write(head.encode())
                else:
                    out.write(glue.encode())
                out.write(text.encode())
        if out is not None:
            out.write(tail.encode())
            out.close()
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    sorted_rows = rows.repartition("name").sortWithinPartitions("name", "place").select("name", "value")
    return sorted_rows.mapInArrow(run, "name string").count()


def write_landing(spark, sf, landing: str) -> None:
    """Monthly listing snapshots (customer = listing), rent, income and lookup files.

    The rents, which go to two files, are computed once.
    """
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    code = F.col("o_custkey").cast("string")
    flags = [F.lit(False).alias(x) for x in ("newDevelopment", "hasPlan", "has3DTour", "has360", "hasStaging", "topNewDevelopment")]
    rooms, baths, lift = F.col("o_orderkey") % 5 + 1, F.col("o_orderkey") % 3 + 1, F.col("o_orderpriority") == "1-URGENT"
    record = F.to_json(F.struct(
        code.alias("propertyCode"), F.floor("o_totalprice").alias("price"), F.col("n_name").alias("neighborhood"), F.col("r_name").alias("district"),
        F.round(F.col("o_totalprice") / 1000, 1).alias("size"), rooms.alias("rooms"), baths.alias("bathrooms"), F.col("o_orderpriority").alias("floor"), F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("propertyType"), F.lit("sale").alias("operation"), lift.alias("hasLift"), F.concat(F.lit("img/"), code).alias("thumbnail"),
        F.concat(F.lit("ref"), code).alias("externalReference"), (rooms * 3).alias("numPhotos"), (rooms % 2 == 0).alias("exterior"), F.concat(F.lit("street "), code).alias("address"),
        F.col("r_name").alias("province"), F.col("n_name").alias("municipality"), F.lit("es").alias("country"), (rooms / 10 + 41).alias("latitude"), (baths / 10 + 2).alias("longitude"),
        lift.alias("showAddress"), F.concat(F.lit("https://listing.example/"), code).alias("url"), (rooms * 100).cast("string").alias("distance"), (~lift).alias("hasVideo"),
        F.round(F.col("o_totalprice") / 50, 1).alias("priceByArea"), F.struct(F.col("c_mktsegment").alias("typology")).alias("detailedType"),
        F.struct(F.col("n_name").alias("subtitle"), F.col("c_mktsegment").alias("title")).alias("suggestedTexts"), *flags,
    ))
    name = F.concat(F.date_format("o_orderdate", "yyyy_MM_01"), F.lit("_"), (F.col("o_custkey") % FILES_PER_MONTH).cast("string"), F.lit("_idealista.json"))
    write_named(rows.select(name.alias("name"), F.col("o_orderkey").alias("place"), record.alias("value")), f"{landing}/idealista", "[", ", ", "]")

    line = lambda *cells: F.to_csv(F.struct(*[x.alias(f"c{i}") for i, x in enumerate(cells)]), {"escape": '"'})

    def csv(df: DataFrame, folder: str, file: str, heads: list[str], cells: list) -> None:
        write_named(df.select(F.lit(file).alias("name"), F.monotonically_increasing_id().alias("place"), line(*cells).alias("value")), f"{landing}/{folder}", ",".join(heads) + "\n", "\n", "\n")

    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    rent = li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == c.c_custkey)
    rent = rent.groupBy(F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"), "c_nationkey").agg(F.round(F.avg("l_extendedprice") / 100, 2).cast("string").alias("p"))
    rent = rent.join(n, F.col("c_nationkey") == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    rents = scratch_path(spark, "rents")
    rent.write.parquet(rents)
    rent = spark.read.schema(rent.schema).parquet(rents)
    heads = ["Any", "Trimestre", "Codi_Districte", "Nom_Districte", "Codi_Barri", "Nom_Barri", "Lloguer_mitja", "Preu"]
    cells = [F.col("y"), F.col("q"), F.col("r_regionkey"), F.col("r_name"), F.col("n_nationkey"), F.col("n_name"), F.lit(RENT_MONTHLY_LABEL), F.col("p")]
    csv(rent.where("y % 2 = 0"), "opendata-rent", "even_lloguer_preu_trim.csv", heads, cells)
    csv(rent.where("y % 2 = 1"), "opendata-rent", "odd_lloguer_preu_trim.csv", heads[::-1], cells[::-1])
    places = n.join(r, n.n_regionkey == r.r_regionkey)
    income = ["Any", "Codi_Districte", "Nom_Districte", "Codi_Barri", "Nom_Barri", "Població", "Índex RFD Barcelona = 100"]
    csv(places, "opendatabcn-income", "income.csv", income, [F.lit(2020), F.col("r_regionkey"), F.col("r_name"), F.col("n_nationkey"), F.col("n_name"), F.col("n_nationkey") + 1000, F.lit("100.5")])
    lookup = ["district", "neighborhood", "district_n_reconciled", "district_n", "district_id", "neighborhood_n_reconciled", "neighborhood_n", "neighborhood_id"]
    named = [F.col("r_name"), F.col("n_name"), F.col("r_name"), F.lower("r_name"), F.col("r_regionkey"), F.concat(F.lit("Barri "), "n_name"), F.lower("n_name"), F.col("n_nationkey")]
    csv(places, "lookup_tables", "lookup.csv", lookup, named)


def _zones(spark, sf) -> str:
    root = scratch_path(spark, "zones")
    write_landing(spark, sf, f"{root}/landing")
    build_persistent(spark, f"{root}/landing", f"{root}/persistent")
    build_formatted(spark, f"{root}/persistent", f"{root}/formatted")
    build_exploitation(spark, f"{root}/formatted", f"{root}/exploitation")
    return root


def q_zones(spark, sf) -> DataFrame:
    """Raw files to the published average price, read back as the dashboard does."""
    kpi = read_kpi_csv(spark, f"{_zones(spark, sf)}/exploitation/avg_price")
    return kpi.select("Neighborhood", F.col("Average_Price").cast("double").alias("Average_Price"))


_G5_SQL = """
WITH l AS (
  SELECT o_custkey AS code, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS d, CAST(floor(o_totalprice) AS BIGINT) AS price, 'Barri ' || n_name AS nb
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
latest AS (SELECT * FROM l QUALIFY rank() OVER (PARTITION BY code ORDER BY d DESC) = 1)
SELECT nb AS Neighborhood, round(avg(price), 2) AS Average_Price FROM latest GROUP BY nb
"""


def q_sorted_csv(spark, sf) -> DataFrame:
    """The average-price KPI as published CSV files, read back with its typed columns."""
    path = scratch_path(spark, "kpi")
    kpi = avg_price_by(order_listings(spark, sf), sort=False)
    write_kpi_csv(kpi, path, [F.col("Average_Price").desc(), F.col("Neighborhood").asc()])
    return read_kpi_csv(spark, path).select("Neighborhood", F.col("Average_Price").cast("double").alias("Average_Price"))


_K4_SQL = f"SELECT neighborhood AS Neighborhood, round(avg(price), 2) AS Average_Price FROM ({_ORDER_LISTINGS_SQL}) GROUP BY neighborhood"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "A9_inventory": q_inventory,
    "F1_footer_drift": q_footer_drift,
    "K2_file_sizes": q_file_sizes,
    "J5_pruned_roi": q_pruned_roi,
    "J6_filtered_links": q_filtered_links,
    "A1_exact_average": q_exact_average,
    "X8_round_exact": q_round_exact,
    "M8_gradient_descent": q_gradient_descent,
    "M7_forest_table": q_forest_table,
    "G4_price_model": q_price_model,
    "X11_base_names": q_base_names,
    "K4_published_kpi": q_sorted_csv,
    "G5_zones": q_zones,
}

ORACLE_SQL: dict[str, str] = {
    "A9_inventory": _A9_SQL,
    "F1_footer_drift": _F1_SQL,
    "K2_file_sizes": _K2_SQL,
    "J5_pruned_roi": _J5_SQL,
    "J6_filtered_links": _J6_SQL,
    "A1_exact_average": _A1_EXACT_SQL,
    "X8_round_exact": _X8_SQL,
    "M8_gradient_descent": _M8_SGD_SQL,
    "M7_forest_table": _M7_SQL,
    "G4_price_model": _G4_SQL,
    "X11_base_names": _X11_SQL,
    "K4_published_kpi": _K4_SQL,
    "G5_zones": _G5_SQL,
}
