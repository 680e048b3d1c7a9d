import pytest

from fixtures import LOOKUP_CSV, build_landing, listing, write_json, write_text
from propmart.plans.persistent import read_mixed
from propmart.schemas import LISTING_SCHEMA
from propmart.sources.files import inventory, inventory_counts
from propmart.sources.parquet import read_with_source, read_zone
from propmart.sources.raw import (
    csv_lines,
    header_lines,
    lacking_columns,
    quarantined_listings,
    read_csv_by_name,
    read_csv_inferred,
    read_income,
    read_json_inferred,
    read_listings,
    read_lookup,
    read_rent,
)


def test_listings_drift_and_number_texts(spark, tmp_dir):
    build_landing(tmp_dir)
    df = read_listings(spark, f"{tmp_dir}/idealista")
    assert df.columns == [f.name for f in LISTING_SCHEMA.fields] + ["source_file"]
    rows = df.collect()
    assert len(rows) == 8  # the empty array adds no row
    by_code = {}
    for r in rows:
        by_code.setdefault(r.propertyCode, []).append(r)
    assert 921 in by_code  # quoted code
    prices = sorted(r.price for r in by_code[1])
    assert prices == [100000, 149000, 150000]  # '149000.0' kept as a whole number
    assert {r.floor for r in by_code[1]} == {"2", "3"}  # floor always text
    parking = [r.parkingSpace for r in by_code[1] if r.parkingSpace is not None]
    assert len(parking) == 1 and parking[0].parkingSpacePrice == 15000.0
    assert by_code[7][0].neighborhood is None  # file without the column
    assert by_code[7][0].source_file == "2021_01_01_idealista.json"


def test_listing_fraction_fails(spark, tmp_dir):
    write_json(f"{tmp_dir}/idealista/2020_01_01.json", [listing(1, price=1.5)])
    with pytest.raises(Exception):
        read_listings(spark, f"{tmp_dir}/idealista").collect()
    assert read_listings(spark, f"{tmp_dir}/idealista", on_error="null").first().price is None


def test_csv_bound_by_name_not_position(spark, tmp_dir):
    write_text(f"{tmp_dir}/c/a.csv", "a,b\n1,x\n2,y\n")
    write_text(f"{tmp_dir}/c/b.csv", "b,a\nz,3\n")
    df = read_csv_by_name(spark, f"{tmp_dir}/c", {"a": ["a"], "b": ["b"]})
    assert sorted((r.a, r.b) for r in df.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_rent_income_lookup_readers(spark, tmp_dir):
    build_landing(tmp_dir)
    rent = read_rent(spark, f"{tmp_dir}/opendata-rent")
    rows = rent.collect()
    assert len(rows) == 8
    assert {r.Preu for r in rows} == {"700", "--", "NA", None, "15.2", "800", "0", "nan"}
    assert {r.Nom_Barri for r in rows if r.Preu == "0"} == {"l'Antiga Esquerra"}
    assert dict(rent.dtypes)["Trimestre"] == "smallint" and dict(rent.dtypes)["Any"] == "int"
    inc = read_income(spark, f"{tmp_dir}/opendatabcn-income")
    got = {r.Nom_Barri: (r.Any, r["Població"], r.Index_RFD_Barcelona_100) for r in inc.collect()}
    assert got["Gràcia"] == (2020, 51000, "110.5")  # BOM stripped, raw index header mapped
    assert got["Horta, Barcelona"][2] == "-"
    lk = read_lookup(spark, f"{tmp_dir}/lookup_tables")
    assert lk.count() == 3
    assert {r.neighborhood for r in lk.collect()} >= {"Horta, Barcelona", "l'Antiga Esquerra"}


def test_read_zone_schema_drift_and_glob(spark, tmp_dir):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{tmp_dir}/z/p1")
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{tmp_dir}/z/p2")
    write_text(f"{tmp_dir}/z/notes.txt", "not parquet")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = read_zone(spark, f"{tmp_dir}/z/*", schema)
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "x"), (2, None)]
    src = read_with_source(spark, f"{tmp_dir}/z/p1")
    assert src.first().source_file.startswith("part-")


def test_inventory(spark, tmp_dir):
    build_landing(tmp_dir)
    inv = inventory(spark, tmp_dir)
    assert inv.count() == 8
    counts = {r.folder.rsplit("/", 1)[-1]: r.n_files for r in inventory_counts(inv).collect()}
    assert counts == {"idealista": 4, "opendata-rent": 2, "opendatabcn-income": 1, "lookup_tables": 1}
    assert {r.base_name for r in inv.where("folder like '%lookup_tables'").collect()} == {"lookup"}


def test_csv_file_without_known_header_fails_or_reads_null(spark, tmp_dir):
    write_text(f"{tmp_dir}/c/a.csv", "a,b\n1,x\n")
    write_text(f"{tmp_dir}/c/b.csv", "a,bee\n2,y\n")
    names = {"a": ["a"], "b": ["b"]}
    strict = read_csv_by_name(spark, f"{tmp_dir}/c", names)
    for action in (strict.collect, strict.count, strict.select("a").collect):
        with pytest.raises(Exception, match="no recognised CSV header"):
            action()
    lenient = read_csv_by_name(spark, f"{tmp_dir}/c", names, on_error="null")
    assert sorted(((r.a, r.b) for r in lenient.collect()), key=str) == [("1", "x"), ("2", None)]
    assert lenient.count() == 2
    lacking = lacking_columns(header_lines(csv_lines(spark.read, f"{tmp_dir}/c")), names).collect()
    assert [(r.source_file.rsplit("/", 1)[-1], r.column) for r in lacking] == [("b.csv", "b")]


def test_csv_with_other_columns_quotes_and_blank_lines(spark, tmp_dir):
    write_text(f"{tmp_dir}/c/a.csv", "\ufeff b , more, a ,x1,x2,x3,x4,x5,x6\n\n\"y, z\",skip,1,,,,,,\n")
    write_text(f"{tmp_dir}/c/b.csv", "a,b\n 2 ,\n")
    write_text(f"{tmp_dir}/c/empty.csv", "")
    df = read_csv_by_name(spark, f"{tmp_dir}/c", {"a": ["a"], "b": ["b"]})
    assert sorted(((r.a, r.b) for r in df.collect()), key=str) == [("1", "y, z"), ("2", None)]
    assert df.count() == 2 and df.select("source_file").distinct().count() == 2


def test_other_csv_files_unite_by_name(spark, tmp_dir):
    write_text(f"{tmp_dir}/c/a.csv", "a,b\n1,2\n")
    write_text(f"{tmp_dir}/c/b.csv", "b,a,c\n20,10,2020-01-31\n2.5,11,\n")
    write_text(f"{tmp_dir}/c/notes.txt", "a,b\n7,7\n")
    df = read_csv_inferred(spark, f"{tmp_dir}/c")
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "date", "source_file": "string"}
    got = {(r.source_file, r.a, r.b, str(r.c)) for r in df.collect()}
    assert got == {("a.csv", 1, 2.0, "None"), ("b.csv", 10, 20.0, "2020-01-31"), ("b.csv", 11, 2.5, "None")}


def test_other_json_files_and_suffix(spark, tmp_dir):
    write_json(f"{tmp_dir}/j/a.json", [{"x": 1, "y": "a"}])
    write_json(f"{tmp_dir}/j/b.json", [{"x": 2, "z": True}])
    write_text(f"{tmp_dir}/j/c.csv", "x,w\nseven,1\n")
    df = read_json_inferred(spark, f"{tmp_dir}/j")
    assert sorted(((r.x, r.y, r.z, r.source_file) for r in df.collect()), key=str) == [(1, "a", None, "a.json"), (2, None, True, "b.json")]
    mixed = read_mixed(spark, f"{tmp_dir}/j")
    assert sorted(((r.x, r.w, r.source_file) for r in mixed.collect()), key=str) == [("1", None, "a.json"), ("2", None, "b.json"), ("seven", 1, "c.csv")]


def test_listing_quarantine_keeps_what_cannot_be_read(spark, tmp_dir):
    write_json(f"{tmp_dir}/q/2020_01_01_a.json", [listing(1), 5, listing("921", rooms="many")])
    write_text(f"{tmp_dir}/q/2020_01_02_b.json", '[{"propertyCode": 3}, {"prop')
    write_text(f"{tmp_dir}/q/2020_01_03_c.json", " ")
    lenient = read_listings(spark, f"{tmp_dir}/q", on_error="null")
    assert sorted((r.propertyCode, r.rooms) for r in lenient.select("propertyCode", "rooms").fillna(-1).collect()) == [(1, 2), (3, -1), (921, -1)]
    bad = quarantined_listings(spark, f"{tmp_dir}/q").collect()
    assert sorted((r.source_file, r.problem, r.bad_text) for r in bad) == [
        ("2020_01_01_a.json", "not a record", "5"),
        ("2020_01_02_b.json", "not JSON", ' {"prop'),  # the record that the file ends in, and no other
    ]
    strict = read_listings(spark, f"{tmp_dir}/q")
    for action in (strict.count, strict.select("source_file").collect):
        with pytest.raises(Exception, match="unreadable listing record"):
            action()


def test_rent_ranges(spark, tmp_dir):
    head = "Any,Trimestre,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Lloguer_mitja,Preu\n"
    write_text(f"{tmp_dir}/r/a.csv", head + "2020,1,255,a,0,b,c,1\n2020,1,-5,a,300,b,c,1\n")
    with pytest.raises(Exception, match="not in 0..255"):
        read_rent(spark, f"{tmp_dir}/r").collect()
    got = read_rent(spark, f"{tmp_dir}/r", on_error="null").collect()
    assert sorted(((r.Codi_Districte, r.Codi_Barri) for r in got), key=str) == [(255, 0), (None, None)]


def test_listings_as_json_lines(spark, tmp_dir):
    import json

    recs = [listing(i, price=1000 + i) for i in range(50)]
    write_text(f"{tmp_dir}/jl/2020_01_01_lines.json", "\n".join(json.dumps(r, ensure_ascii=False) for r in recs) + "\n")
    df = read_listings(spark, f"{tmp_dir}/jl", json_lines=True)
    assert df.count() == 50 and df.where("price = 1049").first().propertyCode == 49


def test_listings_are_stable_under_projection(spark, tmp_dir):
    """A file whose only odd value is in a column not selected later is neither lost nor doubled."""
    write_json(f"{tmp_dir}/f/2020_01_01_a.json", [listing(1, price=100), listing(2, price="149000.0")])
    write_json(f"{tmp_dir}/f/2020_01_02_b.json", [listing(3, price=300)])
    df = read_listings(spark, f"{tmp_dir}/f")
    assert sorted(r.propertyCode for r in df.select("propertyCode").collect()) == [1, 2, 3]
    assert sorted((r.propertyCode, r.price) for r in df.collect()) == [(1, 100), (2, 149000), (3, 300)]
