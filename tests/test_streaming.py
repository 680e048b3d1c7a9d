from fixtures import RENT_LABEL, listing, write_json, write_text
from propmart.schemas import RENT_SCHEMA
from propmart.sources.raw import read_csv_by_name
from propmart.streaming.landing import persist_csv_stream, persist_listing_stream


def test_listing_stream_takes_only_new_files(spark, tmp_dir):
    land, out, ck = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_json(f"{land}/2020_01_01_a.json", [listing(1), listing(2, price="5.0")])
    persist_listing_stream(spark, land, out, ck)
    assert spark.read.parquet(out).count() == 2
    write_json(f"{land}/2020_02_01_b.json", [listing(3)])
    persist_listing_stream(spark, land, out, ck)
    df = spark.read.parquet(out)
    assert sorted(r.propertyCode for r in df.collect()) == [1, 2, 3]
    assert sorted(set(r.source_file for r in df.collect())) == ["2020_01_01_a.json", "2020_02_01_b.json"]


def test_csv_stream_binds_by_header(spark, tmp_dir):
    land, out, ck = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_text(f"{land}/a.csv", f"Any,Trimestre,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Lloguer_mitja,Preu\n2020,1,6,G,31,G,{RENT_LABEL},700\n")
    write_text(f"{land}/b.csv", f"Preu,Nom_Barri,Any,Trimestre,Codi_Districte,Nom_Districte,Codi_Barri,Lloguer_mitja\n800,H,2021,2,7,H,43,{RENT_LABEL}\n")
    names = {f.name: [f.name] for f in RENT_SCHEMA.fields}
    persist_csv_stream(spark, land, out, ck, names, RENT_SCHEMA)
    rows = sorted((r.Any, r.Nom_Barri, r.Preu) for r in spark.read.parquet(out).collect())
    assert rows == [(2020, "G", "700"), (2021, "H", "800")]


def test_income_csv_stream_maps_raw_header(spark, tmp_dir):
    from propmart.schemas import INCOME_SCHEMA
    from propmart.sources.raw import income_names

    land, out, ck = f"{tmp_dir}/land", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_text(
        f"{land}/inc.csv",
        "﻿Any,Codi_Districte,Nom_Districte,Codi_Barri,Nom_Barri,Població,Índex RFD Barcelona = 100\n2020,6,G,31,G,51000,110.5\n",
    )
    persist_csv_stream(spark, land, out, ck, income_names(), INCOME_SCHEMA)
    r = spark.read.parquet(out).first()
    assert (r.Any, r["Població"], r.Index_RFD_Barcelona_100) == (2020, 51000, "110.5")
