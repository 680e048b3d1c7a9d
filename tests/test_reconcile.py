from propmart.operators.reconcile import lookup_conflicts, lookup_for, reconcile
from propmart.operators.tables import format_income, format_listings, format_rent

LK = "district string, neighborhood string, district_n_reconciled string, neighborhood_n_reconciled string"


def _lookup(spark, rows):
    return spark.createDataFrame(rows, LK)


def test_one_key_reconcile_drops_unknown_and_null(spark):
    lk = _lookup(spark, [("D", "g", "Dist", "Gracia"), ("E", "h", "Est", "Horta")])
    df = spark.createDataFrame([(1, "g", "raw"), (2, "Nowhere", "raw"), (3, None, "raw")], "id int, neighborhood string, district string")
    out = reconcile(df, lk, on=[("neighborhood", "neighborhood")], take={"neighborhood": "neighborhood_n_reconciled"})
    assert [tuple(r) for r in out.collect()] == [(1, "Gracia", "raw")]


def test_fanout_and_default_dedupe(spark):
    # same neighborhood under two districts, same reconciled name
    lk = _lookup(spark, [("D1", "g", "x", "Gracia"), ("D2", "g", "y", "Gracia")])
    df = spark.createDataFrame([(1, "g")], "id int, neighborhood string")
    args = dict(on=[("neighborhood", "neighborhood")], take={"neighborhood": "neighborhood_n_reconciled"})
    assert reconcile(df, lk, **args).count() == 1
    assert reconcile(df, lk, keep_fanout=True, **args).count() == 2


def test_conflicts_report(spark):
    lk = _lookup(spark, [("D1", "g", "x", "Gracia"), ("D2", "g", "y", "Vila de Gracia"), ("D3", "h", "z", "Horta")])
    got = [tuple(r) for r in lookup_conflicts(lk, ["neighborhood"]).collect()]
    assert got == [("g", 2, "Gracia", "Vila de Gracia")]


def test_lookup_for_projects_before_distinct(spark):
    lk = _lookup(spark, [("D1", "g", "x", "Gracia"), ("D1", "g", "y", "Gracia")])
    assert lookup_for(lk, ["neighborhood"], ["neighborhood_n_reconciled"]).count() == 1
    assert lookup_for(lk, ["neighborhood"], keep_fanout=True).count() == 2


def test_lookup_joins_without_a_job_of_its_own(spark):
    lk = _lookup(spark, [("D", "g", "Dist", "Gracia")])
    df = spark.createDataFrame([(1, "g")], "id int, neighborhood string")
    args = dict(on=[("neighborhood", "neighborhood")], take={"neighborhood": "neighborhood_n_reconciled"})
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    joined = reconcile(df, lk, **args)
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == set(jobs)
    assert joined.count() == 1


def test_format_income_rent_listings(spark):
    lk = spark.createDataFrame(
        [("Gràcia", "Gràcia", "Gràcia R", "d", "1", "Vila R", "n", "2")],
        "district string, neighborhood string, district_n_reconciled string, district_n string, district_id string, "
        "neighborhood_n_reconciled string, neighborhood_n string, neighborhood_id string",
    )
    inc = spark.createDataFrame(
        [(2020, 6, "Gràcia", 31, "Gràcia", 51000, "110.5"), (2020, 9, "X", 1, "Y", 1, "1")],
        "Any int, Codi_Districte smallint, Nom_Districte string, Codi_Barri smallint, Nom_Barri string, `Població` bigint, Index_RFD_Barcelona_100 string",
    )
    got = format_income(inc, lk).collect()
    assert [tuple(r) for r in got] == [("Gràcia R", "Vila R", 2020, 51000, "110.5")]
    assert got[0].__fields__ == ["district", "neighborhood", "year", "populatonBCN", "Index_RFD_Barcelona_100"]
    rent = spark.createDataFrame(
        [(2020, 1, 6, "Gràcia", 31, "Gràcia", "m", "700")],
        "Any int, Trimestre smallint, Codi_Districte smallint, Nom_Districte string, Codi_Barri smallint, Nom_Barri string, Lloguer_mitja string, Preu string",
    )
    assert [tuple(r) for r in format_rent(rent, lk).collect()] == [("Gràcia R", "Vila R", 2020, 1, "m", "700")]
    import datetime as dt

    lst = spark.createDataFrame(
        [("Gràcia", "raw district", 1, dt.date(2020, 1, 1), 100, 70.5, 2, 1, 41.39, 2.15, "sale", "flat", "2", "good", True)],
        "neighborhood string, district string, propertyCode int, date date, price int, size float, rooms tinyint, "
        "bathrooms tinyint, latitude float, longitude float, operation string, propertyType string, floor string, status string, hasLift boolean",
    )
    out = format_listings(lst, lk)
    r = out.first()
    assert (r.neighborhood, r.district, r.propertyCode, r.price) == ("Vila R", "raw district", 1, 100)
    assert dict(out.dtypes)["size"] == "double" and dict(out.dtypes)["rooms"] == "bigint"


def test_income_fanout_on_two_keys(spark):
    lk = spark.createDataFrame(
        [("D", "N", "Dr", "x", "1", "Nr", "a", "2"), ("D", "N", "Dr", "y", "1", "Nr", "b", "2")],
        "district string, neighborhood string, district_n_reconciled string, district_n string, district_id string, "
        "neighborhood_n_reconciled string, neighborhood_n string, neighborhood_id string",
    )
    inc = spark.createDataFrame(
        [(2020, 1, "D", 1, "N", 10, "1")],
        "Any int, Codi_Districte smallint, Nom_Districte string, Codi_Barri smallint, Nom_Barri string, `Població` bigint, Index_RFD_Barcelona_100 string",
    )
    assert format_income(inc, lk).count() == 1
    assert format_income(inc, lk, keep_fanout=True).count() == 2
