from pyspark.sql import functions as F

from propmart.operators.links import bitmaps_for, extract_links, merge_filters, name_filter, new_links, new_links_filtered, perhaps_stored, resolve_links

HTML = (
    '<html><body><a href="/dataset/2020_lloguer_preu_trim.csv">x</a>'
    '<a class="c" href="/dataset/other.pdf">y</a><link href="/style.css">'
    '<a href="https://cdn.example.org/files/2021_lloguer_preu_trim.csv">z</a></body></html>'
)


def test_extract_resolve_and_new(spark):
    pages = spark.createDataFrame([(1, "https://opendata.example.org", HTML)], "page_id int, url string, html string")
    links = extract_links(pages, suffix="lloguer_preu_trim.csv")
    assert [r.href for r in links.collect()] == [
        "/dataset/2020_lloguer_preu_trim.csv",
        "https://cdn.example.org/files/2021_lloguer_preu_trim.csv",
    ]
    assert extract_links(pages).count() == 3  # <link> is not an anchor
    res = resolve_links(links).collect()
    assert [r.link_url for r in res] == [
        "https://opendata.example.org/dataset/2020_lloguer_preu_trim.csv",
        "https://cdn.example.org/files/2021_lloguer_preu_trim.csv",
    ]
    assert [r.file_name for r in res] == ["2020_lloguer_preu_trim.csv", "2021_lloguer_preu_trim.csv"]
    stored = spark.createDataFrame([("2020_lloguer_preu_trim.csv",)], "file_name string")
    assert [r.file_name for r in new_links(resolve_links(links), stored).collect()] == ["2021_lloguer_preu_trim.csv"]


def test_files_to_fetch_skips_stored(spark, tmp_dir):
    import os

    from propmart.plans.collector import files_to_fetch

    os.makedirs(f"{tmp_dir}/local", exist_ok=True)
    open(f"{tmp_dir}/local/2020_lloguer_preu_trim.csv", "w").write("x")
    pages = spark.createDataFrame([(1, "https://opendata.example.org", HTML), (2, "https://opendata.example.org", HTML)], "page_id int, url string, html string")
    got = [r.file_name for r in files_to_fetch(spark, pages, f"{tmp_dir}/local").collect()]
    assert got == ["2021_lloguer_preu_trim.csv"]


def test_filter_splits_links_without_loss(spark):
    stored = spark.range(5000).select(F.concat(F.lit("file"), "id").alias("file_name"))
    links = spark.range(4000, 9000).select(F.concat(F.lit("file"), "id").alias("file_name"), "id").union(spark.createDataFrame([(None, -1)], "file_name string, id long"))
    n = bitmaps_for(5000)
    assert n == 2
    halves = [name_filter(stored.where(c), n) for c in ("file_name < 'file3'", "file_name >= 'file3'")]
    names = merge_filters(*halves)
    assert {(r.bitmap, bytes(r.bits)) for r in names.collect()} == {(r.bitmap, bytes(r.bits)) for r in name_filter(stored, n).collect()}
    marked = perhaps_stored(links, names, n)
    assert marked.where("id < 5000 AND id >= 0 AND NOT perhaps").count() == 0  # never a false "new"
    wrong = marked.where("id >= 5000 AND perhaps").count()
    assert wrong < 0.03 * 4000
    got = sorted(r.id for r in new_links_filtered(links, stored, names, n).collect())
    assert got == sorted(r.id for r in new_links(links, stored).collect()) == [-1, *range(5000, 9000)]
    empty = name_filter(stored.limit(0), 1)
    assert new_links_filtered(links, stored.limit(0), empty, 1).count() == 5001
