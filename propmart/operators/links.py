"""Link harvesting from crawled pages (X1-X3, F7) and the new-file check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.functions.text import anchor_hrefs, file_name, resolve_link


def extract_links(pages: DataFrame, suffix: str | None = None, html: str = "html", base: str = "url") -> DataFrame:
    """X1 + F7: one row per anchor href of each page, optionally only hrefs
    ending with ``suffix``.  Keeps every other page column (narrow, no shuffle)."""
    out = pages.select(*[c for c in pages.columns if c != html], F.explode(anchor_hrefs(F.col(html))).alias("href"))
    if suffix:
        out = out.where(F.col("href").endswith(F.lit(suffix)))
    return out


def resolve_links(links: DataFrame, base: str = "url", href: str = "href") -> DataFrame:
    """X2 + X3: download URL and target file name of every link."""
    link = resolve_link(F.col(base), F.col(href))
    return links.withColumn("link_url", link).withColumn("file_name", file_name(link))


# Bits of one bitmap, as bitmap_construct_agg makes them.
BITMAP_BITS = 32768
BITS_PER_NAME = 12
PROBES = 6


def _probe(name: Column, n_bitmaps: int) -> tuple[Column, Column]:
    """The bitmap of a name, and its places (an array) in that bitmap."""
    one, two = F.xxhash64(name), F.xxhash64(name, F.lit("second"))
    step = F.pmod(two, F.lit(BITMAP_BITS // 2)) * 2 + 1  # odd, so that the places differ
    places = [F.pmod(F.shiftrightunsigned(one, 20) + step * i, F.lit(BITMAP_BITS)) for i in range(PROBES)]
    return F.pmod(one, F.lit(n_bitmaps)), F.array(*places)


def name_filter(names: DataFrame, n_bitmaps: int, on: str = "file_name") -> DataFrame:
    """A Bloom filter of names as rows (bitmap, bits), one per bitmap in use.

    All places of a name lie in one bitmap, so the filter is made by one
    aggregate that combines map-side, and filters of the same ``n_bitmaps``
    merge by ``merge_filters``.
    """
    bitmap, places = _probe(F.col(on), n_bitmaps)
    spread = names.where(F.col(on).isNotNull()).select(bitmap.alias("bitmap"), F.explode(places).alias("place"))
    return spread.groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits"))


def bitmaps_for(n_names: int) -> int:
    """Bitmaps for about ``BITS_PER_NAME`` bits a name."""
    return max(1, -(-n_names * BITS_PER_NAME // BITMAP_BITS))


def merge_filters(first: DataFrame, second: DataFrame) -> DataFrame:
    """The filter of the names of both."""
    return first.union(second).groupBy("bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))


def perhaps_stored(links: DataFrame, names: DataFrame, n_bitmaps: int, on: str = "file_name") -> DataFrame:
    """``links`` with the column ``perhaps``: false where the filter ``names`` proves the name new.

    The join moves links and bitmaps; a small filter is broadcast.
    """
    bitmap, places = _probe(F.col(on), n_bitmaps)
    held = names.select(F.col("bitmap").alias("__bitmap"), F.col("bits").alias("__bits"))
    joined = links.join(held, bitmap == F.col("__bitmap"), "left")
    byte = lambda p: F.conv(F.hex(F.substr(F.col("__bits"), (F.shiftright(p, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.forall(places, lambda p: F.expr("0") != byte(p).bitwiseAND(F.call_function("shiftleft", F.lit(1), p.bitwiseAND(F.lit(7)).cast("int"))))
    perhaps = F.col(on).isNotNull() & F.col("__bits").isNotNull() & is_set
    return joined.select(*[links[c] for c in links.columns], F.coalesce(perhaps, F.lit(False)).alias("perhaps"))


def new_links_filtered(links: DataFrame, stored: DataFrame, names: DataFrame, n_bitmaps: int, on: str = "file_name") -> DataFrame:
    """J6/F8 against a large manifest: only links that may be stored are joined with it.

    ``names`` is the manifest's filter, which is kept with it and merged with
    that of newly stored names.  Links that it proves new pass without a join.
    Of the manifest, the join moves only the names that a filter of the
    remaining links lets through.
    """
    marked = perhaps_stored(links, names, n_bitmaps, on)
    sure = marked.where(~F.col("perhaps")).drop("perhaps")
    open_ones = marked.where("perhaps").drop("perhaps")
    asked = name_filter(open_ones, n_bitmaps, on)
    have = perhaps_stored(stored.select(on), asked, n_bitmaps, on).where("perhaps")
    return sure.unionByName(new_links(open_ones, have, on))


def new_links(links: DataFrame, stored: DataFrame, on: str = "file_name") -> DataFrame:
    """Links whose target file is not stored yet (left anti join)."""
    have = stored.select(F.col(on).alias("__have")).distinct()
    return links.join(have, links[on] == have["__have"], "left_anti")
