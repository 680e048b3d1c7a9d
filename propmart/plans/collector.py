"""Collector step: which rent files linked from the portal pages are not stored yet.

The source crawled the portal, kept the anchors whose href ends with the rent
file suffix, turned each into a download URL and skipped files already in the
local folder.  The download itself is a network client and is not built here;
this computes the list to fetch from crawled pages, in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propmart.operators.links import extract_links, new_links, resolve_links
from propmart.schemas import RENT_LINK_SUFFIX
from propmart.sources.files import inventory


def files_to_fetch(
    spark: SparkSession, pages: DataFrame, stored_dir: str, suffix: str = RENT_LINK_SUFFIX
) -> DataFrame:
    """X1-X3 + F7 + J6/F8: (page url, href, link_url, file_name) of links not in ``stored_dir``.

    ``pages`` has ``url`` and ``html``; ``stored_dir`` is listed without
    reading file contents.
    """
    links = resolve_links(extract_links(pages.select("url", "html"), suffix=suffix))
    stored = inventory(spark, stored_dir).select("file_name")
    return new_links(links, stored).select("url", "href", "link_url", "file_name").distinct()
