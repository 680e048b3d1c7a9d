"""Text and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMMENT = r"(?s)<!--.*?-->"
# An anchor's opening tag; quoted attribute values may hold '>'.
ANCHOR = r"""(?is)<a(?=[\s/])(?:[^>"']|"[^"]*"|'[^']*')*>"""
# The value of its first href attribute: the name must start an attribute.
HREF = r"""(?is)^<a(?:[\s/]+(?!href[\s=])[^\s=>/"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*[\s/]+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Entities that occur in URLs.
ENTITIES = {"&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&lt;": "<", "&gt;": ">", "&#38;": "&", "&#x26;": "&", "&amp;": "&"}


def anchor_hrefs(html: Column) -> Column:
    """Array of the href values of every anchor element in ``html``.

    Tag and attribute names in any case, values in double, single or no
    quotes, comments ignored, common entities decoded.  Anchors without href
    give nothing; an empty value is kept.
    """
    tags = F.regexp_extract_all(F.regexp_replace(html, COMMENT, ""), F.lit(ANCHOR), 0)
    values = F.filter(F.transform(tags, lambda t: F.regexp_extract(t, HREF, 1)), lambda v: v != "")
    return F.transform(values, lambda v: decode_entities(F.regexp_replace(v, r"""^["']|["']$""", "")))


def decode_entities(text: Column) -> Column:
    """Common entities as the characters they mean; ``&amp;`` last, so nothing is decoded twice."""
    for entity, character in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def after_last(text: Column, delimiter: str) -> Column:
    """Text after the last ``delimiter`` (whole text when it does not occur)."""
    return F.substring_index(text, delimiter, -1)


def resolve_link(base: Column, href: Column, scheme: str = "https://") -> Column:
    """``base + href``, keep what follows the last ``//``, prefix the scheme."""
    return F.concat(F.lit(scheme), after_last(F.concat(base, href), "//"))


def file_name(path: Column) -> Column:
    """Last path segment."""
    return after_last(path, "/")


def strip_extension(name: Column) -> Column:
    """X11: drop a trailing ``.ext``."""
    return F.regexp_replace(name, r"\.[^./]*$", "")


def name_prefix(name: Column, n: int) -> Column:
    """First ``n`` characters of a file name."""
    return F.substring(name, 1, n)
