"""Token counts by section through character offsets.

A document is encoded once, whole.  Every token covers a run of characters;
sections (fields, lines, any intervals) are joined to those runs by interval.
A token that lies in one section counts there.  A token that crosses a
boundary is allocated by an explicit rule:

- ``first``: to the section that holds its first character;
- ``most``: to the section that holds most of its characters, the earlier one
  if equal;
- ``share``: to every section it touches, in proportion to the characters.

Characters outside all sections belong to none: a token is then allocated
among the sections it touches, or to none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.llm.common import pieces
from propmart.llm.tokens import encoder

RULES = ("first", "most", "share")


def allocate(begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens per section, crossing tokens that touch each section, and tokens without any.

    ``begin``/``end`` are the token spans, ``low``/``high`` disjoint ascending
    sections.  Tokens of no characters do not occur; those that share one
    character (parts of a code point) have equal spans and count one by one.
    """
    n = len(low)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not n:
        return counts, crossing, len(begin)
    # interval join: sections first..last (exclusive) overlap the token
    first = np.searchsorted(high, begin, side="right")
    last = np.searchsorted(low, end, side="left")
    touched = last - first
    whole = (touched == 1) & (low[np.minimum(first, n - 1)] <= begin) & (end <= high[np.minimum(first, n - 1)])
    counts += np.bincount(first[whole], minlength=n)
    rest = np.flatnonzero((touched >= 1) & ~whole)
    k = touched[rest]
    token = np.repeat(rest, k)
    section = np.repeat(first[rest] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
    shared = np.minimum(end[token], high[section]) - np.maximum(begin[token], low[section])
    np.add.at(crossing, section, 1)
    if rule == "share":
        total = np.add.reduceat(shared, np.cumsum(k) - k) if len(rest) else shared
        np.add.at(counts, section, shared / np.repeat(total, k))
    elif len(rest):
        starts = np.cumsum(k) - k
        if rule == "first":  # the section of the first character, or the first that is touched
            pick = section[starts]
        else:
            most = np.repeat(np.maximum.reduceat(shared, starts), k)
            best = np.flatnonzero(shared == most)
            pick = section[best[np.unique(token[best], return_index=True)[1]]]
        np.add.at(counts, pick, 1)
    return counts, crossing, int((touched < 1).sum())


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a text as sections; a line feed belongs to the line it ends."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    cuts = np.flatnonzero(code == 10) + 1
    bounds = np.unique(np.concatenate([[0], cuts, [len(code)]]))
    return bounds[:-1], bounds[1:]


SCHEMA = "doc_id long, section int, low long, high long, n_tokens double, n_crossing long, doc_tokens long, outside long"


def attribute(docs: DataFrame, tokenizer: str, rule: str = "most", sections: str | None = None) -> DataFrame:
    """Tokens per section of every document.

    ``sections`` names an array column of structs (low, high) of character
    offsets, disjoint; without it the lines of ``text`` are the sections.
    Offsets past the text's end are cut off, empty and null intervals dropped,
    the rest numbered from 0 in ascending order.  Returns doc_id, section,
    low, high, n_tokens, n_crossing (crossing tokens that touch it),
    doc_tokens (of the whole document) and outside (its tokens in no section).
    A document without sections (a null or empty text) gives one row with null
    section and zero counts.  Repeated rows are rows of their own.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            whole = None if len(texts) == 1 else made.spans(texts)
            ends = [0, 0] if whole is None else np.concatenate([[0], np.cumsum(whole[2])])
            given = batch.column(2).to_pylist() if sections else [None] * len(texts)
            out: list[list] = [[] for _ in range(8)]
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), texts, strict=True)):
                if sections:
                    cut = sorted((max(0, s["low"]), min(len(text), s["high"])) for s in given[i] or () if s and s["low"] is not None and s["high"] is not None)
                    cut = [x for x in cut if x[0] < x[1]]
                    low, high = (np.array(x, np.int64) for x in (zip(*cut, strict=True) if cut else ((), ())))
                    if (low[1:] < high[:-1]).any():
                        raise ValueError(f"sections of document {key} overlap")
                else:
                    low, high = line_sections(text)
                n = len(low)
                if whole is not None:
                    n_tokens = int(whole[2][i])
                    counts, crossing, outside = allocate(whole[0][ends[i] : ends[i + 1]], whole[1][ends[i] : ends[i + 1]], low, high, rule)
                else:  # perhaps a very long text: its parts add up
                    counts, crossing, outside, n_tokens, base = np.zeros(n), np.zeros(n, np.int64), 0, 0, 0
                    for part in made.parts(text):
                        b, e, _ = made.spans([part])
                        more = allocate(b + base, e + base, low, high, rule)
                        counts, crossing, outside = counts + more[0], crossing + more[1], outside + more[2]
                        n_tokens, base = n_tokens + len(b), base + len(part)
                rows = (range(n), low.tolist(), high.tolist(), counts.tolist(), crossing.tolist()) if n else ([None], [0], [0], [0.0], [0])
                for column, values in zip(out, ([key] * max(n, 1), *rows, [n_tokens] * max(n, 1), [outside] * max(n, 1)), strict=True):
                    column.extend(values)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.col(sections)] if sections else []))
    return rows.mapInArrow(run, SCHEMA)


def with_sections(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """``docs`` with the array column ``sections`` from rows (doc_id, low, high).

    One shuffle by doc_id; the intervals of one document are gathered, which
    its length bounds.  Documents without intervals get null.
    """
    gathered = intervals.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("low", "high")).alias("sections"))
    return docs.join(gathered, F.col("doc_id") == F.col("__id"), "left").drop("__id")
