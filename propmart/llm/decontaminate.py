"""Benchmark decontamination with spaced-seed hashing.

Tokens are lower-cased words without punctuation, and single characters of
scripts that are written without blanks.  Fixed masks take some token
positions of a window and ignore the others, so a window still hashes alike
after a substitution at an ignored position.  Seeds of the benchmark and of
the documents are joined on their hashes; every hit is verified along its
alignment by the longest stretch in which enough tokens agree.  Items no longer
than such a stretch are compared whole, with masks for every change allowed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.llm import shingles as sh
from propmart.llm.common import pieces

MASKS = ("110110101", "1011001011", "11100010111", "1110111", "1111101")  # one of them hits every stretch of STRETCH tokens or more that agrees
MIN_TOKENS = 5  # shorter items must be equal in all their tokens
MIN_CHARS = 16  # of the tokens of such an item; below it is not told from chance
STRETCH = 13  # tokens of an overlap that counts; for shorter items all their tokens
AGREE = 0.8  # share of them that must be equal
PART_BYTES = 16 << 20  # benchmark text that one pass over the documents holds
FILTER_BITS = 22

# every ASCII character that is neither a letter nor a digit separates tokens
SEPARATORS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


# code points of scripts written without blanks: each is a token
UNSPACED = (
    (0x0E00, 0x1000),  # Thai, Lao, Tibetan
    (0x1000, 0x10A0),  # Myanmar
    (0x1780, 0x1800),  # Khmer
    (0x1950, 0x1A00),  # Tai Le, New Tai Lue, Khmer symbols
    (0x1A20, 0x1AB0),  # Tai Tham
    (0x1B00, 0x1B80),  # Balinese
    (0x2E80, 0x2FE0),  # radicals
    (0x3005, 0x3008),  # ideographic marks
    (0x3040, 0x3130),  # kana, Bopomofo
    (0x31A0, 0x31C0),
    (0x31F0, 0x3200),
    (0x3400, 0x4DC0),  # Han
    (0x4E00, 0xA4D0),  # Han, Yi
    (0xA980, 0xAA00),  # Javanese, Myanmar
    (0xAA60, 0xAAE0),  # Myanmar, Tai Viet
    (0xF900, 0xFB00),
    (0xFF66, 0xFFA0),  # halfwidth kana
    (0x1AFF0, 0x1B170),  # kana
    (0x20000, 0x40000),  # Han
)


def _spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of texts, with a blank on both sides of every character of an unspaced script."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return data, bounds
    size = np.where(data[lead] >= 0xF0, 4, 3)
    code = data[lead].astype(np.int32) & np.where(size == 4, 0x07, 0x0F)
    for i in (1, 2, 3):
        code = np.where(i < size, code << 6 | (data[np.minimum(lead + i, len(data) - 1)] & 0x3F), code)
    low, high = np.array(UNSPACED).T
    alone = code < high[np.searchsorted(low, code, side="right") - 1]
    alone &= code >= low[0]
    cut = np.unique(np.concatenate([lead[alone], (lead + size)[alone]]))
    return np.insert(data, cut, 32), bounds + np.searchsorted(cut, bounds, side="left")


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of lower-cased texts, and token bounds of the texts."""
    hashes, _, _, bounds = sh.words(*_spaced(*sh.text_bytes(column)), SEPARATORS)
    return hashes, bounds


def _characters(column: pa.Array) -> np.ndarray:
    """Characters in the tokens of every text."""
    data, bounds = sh.text_bytes(column)
    counted = ~SEPARATORS[data] & ((data & 0xC0) != 0x80)
    return np.diff(np.concatenate([[0], np.cumsum(counted)])[bounds])


def _needed(length: int, agree: float) -> int:
    """Equal tokens that a whole item of so many tokens needs."""
    return length if length < MIN_TOKENS else max(1, -(-length * round(agree * 1000) // 1000))


def _short_masks(length: int, changes: int) -> list[np.ndarray]:
    """Positions that each mask of a whole item takes; whichever ``changes`` of them differ, one mask takes none of those."""
    blocks = length if changes == 1 and length < 9 else {0: 1, 1: 3, 2: 5}.get(changes, changes + 1)
    parts = np.array_split(np.arange(length), min(blocks, length))
    return [np.concatenate([p for i, p in enumerate(parts) if i not in left]) for left in combinations(range(len(parts)), changes)]


def _seed(hashes: np.ndarray, at: np.ndarray, number: int, mask: np.ndarray) -> np.ndarray:
    """Hash of the tokens that a mask takes of the windows that start at ``at``."""
    out = np.full(len(at), number + 1, np.uint64)
    for c, i in zip(sh.multipliers(len(mask), 11), mask - mask[0], strict=True):
        out += hashes[at + i] * c
    return sh.mix(out)


def _seeds(hashes: np.ndarray, bounds: np.ndarray, number: int, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed hash and first token of every window of a mask that lies in one text."""
    span = int(mask[-1] - mask[0]) + 1
    n = np.maximum(np.diff(bounds) - span + 1, 0)
    ends = np.cumsum(n)
    at = np.repeat(bounds[:-1] - (ends - n), n) + np.arange(int(n.sum()))
    return _seed(hashes, at, number, mask), at


class Benchmark:
    """Seeds and tokens of one part of the benchmark, as sorted arrays."""

    def __init__(self, items: pa.Table, stretch: int = STRETCH, agree: float = AGREE):
        texts = items.column("text").combine_chunks()
        self.ids = items.column("item_id").to_pylist()
        self.hashes, self.bounds = tokens(texts)
        self.stretch, self.agree = stretch, agree
        lengths = np.diff(self.bounds)
        self.masks = [np.flatnonzero([c == "1" for c in m]) for m in MASKS]
        long = np.where(lengths > stretch, lengths, 0)
        seeds, places = [], []
        for number, mask in enumerate(self.masks):
            seed, at = _seeds(self.hashes, self.bounds, number, mask)
            right = long[np.searchsorted(self.bounds, at, side="right") - 1] > 0
            seeds.append(seed[right])
            places.append(at[right])
        whole = (lengths > 0) & (lengths <= stretch) & ((lengths >= MIN_TOKENS) | (_characters(texts) >= MIN_CHARS))
        for length in np.unique(lengths[whole]).tolist():
            first = self.bounds[:-1][whole & (lengths == length)]
            for mask in _short_masks(length, length - _needed(length, agree)):
                at = first + mask[0]
                seeds.append(_seed(self.hashes, at, len(self.masks), mask))
                places.append(at)
                self.masks.append(mask)
        seed, place = np.concatenate(seeds), np.concatenate(places)
        order = np.argsort(seed, kind="stable")
        self.seeds, self.places = seed[order], place[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.seeds >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct rows (document, item, shift): where shift added to a token of the item names the document's."""
        found = []
        for number, mask in enumerate(self.masks):
            seed, at = _seeds(hashes, bounds, number, mask)
            some = np.flatnonzero(self.filter[(seed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            seed, at = seed[some], at[some]
            low, high = np.searchsorted(self.seeds, seed, "left"), np.searchsorted(self.seeds, seed, "right")
            n = high - low
            token = np.repeat(at, n)
            place = self.places[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            doc = np.searchsorted(bounds, token, side="right") - 1
            item = np.searchsorted(self.bounds, place, side="right") - 1
            found.append(np.stack([doc, item, token - place], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, first token of the item, tokens, equal tokens) of verified hits."""
        hits = self.hits(hashes, bounds)
        lengths = np.diff(self.bounds)[hits[:, 1]]
        for length in np.unique(lengths[lengths <= self.stretch]).tolist():  # whole items
            doc, item, shift = (rows := hits[lengths == length]).T
            at = self.bounds[item][:, None] + np.arange(length)
            other = at + shift[:, None]
            inside = (other >= bounds[doc][:, None]) & (other < bounds[doc + 1][:, None])
            equal = (inside & (self.hashes[at] == hashes[np.clip(other, 0, len(hashes) - 1)])).sum(axis=1)
            right = equal >= _needed(length, self.agree)
            for (d, i, _), n in zip(rows[right].tolist(), equal[right].tolist(), strict=True):
                yield d, i, 0, length, n
        for doc, item, shift in hits[lengths > self.stretch].tolist():
            low, high = int(self.bounds[item]), int(self.bounds[item + 1])
            a, b = max(low, int(bounds[doc]) - shift), min(high, int(bounds[doc + 1]) - shift)
            equal = self.hashes[a:b] == hashes[a + shift : b + shift]
            first, n = longest_stretch(equal, self.agree)
            if n >= self.stretch:
                yield doc, item, a - low + first, n, int(equal[first : first + n].sum())


def longest_stretch(equal: np.ndarray, agree: float) -> tuple[int, int]:
    """First place and length of the longest stretch, from an equal token to an equal one, of which a share of ``agree`` is equal.

    Of several the one with most equal tokens, then the first.
    """
    place = np.flatnonzero(equal)
    if not len(place):
        return 0, 0
    share = round(agree * 1000)
    run = 1000 * np.arange(len(place)) - share * place
    # for each end the first start from which the share is reached
    start = np.searchsorted(-np.minimum.accumulate(run), -(run + 1000 - share), side="left")
    n = place - place[start] + 1
    best = int(np.lexsort((place, -(np.arange(len(place)) - start), -n))[0])
    return int(place[start[best]]), int(n[best])


def _parts(benchmark: DataFrame, part_bytes: int, options: tuple[int, float]) -> Iterator:
    """The benchmark in broadcast parts of about ``part_bytes`` of text."""
    rows = benchmark.select(F.col("item_id"), F.lower(F.col("text").cast("string")).alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // part_bytes)
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        items = part.orderBy("item_id", "text").toArrow()
        if items.num_rows:
            yield benchmark.sparkSession.sparkContext.broadcast(Benchmark(items, *options))


def _scan(docs: DataFrame, part, schema: str, emit: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = part.value
        for batch in pieces(batches, "__text"):
            hashes, bounds = tokens(batch.column(batch.num_columns - 1))
            if (out := emit(known, batch, list(known.overlaps(hashes, bounds)))) is not None:
                yield out

    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, stretch: int = STRETCH, agree: float = AGREE, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document row and benchmark item that it overlaps.

    Columns doc_id, item_id, item_tokens, first (token of the item), n_tokens
    and n_equal of the longest verified stretch.  Null and empty texts on
    either side match nothing; repeated rows are reported as often as they
    come.  A benchmark above ``part_bytes`` is searched in parts, each in a
    pass of its own over the documents.
    """
    schema = "doc_id long, item_id long, item_tokens long, first long, n_tokens long, n_equal long"

    def emit(known: Benchmark, batch: pa.RecordBatch, found: list) -> pa.RecordBatch | None:
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, first, n, equal in found:
            if (n, equal, -first) > best.get((doc, item), (0, 0, 0)):
                best[doc, item] = (n, equal, -first)
        if not best:
            return None
        ids, lengths = batch.column(0), np.diff(known.bounds)
        rows = [(ids[d].as_py(), known.ids[i], int(lengths[i]), -first, n, equal) for (d, i), (n, equal, first) in sorted(best.items())]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "item_id", "item_tokens", "first", "n_tokens", "n_equal"])

    text = docs.select(F.col("doc_id").cast("long"), F.lower(F.col("text").cast("string")).alias("__text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for part in _parts(benchmark, part_bytes, (stretch, agree)):
        out = out.union(_scan(text, part, schema, emit))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, stretch: int = STRETCH, agree: float = AGREE, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns."""

    def emit(known: Benchmark, batch: pa.RecordBatch, found: list) -> pa.RecordBatch | None:
        kept = np.ones(batch.num_rows, bool)
        kept[[f[0] for f in found]] = False
        return batch.filter(pa.array(kept)).select(batch.schema.names[:-1])

    for part in _parts(benchmark, part_bytes, (stretch, agree)):
        # positions instead of names, for columns whose names clash
        names = docs.columns
        plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
        plain = plain.withColumn("__text", F.lower(F.col(f"c{names.index('text')}").cast("string")))
        docs = _scan(plain, part, plain.drop("__text").schema, emit).toDF(*names)
    return docs
