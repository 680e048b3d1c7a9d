"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when it lies in a string of ``width`` bytes that also starts
elsewhere.  Sorting every suffix would move the corpus many times over, so:

- anchors: in every window of ``width`` bytes the ``gram``-byte strings with
  the least hash.  Equal windows have equal anchors at equal places, so only
  anchors that occur more than once can lie in a repeated window;
- an anchor's context is everything that a window through it may hold.  A
  context that occurs twice is repeated as a whole (full);
- of the other shared anchors, the suffixes that start at the anchor and the
  reversed prefixes that end there are sorted per anchor by mergesort.  Two
  of them are compared in a logarithmic number of steps: prefix polynomial
  hashes and binary search find their common extension.  Neighbours' common
  extensions are verified on the bytes.  For every place of a window around
  the anchor, the runs of suffixes that agree on its right part and of
  prefixes that agree on its left part tell which windows occur twice.

Copies of a whole text are removed as a whole; one of them takes part above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.llm import shingles as sh
from propmart.llm.common import pieces, sorted_groups, written

WIDTH, GRAM = 200, 64
CHUNK = 1 << 19  # bytes of one long text that are searched at once
LARGE_GROUP = 20_000  # contexts of one anchor that are sorted in one task
BATCH_CONTEXTS = 5_000
BATCH_TEXTS = 500  # texts that are Python objects at once
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(x: np.ndarray, size: int, func: np.ufunc, fill: np.uint64) -> np.ndarray:
    """``func`` over every run of ``size`` values."""
    padded = np.full(-(-len(x) // size) * size, fill, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, size)
    ahead = func.accumulate(blocks, axis=1).reshape(-1)
    behind = np.ascontiguousarray(func.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).reshape(-1)
    n = len(x) - size + 1
    return func(behind[:n], ahead[size - 1 : size - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, low: int, high: int, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors of the windows that start in ``low`` to ``high``, their hashes, and prefix hashes."""
    prefix = sh.prefix_hash(data)
    if len(data) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), prefix
    hashes = sh.mix((prefix[gram:] - prefix[:-gram]) * sh.powers(len(data) + 1)[1][: len(data) - gram + 1]) | np.uint64(1)
    size = width - gram + 1
    for end in bounds[1:-1].tolist():
        hashes[max(0, end - gram + 1) : end] = NONE
    least = _sliding(hashes, size, np.minimum, NONE)
    for end in bounds[1:-1].tolist():
        least[max(0, end - width + 1) : end] = 0
    least[: max(0, low)] = 0
    least[max(0, high) :] = 0
    around = np.concatenate([np.zeros(size - 1, np.uint64), least, np.zeros(size - 1, np.uint64)])
    best = _sliding(around, size, np.maximum, np.uint64(0))
    place = np.flatnonzero(best == hashes)
    return place, hashes[place], prefix


def _anchor_rows(width: int, gram: int):
    left, names = width - gram, ["anchor", "context", "key", "place"]

    def rows(data: np.ndarray, bounds: np.ndarray, keys: np.ndarray, low: int, high: int, shift: int, whole: int | None) -> pa.RecordBatch:
        place, anchor, prefix = anchors(data, bounds, low, high, width, gram)
        doc = np.searchsorted(bounds, place, side="right") - 1
        a = np.maximum(bounds[doc], place - left)
        b = np.minimum(bounds[doc + 1], place + width)
        down = sh.powers(len(data) + 1)[1]
        shape = (place - a).astype(np.uint64) * np.uint64(1 << 20) + (b - place).astype(np.uint64)
        context = sh.mix((prefix[b] - prefix[a]) * down[a] + sh.mix(shape))
        size = np.diff(bounds)[doc] if whole is None else whole
        packed = ((place - bounds[doc] + shift) << 32) | size
        return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys[doc]), pa.array(packed)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 1 << 19):  # some ten arrays of eight bytes per byte
            data, bounds = sh.text_bytes(batch.column(1))
            keys = np.asarray(batch.column(0))
            if batch.num_rows > 1 or len(data) <= CHUNK:
                yield rows(data, bounds, keys, 0, len(data), 0, None)
                continue
            for start in range(0, len(data), CHUNK):  # windows that start in the chunk, with what lies around them
                a, b = max(0, start - width), min(len(data), start + CHUNK + 2 * width)
                yield rows(data[a:b], np.array([0, b - a]), keys, start - a, start - a + CHUNK, a, len(data))

    return run


class Extensions:
    """Common extensions of places in a byte array, by prefix hashes and binary search."""

    def __init__(self, data: np.ndarray):
        self.data, self.prefix, self.down = data, sh.prefix_hash(data), sh.powers(len(data) + 1)[1]

    def _same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        p, d = self.prefix, self.down
        return (p[x + n] - p[x]) * d[x] == (p[y + n] - p[y]) * d[y]

    def forward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes in common of the strings that start at x and y, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self._same(x, y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def backward(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes in common of the strings that end at x and y, at most ``most``."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self._same(x - mid, y - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _mergesort(ext: Extensions, at: np.ndarray, room: np.ndarray, group: np.ndarray, forward: bool) -> np.ndarray:
    """Order of the strings that start (or, reversed, end) at ``at``, group by group.

    ``group`` ascends; ``room`` is the number of bytes of each string.  Runs
    of doubling length are merged, all at once: the place of an element is its
    own rank plus its rank in the other run, found by binary search.
    """
    n = len(at)
    first = np.searchsorted(group, group, side="left")
    size = np.searchsorted(group, group, side="right") - first
    order, rank = np.arange(n), np.arange(n) - first
    length = 1
    while length < size.max(initial=0):
        # rank: place of the element at a position of the order, within its group
        run = rank // length
        other = run ^ 1
        start = other * length
        stop = np.minimum(start + length, size)
        moving = np.flatnonzero(start < size)
        low, high = start[moving].copy(), stop[moving].copy()
        mine, base, is_left = order[moving], first[moving], (run[moving] & 1) == 0
        active = np.arange(len(moving))
        while len(active := active[low[active] < high[active]]):
            mid = (low[active] + high[active]) >> 1
            x, y = mine[active], order[base[active] + mid]
            most = np.minimum(room[x], room[y])
            common = (ext.forward if forward else ext.backward)(at[x], at[y], most)
            ended = common == most
            step = np.where(ended, 0, common)
            bx = ext.data[np.where(ended, 0, at[x] + step if forward else at[x] - step - 1)].astype(np.int64)
            by = ext.data[np.where(ended, 0, at[y] + step if forward else at[y] - step - 1)].astype(np.int64)
            differ = np.where(ended, room[y] - room[x], by - bx)  # positive: y is larger
            below = (differ < 0) | ((differ == 0) & ~is_left[active])  # of equal ones the left run comes first
            low[active] = np.where(below, mid + 1, low[active])
            high[active] = np.where(below, high[active], mid)
        place = np.arange(n)
        place[moving] = base + np.minimum(start[moving], run[moving] * length) + (rank[moving] - run[moving] * length) + (low - start[moving])
        new = np.empty(n, np.int64)
        new[place] = order
        order = new
        length *= 2
    return order


def _neighbours(data: np.ndarray, at: np.ndarray, room: np.ndarray, group: np.ndarray, order: np.ndarray, most: int, forward: bool) -> np.ndarray | None:
    """Verified common bytes of each string with the one before it in the order (first of a group: -1).

    None if the order is not that of the bytes, which a hash collision could cause.
    """
    reach = np.arange(most)
    out = np.full(len(at), -1)
    for a in range(0, len(order), 4096):
        some = order[max(0, a - 1) : a + 4096]
        place = at[some, None] + reach if forward else at[some, None] - 1 - reach
        inside = reach < room[some, None]
        rows = np.where(inside, data[np.where(inside, place, 0)].astype(np.int16), -1)
        equal = (rows[1:] == rows[:-1]) & inside[1:]
        common = np.where(equal.all(axis=1), most, equal.argmin(axis=1))
        together = group[some[1:]] == group[some[:-1]]
        stop = np.minimum(common, most - 1)
        i = np.arange(len(common))
        if (together & (common < most) & (rows[1:][i, stop] < rows[:-1][i, stop])).any():
            return None
        out[max(0, a - 1) + 1 : max(0, a - 1) + len(some)] = np.where(together, common, -1)
    return out


def _bytes_order(data: np.ndarray, at: np.ndarray, room: np.ndarray, group: np.ndarray, forward: bool) -> np.ndarray:
    """The same order as ``_mergesort`` by comparing bytes; only after a collision."""
    texts = [data[a : a + r].tobytes() if forward else data[a - r : a][::-1].tobytes() for a, r in zip(at.tolist(), room.tolist(), strict=True)]
    return np.array(sorted(range(len(at)), key=lambda i: (group[i], texts[i], i)), np.int64)


def repeated_places(data: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray, group: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of a repeated window's start, relative to each anchor.

    ``before`` and ``after`` are the bytes of context on either side of
    ``at`` (the anchor is part of ``after``).  Returns the least and greatest
    i for which the window that starts i bytes before the anchor occurs in
    another context of its group; (-1, -1) where none does.  All bytes from
    the greatest to the end of the least are then covered, as every window
    holds the anchor.
    """
    ext = Extensions(data)
    sides = []
    for room, most, forward in ((after, width, True), (before, width - gram, False)):
        order = _mergesort(ext, at, room, group, forward)
        common = _neighbours(data, at, room, group, order, most, forward)
        if common is None:
            order = _bytes_order(data, at, room, group, forward)
            common = _neighbours(data, at, room, group, order, most, forward)
        sides.append((order, common))
    (right, right_common), (left, left_common) = sides
    least, greatest = np.full(len(at), -1), np.full(len(at), -1)
    right_run, left_run = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for i in range(width - gram + 1):
        right_run[right] = np.cumsum(right_common < width - i)
        left_run[left] = np.cumsum(left_common < i)
        have = np.flatnonzero((before >= i) & (after >= width - i))
        both = right_run[have] * (len(at) + 1) + left_run[have]
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        twice = np.zeros(len(have), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        found = have[twice]
        least[found[least[found] < 0]] = i
        greatest[found] = i
    return least, greatest


def few(batches: Iterator[pa.RecordBatch], rows: int = BATCH_TEXTS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _contexts(width: int, gram: int):
    """Contexts of the listed anchors of each text: (anchor, key, place, before, single, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("place", pa.int32()), ("before", pa.int32()), ("single", pa.bool_()), ("bytes", pa.binary())])
        for batch in few(batches):
            out = []
            for key, data, n, listed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not listed:
                    continue
                text = pa.decompress(data, n, "zstd", asbytes=True)
                for x in listed:
                    p = x["place"]
                    low = max(0, p - (width - gram))
                    out.append((x["anchor"], key, p, p - low, x["single"], text[low : p + width]))
                if len(out) > BATCH_CONTEXTS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _extents(width: int, gram: int):
    """(key, low, high): what the repeated windows around each single anchor cover."""

    def solve(groups: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(groups).combine_chunks()
        data, bounds = sh.text_bytes(table.column("bytes").combine_chunks())
        group = np.repeat(np.arange(len(groups)), [g.num_rows for g in groups])
        before = np.asarray(table.column("before")).astype(np.int64)
        at = bounds[:-1] + before
        least, greatest = repeated_places(data, at, before, bounds[1:] - at, group, width, gram)
        keep = np.asarray(table.column("single")) & (least >= 0)
        place = np.asarray(table.column("place")).astype(np.int64)[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(table.column("key"))[keep]), pa.array(place - greatest[keep]), pa.array(place - least[keep] + width)], names=["key", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for group in sorted_groups(batches, 1):
            held.append(group)
            n += group.num_rows
            if n >= BATCH_CONTEXTS:
                yield solve(held)
                held, n = [], 0
        if held:
            yield solve(held)

    return run


def _windows(width: int, gram: int):
    """(hash, key, low) of every window through the listed anchors of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            for key, data, n, listed in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not listed:
                    continue
                text = np.frombuffer(pa.decompress(data, n, "zstd"), np.uint8)
                place = np.sort(np.array([x["place"] for x in listed]))
                while len(place):  # anchors that lie near each other
                    near, place = np.split(place, [min(1000, int(np.searchsorted(place, place[0] + CHUNK)))])
                    base = max(0, int(near[0]) - width)
                    part = text[base : int(near[-1]) + width]
                    prefix, down = sh.prefix_hash(part), sh.powers(len(part) + 1)[1]
                    start = np.unique(near[:, None] - np.arange(width - gram + 1)) - base
                    start = start[(start >= 0) & (start + width <= len(part))]
                    hashes = sh.mix((prefix[start + width] - prefix[start]) * down[start])
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(np.full(len(start), key)), pa.array(start + base)], names=["hash", "key", "low"])

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n_removed, n_spans, kept_sha256, kept) of texts and their spans."""
    for batch in few(batches):
        rows = []
        for key, data, n, spans in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            text, cuts = pa.decompress(data, n, "zstd", asbytes=True), merged([(s["low"], s["high"]) for s in spans])
            digest, at = hashlib.sha256(), 0
            for low, high in cuts:
                digest.update(text[at:low])
                at = high
            digest.update(text[at:])
            rows.append((key, sum(b - a for a, b in cuts), len(cuts), digest.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["key", "n_removed", "n_spans", "kept_sha256"])


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        data = [pa.compress(t or b"", "zstd", asbytes=True) for t in batch.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["doc_id", "key", "data"])


def spans_by_text(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, key, n_bytes, sha256), copies per key, and cut texts by key.

    ``key`` is 60 bits of the SHA-256 of a text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    rows = rows.withColumn("key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    light = written(rows.select("doc_id", "key", F.octet_length("text").alias("n_bytes"), digest.alias("sha256")), "repeat-documents")
    copies = written(light.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.first("n_bytes").alias("n_bytes")), "repeat-texts")

    found = rows.select("key", "text").mapInArrow(_anchor_rows(width, gram), "anchor long, context long, key long, place long")
    once = F.xxhash64("key", "place")
    shared = found.groupBy(F.col("anchor").alias("s")).agg(F.min(once).alias("a"), F.max(once).alias("b")).filter("a != b").select("s")
    shared = written(shared, "repeat-anchors")
    joined = written(found.join(shared, F.col("anchor") == F.col("s")).select("anchor", "context", "key", "place"), "repeat-joined")
    # apart from the join, whose hot anchors can so be split; copies of a text combine before the shuffle
    several = written(joined.distinct(), "repeat-shared")

    # contexts that occur twice are repeated as a whole
    kinds = several.groupBy(F.col("anchor").alias("k"), F.col("context").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("at"))
    kinds = written(kinds, "repeat-contexts")
    place, size = F.shiftright("place", 32), F.col("place").bitwiseAND(0xFFFFFFFF)
    full = several.join(kinds.filter("n > 1").select("k", "c"), (F.col("anchor") == F.col("k")) & (F.col("context") == F.col("c"))).select(
        "key", F.greatest(F.lit(0), place - (width - gram)).alias("low"), F.least(size, place + width).alias("high")
    )
    full = full.filter(F.col("high") - F.col("low") >= width)

    # the others are compared with all contexts of their anchor
    groups = kinds.groupBy(F.col("k").alias("g")).agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("fewest")).filter("fewest = 1")
    groups = written(groups, "repeat-groups")  # a table of its own, so that the join can split an anchor with very many contexts
    listed = kinds.join(groups, F.col("k") == F.col("g")).select(
        F.col("at.key").alias("key"),
        F.struct(F.shiftright("at.place", 32).cast("int").alias("place"), F.col("k").alias("anchor"), (F.col("n") == 1).alias("single")).alias("x"),
        (F.col("members") > LARGE_GROUP).alias("large"),
    )
    listed = listed.groupBy(F.col("key").alias("l")).agg(F.collect_list(F.when(~F.col("large"), F.col("x"))).alias("few"), F.collect_list(F.when(F.col("large"), F.col("x"))).alias("many"))
    wanted = several.select(F.col("key").alias("w")).distinct().join(copies, F.col("w") == F.col("key")).select("w", "first_id", "n_bytes", "copies")
    wanted = wanted.join(listed, F.col("w") == F.col("l"), "left").select(F.col("w").alias("k"), "first_id", "n_bytes", "copies", "few", "many")
    data = rows.select("doc_id", "key", "text").mapInArrow(_squeezed, "doc_id long, key long, data binary")
    texts = data.join(wanted, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    # repeated rows of one id and text: the aggregate keeps one
    texts = written(texts.select("key", "data", F.col("n_bytes").cast("long").alias("n_bytes"), "copies", "few", "many").dropDuplicates(["key"]), "repeat-data")

    schema = "anchor long, key long, place int, before int, single boolean, bytes binary"
    contexts = texts.select("key", "data", "n_bytes", "few").mapInArrow(_contexts(width, gram), schema)
    contexts = contexts.repartition("anchor").sortWithinPartitions("anchor")
    extents = contexts.mapInArrow(_extents(width, gram), "key long, low long, high long")
    windows = written(texts.select("key", "data", "n_bytes", "many").mapInArrow(_windows(width, gram), "hash long, key long, low long").distinct(), "repeat-windows")
    start = F.xxhash64("key", "low")
    twice = windows.groupBy(F.col("hash").alias("h")).agg(F.min(start).alias("a"), F.max(start).alias("b")).filter("a != b")
    large = windows.join(twice, F.col("hash") == F.col("h")).select("key", "low", (F.col("low") + width).alias("high"))
    spans = full.union(extents).union(large).groupBy(F.col("key").alias("s")).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    cut = texts.filter(F.col("copies") == 1).select("key", "data", "n_bytes").join(spans, F.col("key") == F.col("s")).select("key", "data", "n_bytes", "spans")
    return light, copies, cut.mapInArrow(_cut, "key long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Null texts are empty.  Texts of fewer than ``width`` bytes lose nothing;
    longer texts that occur more than once go as a whole, also in rows that
    repeat an id.
    """
    light, copies, cut = spans_by_text(docs, width, gram)
    cut = written(cut, "repeat-cut").select(F.col("key").alias("c"), "n_removed", "n_spans", "kept_sha256")
    gone = copies.filter((F.col("copies") > 1) & (F.col("n_bytes") >= width)).select(F.col("key").alias("g"))
    by_text = written(
        gone.select(F.col("g").alias("c"), F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit("").cast("binary"), 256).alias("kept_sha256")).union(cut),
        "repeat-results",
    )
    out = light.join(by_text, F.col("key") == F.col("c"), "left")
    n = F.col("n_bytes").cast("long")
    return out.select(
        "doc_id",
        n.alias("n_bytes"),
        F.when(F.col("c").isNull(), 0).otherwise(F.coalesce("n_removed", n)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
