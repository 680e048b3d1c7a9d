"""N-gram Jaccard join with MinHash banding and exact verification.

Every document gets a MinHash signature, cut into bands ("trees") of a fixed
depth.  An LSH forest would keep them as sorted prefix tries and shorten the
matched prefixes by what it finds; here fixed-length banding replaces that:
one prefix length follows from the threshold and the target recall alone, and
documents are candidates when they share a prefix of that length in any tree.
Documents with the same sequence of words
are one class, compared once.  Candidates are then verified exactly:

- candidate edges join classes of a bucket whose one-bit signatures agree (in
  buckets of many classes: all with the least one), and their connected
  components hold every candidate pair;
- the classes of a component are dealt into blocks of bounded size, and every
  pair of blocks is one group of a shuffle, compared inside a task.  No row is
  made per pair: a group returns a number of links per class and at most one
  edge per class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm import shingles as sh
from propmart.llm.common import connected_components, pieces, sorted_groups, written

TREES, DEPTH = 16, 5
PAIRED = 32  # buckets of up to this many classes compare one-bit signatures
BITS_AGREE = 0.7  # share of one-bit signatures; a pair at 0.8 has 0.9 +- 0.034
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 20  # mean size of a block
COLUMNS = 8192  # shingles multiplied at once


def prefix_length(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that still finds a pair at ``threshold`` with ``recall``."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def text_hash() -> Column:
    """Tells rows of one id apart, together with a null id from any other."""
    return F.xxhash64(F.col("text").cast("string"), F.col("doc_id").isNull())


def prepare(docs: DataFrame, length: int, size: int = 5, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """Per row: doc_id, text_hash, key (its sequence of words), n_shingles, bits, buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(1) << np.arange(64, dtype=np.uint64)
        for batch in pieces(batches, "text"):
            data, texts = sh.text_bytes(batch.column(2))
            hashes, start, end, bounds = sh.words(data, texts)
            keys = sh.sequence_key(data, start, end, bounds)
            grams, g_bounds = sh.shingles(hashes, bounds, size)
            sig = sh.signatures(grams, g_bounds, trees * depth)
            odd = (sh.mix(sig.astype(np.uint64)) & np.uint64(1)).astype(bool)
            padded = np.zeros((len(sig), -(-trees * depth // 64) * 64), bool)
            padded[:, : trees * depth] = odd
            bits = (padded.reshape(len(sig), -1, 64) * mask).sum(axis=2, dtype=np.uint64)
            trie = sig.reshape(len(sig), trees, depth)[:, :, :length].astype(np.uint64)
            bucket = np.broadcast_to(np.arange(trees, dtype=np.uint64), trie.shape[:2]).copy()
            for i in range(length):
                bucket = sh.mix(bucket * sh.BASE + trie[:, :, i])
            n = np.diff(g_bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(keys, pa.string()),
                    pa.array(n),
                    pa.FixedSizeListArray.from_arrays(bits.reshape(-1).view(np.int64), bits.shape[1]).cast(pa.list_(pa.int64())),
                    pa.FixedSizeListArray.from_arrays(bucket.reshape(-1).view(np.int64), trees).cast(pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "key", "n_shingles", "bits", "buckets"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("text_hash"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, key string, n_shingles long, bits array<long>, buckets array<long>")


def _close_pairs(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, bits, keys = np.zeros(0, np.int64), None, np.zeros(0, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.asarray(batch.column(2).flatten()).view(np.uint64).reshape(batch.num_rows, -1)
            tail = bucket == bucket[-1] if len(bucket) else np.zeros(0, bool)  # a bucket may pass the batch's end
            bits = new if bits is None else np.concatenate([bits[tail], new])
            bucket = np.concatenate([bucket[tail], np.asarray(batch.column(0))])
            keys = np.concatenate([keys[tail], np.array(batch.column(1).to_pylist(), object)])
            left, right = [], []
            at, step = np.arange(len(bucket)), 1
            while len(at := at[at + step < len(bucket)]) and len(at := at[bucket[at] == bucket[at + step]]):
                differ = np.bitwise_count(bits[at] ^ bits[at + step]).sum(axis=1)
                near = at[differ <= (1 - BITS_AGREE) * n_bits]
                left.append(near)
                right.append(near + step)
                step += 1
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(keys[np.concatenate(x)], pa.string()) for x in (left, right)], names=["a", "b"])

    return run


def candidate_edges(classes: DataFrame, n_bits: int) -> DataFrame:
    """Edges (a, b) whose components hold all classes that share a bucket."""
    rows = classes.filter("n_shingles > 0").select(F.explode("buckets").alias("bucket"), "key", "bits")
    shared = rows.groupBy(F.col("bucket").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least")).filter("n > 1")
    shared = written(shared, "forest-buckets")
    joined = rows.join(shared, F.col("bucket") == F.col("k"))
    few = joined.filter(F.col("n") <= PAIRED).select("bucket", "key", "bits").repartition("bucket").sortWithinPartitions("bucket", "key")
    many = joined.filter((F.col("n") > PAIRED) & (F.col("key") != F.col("least"))).select(F.col("key").alias("a"), F.col("least").alias("b"))
    return few.mapInArrow(_close_pairs(n_bits), "a string, b string").union(many)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, texts = sh.text_bytes(batch.column(0))
            hashes, start, end, bounds = sh.words(data, texts)
            keys = sh.sequence_key(data, start, end, bounds)
            grams, g_bounds = sh.shingles(hashes, bounds, size)
            right = [i for i, (a, b) in enumerate(zip(keys, batch.column(1).to_pylist(), strict=True)) if a == b]
            sets = [np.unique(grams[g_bounds[i] : g_bounds[i + 1]]).tobytes() for i in right]
            kept = batch.take(pa.array(right, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns[1:], pa.array(sets, pa.binary())], names=["key", "component", "blocks", "block", "grams"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, by products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    distinct, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    for low in range(0, int(common.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    out[np.diag_indices(len(sets))] = [len(s) for s in sets]
    return out


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, other, links = [], [], []
        for group in sorted_groups(batches, 3):
            found = {k: (b, np.frombuffer(g, np.uint64)) for k, b, g in zip(*(group.column(i).to_pylist() for i in (3, 4, 5)), strict=True)}
            names = list(found)  # repeated rows of one id and text come once
            if len(names) < 2:
                continue
            block, sets = np.array([b for b, _ in found.values()]), [s for _, s in found.values()]
            both = intersections(sets)
            n = np.diag(both)
            near = both / (n[:, None] + n[None, :] - both) >= threshold
            near[np.diag_indices(len(names))] = False
            low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            if low != high:
                near &= block[:, None] != block[None, :]
            count = near.sum(axis=1)
            root = np.arange(len(names))  # the least number that a class reaches within the group
            while True:
                reach = np.where(near, root[None, :], len(names)).min(axis=1)
                new = np.minimum(root, reach)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            for i in np.flatnonzero(count):
                keys.append(names[i])
                other.append(names[root[i]])
                links.append(int(count[i]))
            if len(keys) > 20_000:
                yield pa.RecordBatch.from_pydict({"a": keys, "b": other, "links": pa.array(links, pa.int64())})
                keys, other, links = [], [], []
        if keys:
            yield pa.RecordBatch.from_pydict({"a": keys, "b": other, "links": pa.array(links, pa.int64())})

    return run


def _joined(docs: DataFrame, threshold: float, size: int, recall: float) -> DataFrame:
    """Per row: doc_id, text_hash, group (a name of its connected documents), class_id, n_links, copies."""
    length = prefix_length(threshold, recall)
    ready = written(prepare(docs, length, size), "forest-documents")
    classes = written(
        ready.groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), F.first("buckets").alias("buckets")
        ),
        "forest-classes",
    )
    components = written(connected_components(candidate_edges(classes, TREES * DEPTH), "forest-candidates"), "forest-components")
    members = components.join(classes.select("key", "least_id", "n_shingles"), F.col("node") == F.col("key"))
    members = written(members.select("key", "least_id", "n_shingles", "component"), "forest-members")
    sizes = members.groupBy(F.col("component").alias("c")).agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_CLASSES, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    members = members.join(sizes, F.col("component") == F.col("c")).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    members = members.select("least_id", "key", "component", "blocks", "block")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(members, F.col("doc_id").eqNullSafe(F.col("least_id"))).select("text", "key", "component", "blocks", "block")
    sets = found.mapInArrow(_sets(size), "key string, component string, blocks int, block int, grams binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = sets.select("key", "component", "block", "grams", other).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "key", "block", "grams"
    )
    dealt = dealt.repartition("component", "low", "high").sortWithinPartitions("component", "low", "high")
    links = written(dealt.mapInArrow(_compare(threshold), "a string, b string, links long"), "forest-links")
    counts = links.groupBy("a").agg(F.sum("links").alias("n_links"))
    groups = connected_components(links, "forest-groups")
    info = classes.select("key", "least_id", "copies").join(groups, F.col("key") == F.col("node"), "left").join(counts, F.col("key") == F.col("a"), "left")
    info = info.withColumn("group", F.coalesce("component", "key"))
    first = info.filter(F.col("component").isNotNull()).groupBy(F.col("component").alias("g")).agg(F.min("least_id").alias("group_id"))
    info = info.join(first, F.col("group") == F.col("g"), "left").select(
        F.col("key").alias("k"), "group", F.coalesce("group_id", "least_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"
    )
    info = written(info, "forest-info")
    return ready.select("doc_id", "text_hash", "key").join(info, F.col("key") == F.col("k")).drop("key", "k")


def jaccard_join(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.999) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copies.

    ``class_id`` is the least doc_id of all documents that are connected by
    links, ``n_links`` the number of other word sequences whose shingles have
    a Jaccard similarity of at least ``threshold`` with the document's,
    ``copies`` the number of documents with its own sequence of words.
    Texts without words (null, empty, blank) are copies of each other without
    links.  Rows that repeat an id are rows of their own; a null id is never
    the least of a class that has others.
    """
    return _joined(docs, threshold, size, recall).select("doc_id", "class_id", "n_links", "copies")


def one_per_group(docs: DataFrame, threshold: float = 0.8, size: int = 5, recall: float = 0.999) -> DataFrame:
    """One row of ``docs``, with all its columns, per group of connected documents.

    The row with the least doc_id stays (a null id only where there is no
    other); of several texts or rows with that id, one.
    """
    found = _joined(docs, threshold, size, recall)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("group").agg(first).select(F.coalesce("first.doc_id", F.lit(0)).alias("__kept_id"), F.col("first.text_hash").alias("__kept_hash"))
    kept = written(kept, "forest-kept")
    rows = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).withColumn("__hash", text_hash())
    rows = rows.join(kept, (F.col("__id") == F.col("__kept_id")) & (F.col("__hash") == F.col("__kept_hash")), "left_semi")
    # the window has the keys of the join, so it shuffles nothing more
    number = F.row_number().over(Window.partitionBy("__id", "__hash").orderBy(F.lit(0)))
    return rows.withColumn("__number", number).filter("__number = 1").drop("__id", "__hash", "__number")
