"""Ranked lexical search of many items at once, with shared partial sums.

The items of a block are factored together: their terms are ordered by the
number of items that hold them, and neighbouring sums that at least two items
need become nodes, round by round, until no two items share one.  The nodes
form a DAG: each document's partial sum of a node is made once, from the two
sums below it, and every item adds up the few nodes and terms that are left to
it.  Documents are scored where they lie; a task passes on its own best rows
per item only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propmart.llm.common import pieces, written

BLOCK_BYTES = 4 << 20  # item text that is searched in one pass over the documents
PART_BYTES = 4 << 20  # of one text that are cut into terms at once
CELLS = 4 << 20  # partial sums that a task holds at once
SALTS = 1024  # groups in which the best rows of tasks are thinned out first

_LETTERS = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_FOLD = bytes(b if b in _LETTERS else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, in runs of bounded size.

    A term is a maximal run of ASCII letters, digits and characters beyond
    ASCII; only A to Z are lower-cased.
    """
    folded = data.translate(_FOLD)
    start = 0
    while len(folded) - start > PART_BYTES:
        cut = folded.find(b" ", start + PART_BYTES)
        if cut < 0:
            break
        yield folded[start:cut].split()
        start = cut
    yield folded[start:].split()


def share(sequences: Sequence[Sequence[int]], first: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Factor sums: the nodes (pairs of smaller symbols) and what is left of each sequence.

    Symbols are distinct within a sequence; node ``i`` has the number ``first
    + i``.  In every round a pair of neighbours is replaced wherever it is
    more common than the pairs that it overlaps, if two sequences at least
    agree on that.
    """
    nodes: list[tuple[int, int]] = []
    left = [list(s) for s in sequences]
    while True:
        found = Counter(p for s in left for p in zip(s[:-1], s[1:], strict=True))
        rank = {p: (-c, p) for p, c in found.items() if c > 1}
        if not rank:
            return nodes, left
        none = (0, (0, 0))
        picked = []
        for s in left:
            ranks = [none, *(rank.get(p, none) for p in zip(s[:-1], s[1:], strict=True)), none]
            picked.append([i - 1 for i in range(1, len(ranks) - 1) if ranks[i] < ranks[i - 1] and ranks[i] < ranks[i + 1]])
        uses = Counter((s[i], s[i + 1]) for s, at in zip(left, picked, strict=True) for i in at)
        number = {p: first + len(nodes) + i for i, p in enumerate(sorted(p for p, c in uses.items() if c > 1))}
        nodes += sorted(number)
        for k, (s, at) in enumerate(zip(left, picked, strict=True)):
            out, done = [], 0
            for i in at:
                if (s[i], s[i + 1]) in number:
                    out += [*s[done:i], number[s[i], s[i + 1]]]
                    done = i + 2
            left[k] = out + s[done:]


@dataclass
class Plan:
    """The items of a block as sums of shared nodes."""

    vocabulary: dict[bytes, int]
    leaf_term: np.ndarray  # term of every leaf
    leaf_times: np.ndarray  # times it stands in the items that use it
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # nodes and the two symbols below each
    items: list[np.ndarray]  # symbols that make up an item
    n_symbols: int

    @classmethod
    def of(cls, texts: Sequence[bytes]) -> Plan:
        bags = [Counter(t for run in terms(text) for t in run) for text in texts]
        holders = Counter(leaf for bag in bags for leaf in bag.items())
        # leaves that the same items hold come side by side
        used_by: dict[tuple[bytes, int], list[int]] = {}
        for i, bag in enumerate(bags):
            for leaf in bag.items():
                used_by.setdefault(leaf, []).append(i)
        order = sorted(holders, key=lambda leaf: (-holders[leaf], used_by[leaf], leaf))
        number = {leaf: i for i, leaf in enumerate(order)}
        vocabulary = {t: i for i, t in enumerate(sorted({t for t, _ in order}))}
        nodes, left = share([sorted(number[leaf] for leaf in bag.items()) for bag in bags], len(order))
        depth = [0] * len(order)
        by_depth: dict[int, list[int]] = {}
        for i, (a, b) in enumerate(nodes):
            depth.append(1 + max(depth[a], depth[b]))
            by_depth.setdefault(depth[-1], []).append(i)
        levels = []
        for d in sorted(by_depth):
            at = by_depth[d]
            below = np.array([nodes[i] for i in at], np.int64)
            levels.append((np.array(at, np.int64) + len(order), below[:, 0], below[:, 1]))
        leaf_term = np.array([vocabulary[t] for t, _ in order], np.int64)
        leaf_times = np.array([c for _, c in order], np.int64)
        return cls(vocabulary, leaf_term, leaf_times, levels, [np.array(s, np.int64) for s in left], len(order) + len(nodes))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (items x documents) from the values of terms in documents."""
        leaves = np.argsort(self.leaf_term, kind="stable")
        first = np.searchsorted(self.leaf_term[leaves], np.arange(len(self.vocabulary) + 1))
        count = first[term + 1] - first[term]
        at = np.repeat(first[term] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        leaf = leaves[at]
        sums = np.zeros((self.n_symbols, n_docs), np.int64)
        sums[leaf, np.repeat(doc, count)] = np.repeat(value, count) * self.leaf_times[leaf]
        for node, a, b in self.levels:
            sums[node] = sums[a] + sums[b]
        return np.array([sums[s].sum(axis=0) for s in self.items], np.int64).reshape(len(self.items), n_docs)


COUNTS = "doc_id long, n long, terms array<int>, tf array<int>"


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document doc_id, its number n of terms, and the counts of those in ``vocabulary``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary))
        for batch in pieces(batches, "text"):
            n, hits = np.zeros(batch.num_rows, np.int64), []
            for i, data in enumerate(batch.column(1).to_pylist()):
                for part in terms(data or b""):
                    n[i] += len(part)
                    found, times = np.unique(np.array([vocabulary[t] for t in part if t in vocabulary], np.int64), return_counts=True)
                    hits.append((found + i * size, times))
            place = np.concatenate([h[0] for h in hits])
            place, where = np.unique(place, return_inverse=True)
            times = np.bincount(where, np.concatenate([h[1] for h in hits]), len(place)).astype(np.int32)
            ends = pa.array(np.searchsorted(place, np.arange(batch.num_rows + 1) * size).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(c)) for c in ((place % size).astype(np.int32), times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, COUNTS)


def _best(item: np.ndarray, doc: np.ndarray, absent: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of every item: score descending, then id ascending, null ids last."""
    order = np.lexsort((doc, absent, -score, item))
    item = item[order]
    return order[np.arange(len(item)) - np.searchsorted(item, item) < k]


def task_best(counts: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best rows of every task: item (its place in the plan), doc_id, score and the task's number."""

    def scored(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        ids = batch.column(0)
        absent, doc_id = np.asarray(ids.is_null(), bool), np.asarray(ids.fill_null(0), np.int64)
        n = np.asarray(batch.column(1), np.int64)
        lists = [batch.column(i) for i in (2, 3)]
        term, tf = (np.asarray(c.flatten(), np.int64) for c in lists)
        doc = np.repeat(np.arange(len(n)), np.asarray(lists[0].value_lengths(), np.int64))
        m = 100 - 25 + (25 * n * n_docs) // n_terms
        value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        table = plan.scores(doc, term, value, len(n))
        if len(n) > k:  # what lies below an item's k best scores here is out
            least = np.partition(table, len(n) - k, axis=1)[:, len(n) - k]
            item, place = np.nonzero((table >= least[:, None]) & (table > 0))
        else:
            item, place = np.nonzero(table > 0)
        return item, doc_id[place], absent[place], table[item, place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, CELLS // max(1, plan.n_symbols))
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                found = scored(batch.slice(at, step))
                if held is not None:
                    found = tuple(np.concatenate(x) for x in zip(held, found, strict=True))
                keep = _best(*found, k)
                held = tuple(x[keep] for x in found)
        if held is not None:
            item, doc_id, absent, score = held
            task = np.full(len(item), TaskContext.get().partitionId(), np.int32)
            columns = [pa.array(item.astype(np.int32)), pa.array(doc_id, mask=absent), pa.array(score), pa.array(task)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score", "task"])

    return counts.mapInArrow(run, "item int, doc_id long, score long, task int")


def _ranked(rows: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents of the highest score for each item: item_id, rank, doc_id, score.

    Every row of ``docs`` and of ``items`` stands for itself; a null text has
    no terms, a null doc_id comes last among equal scores, and a null item_id
    is an id of its own.  Items without terms and documents without a score
    above 0 give no row; with no document at all there is no row.  Very long
    texts are cut into terms in parts.  Other columns are not read.

    Equal item texts are searched once.  The items go through the documents in
    blocks of about ``block_bytes`` of text (dealt by their SHA-256), one
    pass over the documents per block; a block is what the driver holds and
    sends to the tasks.  Tasks return ``k`` rows per item, which are thinned
    out in two rounds.
    """
    asked = items.select("item_id", F.sha2(F.col("text").cast("string").cast("binary"), 256).alias("__key"), F.col("text").cast("string").cast("binary").alias("text")).where("text IS NOT NULL")
    texts = written(asked.groupBy("__key").agg(F.first("text").alias("text")), "ranked-items")
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-n_bytes // block_bytes))
    block = F.pmod(F.conv(F.substring("__key", 1, 12), 16, 10).cast("long"), F.lit(n_blocks))
    best = None
    for number in range(n_blocks):
        rows = sorted((r["__key"], bytes(r["text"])) for r in texts.where(block == number).collect())
        plan = Plan.of([text for _, text in rows])
        counts = written(term_counts(docs, plan.vocabulary), "ranked-counts")
        n_docs, n_terms = counts.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(plan.vocabulary), np.int64)
        for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term of the block
            df[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        found = task_best(counts.where(F.size("terms") > 0), plan, weights, n_docs, n_terms or 1, k)
        found = _ranked(found.withColumn("salt", F.pmod(F.col("task"), F.lit(SALTS))), ["item", "salt"], k).drop("rank", "salt", "task")
        keys = docs.sparkSession.createDataFrame([(i, key) for i, (key, _) in enumerate(rows)], "item int, __key string")
        top = written(_ranked(found, ["item"], k).join(F.broadcast(keys), "item").select("__key", "rank", "doc_id", "score"), "ranked-best")
        best = top if best is None else best.union(top)
    return asked.select("item_id", "__key").join(best, "__key").select("item_id", "rank", "doc_id", "score")
