"""Language identification by multilingual mixture inference.

Every language has a distribution over letter trigrams (hashed), learned from
a bounded sample of labelled rows.  A document is a mixture: each word comes
from one language, with the likelihood of its trigrams, and expectation
maximisation estimates the proportions.  The set of languages is chosen by
penalised likelihood (BIC): among the most frequent one, two, ... languages
the set whose likelihood pays for its number of proportions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.llm import shingles as sh
from propmart.llm.common import pieces
from propmart.llm.tokens import LETTER, LONG, _classes, long_parts

SAMPLE_DOCS = 1500  # labelled rows per language that the trigrams are learned from
BUCKET_BITS = 16
SMOOTHING = 0.5
ROUNDS, SETTLED = 30, 1e-3
UNKNOWN = "und"
LONGEST = 40  # letters of a word whose trigrams count with full weight


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket of every letter, first letter of every word, word bounds of the texts.

    A letter's trigram is its neighbours and itself; what is no letter, or
    lies in another text, counts as one and the same edge.
    """
    text = "".join(texts)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    letter = _classes()[code] == LETTER
    value = np.where(letter, code, 0).astype(np.uint64)
    left, right = np.zeros(len(code), np.uint64), np.zeros(len(code), np.uint64)
    left[1:], right[:-1] = value[:-1], value[1:]
    inner = bounds[(bounds > 0) & (bounds < len(code))]
    left[inner], right[inner - 1] = 0, 0
    at = np.flatnonzero(letter)
    bucket = (sh.mix((left[at] << np.uint64(42)) | (value[at] << np.uint64(21)) | right[at]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(left[at] == 0)
    return bucket, first, np.searchsorted(at[first], bounds)


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages, and the logarithm of each trigram's share in each of them.

    ``labelled`` has text and lang.  Of every language about ``sample_docs``
    rows with the lowest hashes of their text are used, whole; the driver gets
    one row of counts per language, whatever the number of rows.
    """
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.lower(F.col("text").cast("string")).alias("text")).filter("lang is not null and text is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    if not names:
        return [], np.zeros((1 << BUCKET_BITS, 0), np.float32)
    share = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, sample_docs / counts[n])))])[F.col("lang")]
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text"):
            texts = batch.column(1).to_pylist()
            langs = batch.column(0).to_pylist()
            for name in set(langs):
                for part in (p for t, x in zip(texts, langs, strict=True) if x == name for p in long_parts(t)):
                    sums[name] = sums.get(name, 0) + np.bincount(trigrams([part])[0], minlength=1 << BUCKET_BITS)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "counts": pa.array(list(sums.values()), pa.list_(pa.int64()))})

    def add(left: pa.Table) -> pa.Table:
        total = np.stack([np.asarray(x) for x in left.column("counts").combine_chunks().to_numpy(zero_copy_only=False)]).sum(axis=0)
        return pa.table({"lang": [left.column("lang")[0].as_py()], "counts": pa.array([total], pa.list_(pa.int64()))})

    schema = "lang string, counts array<long>"
    summed = {r.lang: np.array(r.counts) for r in sample.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema).collect()}
    table = np.full((1 << BUCKET_BITS, len(names)), SMOOTHING)
    for i, name in enumerate(names):
        table[:, i] += summed.get(name, 0)
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def _mixture(like: np.ndarray, doc: np.ndarray, n_docs: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood per document by expectation maximisation.

    ``like`` holds per word the likelihoods relative to its best language,
    ``doc`` the sorted document numbers, ``allowed`` the languages of each.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.zeros(n_docs)
    active = np.ones(n_docs, bool)
    rows, owner = like, doc
    for _ in range(ROUNDS):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        part = rows * share[owner].astype(np.float32)
        sums = part.sum(axis=1)
        part /= sums[:, None]
        some = owner[first]
        new = np.add.reduceat(part, first, axis=0, dtype=np.float64) / np.diff(np.append(first, len(owner)))[:, None]
        total[some] = np.add.reduceat(np.log(sums, dtype=np.float64), first)
        moved = np.abs(new - share[some]).max(axis=1)
        share[some] = new
        active[:] = False
        active[some[moved > SETTLED]] = True
        keep = active[owner]
        if not keep.any():
            break
        rows, owner = rows[keep], owner[keep]
    return share, total


def _word_logs(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of every word in every language, and words per text; long texts in parts."""
    owner, parts = [], []
    for i, text in enumerate(texts):
        for part in long_parts(text):
            owner.append(i)
            parts.append(part)
    logs, n_words, at = [np.zeros((0, table.shape[1]), np.float32)], np.zeros(len(texts), np.int64), 0
    while at < len(parts):
        stop, size = at, 0
        while stop < len(parts) and (stop == at or size + len(parts[stop]) <= LONG):
            size += len(parts[stop])
            stop += 1
        bucket, first, bounds = trigrams(parts[at:stop])
        if len(first):
            log = np.add.reduceat(table[bucket], first, axis=0)
            length = np.diff(np.append(first, len(bucket)))
            log *= np.minimum(1.0, LONGEST / length)[:, None].astype(np.float32)  # a run of letters without end is one word among others
            logs.append(log)
        np.add.at(n_words, owner[at:stop], np.diff(bounds))
        at = stop
    return np.concatenate(logs), n_words


def infer(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best language (-1: no letter), its proportion, and all proportions and chosen sets."""
    n, k = len(texts), table.shape[1]
    log, n_words = _word_logs(texts, table)
    best, score = np.full(n, -1), np.zeros(n)
    shares, chosen = np.zeros((n, k)), np.zeros((n, k), bool)
    have = np.flatnonzero(n_words)
    if not len(have) or not k:
        return best, score, shares, chosen
    top = log.max(axis=1)
    like = np.exp(log - top[:, None]) + np.float32(1e-30)
    doc = np.repeat(np.arange(len(have)), n_words[have])
    words = n_words[have]
    share, full = _mixture(like, doc, len(have), np.ones((len(have), k)))
    order = np.argsort(-share, axis=1, kind="stable")
    start = np.flatnonzero(np.diff(doc, prepend=-1))
    single = np.add.reduceat(np.log(like[np.arange(len(doc)), order[doc, 0]], dtype=np.float64), start)
    rank = np.argsort(order, axis=1)
    final, size, cost = np.zeros((len(have), k)), np.ones(len(have), int), -2 * single
    final[np.arange(len(have)), order[:, 0]] = 1
    # a larger set costs at least log(words) more and gains at most what all languages gain
    open_ = np.flatnonzero(2 * (full - single) > np.log(words))
    for m in range(2, k + 1):
        if not len(open_):
            break
        keep = np.isin(doc, open_)
        number = np.searchsorted(open_, doc[keep])
        mixed, total = _mixture(like[keep], number, len(open_), (rank[open_] < m).astype(float))
        bic = -2 * total + (m - 1) * np.log(words[open_])
        better = bic < cost[open_]
        final[open_[better]], size[open_[better]], cost[open_[better]] = mixed[better], m, bic[better]
        open_ = open_[2 * (full[open_] - total) > np.log(words[open_])]
    best[have], shares[have] = final.argmax(axis=1), final
    score[have] = final.max(axis=1)
    chosen[have] = rank < size[:, None]
    return best, score, shares, chosen


def identify(docs: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """Per row: all columns of ``docs``, lang_pred, score and languages (of the chosen set).

    ``score`` is the proportion of the predicted language among the words.
    Null texts and texts without a letter, and every text where nothing was
    learned, are ``und`` with score 0.
    """
    model = docs.sparkSession.sparkContext.broadcast((names, table))
    n_columns = len(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(n_columns)])
    plain = plain.withColumn("__text", F.lower(F.col(f"c{docs.columns.index('text')}").cast("string")))
    schema = plain.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("languages", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        for batch in pieces(batches, "__text"):
            best, score, shares, chosen = infer([t or "" for t in batch.column(n_columns).to_pylist()], table)
            sets = [",".join(f"{names[i]}:{s[i]:.3f}" for i in np.argsort(-s, kind="stable") if c[i]) for s, c in zip(shares, chosen, strict=True)]
            pred = [names[i] if i >= 0 else UNKNOWN for i in best]
            arrays = [*batch.columns[:n_columns], pa.array(pred, pa.string()), pa.array(score), pa.array(sets, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return plain.mapInArrow(run, schema).toDF(*docs.columns, "lang_pred", "score", "languages")


def predict_all(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Learn from the rows that are not held out, then predict every row.

    Returns doc_id, held_out, lang_pred, score, languages.
    """
    names, table = learn(docs.filter(~held_out(F.col("doc_id"))), sample_docs)
    out = identify(docs.select("doc_id", "text"), names, table)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def keep_identified(docs: DataFrame, least: float = 0.4, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Rows in which one learned language has at least ``least`` of the words, all columns kept."""
    names, table = learn(docs.filter(~held_out(F.col("doc_id"))), sample_docs)
    if not names:
        return docs
    out = identify(docs, names, table)
    own = [f"c{i}" for i in range(len(docs.columns))]
    kept = out.toDF(*own, "pred", "score", "languages").filter((F.col("pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*own).toDF(*docs.columns)
