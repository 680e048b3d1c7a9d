"""Alignment of two tokenizers over documents, with corpus-wide pair counts.

Texts are cut where neither tokenizer can join what stands on both sides.
Such a piece is encoded and aligned once by a worker and then found by its own
characters.  Counts go three ways: the distinct pairs of ids get a minimal
perfect hash, in shards; every shard's counts are dense vectors indexed by that
hash, summed as a tree; and a second pass aligns the documents again and looks
the counts up, each key verified against the one that is stored at its place.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propmart.llm.common import OwnFile, open_input, pieces, scratch, sorted_groups, written
from propmart.llm.shingles import mix
from propmart.llm.tokens import _CUT

LONG = 1 << 21  # characters of one text that are aligned at once
MOST_PIECES = 400_000  # distinct pieces that a worker knows at most; then it keeps the common ones
LONGEST = 200  # characters of a piece that is kept
SHARD_KEYS = 1 << 17  # pairs of ids per shard, in the mean
GROUP_ROWS = 1 << 20  # partial counts that one dense vector takes in
ARITY = 16  # vectors that are summed at once
SPREAD = 1.6  # bits per key on every level of the hash
OPEN_SHARDS = 24  # shards that a worker keeps open

# before a blank that follows other text: both tokenizers start a token there
_BLANK = re.compile("(?<=[^\\s\x1c-\x1f\x85\u180e\u200b\ufeff\u2581]) ")
# a blank at the start or after white space, which is no place to cut, or what may look like that
_UNEVEN = "^ |[\\x09-\\x0d\\x1c-\\x20\\x85\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}\\x{2581}] "


def byte_of_char() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others, in order, are
    the characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


# fixed value: the split pattern of byte-level pre-tokenization
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked_encoder(made: dict, token_bytes: list[bytes]):
    """A faster encoder of a byte-level tokenizer whose ids are the order of its merges; None for any other."""
    merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"].get("merges", [])]
    vocabulary = made["model"].get("vocab", {})
    if len(set(token_bytes[:256])) != 256 or any(len(t) != 1 for t in token_bytes[:256]) or any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    import tiktoken

    ranks = {t: i for i, t in enumerate(token_bytes[: 256 + len(merges)])}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """The pieces that a worker knows: their alignment, uses, and sums over the counts of their links."""

    def __init__(self):
        self.number: dict = {}
        self.units: list = []
        self.text: list[str] = []  # of their groups
        self.sizes = np.zeros((0, 3), np.int64)  # tokens of A, tokens of B, groups; no groups: the bytes differ
        self.first = np.zeros(1, np.int64)  # of their links
        self.keys = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)  # lookups, for what is worth keeping
        self.seen = np.zeros(0, np.int64)  # occurrences in texts that count, since the last flush
        self.sums = np.zeros((0, 3), np.int64)  # over links: best ones, counts, links that have a count
        self.counted = ""  # the counts that the sums are of

    def add(self, units: list, sizes: np.ndarray, said: list[str], first: np.ndarray, keys: np.ndarray) -> None:
        for u in units:
            self.number[u] = len(self.number)
        self.units += units
        self.text += said
        self.sizes = np.concatenate([self.sizes, sizes])
        self.first = np.concatenate([self.first, self.first[-1] + first[1:]])
        self.keys = np.concatenate([self.keys, keys])
        self.uses, self.seen = (np.concatenate([x, np.zeros(len(units), np.int64)]) for x in (self.uses, self.seen))

    def full(self) -> bool:
        return len(self.text) > MOST_PIECES or len(self.keys) > 8 * MOST_PIECES

    def thin_out(self) -> None:
        """Keep the pieces used most, and several times; occurrences must have been flushed."""
        least = max(2, int(np.partition(self.uses, -MOST_PIECES // 2)[-MOST_PIECES // 2]) + 1 if len(self.uses) > MOST_PIECES // 2 else 2)
        keep = np.flatnonzero((self.uses >= least) & (np.diff(self.first) <= LONGEST))
        size = np.diff(self.first)[keep]
        ends = np.concatenate([[0], np.cumsum(size)])
        self.keys = self.keys[np.repeat(self.first[keep] - ends[:-1], size) + np.arange(ends[-1])]
        self.first, self.sizes, self.seen = ends, self.sizes[keep], np.zeros(len(keep), np.int64)
        self.uses = self.uses[keep] // 2  # what has not come for long gives way
        self.sums = self.sums[keep] if len(self.sums) > keep[-1:].max(initial=-1) else np.zeros((0, 3), np.int64)
        at = keep.tolist()
        self.units, self.text = [self.units[i] for i in at], [self.text[i] for i in at]
        self.number = {u: i for i, u in enumerate(self.units)}


class Aligner:
    """Aligns texts by a byte-level BPE (A) and a piece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        byte = byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(byte.__getitem__, token))
        made = json.loads(self.a.to_str())
        splits = made.get("pre_tokenizer") or {}
        if splits.get("type") != "ByteLevel" or not splits.get("use_regex", True) or splits.get("add_prefix_space") or made.get("normalizer"):
            raise ValueError("only byte-level tokenizers without normalizer or added space are supported")
        self.ranked = ranked_encoder(made, self.a_bytes)
        model = proto.ModelProto()
        with open(b_path, "rb") as file:
            model.ParseFromString(file.read())
        if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
            raise ValueError("only piece models that add a space and change nothing else are supported")
        model.normalizer_spec.add_dummy_prefix = False  # the space is given with the text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        names = [p.piece for p in model.pieces]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("only piece models whose pieces do not pass a space are supported")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.b_joins = {p[i : i + 2] for p in names for i in range(len(p) - 1)}
        self.n_b = len(names)
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.written = [np.array([f"{i}{end}" for i in range(len(t))], object) for t, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends]
        self.known = Pieces()

    def segments(self, text: str) -> Iterator[str]:
        """A text in parts between which both tokenizers cut; the blank between two parts is left out."""
        start = 0
        while len(text) - start > LONG:
            found = _BLANK.search(text, start + LONG)
            if not found:
                break
            yield text[start : found.start()]
            start = found.end()
        yield text[start:]

    def cut(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """The distinct pieces of some segments, the pieces in their order, and their number per segment.

        A string stands for itself after a blank, a tuple for the string in it.
        """
        found = pc.split_pattern(texts, " ")
        if pc.any(pc.match_substring_regex(texts, _UNEVEN)).as_py() or pc.max(pc.binary_length(found.flatten())).as_py() > LONG // 16:
            out, counts = [], []
            for text in texts.to_pylist():
                units = _BLANK.split(text)
                if max(map(len, units)) > LONG // 16:
                    units = [u for p in units for u in (self._finer(" " + p) if len(p) > LONG // 16 else [p])]
                out += units
                counts.append(len(units))
            number = {u: i for i, u in enumerate(dict.fromkeys(out))}
            return list(number), np.array([number[u] for u in out], np.int64), np.array(counts, np.int64)
        coded = found.flatten().dictionary_encode()
        return coded.dictionary.to_pylist(), np.asarray(coded.indices, np.int64), np.asarray(found.value_lengths(), np.int64)

    def _finer(self, text: str) -> Iterator[tuple[str]]:
        """A piece without blanks, cut where A ends a run and no piece of B passes on."""
        start = 0
        for m in _CUT.finditer(text):
            at = m.start()
            if at - start >= 64 and text[at - 1 : at + 1].replace(" ", "▁") not in self.b_joins:
                yield (text[start:at],)
                start = at
        yield (text[start:],)

    def align(self, units: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Sizes, texts of groups, and links (first place per unit, keys) of strings in a row.

        The strings must be such that the tokens of all in a row are those of each.
        """
        raw = [u.encode() for u in units]
        text = "".join(units)
        a = self.ranked.encode_ordinary(text) if self.ranked else self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        a = np.array(a, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        data = b"".join(raw)
        fits = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == data and b"".join(map(self.b_bytes.__getitem__, b.tolist())) == data
        if not fits:
            if len(units) > 1:
                return self._joined([self.align([u]) for u in units])
            return np.zeros((1, 3), np.int64), [""], np.zeros(2, np.int64), np.zeros(0, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([len(x) for x in raw])
        shared, a_at, b_at = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
        a_first, b_first, first = (np.concatenate([[0], np.searchsorted(x, ends, side="right")]) for x in (a_end, b_end, shared))
        # tokens in the order of groups, those of A first
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[a_at], b_last[b_at] = True, True
        words = np.concatenate([np.where(a_last, self.written[1][a], self.written[0][a]), np.where(b_last, self.written[3][b], self.written[2][b])])
        group = np.concatenate([np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)])
        words = words[np.argsort(group, kind="stable")].tolist()
        place = (a_first + b_first).tolist()
        said = ["".join(words[x:y])[:-1] for x, y in zip(place[:-1], place[1:], strict=True)]
        sizes = np.stack([np.diff(a_first), np.diff(b_first), np.diff(first)], axis=1)
        return sizes, said, first, a[a_at] * self.n_b + b[b_at]

    @staticmethod
    def _joined(made: list) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        firsts, base = [np.zeros(1, np.int64)], 0
        for m in made:
            firsts.append(m[2][1:] + base)
            base += len(m[3])
        return np.concatenate([m[0] for m in made]), list(chain.from_iterable(m[1] for m in made)), np.concatenate(firsts), np.concatenate([m[3] for m in made])

    def numbers(self, units: list, order: np.ndarray) -> np.ndarray:
        """Numbers of the pieces ``units[i]`` for i in ``order``; new ones are aligned."""
        out = list(map(self.known.number.get, units))
        if None in out:
            run, alone = [], []
            for u in (u for u, at in zip(units, out, strict=True) if at is None):
                if isinstance(u, str) and u and u[-1] > " " and not u[-1].isspace() and "▁" not in u and len(u) < LONGEST:
                    run.append(u)
                else:
                    alone.append(u)
            made = [self.align([" " + u for u in run[i : i + 2000]]) for i in range(0, len(run), 2000)]
            made += [self.align([u[0] if isinstance(u, tuple) else " " + u]) for u in alone]
            self.known.add(run + alone, *self._joined(made))
            out = list(map(self.known.number.__getitem__, units))
        numbers = np.array(out, np.int64)[order]
        self.known.uses += np.bincount(numbers, minlength=len(self.known.uses))
        return numbers

    def fits(self, numbers: np.ndarray) -> np.ndarray:
        return self.known.sizes[numbers, 2] > 0


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner of two files; tasks of a worker share it."""
    return Aligner(a_path, b_path)


def _work(made: Aligner, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows, numbers of their pieces, and the first piece of each row, in runs of bounded size.

    A long text comes in several runs of its own.  Before a run is taken up,
    the worker must not know more pieces than it may.
    """
    rows, held, size = [], [], 0

    def run() -> tuple[list[int], np.ndarray, np.ndarray]:
        units, order, counts = made.cut(pa.array(held, pa.string()))
        return rows, made.numbers(units, order), np.cumsum(counts) - counts

    for row, text in enumerate(texts):
        for segment in made.segments(text) if text else ():
            if len(segment) + size > LONG and rows:
                yield run()
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(segment)
            size += len(segment)
    if rows:
        yield run()


def count_links(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Partial counts of linked id pairs: key, n, and the flush they come from."""

    def flush(known: Pieces, count: int) -> pa.RecordBatch:
        used = np.flatnonzero(known.seen)
        size = np.diff(known.first)[used]
        at = np.repeat(known.first[used] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        keys, where = np.unique(known.keys[at], return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, where, np.repeat(known.seen[used], size))
        known.seen[:] = 0
        origin = np.full(len(keys), (TaskContext.get().partitionId() << 20) + count, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), pa.array(origin)], names=["key", "n", "origin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, flushes = aligner(a_path, b_path), 0
        made.known.seen[:] = 0
        for batch in pieces(batches, "text", LONG):
            texts = [t or "" for t in batch.column(0).to_pylist()]
            bad: set[int] = set()
            if len(texts) == 1 and len(texts[0]) > LONG:  # a misfit in any run takes the whole text away
                for rows, numbers, _ in _work(made, texts):
                    if not made.fits(numbers).all():
                        bad.update(rows)
                    if made.known.full():
                        yield flush(made.known, flushes)
                        made.known.thin_out()
                        flushes += 1
            for rows, numbers, first in _work(made, texts):
                good = np.logical_and.reduceat(made.fits(numbers), first) & ~np.isin(rows, list(bad))
                counts = np.diff(np.append(first, len(numbers)))
                made.known.seen += np.bincount(numbers[np.repeat(good, counts)], minlength=len(made.known.seen))
                if made.known.full():
                    yield flush(made.known, flushes)
                    made.known.thin_out()
                    flushes += 1
        yield flush(made.known, flushes)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "key long, n long, origin long")


# ---------------------------------------------------------------------------
# Minimal perfect hash
# ---------------------------------------------------------------------------


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) * np.uint64(2) + np.uint64(1) + (np.uint64(level) << np.uint64(48))) % np.uint64(size)).astype(np.int64)


def shard_of(keys: np.ndarray, n_shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(n_shards)).astype(np.int64)


class PerfectHash:
    """A place below ``len(keys)`` for each of some distinct keys, no two alike.

    Levels of bits: a key that is alone at its place of a level sets that bit,
    the others go on to the next level.  The set bits before a key's own give
    its number.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # 0/1 per place
        self.before, n = [], 0
        for bits in levels:
            self.before.append(n + np.cumsum(bits, dtype=np.int64) - bits)
            n += int(bits.sum())
        self.n = n

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        left = keys
        while len(left):
            size = max(8, int(SPREAD * len(left)))
            at = _place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys; of an unknown key any place, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            at = _place(keys[left], level, len(bits))
            hit = bits[at] > 0
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        return b"".join([np.array([len(self.levels), *map(len, self.levels)], "<i8").tobytes(), *(np.packbits(b).tobytes() for b in self.levels)])

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        sizes = np.frombuffer(data, "<i8", n, 8).tolist()
        levels, at = [], 8 * (n + 1)
        for size in sizes:
            step = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, step, at), count=size))
            at += step
        return cls(levels)


SHARD = "shard long, hash binary, keys binary"


def perfect_hashes(keys: DataFrame) -> DataFrame:
    """A row per shard of distinct keys: its hash, and its keys in the order of their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, 1):
            found = np.asarray(group.column(1), np.int64)
            made = PerfectHash.of(found)
            placed = np.empty(len(found), np.int64)
            placed[made.find(found)] = found
            yield pa.RecordBatch.from_pydict({"shard": [group.column(0)[0].as_py()], "hash": [made.dump()], "keys": [placed.astype("<i8").tobytes()]})

    return keys.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, SHARD)


def with_shard(keys: DataFrame, n_shards: int) -> DataFrame:
    """Rows whose first column is the key, with the shard of each in front."""
    names = keys.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = shard_of(np.asarray(batch.column(0), np.int64), n_shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], names=["shard", *names])

    return keys.mapInArrow(run, "shard long, " + ", ".join(f"{c} long" for c in names))


def dense_counts(partial: DataFrame, hashes: DataFrame, n_rows: int, n_shards: int) -> DataFrame:
    """(shard, vector): the counts of every shard's keys, by their places, summed as a tree.

    ``partial`` (shard, key, n, origin) may hold a key once per origin.  Vectors
    of about ``GROUP_ROWS`` partial counts each are the leaves.
    """

    def leaf(rows: pa.Table, made: pa.Table) -> pa.Table:
        found, stored = PerfectHash.load(made.column("hash")[0].as_py()), np.frombuffer(made.column("keys")[0].as_py(), "<i8")
        keys = np.asarray(rows.column("key"), np.int64)
        at = found.find(keys)
        if (at < 0).any() or (stored[at] != keys).any():
            raise ValueError("a key is not where its hash says")
        total = np.zeros(found.n, np.int64)
        np.add.at(total, at, np.asarray(rows.column("n"), np.int64))
        return pa.table({"shard": rows.column("shard")[:1], "salt": rows.column("salt")[:1], "vector": [total.astype("<i8").tobytes()]})

    def both(rows: pa.Table) -> pa.Table:
        vectors = rows.column("vector").to_pylist()
        total = np.frombuffer(vectors[0], "<i8").copy()
        for v in vectors[1:]:
            total += np.frombuffer(v, "<i8")
        return pa.table({"shard": rows.column("shard")[:1], "salt": rows.column("salt")[:1], "vector": [total.tobytes()]})

    schema = "shard long, salt long, vector binary"
    salts = max(1, -(-n_rows // (n_shards * GROUP_ROWS)))
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("origin"), F.lit(salts)))
    dealt = hashes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    there = dealt.join(salted.select("shard", "salt").distinct(), ["shard", "salt"], "left_semi") if salts > 1 else dealt
    out = salted.groupBy("shard", "salt").cogroup(there.groupBy("shard", "salt")).applyInArrow(leaf, schema)
    while salts > 1:
        salts = -(-salts // ARITY)
        out = written(out, "pair-vectors").withColumn("salt", F.floor(F.col("salt") / ARITY)).groupBy("shard", "salt").applyInArrow(both, schema)
    return out.select("shard", "vector")


def best_of_b(counted: DataFrame, n_b: int) -> np.ndarray:
    """The highest count of every B id (a row per id of the vocabulary comes to the driver)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                most = np.zeros(n_b, np.int64)
                np.maximum.at(most, np.frombuffer(keys, "<i8") % n_b, np.frombuffer(vector, "<i8"))
                there = np.flatnonzero(most)
                yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(most[there])], names=["b", "most"])

    best = np.zeros(n_b, np.int64)
    for r in counted.select("keys", "vector").mapInArrow(run, "b long, most long").groupBy("b").agg(F.max("most").alias("most")).collect():
        best[r["b"]] = r["most"]
    return best


def write_shards(counted: DataFrame, folder: str, best: np.ndarray) -> dict[int, str]:
    """One file per shard (hash, keys, counts, whether a count is its B id's best); their names."""
    n_b = len(best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, made, raw, vector in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                keys, counts = np.frombuffer(raw, "<i8"), np.frombuffer(vector, "<i8")
                out = OwnFile(folder, "pairs", ".mph")
                out.write(np.array([len(made), len(keys)], "<i8").tobytes())
                out.write(made)
                out.write(raw)
                out.write(vector)
                out.write((counts == best[keys % n_b]).astype(np.uint8).tobytes())
                out.close()
                yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [out.name]})

    rows = written(counted.select("shard", "hash", "keys", "vector").mapInArrow(run, "shard long, file string"), "pair-manifest")
    return {r["shard"]: r["file"] for r in rows.collect()}


class Counts:
    """Counts of pairs, read shard by shard as they are asked for."""

    def __init__(self, folder: str, files: dict[int, str], n_shards: int):
        self.folder, self.files, self.n_shards = folder, files, n_shards
        self.open: dict[int, tuple] = {}

    def _shard(self, number: int) -> tuple:
        if number in self.open:
            self.open[number] = self.open.pop(number)  # the last one used
            return self.open[number]
        while len(self.open) >= OPEN_SHARDS:
            del self.open[next(iter(self.open))]
        with open_input(self.folder, self.files[number]) as file:
            data = file.read()
        n_hash, n = np.frombuffer(data, "<i8", 2).tolist()
        at = 16 + n_hash
        parts = [np.frombuffer(data, "<i8", n, at + 8 * n * i) for i in range(2)]
        self.open[number] = (PerfectHash.load(data[16:at]), *parts, np.frombuffer(data, np.uint8, n, at + 16 * n))
        return self.open[number]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, and 1 where it is its B id's best, of every key; 0 for a pair that was never counted."""
        count, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        shard = shard_of(keys, self.n_shards)
        for number in np.unique(shard).tolist():
            if number not in self.files:
                continue
            rows = np.flatnonzero(shard == number)
            made, stored, counts, flags = self._shard(number)
            at = made.find(keys[rows])
            there = (at >= 0) & (stored[at] == keys[rows])
            count[rows[there]], best[rows[there]] = counts[at[there]], flags[at[there]]
        return count, best


SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def look_up(docs: DataFrame, a_path: str, b_path: str, folder: str, files: dict[int, str], n_shards: int) -> DataFrame:
    """Aligns the documents again and adds up the counts of their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, counts = aligner(a_path, b_path), Counts(folder, files, n_shards)
        if made.known.counted != folder:
            made.known.sums, made.known.counted = np.zeros((0, 3), np.int64), folder
        for batch in pieces(batches, "text", LONG):
            n = batch.num_rows
            texts = [t or "" for t in batch.column(1).to_pylist()]
            totals, digests = np.zeros((n, 6), np.int64), [None] * n
            fits = np.array([bool(t) for t in texts])
            for rows, numbers, first in _work(made, texts):
                known = made.known
                if (old := len(known.sums)) < len(known.text):  # pieces without sums
                    keys, where = np.unique(known.keys[known.first[old] :], return_inverse=True)
                    count, best = counts.find(keys)
                    piece = np.repeat(np.arange(len(known.text) - old), np.diff(known.first[old:]))
                    more = [np.zeros((len(known.text) - old, 3), np.int64)]
                    np.add.at(more[0], piece, np.stack([best, count, count > 0], axis=1)[where])
                    known.sums = np.concatenate([known.sums, *more])
                np.add.at(totals, rows, np.add.reduceat(np.concatenate([known.sizes[numbers], known.sums[numbers]], axis=1), first))
                np.logical_and.at(fits, rows, np.logical_and.reduceat(made.fits(numbers), first))
                order = numbers.tolist()
                for row, a, b in zip(rows, first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
                    said = ";".join(map(known.text.__getitem__, order[a:b])).encode()
                    if digests[row] is None:
                        digests[row] = hashlib.sha256(said)
                    else:
                        digests[row].update(b";" + said)
                if known.full():
                    known.thin_out()
            totals[~fits] = 0
            if (totals[:, 2] != totals[:, 5]).any():
                raise ValueError("a link has no count")
            sha = [d.hexdigest() if ok and d else "" for d, ok in zip(digests, fits, strict=True)]
            columns = [totals[:, 0], totals[:, 1], totals[:, 2], totals[:, 2], totals[:, 3], totals[:, 4]]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns), pa.array(sha)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Aligned tokens of every document, with the corpus-wide counts of its links.

    A text gets a space in front and is encoded by A (a byte-level BPE, whose
    special tokens are plain text) and by B (a piece model that adds the space
    itself).  Byte offsets where tokens of both end cut the tokens into groups;
    the two tokens that end there are a link.  Returns doc_id, n_a, n_b,
    n_groups, n_links, n_best (links whose pair is the most frequent one of its
    B id, ties included), count_sum (corpus-wide counts over the links) and
    groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).  Null and empty texts, and texts
    that one of the tokenizers changes (U+2581 for B), have no tokens: zeros
    and ''.  Rows of one id, or of one text, are rows of their own and all
    count; a null id stays null.  An empty table gives no row.  Other columns
    are not read.  Very long texts are aligned in parts of about 1 MB, each cut
    where neither tokenizer can join what stands on both sides.

    Both passes read the texts and shuffle none of them.  What is counted, the
    distinct pairs of ids, is bounded by the two vocabularies alone; a task
    keeps ``MOST_PIECES`` pieces and ``OPEN_SHARDS`` shards at once.
    """
    spark = docs.sparkSession
    partial = written(count_links(docs, a_path, b_path), "pair-partial")
    distinct = written(partial.select("key").distinct(), "pair-keys")
    n_rows, n_keys = partial.count(), distinct.count()
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    hashes = written(perfect_hashes(with_shard(distinct, n_shards)), "pair-hashes")
    vectors = dense_counts(with_shard(partial, n_shards), hashes, n_rows, n_shards)
    counted = written(hashes.join(vectors, "shard"), "pair-counts")
    folder = scratch(spark, "pairs")
    files = write_shards(counted, folder, best_of_b(counted, aligner(a_path, b_path).n_b))
    return look_up(docs, a_path, b_path, folder, files, n_shards)
