"""Byte-level BPE encoding in batches, through the ``tokenizers`` library.

A byte-level BPE splits a text into pieces by a fixed pattern and encodes each
piece by itself.  A batch of texts is split in numpy over its code points;
pieces repeat, so a worker lets the library encode each distinct piece once
and looks the rest up by a 64-bit hash.  A piece that is found is compared with
the one that is known, character by character; pieces of one hash get places of
their own.  Ids and character spans equal those
of encoding whole texts (tested); occurrences of added tokens are pieces of their
own.  Tokenizers with any other pre-tokenizer or
with a normalizer are refused.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import regex

from propmart.llm.shingles import mix, powers

OTHER, LETTER, NUMBER, SPACE = range(4)
MOST_PIECES = 300_000  # distinct pieces kept by a worker; then it starts anew
SLOT_BITS = 20
LONG = 1 << 20  # characters of one text that are split at once
JOINED = 500  # new pieces given to the library as one text
# where a piece ends and another starts, whatever stands before and after
_CUT = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}])(?=\p{N})|(?<=[^\s\p{L}\p{N}'])(?=\p{L})")


@cache
def _classes() -> np.ndarray:
    """Class of every code point, as the split pattern tells them apart."""
    table = np.zeros(0x110000, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        run = "".join(map(chr, range(low, high)))
        for number, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, run):
                table[low + m.start() : low + m.end()] = number
    return table


def split(code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the pieces of texts given as code points in a row.

    The rules of byte-level pre-tokenization: runs of letters, numbers or
    other characters, each with one blank before it; the English contraction
    endings 's 't 're 've 'm 'll 'd where an apostrophe starts a piece; runs of
    white space, of which the last character stands alone before other text.
    """
    n = len(code)
    kind = _classes()[code]
    first = np.zeros(n + 1, bool)  # starts of texts
    first[bounds] = True
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    start[n] = True
    begin = np.flatnonzero(start[:n])
    end = np.append(begin[1:], n)
    run = kind[begin]
    space = (run == SPACE) & ~first[end]
    last = end[space] - 1
    start[last] = True
    start[end[space][code[last] == 32]] = False
    lone = np.flatnonzero((run[:-1] == OTHER) & (end[:-1] - begin[:-1] == 1) & (run[1:] == LETTER))
    lone = lone[(code[begin[lone]] == 39) & start[begin[lone]] & ~first[end[lone]]]
    if len(lone):
        at, left = end[lone], end[lone + 1] - end[lone]
        one, two = code[at], np.where(left > 1, code[np.minimum(at + 1, n - 1)], 0)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b))
        taken = np.where(single, 1, np.where(double, 2, 0))
        at, taken = at[taken > 0], taken[taken > 0]
        start[at] = False
        start[at + taken] = True
    return np.flatnonzero(start[:n])


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.size = np.zeros(1 << 16, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.resize(self.data, max(need, 2 * len(self.data)))
        self.data[self.size : need] = values
        self.size = need


class _Numbers:
    """64-bit hash -> number, for whole arrays (open addressing; 0 is empty)."""

    def __init__(self):
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.values = np.zeros(1 << SLOT_BITS, np.int32)
        self.count = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        key = self.keys[slot]
        out = np.where(key == hashes, self.values[slot], -1)
        left = np.flatnonzero((key != hashes) & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << SLOT_BITS) - 1)
            key = self.keys[slot[left]]
            hit = key == hashes[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct new hashes in their order."""
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]
            put = self.keys[slot[left]] == hashes[left]
            self.values[slot[left[put]]] = self.count + left[put]
            left = left[~put]
            slot[left] = (slot[left] + 1) & ((1 << SLOT_BITS) - 1)
        self.count += len(hashes)


class Encoder:
    """Ids, and on request character spans, of whole texts.

    With ``added`` the strings of added tokens in a text are these tokens, as
    the library has it unless told otherwise; else they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        # a task has one core; the library's own threads would also keep memory each
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # pieces are ordinary text
        made = json.loads(self.tokenizer.to_str())
        splits = made.get("pre_tokenizer") or {}
        if splits.get("type") != "ByteLevel" or not splits.get("use_regex", True) or splits.get("add_prefix_space") or made.get("normalizer"):
            raise ValueError("only byte-level tokenizers without normalizer or added space are supported")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocab_size = max(vocabulary.values()) + 1
        self.id_bytes = np.zeros(self.vocab_size, np.int64)  # a byte-level token has a character per byte
        self.id_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.added: dict[str, int] = {}
        if added:
            given = made.get("added_tokens") or []
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or not t["special"] for t in given):
                raise ValueError("only special added tokens that match as they are written are supported")
            self.added = {t["content"]: t["id"] for t in given}
            self.id_bytes[list(self.added.values())] = [len(t.encode()) for t in self.added]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.find_added = regex.compile("|".join(map(regex.escape, longest_first))) if self.added else None
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.first = _Grown(np.uint32), _Grown(np.int64)
        self.count = _Grown(np.int32)
        self.begin, self.end = _Grown(np.int32), _Grown(np.int32)
        self.chars, self.char_first, self.char_count = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int32)

    def _differ(self, numbers: np.ndarray, code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where pieces of a text are not the known pieces of these numbers (whose hash is the same)."""
        size = (end - start).astype(np.int64)
        wrong = self.char_count.data[numbers] != size
        ends = np.cumsum(size)
        held = self.char_first.data[numbers]
        held[wrong] = 0
        shift = np.repeat(held - (ends - size), size)
        at = np.arange(len(shift))
        unlike = np.flatnonzero(self.chars.data[np.minimum(shift + at, self.chars.size - 1)] != code[start[0] : end[-1]])
        wrong[np.searchsorted(ends, unlike, side="right")] = True
        return wrong

    def _learn(self, new: list[str], joinable: np.ndarray) -> None:
        """Let the library encode new pieces; blank-and-letters pieces many at once."""
        order = np.argsort(~joinable, kind="stable")
        n_join = int(joinable.sum())
        new = [new[i] for i in order]
        texts = ["".join(new[i : i + JOINED]) if i + JOINED <= n_join else "".join(new[i:n_join]) for i in range(0, n_join, JOINED)] + new[n_join:]
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lists = [e.ids for e in got]
        for i, piece in enumerate(new[n_join:], len(lists) - len(new) + n_join):
            if piece in self.added:
                lists[i] = [self.added[piece]]
        ids = np.fromiter(chain.from_iterable(lists), np.uint32)
        raw = [p.encode() for p in new]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))  # of pieces, in bytes
        token_ends = np.cumsum(self.id_bytes[ids])
        if token_ends[-1] != ends[-1]:
            raise ValueError("the tokenizer's tokens do not tile the text")
        past = np.searchsorted(token_ends, ends, side="right")
        count = np.diff(past, prepend=0)
        char = np.cumsum((np.frombuffer(b"".join(raw), np.uint8) & 0xC0) != 0x80) - 1
        base = np.repeat(char[np.concatenate([[0], ends[:-1]])], count)
        begin, end = char[token_ends - self.id_bytes[ids]] - base, char[token_ends - 1] + 1 - base
        # back to the order in which the pieces were numbered
        back = np.empty(len(new), np.int64)
        back[order] = np.arange(len(new))
        start = (past - count)[back]
        self.first.extend(self.ids.size + start)
        self.count.extend(count[back])
        self.ids.extend(ids)
        self.begin.extend(begin)
        self.end.extend(end)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        first = self.chars.size + np.cumsum(sizes) - sizes
        self.chars.extend(np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), "<u4"))
        self.char_first.extend(first[back])
        self.char_count.extend(sizes[back])

    def _pieces(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
        """The texts in a row, their code points, the starts of all pieces, and the texts' bounds."""
        text = "".join(texts)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        if not len(code):
            return text, code, np.zeros(0, np.int64), bounds
        low, high = self._occurrences(texts, text, bounds)
        start = split(code, np.unique(np.concatenate([bounds, low, high])))
        if len(low):  # an added token is one piece
            at = np.searchsorted(low, start, side="right") - 1
            start = start[(at < 0) | (start == low[at]) | (start >= high[at])]
        return text, code, start, bounds

    def _occurrences(self, texts: list[str], text: str, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the added tokens in the texts in a row."""
        found = []
        if self.added and self.find_added.search(text):
            for base, one in zip(bounds.tolist(), texts, strict=False):
                found += [(base + m.start(), base + m.end()) for m in self.find_added.finditer(one)]
        low, high = np.array(found, np.int64).reshape(-1, 2).T
        return low, high

    def _numbered(self, text: str, code: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the pieces in their order, in as many runs as the tables need.

        The numbers of a run hold until the next one is taken.
        """
        end = np.append(start[1:], len(code))
        up, down = powers(len(code) + 1)
        prefix = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
        hashes = mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))
        hashes[hashes == 0] = 1
        del prefix
        room = (1 << SLOT_BITS) // 2
        step = max(1, len(hashes))
        if self.numbers.count > MOST_PIECES:
            self._clear()
        if self.numbers.count + len(np.unique(hashes[self.numbers.find(hashes) < 0])) > room:
            self._clear()
            if len(np.unique(hashes)) > room:
                step = room
        for low in range(0, len(hashes), step):
            run = hashes[low : low + step]
            numbers = self.numbers.find(run)
            while True:
                missing = np.flatnonzero(numbers < 0)
                if not len(missing):
                    wrong = np.flatnonzero(self._differ(numbers, code, start[low : low + step], end[low : low + step]))
                    if not len(wrong):
                        break
                    # other pieces of this hash: their next place
                    run[wrong] = mix(run[wrong] + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
                    numbers[wrong] = self.numbers.find(run[wrong])
                    continue
                distinct, where = np.unique(run[missing], return_index=True)
                if self.numbers.count + len(distinct) > room:
                    self._clear()
                    missing = np.arange(len(run))
                    distinct, where = np.unique(run, return_index=True)
                at = low + missing[where]
                kind = _classes()
                joinable = (code[start[at]] == 32) & (end[at] - start[at] > 1)
                joinable &= kind[code[np.minimum(start[at] + 1, len(code) - 1)]] == LETTER
                new = [text[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                if self.added:
                    joinable &= [piece not in self.added for piece in new]
                self._learn(new, joinable)
                self.numbers.add(distinct)
                numbers[missing] = self.numbers.find(run[missing])
            yield numbers

    def _expand(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of every token in the piece tables, and tokens per piece."""
        count = self.count.data[numbers]
        shift = self.first.data[numbers] - (np.cumsum(count, dtype=np.int64) - count)
        return np.repeat(shift, count) + np.arange(int(count.sum())), count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text."""
        text, code, start, bounds = self._pieces(texts)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
        for numbers in self._numbered(text, code, start):
            at, count = self._expand(numbers)
            ids.append(self.ids.data[at])
            counts.append(count)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts), dtype=np.int64)])
        return np.concatenate(ids), np.diff(ends[np.searchsorted(start, bounds)])

    def spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Character starts and ends (within its text) of every token, and tokens per text."""
        text, code, start, bounds = self._pieces(texts)
        begin, end, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for numbers in self._numbered(text, code, start):
            at, count = self._expand(numbers)
            begin.append(self.begin.data[at])
            end.append(self.end.data[at])
            counts.append(count)
        count = np.concatenate(counts)
        ends = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        per_text = np.diff(ends[np.searchsorted(start, bounds)])
        base = np.repeat(start, count) - np.repeat(bounds[:-1], per_text)
        return base + np.concatenate(begin), base + np.concatenate(end), per_text

    def parts(self, text: str, size: int = LONG) -> Iterator[str]:
        """A text in parts whose pieces are those of the whole text.

        Cuts lie where a run of letters, numbers or other characters ends, but
        not after an apostrophe nor in an added token; a part grows only by
        what cannot be cut.
        """
        taken = ((m.start(), m.end()) for m in self.find_added.finditer(text)) if self.added else iter(())
        low, high = next(taken, (len(text), len(text)))
        start = 0
        while len(text) - start > size:
            for m in _CUT.finditer(text, start + size):
                while high <= m.start() and low < len(text):
                    low, high = next(taken, (len(text), len(text)))
                if not low < m.start() < high:
                    break
            else:
                break
            yield text[start : m.start()]
            start = m.start()
        yield text[start:]


def long_parts(text: str, size: int = LONG) -> Iterator[str]:
    """A text in parts whose pieces are those of the whole text.

    Cuts lie before a blank that stands between other text and a letter;
    without one the part grows.
    """
    cut = regex.compile(r"(?<=\S) (?=\p{L})")
    start = 0
    while len(text) - start > size:
        found = cut.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


@cache
def encoder(path: str) -> Encoder:
    """The worker's encoder of one tokenizer file; tasks of a worker share it."""
    return Encoder(path, added=True)
