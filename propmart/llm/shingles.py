"""Word and shingle hashes of whole Arrow batches, in numpy.

Words are runs of bytes other than ASCII white space.  A document of at least
``size`` words has one shingle per run of that many words; a shorter one with
any word has one shingle of all its words.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SLICE = 1 << 21  # bytes that are hashed at once
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverses for i below ``size``; a worker keeps the longest so far."""
    have = _POWERS.get("held")
    if have is None or len(have[0]) < size:
        out, room = [], 1 << max(16, int(size - 1).bit_length())
        for base in (BASE, INVERSE):
            p = np.ones(room, np.uint64)
            done, step = 1, base
            while done < room:  # doubles the filled part
                p[done : 2 * done] = p[:done] * step
                done, step = 2 * done, np.uint64(int(step) ** 2 % (1 << 64))
            out.append(p)
        have = _POWERS["held"] = (out[0], out[1])
    return have[0][:size], have[1][:size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in a row, and n + 1 bounds; null: empty."""
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * BASE**position, modulo 2**64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def words(data: np.ndarray, bounds: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of every word, and word bounds of the documents.

    Many bytes, such as those of one very long text, are taken in slices that
    end at white space.
    """
    parts, low = [], 0
    while low < len(data):
        high = min(len(data), low + SLICE)
        while high < len(data) and not white[data[high]]:
            ahead = white[data[high : high + 4096]]
            high = min(len(data), high + (int(ahead.argmax()) if ahead.any() else 4096))
        a, b = np.searchsorted(bounds, [low, high], side="right")
        hashes, start, end = _words(data[low:high], bounds[a:b] - low, white)
        parts.append((hashes, start + low, end + low))
        low = high
    hashes, start, end = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return hashes, start, end, np.searchsorted(start, bounds)


def _words(data: np.ndarray, bounds: np.ndarray, white: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = ~white[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner], after[inner - 1] = False, False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    # a byte at its place in the word is mixed before it is added: a polynomial
    # modulo 2**64 gives one value to long words that differ in a regular way
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, end - start)
    p = np.zeros(len(at) + 1, np.uint64)
    np.cumsum(mix(data[at].astype(np.uint64) + np.uint64(1) + (place.astype(np.uint64) << np.uint64(8)) * BASE), out=p[1:])
    ends = np.cumsum(end - start)
    return mix(p[ends] - p[ends - (end - start)]), start, end


@cache
def multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, and shingle bounds of the documents."""
    n_words = np.diff(bounds)
    counts = np.where(n_words >= size, n_words - size + 1, (n_words > 0).astype(np.int64))
    ends = np.cumsum(counts)
    at = np.repeat(bounds[:-1] - (ends - counts), counts) + np.arange(int(counts.sum()))
    c = multipliers(size, 5)
    if (short := (n_words > 0) & (n_words < size)).any():
        doc = np.repeat(np.arange(len(n_words)), counts)
        left = np.where(short[doc], bounds[1:][doc] - at, size)
        out = np.zeros(len(at), np.uint64)
        for i in range(size):
            have = left > i
            out[have] += hashes[at[have] + i] * c[i]
    else:
        out = hashes[at] * c[0]
        for i in range(1, size):
            out += hashes[at + i] * c[i]
    return mix(out), np.concatenate([[0], ends])


def sequence_key(data: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> list[str]:
    """128 bits of the SHA-256 of each document's words, joined by blanks, as hexadecimal text."""
    out = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if low == high:
            out.append(hashlib.sha256().hexdigest()[:32])
            continue
        text = data[start[low] : end[high - 1]].tobytes()
        out.append(hashlib.sha256(b" ".join(text.split())).hexdigest()[:32])
    return out


def signatures(hashes: np.ndarray, bounds: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """MinHash signatures (documents x ``count``, 32 bits); without shingles: all ones."""
    n = len(bounds) - 1
    out = np.full((n, count), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        first = bounds[some]
        for j, c in enumerate(multipliers(count, seed)):
            out[some, j] = np.minimum.reduceat(((hashes * c) >> np.uint64(32)).astype(np.uint32), first)
    return out
