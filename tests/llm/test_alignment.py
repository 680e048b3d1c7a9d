import hashlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest

from propmart.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "a  b \n c", "x ", " ", " \t y", "it's  we'll '' 's o'clock", "a<|endoftext|>b <s> </s> <unk> <0x0A>", "▁ foo", "foo ▁bar", "漢字かな 交じり文🙂 ok",
    "tab\tsep\x1c x\x85 y z w​ v", "trail  ", "nul\0 x", "end\n", "abc123,456;789" * 300, "漢字かな🙂" * 900, "Ünïcode ﬁ ½ ①", "a\r\n b\r\n\r\n  c", "    indent\n        more",
]


@cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(text):
    """Groups and links of whole-text encodings, or None."""
    if not text:
        return None
    a, b = libraries()
    byte = alignment.byte_of_char()
    sides = []
    for ids, data in (
        (ids := a.encode(" " + text, add_special_tokens=False).ids, [bytes(byte[c] for c in a.id_to_token(i)) for i in ids]),
        (ids := b.encode(text), [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids]),
    ):
        if b"".join(data) != (" " + text).encode():
            return None
        sides.append((ids, {sum(map(len, data[: k + 1])): k for k in range(len(data))} if len(data) < 3000 else dict(zip(np.cumsum(list(map(len, data))).tolist(), range(len(data)), strict=True))))
    (ids_a, ends_a), (ids_b, ends_b) = sides
    groups, links, at_a, at_b = [], [], 0, 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        i, j = ends_a[end] + 1, ends_b[end] + 1
        groups.append(",".join(map(str, ids_a[at_a:i])) + "|" + ",".join(map(str, ids_b[at_b:j])))
        links.append((ids_a[i - 1], ids_b[j - 1]))
        at_a, at_b = i, j
    return len(ids_a), len(ids_b), groups, links


def brute(rows):
    made = [(i, plain(t)) for i, t in rows]
    count = Counter(x for _, m in made if m for x in m[3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = Counter()
    for i, m in made:
        if m is None:
            out[(i, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        n_a, n_b, groups, links = m
        top, total = sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links)
        out[(i, n_a, n_b, len(groups), len(links), top, total, hashlib.sha256(";".join(groups).encode()).hexdigest())] += 1
    return out


def test_equals_whole_text_encoding(spark, make_docs, edge_rows):
    rows = [(i, t) for i, t in enumerate(TEXTS, 100)] + edge_rows + [(90, "word " * 450_000 + "▁"), (91, "x-1 " * 60_000)]
    got = alignment.align(make_docs(rows, extra=True), A, B)
    assert got.columns == [f.split()[0] for f in alignment.SCHEMA.split(", ")]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_without_pairs(spark, make_docs):
    assert alignment.align(make_docs([]), A, B).count() == 0
    assert {tuple(r) for r in alignment.align(make_docs([(1, None), (2, ""), (3, "▁")]), A, B).collect()} == {(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)}


@pytest.mark.parametrize("size", [64, 1 << 12])
def test_parts_are_those_of_the_whole_text(monkeypatch, size):
    monkeypatch.setattr(alignment, "LONG", size)
    made = alignment.Aligner(A, B)
    for text in TEXTS + [" ".join(TEXTS), "漢字。かな,12 a'b" * 100, "plain words only " * 30 + "end"]:
        want = plain(text)
        made.known = alignment.Pieces()
        numbers = np.concatenate([x for _, x, _ in alignment._work(made, [text])])
        assert (want is not None) == bool(made.fits(numbers).all())
        if want:
            known = made.known
            assert ";".join(known.text[i] for i in numbers) == ";".join(want[2])
            keys = np.concatenate([known.keys[known.first[i] : known.first[i + 1]] for i in numbers])
            assert [(k // made.n_b, k % made.n_b) for k in keys.tolist()] == want[3]


def test_common_pieces_stay(monkeypatch):
    monkeypatch.setattr(alignment, "MOST_PIECES", 50)
    made = alignment.Aligner(A, B)
    texts = [" ".join(["common", "often"] * 5 + [f"rare{i}x{j}" for j in range(30)]) for i in range(12)]
    for text in texts:
        want, numbers = plain(text), np.concatenate([x for _, x, _ in alignment._work(made, [text])])
        assert ";".join(made.known.text[i] for i in numbers) == ";".join(want[2])
        if made.known.full():
            made.known.thin_out()
            assert {"common", "often"} <= set(made.known.number) and len(made.known.text) <= 50


def test_few_pieces_and_shards_at_once(spark, make_docs, monkeypatch):
    rows = [(i, f"text number {i} with word{i * 7} and some 漢字 {i}") for i in range(60)]
    monkeypatch.setattr(alignment, "SHARD_KEYS", 16)
    monkeypatch.setattr(alignment, "GROUP_ROWS", 2)  # many vectors, so that the tree has levels
    assert Counter(map(tuple, alignment.align(make_docs(rows), A, B).collect())) == brute(rows)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        keys = rng.permutation(np.unique(rng.integers(0, 1 << 31, n)))
        made = alignment.PerfectHash.load(alignment.PerfectHash.of(keys).dump())
        assert sorted(made.find(keys).tolist()) == list(range(len(keys)))
        assert (made.find(keys + (1 << 32)) < max(1, len(keys))).all()
