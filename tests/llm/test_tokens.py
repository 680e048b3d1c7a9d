import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from propmart.llm import attribution, packing
from propmart.llm.common import scratch
from propmart.llm.queries import byte_bpe
from propmart.llm.tokens import Encoder, long_parts


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(byte_bpe())
    t.encode_special_tokens = True
    return t


def texts():
    rnd = random.Random(3)
    alphabet = "aé \n\t  12½²'sdmtrevlstＡ中文🙂é<|>_-.​\x1c\x85᠎　 ̀ⅷ\x00'"
    made = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    return made + ["", " ", "  \n\n a", "<|endoftext|> x", "don't we'll I'VE 'sabc !!'s  's", "a" * 5000, "x  " * 300]


def test_ids_and_spans_equal_the_library(library):
    own, all_texts = Encoder(byte_bpe()), texts()
    want = [library.encode(t, add_special_tokens=False) for t in all_texts]
    ids, counts = own.encode(all_texts)
    assert ids.tolist() == [i for e in want for i in e.ids]
    assert counts.tolist() == [len(e.ids) for e in want]
    begin, end, counts = own.spans(all_texts)
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [tuple(o) for e in want for o in e.offsets]


def test_long_texts_in_parts(library):
    own = Encoder(byte_bpe())
    for text in texts():
        parts = list(long_parts(text, 20))
        assert "".join(parts) == text
        assert own.encode(parts)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_cache_is_bounded(library, monkeypatch):
    from propmart.llm import tokens

    monkeypatch.setattr(tokens, "MOST_PIECES", 50)
    own = Encoder(byte_bpe())
    for t in texts():
        assert own.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        Encoder(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("width", [1, 2, 7, 15, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_pack_round_trip(width, n):
    ids = np.random.default_rng(n).integers(0, 1 << width, n).astype(np.uint32)
    words = packing.pack(ids, width)
    assert len(words) == -(-n // 64) * width
    assert (packing.unpack(words, width, n) == ids).all()


def test_bit_width():
    assert [packing.bit_width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "" if row[1] is not None else "")


def test_documents_from_files(spark, make_docs, edge_rows, library):
    got = sorted(
        ((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in packing.pack_and_read(make_docs(edge_rows, extra=True), byte_bpe()).collect()),
        key=lambda r: r[1],
    )
    want, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in edge_rows), key=order):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_random_access(spark, make_docs, library):
    folder = scratch(spark, "packed-test")
    text = " ".join(f"w{i}" for i in range(70_000))
    row = packing.write_packed(make_docs([(1, text)]), folder, byte_bpe()).collect()
    file = packing.PackedFile(folder, row[0].file)
    ids = [*library.encode(text, add_special_tokens=False).ids, 2]
    assert len(file.blocks) > 1 and file.n_ids == len(ids)
    for start, count in ((0, 0), (0, 5), (65_530, 20), (len(ids) - 3, 3), (0, len(ids))):
        assert file.run(start, count).tolist() == ids[start : start + count]


def test_empty_table(spark, make_docs):
    df = packing.pack_and_read(make_docs([]), byte_bpe())
    assert df.collect() == [] and df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def brute(offsets, sections, rule):
    counts, crossing, outside = [0.0] * len(sections), [0] * len(sections), 0
    for b, e in offsets:
        shared = [max(0, min(e, h) - max(b, lo)) for lo, h in sections]
        touched = [i for i, s in enumerate(shared) if s]
        if not touched:
            outside += 1
            continue
        if len(touched) > 1 or shared[touched[0]] < e - b:
            for i in touched:
                crossing[i] += 1
        if rule == "first":
            counts[touched[0]] += 1
        elif rule == "most":
            counts[shared.index(max(shared))] += 1
        else:
            for i in touched:
                counts[i] += shared[i] / sum(shared)
    return counts, crossing, outside


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_against_brute_force(spark, make_docs, edge_rows, library, rule):
    rows = [r for r in edge_rows if len(r[1] or "") < 1000] + [(20, "a\nb  \n\n\n c,\n"), (21, "\n"), (22, "x\r\ny")]
    got = attribution.attribute(make_docs(rows, extra=True), byte_bpe(), rule).collect()
    found = sorted((str(r.doc_id), r.section or 0, r.low, r.high, round(r.n_tokens, 9), r.n_crossing, r.doc_tokens, r.outside) for r in got)
    want = []
    for doc_id, text, *_ in rows:
        text = text or ""
        lines, at = [], 0
        for line in text.split("\n"):
            size = len(line) + (at + len(line) < len(text))
            if size:
                lines.append((at, at + size))
            at += size
        offsets = library.encode(text, add_special_tokens=False).offsets
        counts, crossing, outside = brute(offsets, lines, rule)
        if not lines:
            want.append((str(doc_id), 0, 0, 0, 0.0, 0, 0, 0))
        for i, (low, high) in enumerate(lines):
            want.append((str(doc_id), i, low, high, round(counts[i], 9), crossing[i], len(offsets), outside))
    assert found == sorted(want)


@pytest.mark.parametrize("rule", attribution.RULES)
def test_given_sections(spark, make_docs, library, rule):
    rnd = random.Random(5)
    rows, intervals = [], []
    for i in range(40):
        text = "".join(rnd.choice("ab cdé🙂. ") for _ in range(60))
        rows.append((i, text))
        cuts = sorted(rnd.sample(range(70), 2 * rnd.randint(0, 5)))
        intervals += [(i, a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
    docs = attribution.with_sections(make_docs(rows), spark.createDataFrame(intervals, "doc_id long, low long, high long"))
    got = {(r.doc_id, r.section): r for r in attribution.attribute(docs, byte_bpe(), rule, "sections").collect()}
    for i, text in rows:
        cut = [(a, min(b, 60)) for d, a, b in intervals if d == i and a < 60]
        counts, crossing, outside = brute(library.encode(text, add_special_tokens=False).offsets, cut, rule)
        assert [round(got[i, j].n_tokens, 9) for j in range(len(cut))] == [round(c, 9) for c in counts]
        assert [got[i, j].n_crossing for j in range(len(cut))] == crossing
        assert got[i, 0 if cut else None].outside == outside


def test_long_document_is_whole(spark, make_docs, library):
    text = "word " * 900_000 + "\nlast line"
    rows = attribution.attribute(make_docs([(1, text)]), byte_bpe()).collect()
    assert len(rows) == 2
    assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_overlapping_sections_and_unknown_rules_are_refused(spark, make_docs):
    docs = make_docs([(1, "abc def")]).selectExpr("*", "array(named_struct('low', 0L, 'high', 4L), named_struct('low', 2L, 'high', 5L)) AS sections")
    with pytest.raises(Exception, match="overlap"):
        attribution.attribute(docs, byte_bpe(), "most", "sections").collect()
    with pytest.raises(ValueError, match="rule"):
        attribution.attribute(docs, byte_bpe(), "last")


def test_attribution_of_nothing(spark, make_docs):
    assert attribution.attribute(make_docs([]), byte_bpe()).collect() == []


def test_more_distinct_pieces_than_the_table_holds(library, monkeypatch):
    from propmart.llm import tokens

    monkeypatch.setattr(tokens, "SLOT_BITS", 6)
    text = "".join(f"{i},x{i}y" for i in range(500))
    want = library.encode(text, add_special_tokens=False)
    own = Encoder(byte_bpe())
    ids, counts = own.encode(["12,", text, ""])
    assert counts.tolist() == [len(library.encode("12,").ids), len(want.ids), 0]
    assert ids[counts[0] :].tolist() == want.ids
    begin, end, _ = own.spans([text])
    assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [tuple(o) for o in want.offsets]


def test_long_texts_without_blanks(spark, make_docs, library):
    text = ",".join(map(str, range(3_000_000, 3_700_000)))  # 5.6 MB, 700,000 distinct numbers
    own = Encoder(byte_bpe())
    want = library.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.parts(text))) < 1_100_000
    assert own.encode([text])[0].tolist() == want
    row = packing.pack_and_read(make_docs([(1, text)]), byte_bpe()).collect()[0]
    assert (row.n_tokens, row.ids_crc32) == (len(want) + 1, zlib.crc32(np.array([*want, 2], "<u4").tobytes()))


def test_parts_are_cut_at_piece_boundaries(library):
    own = Encoder(byte_bpe())
    for size in (1, 3, 10):
        for text in texts():
            parts = list(own.parts(text, size))
            assert "".join(parts) == text
            assert own.encode(parts)[0].tolist() == library.encode(text, add_special_tokens=False).ids


def added_texts():
    end = "<|endoftext|>"
    rnd = random.Random(8)
    parts = [end, end, "<|endoftext|", "|endoftext|>", "'s", " ", "a", "don't", "\n\n", "12", "<", "é", "'"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    return [*made, f"a {end} b", end, "", f"x  {end}  y", "<|endof", "text|>", f"{end}'s {end}'s"]


def test_added_tokens_equal_the_unmodified_library():
    plain, own = Tokenizer.from_file(byte_bpe()), Encoder(byte_bpe(), added=True)
    for all_texts in (added_texts(), texts()):
        want = [plain.encode(t, add_special_tokens=False) for t in all_texts]
        ids, counts = own.encode(all_texts)
        assert ids.tolist() == [i for e in want for i in e.ids]
        assert counts.tolist() == [len(e.ids) for e in want]
        begin, end, _ = own.spans(all_texts)
        assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [tuple(o) for e in want for o in e.offsets]
        for size in (1, 7):
            for text, e in zip(all_texts, want, strict=True):
                parts = list(own.parts(text, size))
                assert "".join(parts) == text
                assert own.encode(parts)[0].tolist() == e.ids


def test_operators_take_added_tokens_as_the_unmodified_library(spark, make_docs):
    plain = Tokenizer.from_file(byte_bpe())
    rows = list(enumerate(added_texts()[-60:]))
    packed = {r.doc_id: r for r in packing.pack_and_read(make_docs(rows), byte_bpe()).collect()}
    counted = {r.doc_id: r.doc_tokens for r in attribution.attribute(make_docs(rows), byte_bpe()).collect()}
    start = 0
    for doc_id, text in rows:
        ids = [*plain.encode(text, add_special_tokens=False).ids, 2]
        got = packed[doc_id]
        assert (got.start, got.n_tokens, got.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert counted[doc_id] == len(ids) - 1
        start += len(ids)


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_of_one_polynomial_hash_get_their_own_ids(n):
    made, plain = Encoder(byte_bpe()), Tokenizer.from_file(byte_bpe())
    plain.encode_special_tokens = True
    pair = [thue_morse(n), thue_morse(n, "b", "a")]
    for texts in (pair, pair[::-1], [" ".join(pair * 3)], [f"x {t} y" for t in pair]):
        ids, counts = made.encode(texts)
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
        low, high, _ = made.spans(texts)
        assert list(zip(low.tolist(), high.tolist())) == [o for e in plain.encode_batch(texts, add_special_tokens=False) for o in e.offsets]
