import zlib

import pytest

from __spark_entry__ import queries
from propmart.llm import language

SF_ORACLE = "/root/testdata/sf0.01"

DE = "der hund und die katze gehen nicht über straße weil sie müde sind".split()
EN = "the dog and the cat do not walk over there because they were tired".split()
FR = "le chien et la chatte ne traversent pas où ils étaient fatigués hier".split()


def texts(words, n, shift=0):
    return [" ".join(words[(i * 7 + j * (i + 1 + shift)) % len(words)] for j in range(8 + i % 5)) for i in range(n)]


def labelled():
    rows = []
    for lang, words in (("de", DE), ("en", EN), ("fr", FR)):
        rows += [(len(rows) + i, t, lang) for i, t in enumerate(texts(words, 60))]
    return rows


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_held_out_accuracy(spark):
    """Languages of the given documents that were never learned from."""
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = queries()["op3_language_mixture"](spark, SF_ORACLE).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (remainder(r.doc_id) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_labels_and_ids_are_not_inputs(spark, make_docs):
    rows = labelled()
    first = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_all(make_docs(rows, extra=True)).collect()}
    changed = [(i, t, "xx" if remainder(i) == 2 else lang, "other") for i, t, lang in rows]
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_all(make_docs(changed)).collect()}
    assert first == again
    assert all(first[i][0] == lang for i, _, lang in rows)


def test_mixture(spark, make_docs):
    mixed = " ".join(texts(DE, 30) + texts(FR, 10))
    rows = [*labelled(), (500, mixed), (501, "123 !!! 漢"), (502, None), (503, ""), (504, "... 12")]
    rows = [(i, t, None if i >= 500 else lang[0]) for i, t, *lang in rows]
    got = {r.doc_id: r for r in language.predict_all(make_docs(rows)).collect()}
    assert got[500].lang_pred == "de" and 0.6 < got[500].score < 0.85
    assert [x.split(":")[0] for x in got[500].languages.split(",")] == ["de", "fr"]
    assert got[0].languages.startswith("de:") and "," not in got[0].languages
    for i in (502, 503, 504):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)


def test_edge_rows(spark, make_docs, edge_rows):
    rows = [(r[0], r[1], "en") for r in edge_rows]
    got = language.predict_all(make_docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got} == {"en", "und"}


@pytest.mark.parametrize("rows", [[], [(1, "text without a label", None)]])
def test_nothing_learned(spark, make_docs, rows):
    got = language.predict_all(make_docs(rows)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)


def test_stage_keeps_clean_documents_and_columns(spark, make_docs):
    rows = [*labelled(), (900, "1234 ..."), (901, None)]
    docs = make_docs(rows, extra=True)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if r[0] < 900}


def test_trigrams_do_not_cross_texts():
    bucket, first, bounds = language.trigrams(["ab", "cd", "", "a b"])
    alone = [language.trigrams([t])[0].tolist() for t in ("ab", "cd", "", "a b")]
    assert bucket.tolist() == sum(alone, [])
    assert first.tolist() == [0, 2, 4, 5] and bounds.tolist() == [0, 1, 2, 2, 4]


def test_long_texts_in_parts(monkeypatch):
    import numpy as np

    table = np.log(np.random.default_rng(1).random((1 << language.BUCKET_BITS, 3)).astype(np.float32) + 0.1)
    some = [" ".join(texts(EN, 40)), "", "12 34", " ".join(texts(DE, 25)), "é", " ".join(texts(FR, 90))]
    want = language.infer(some, table)
    monkeypatch.setattr(language, "LONG", 64)
    monkeypatch.setattr(language, "long_parts", lambda t, f=language.long_parts: f(t, 30))
    assert all(np.allclose(a, b) for a, b in zip(language.infer(some, table), want, strict=True))
