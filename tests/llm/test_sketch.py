import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from propmart.llm import sketch


def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """Edited texts in descending id order; null ids last, ties by text."""
    texts = [(r[0], r[1] or "") for r in rows]
    texts.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (doc_id, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        out.append((doc_id, text, following, edited))
    return out


def test_contract_and_estimates(spark, make_docs, edge_rows):
    rnd = random.Random(4)
    rows = edge_rows + [(100 + i, " ".join(f"w{rnd.randint(0, 300)}" for _ in range(rnd.choice([1, 4, 30, 400])))) for i in range(60)]
    rows += [(300, rows[-1][1]), (301, "🙂é " * 50)]
    got = sketch.fingerprints(make_docs(rows, extra=True)).collect()
    want = expected(rows)
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted((str(i), len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, _, e in want)
    by = {(str(r.doc_id), r.n_chars, r.edited_sha256): r for r in got}
    prints = {}
    for doc_id, text, following, edited in want:
        r = by[str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest()]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        a, b, c = shingle_set(text), shingle_set(edited), shingle_set(following)
        assert abs(r.near_edited - jaccard(a, b)) < 0.15 and abs(r.near_next - jaccard(a, c)) < 0.15
        exact = len(a | b) <= sketch.K
        assert not exact or r.near_edited == pytest.approx(jaccard(a, b))
        assert r.n_shingles == (len(a) if len(a) < sketch.K else pytest.approx(len(a), rel=0.35))
        assert r.in_edited == pytest.approx(len(a & b) / len(a) if a else 1.0, abs=0.2)
        assert len(base64.b64decode(r.fingerprint)) == 8 * min(len(a), sketch.K)


def test_runs_are_cut_anywhere(spark, make_docs):
    rows = [(3 * i, f"text number {i} of some words") for i in range(50)]
    df = make_docs(rows).select("doc_id", "text")
    for buckets in (1, 2, 7, 50, 200):
        led = {r.doc_id: r.next_text for r in sketch.with_next(df, ["text"], {}, buckets).collect()}
        assert led == {i: f for i, _, f, _ in expected(rows)}


def test_one_row_and_no_row(spark, make_docs):
    one = sketch.fingerprints(make_docs([(7, "abcdef")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert sketch.fingerprints(make_docs([])).collect() == []
    assert sketch.fingerprints(make_docs([(None, None), (None, "abc")])).count() == 2


def test_merging_parts(spark, monkeypatch):
    monkeypatch.setattr(sketch, "MERGED_AT_ONCE", 4)
    parts = [("hot" if i % 3 else f"k{i}", " ".join(f"w{i * 7 + j}" for j in range(20))) for i in range(90)]
    df = spark.createDataFrame(parts, "k string, text string").withColumn("sketch", sketch.text_sketch(F.col("text"), 64))
    got = {r.k: r.sketch for r in sketch.merge_groups(df, "k", k=64).collect()}
    hashes = df.select("k", F.explode(sketch.text_sketch(F.col("text"), 10_000)).alias("h")).distinct().collect()
    for key in {k for k, _ in parts}:
        assert got[key] == sorted(r.h for r in hashes if r.k == key)[:64]


def test_no_python_in_the_plan(spark, make_docs):
    plan = sketch.fingerprints(make_docs([(1, "a b c"), (2, "d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
