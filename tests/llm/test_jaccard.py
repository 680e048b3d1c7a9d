import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from propmart.llm import lsh_forest
from propmart.llm import shingles as sh
from propmart.llm.common import connected_components


def words(text):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shingle_set(w, size=5):
    if len(w) >= size:
        return {w[i : i + size] for i in range(len(w) - size + 1)}
    return {w} if w else set()


def brute(rows, threshold=0.8):
    """(id, class, links, copies) per row by comparing all pairs."""
    ids = defaultdict(list)
    for r in rows:
        ids[words(r[1])].append(r[0])
    sets = {w: shingle_set(w) for w in ids}
    parent, links = {w: w for w in ids}, defaultdict(int)

    def root(w):
        while parent[w] != w:
            w = parent[w]
        return w

    for a, b in itertools.combinations(ids, 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for w, own in ids.items():
        members[root(w)] += [i for i in own if i is not None]
    return sorted(((r[0], min(members[root(words(r[1]))], default=None), links[words(r[1])], len(ids[words(r[1])])) for r in rows), key=str)


def found(df):
    return sorted(((r.doc_id, r.class_id, r.n_links, r.copies) for r in df.collect()), key=str)


def near_copies(n=60, seed=1):
    """Families of texts with edits, exact copies, and texts that share only a passage."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randint(0, 5000)}"
    passage = [word() for _ in range(40)]
    rows = []
    for family in range(12):
        base = [word() for _ in range(rnd.choice([6, 40, 120]))]
        if family % 3 == 0:
            base += passage
        for _ in range(n // 12):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                text[rnd.randrange(len(text))] = word()
            rows.append((len(rows) + 1, " ".join(text)))
    return rows


def test_against_brute_force(spark, make_docs, edge_rows):
    rows = near_copies() + [(r[0] and r[0] + 1000, *r[1:]) for r in edge_rows]
    assert found(lsh_forest.jaccard_join(make_docs(rows, extra=True))) == brute(rows)


def test_large_group_over_many_blocks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(lsh_forest, "BLOCK_CLASSES", 16)
    monkeypatch.setattr(lsh_forest, "PAIRED", 4)
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[:j] + [f"x{i}"] + base[j + 1 :])) for i, j in ((i, rnd.randrange(150)) for i in range(120))]
    got = found(lsh_forest.jaccard_join(make_docs(rows)))
    assert got == brute(rows) and got[0][2] > 100


def test_no_documents(spark, make_docs):
    df = lsh_forest.jaccard_join(make_docs([]))
    assert df.collect() == [] and df.columns == ["doc_id", "class_id", "n_links", "copies"]
    assert lsh_forest.one_per_group(make_docs([])).collect() == []


def test_one_per_group(spark, make_docs, edge_rows):
    rows = near_copies(36) + [(r[0] and r[0] + 1000, *r[1:]) for r in edge_rows]
    docs = make_docs(rows, extra=True)
    kept = lsh_forest.one_per_group(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    least = {}
    classes = {words(r[1]): c for r, c in zip(sorted(rows, key=lambda r: str(r[0])), [None] * len(rows), strict=True)}
    for doc_id, class_id, *_ in brute(rows):
        least.setdefault(class_id, doc_id)
    # every class has one row, with its least id
    assert len(got) == len({c for _, c, *_ in brute(rows)}) and classes
    assert sorted((g[0] for g in got if g[0] is not None)) == sorted(c for c in {c for _, c, *_ in brute(rows)} if c is not None)


def test_prefix_length():
    assert lsh_forest.prefix_length(0.8, 0.999) == 4
    assert lsh_forest.prefix_length(0.8, 0.99) == 5
    assert lsh_forest.prefix_length(0.1, 0.999) == 1


@pytest.mark.parametrize("seed", range(4))
def test_intersections(seed, monkeypatch):
    monkeypatch.setattr(lsh_forest, "COLUMNS", 16)
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 120)).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert lsh_forest.intersections(sets).tolist() == want


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"{rnd.randint(0, 80):03d}", f"{rnd.randint(0, 80):03d}") for _ in range(60)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    want = {(x, root(x)) for e in edges if e[0] != e[1] for x in e}
    assert {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()} == want


def test_word_and_shingle_hashes():
    import pyarrow as pa

    texts = ["a b  c", "", None, "é\tb\nc d e f", "  ", "x" * 3, "a b c"]
    data, texts_bounds = sh.text_bytes(pa.array(texts))
    hashes, start, end, bounds = sh.words(data, texts_bounds)
    assert np.diff(bounds).tolist() == [len(words(t)) for t in texts]
    joined = "".join(t or "" for t in texts).encode()
    seen = {}
    for h, a, b in zip(hashes.tolist(), start, end, strict=True):
        assert seen.setdefault(joined[a:b], h) == h
    assert len(set(seen.values())) == len(seen)
    grams, g_bounds = sh.shingles(hashes, bounds)
    assert np.diff(g_bounds).tolist() == [max(len(w) - 4, min(len(w), 1)) for w in map(words, texts)]
    keys = sh.sequence_key(data, start, end, bounds)
    assert keys[0] == keys[6] and keys[1] == keys[2] == keys[4] and len(set(keys)) == 4


def test_words_in_slices(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab é\n\t") for _ in range(rnd.randint(0, 300))) for _ in range(40)] + ["x" * 500, "", " " * 100]
    want = sh.words(*sh.text_bytes(pa.array(texts)))
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(sh, "SLICE", size)
        got = sh.words(*sh.text_bytes(pa.array(texts)))
        assert all((a == b).all() for a, b in zip(got, want, strict=True))


def test_words_of_one_polynomial_hash_are_different_texts(spark, make_docs):
    word = lambda n, a, b: "".join((a, b)[i.bit_count() % 2] for i in range(n))
    rows = [(i * 10 + j, f"one two {word(n, *ab)} three four five") for i, n in enumerate((1024, 2048)) for j, ab in enumerate(("ab", "ba"))]
    got = {r.doc_id: r for r in lsh_forest.jaccard_join(make_docs(rows)).collect()}
    assert {i: (r.class_id, r.copies) for i, r in got.items()} == {i: (i, 1) for i, _ in rows}
