import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from propmart.llm import repeats as rp


def brute(rows, width):
    """Every window of every row counted, rows of equal texts included."""
    datas = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(d[j : j + width] for _, d in datas for j in range(len(d) - width + 1))
    out = []
    for doc_id, d in datas:
        spans = []
        for j in range(len(d) - width + 1):
            if seen[d[j : j + width]] > 1:
                spans.append((j, j + width))
        cuts, kept, at = rp.merged(spans), b"", 0
        for a, b in cuts:
            kept += d[at:a]
            at = b
        out.append((str(doc_id), len(d), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(kept + d[at:]).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def cases(seed, width=24):
    """Texts built from shared passages, edits, periods and few letters."""
    rnd = random.Random(seed)
    noise = lambda n, letters="abcdefghij é🙂": "".join(rnd.choice(letters) for _ in range(n))
    passages = [noise(rnd.randint(width - 4, 3 * width)) for _ in range(8)]
    rows = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            text = noise(rnd.randint(0, 120))
        elif kind == 1:
            text = noise(rnd.randint(0, 40)) + rnd.choice(passages) + noise(rnd.randint(0, 40)) + rnd.choice(passages)
        elif kind == 2:
            base = rnd.choice(passages)
            at = rnd.randrange(len(base))
            text = noise(9) + base[:at] + "#" + base[at:] + noise(9)
        elif kind == 3:
            text = noise(rnd.randint(1, 5)) * rnd.randint(1, 30) + noise(3)
        elif kind == 4:
            text = noise(rnd.randint(0, 200), "ab")
        else:
            text = rows[rnd.randrange(len(rows))][1]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_small_windows_against_brute_force(spark, make_docs, seed):
    rows = [*cases(seed), (None, None), (70, ""), (None, cases(seed)[1][1])]
    assert found(rp.remove_repeats(make_docs(rows, extra=True), width=24, gram=8)) == brute(rows, 24)


def test_real_width(spark, make_docs, edge_rows):
    rnd = random.Random(8)
    passage = " ".join(f"p{rnd.randint(0, 999)}" for _ in range(80))
    rows = edge_rows[:9] + [(i, " ".join(f"w{rnd.randint(0, 9999)}" for _ in range(60)) + passage[i : len(passage) - i] + f"end {i}") for i in range(20, 60)]
    rows += [(90, "a" * 5000), (91, "a" * 199), (92, "ab" * 150 + "c"), (93, passage[:199]), (94, passage[:200])]
    assert found(rp.remove_repeats(make_docs(rows, extra=True))) == brute(rows, 200)


def test_long_text_in_chunks(spark, make_docs, monkeypatch):
    rnd = random.Random(9)
    passage = "".join(rnd.choice("abcdefgh") for _ in range(50))
    text = "".join(rnd.choice("abcdefgh") if i % 97 else passage for i in range(3000))
    rows = [(1, text), (2, "x" + passage + "y")]
    want = brute(rows, 24)
    for chunk in (100, 333, 5000):
        monkeypatch.setattr(rp, "CHUNK", chunk)
        # one text per batch, or it would not be cut
        one = [rp._anchor_rows(24, 8)(iter([batch])) for batch in batches(rows)]
        got = {tuple(x) for it in one for b in it for x in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        monkeypatch.setattr(rp, "CHUNK", 1 << 20)
        whole = {tuple(x) for batch in batches(rows) for b in rp._anchor_rows(24, 8)(iter([batch])) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)}
        assert got == whole
    assert found(rp.remove_repeats(make_docs(rows), width=24, gram=8)) == want


def batches(rows):
    import pyarrow as pa

    return [pa.RecordBatch.from_pydict({"key": pa.array([i], pa.int64()), "text": [t]}) for i, t in rows]


def test_large_groups_by_windows(spark, make_docs, monkeypatch):
    monkeypatch.setattr(rp, "LARGE_GROUP", 3)
    rows = cases(5)
    assert found(rp.remove_repeats(make_docs(rows), width=24, gram=8)) == brute(rows, 24)


def test_empty_table(spark, make_docs):
    df = rp.remove_repeats(make_docs([]))
    assert df.collect() == [] and df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("seed", range(5))
def test_mergesort_orders_as_bytes_do(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99 + seed, 4000).astype(np.uint8)
    n = 300
    at = rng.integers(40, 3900, n)
    group = np.sort(rng.integers(0, 1 + 40 * seed, n))
    ext = rp.Extensions(data)
    for forward in (True, False):
        room = rng.integers(0, 40, n)
        order = rp._mergesort(ext, at, room, group, forward)
        assert order.tolist() == rp._bytes_order(data, at, room, group, forward).tolist()
        common = rp._neighbours(data, at, room, group, order, 40, forward)
        text = lambda i: data[at[i] : at[i] + room[i]] if forward else data[at[i] - room[i] : at[i]][::-1]  # noqa: B023, E731
        for k in range(n):
            i, j = order[k], order[k - 1]
            if k == 0 or group[i] != group[j]:
                assert common[k] == -1
            else:
                a, b = text(i), text(j)
                m = min(len(a), len(b))
                assert common[k] == (m if (a[:m] == b[:m]).all() else int((a[:m] != b[:m]).argmax()))


def test_a_collision_is_noticed(monkeypatch):
    """With a useless hash the order is wrong, and the bytes decide."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 2000).astype(np.uint8)
    at = rng.integers(100, 1800, 50)
    before, after, group = np.minimum(at, 16), np.full(50, 24), np.sort(rng.integers(0, 6, 50))
    want = [x.tolist() for x in rp.repeated_places(data, at, before, after, group, 24, 8)]
    monkeypatch.setattr(rp.Extensions, "_same", lambda self, x, y, n: np.ones(len(x), bool))
    assert [x.tolist() for x in rp.repeated_places(data, at, before, after, group, 24, 8)] == want
