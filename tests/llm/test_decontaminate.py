import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from propmart.llm import decontaminate as dc

ITEMS = "item_id long, text string"


def vocabulary(seed):
    rnd = random.Random(seed)
    return lambda n: [f"v{rnd.randint(0, 4000)}" for _ in range(n)]


def case():
    some = vocabulary(1)
    rnd = random.Random(2)
    items = [(i, " ".join(some(30))) for i in range(20)] + [(20, " ".join(some(7))), (21, "too short"), (22, None), (23, ""), (24, " ".join(some(400)))]
    rows, want = [], set()

    def add(text, item=None):
        rows.append((len(rows) + 100, text))
        if item is not None:
            want.add((len(rows) + 99, item))

    for i in range(40):
        add(" ".join(some(80)))
    for i in range(20):
        words = items[i][1].split()
        add(" ".join(some(30) + words + some(30)), i)
        add(" ".join([*some(5), *(w.upper() + "," for w in words)]), i)
        for at in range(rnd.randrange(6), 30, 7):  # a substitution in every seven words
            words[at] = "changed"
        add(" ".join(some(30) + words + some(30)), i)
        add(" ".join(some(10) + items[i][1].split()[8:22] + some(10)), i)  # a passage of 14 words
        add(" ".join(some(10) + items[i][1].split()[8:16] + some(10)))  # too short a passage
    add(" ".join(some(9)) + " " + items[20][1] + " " + " ".join(some(9)), 20)
    add(items[24][1], 24)
    add("too short")
    return items, rows, want


def test_finds_planted_passages_and_leaves_the_rest(spark, make_docs):
    items, rows, want = case()
    rows += [(None, items[3][1]), (50, None), (51, ""), (52, items[4][1]), (52, items[4][1])]
    docs = make_docs(rows, extra=True)
    got = dc.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in got), key=str)
    assert pairs == sorted([*want, (None, 3), (52, 4), (52, 4)], key=str)
    assert all(r.n_equal >= 0.8 * r.n_tokens and r.n_tokens <= r.item_tokens for r in got)
    kept = dc.decontaminate(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    bad = {d for d, _ in want} | {None, 52}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if r[0] not in bad)


def test_parts_give_the_same_rows(spark, make_docs):
    items, rows, want = case()
    docs, bench = make_docs(rows), spark.createDataFrame(items, ITEMS)
    got = dc.contaminated(docs, bench, part_bytes=500)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = dc.decontaminate(docs, bench, part_bytes=500)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in want}


def test_empty_tables(spark, make_docs):
    items, rows, _ = case()
    empty = spark.createDataFrame([], ITEMS)
    assert dc.contaminated(make_docs(rows[:3]), empty).collect() == []
    assert dc.decontaminate(make_docs(rows[:3]), empty).count() == 3
    assert dc.contaminated(make_docs([]), spark.createDataFrame(items, ITEMS)).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_longest_stretch(seed):
    equal = np.random.default_rng(seed).random(int(np.random.default_rng(seed).integers(0, 25))) < 0.7
    stretches = [
        (b - a, int(equal[a:b].sum()), -a) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if equal[a] and equal[b - 1] and equal[a:b].sum() * 1000 >= 800 * (b - a)
    ]
    n, _, first = max(stretches, default=(0, 0, 0))
    assert dc.longest_stretch(equal, 0.8) == (-first, n)


def test_masks_ignore_positions():
    spans = [len(m) for m in dc.MASKS]
    assert all(m[0] == m[-1] == "1" and "0" in m for m in dc.MASKS) and max(spans) <= dc.STRETCH


@pytest.mark.parametrize("length", range(5, 21))
def test_every_accepted_change_is_found(length):
    item = [f"w{i}" for i in range(length)]
    changed = [c for k in range(length // 5 + 2) for c in itertools.combinations(range(length), k)]
    docs = ["before it " + " ".join("other" if i in c else w for i, w in enumerate(item)) + " after it" for c in changed]
    known = dc.Benchmark(pa.table({"item_id": [1], "text": [" ".join(item)]}))
    got = {d: (first, n, equal) for d, _, first, n, equal in known.overlaps(*dc.tokens(pa.array(docs)))}
    want = {}
    for d, c in enumerate(changed):
        equal = np.array([i not in c for i in range(length)])
        if length <= 13:
            if 5 * equal.sum() >= 4 * length:
                want[d] = (0, length, int(equal.sum()))
            continue
        first, n = dc.longest_stretch(equal, 0.8)
        if n >= 13:
            want[d] = (first, n, int(equal[first : first + n].sum()))
    assert got == want


@pytest.mark.parametrize("length", [5, 9, 10, 13])
def test_short_item_cut_by_the_end_of_a_document(length):
    item = [f"w{i}" for i in range(length)]
    known = dc.Benchmark(pa.table({"item_id": [1], "text": [" ".join(item)]}))
    docs = [" ".join(item[1:]), " ".join(item[:-1]), " ".join(item[: length // 2])]
    assert [(f[0], f[4]) for f in known.overlaps(*dc.tokens(pa.array(docs)))] == [(0, length - 1), (1, length - 1)]


def test_masks_hit_every_stretch_that_agrees():
    masks = [(len(m), int(m, 2)) for m in dc.MASKS]
    width = max(n for n, _ in masks)
    most = {(1, 1): 1}  # last tokens (bits), how many -> most of (equal tokens - 4 x changed ones) without a hit
    for n in range(2, 300):
        after = {}
        for (bits, have), score in most.items():
            for equal in (0, 1):
                now, size = (bits << 1 | equal) & ((1 << width) - 1), min(width, have + 1)
                if not any(size >= span and now & m == m for span, m in masks):
                    after[now, size] = max(after.get((now, size), -(10**6)), score + (1 if equal else -4))
        most = after
        assert n < dc.STRETCH or all(score < 0 for (bits, _), score in most.items() if bits & 1)


def test_items_of_few_tokens_are_searched_exactly(spark, make_docs):
    items = [(1, "Photosynthesis, chlorophyll!"), (2, "Honorificabilitudinitatibus"), (3, "of the"), (4, "Wie heißt die Hauptstadt?")]
    rows = [
        (10, "what photosynthesis chlorophyll does"),
        (11, "photosynthesis of chlorophyll"),
        (12, "photosynthesis"),
        (13, "HONORIFICABILITUDINITATIBUS"),
        (14, "of the of the"),
        (15, "wie heißt die hauptstadt"),
        (16, "wie heißt die stadt"),
    ]
    docs, bench = make_docs(rows), spark.createDataFrame(items, ITEMS)
    got = dc.contaminated(docs, bench).collect()
    assert sorted(tuple(r) for r in got) == [(10, 1, 2, 0, 2, 2), (13, 2, 1, 0, 1, 1), (15, 4, 4, 0, 4, 4)]
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench).collect()) == [11, 12, 14, 16]


def test_unspaced_scripts(spark, make_docs):
    items = [
        (1, "光合作用是植物利用阳光把二氧化碳和水转化为有机物的过程"),
        (2, "日本の首都はどこですか"),
        (3, "ประเทศไทยมีกี่จังหวัดในปัจจุบัน"),
        (4, "𠀀𠀁𠀂𠀃𠀄𠀅"),
    ]
    rows = [(10 + i, f"x {t} y") for i, t in items] + [(21, items[0][1].replace("阳光", "日光")), (22, "前文" + items[1][1] + "後文"), (23, "植物需要水和阳光"), (24, "word " * 20), (25, None)]
    docs, bench = make_docs(rows), spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): r.item_tokens for r in dc.contaminated(docs, bench).collect()}
    assert got == {(11, 1): 27, (12, 2): 11, (13, 3): len(items[2][1]), (14, 4): 6, (21, 1): 27, (22, 2): 11}
    assert sorted(r.doc_id for r in dc.decontaminate(docs, bench).collect()) == [23, 24, 25]


def test_tokens_of_unspaced_scripts_among_words():
    text = ["", "abc中文def", "é“x” ก.ข", None, "中"]
    _, bounds = dc.tokens(pa.array(text))
    assert np.diff(bounds).tolist() == [0, 4, 3, 0, 1]
    for code in [c for pair in dc.UNSPACED for c in pair]:
        apart = any(low <= code < high for low, high in dc.UNSPACED)
        assert np.diff(dc.tokens(pa.array([f"a{chr(code)}b"]))[1]).tolist() == [3 if apart else 1]
