import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from propmart.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, b, _ in held for t in b)
    out = Counter()
    for item, text in items:
        asked, scores = Counter(words(text)), []
        for place, (i, b, n) in enumerate(held):
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t, c in asked.items() if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, place))
        for rank, (s, absent, i, _) in enumerate(sorted(scores)[:k], 1):
            out[(item, rank, None if absent else i, -s)] += 1
    return out


def found(spark, make_docs, docs, items, extra=False, **how):
    asked = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        asked = asked.selectExpr("*", "1 AS rank", "2 AS score", "3 AS doc_id", "4 AS item", "5 AS __key")
    got = ranked.search(make_docs(docs, extra), asked, **how)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_equals_brute_force(spark, make_docs, block_bytes):
    rnd = random.Random(3)
    vocabulary = [a + b for a in ("the", "a", "Of", "é", "漢", "x1") for b in ("", "Ing", "s", "ok")]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", "\n", "-", " _ "]) for _ in range(n))
    docs = [(i, text(rnd.randrange(1, 60))) for i in range(150)] + [(i, "the Ok document, again") for i in range(500, 540)]
    items = [(i, text(rnd.randrange(1, 30))) for i in range(25)] + [(40, "document again again"), (41, "document again again"), (42, "nowhere")]
    assert found(spark, make_docs, docs, items, k=5, block_bytes=block_bytes) == brute(docs, items, 5)


def test_edges(spark, make_docs, edge_rows):
    items = [(1, "three four FIVE five"), (2, None), (3, ""), (4, "..."), (None, "id here"), (1, "three four FIVE five"), (5, "word3 and17 漢字 and17")]
    assert found(spark, make_docs, edge_rows, items, extra=True) == brute(edge_rows, items)
    assert not found(spark, make_docs, [], items)
    assert not found(spark, make_docs, [(1, None)], items)
    assert not found(spark, make_docs, edge_rows, [])


def test_very_long_text_is_cut_between_terms(monkeypatch):
    data = " ".join(f"w{i}" for i in range(5000)).encode()
    whole = [t for run in ranked.terms(data) for t in run]
    monkeypatch.setattr(ranked, "PART_BYTES", 100)
    runs = list(ranked.terms(data))
    assert len(runs) > 100 and [t for run in runs for t in run] == whole


def test_shared_sums_are_used_and_exact():
    rnd = random.Random(5)
    sets = [sorted(rnd.sample(range(12), rnd.randrange(1, 10))) for _ in range(30)]
    nodes, left = ranked.share(sets, 12)
    below = {i: Counter([i]) for i in range(12)}
    for i, (a, b) in enumerate(nodes):
        below[12 + i] = below[a] + below[b]
    assert [sum((below[x] for x in s), Counter()) for s in left] == [Counter(s) for s in sets]
    uses = Counter(x for s in left for x in s) + Counter(x for p in nodes for x in p)
    assert nodes and all(uses[12 + i] >= 1 for i in range(len(nodes)))
    assert len(nodes) + sum(len(s) - 1 for s in left) < sum(len(s) - 1 for s in sets)


def test_plan_scores_repeated_terms():
    plan = ranked.Plan.of([b"a b b", b"a b", b"b b a c", b""])
    value = {b"a": 3, b"b": 5, b"c": 7}
    term = np.array([plan.vocabulary[t] for t in value])
    table = plan.scores(np.zeros(3, np.int64), term, np.array(list(value.values())), 2)
    assert table.tolist() == [[13, 0], [8, 0], [20, 0], [0, 0]]
