import hashlib
import re
from collections import defaultdict

import pytest

from propmart.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(totals, share=1.5, most=2.0):
    """Share the budget by weight and reshare what lies above a cap until nothing does."""
    names = sorted((s for s in totals if s is not None), key=lambda s: s.encode()) + ([None] if None in totals else [])
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(totals.values()), set(names), {}
    while free:
        w = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / w >= most * totals[s]}
        if not full:
            out |= {s: left * weight[s] / w for s in free}
            break
        for s in full:
            out[s] = most * totals[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


def brute(rows):
    totals, seen = defaultdict(int), defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
    target = targets(totals)
    named = []
    for r in rows:
        seen[r[0], r[1], r[3]] += 1
        text = "" if r[1] is None else hashlib.md5(r[1].encode()).hexdigest()
        name = f"{'' if r[0] is None else r[0]}:{text}:{seen[r[0], r[1], r[3]]}:mix"
        named.append((hashlib.md5(name.encode()).hexdigest()[:15], *r))
    out = []
    for source, total in totals.items():
        mine = [(r[0], r[1], size(r[2])) for r in named if r[4] == source]
        whole = min(2, int(target[source] // total)) if total else 0
        need = target[source] - whole * total
        for h, doc_id, n in mine:
            below, unit = sum(x for g, _, x in mine if g < h), sum(x for g, _, x in mine if g == h)
            out.append((doc_id, n, total, pytest.approx(target[source]), n * (whole + (2 * below + unit < 2 * need))))
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[4]))


def found(df):
    return sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in df.collect()), key=lambda r: (str(r[0]), r[1], r[4]))


def case():
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 90)), "en", f"s{i % 5 if i % 3 else 0}") for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", "s2"), (1002, "a b", "en", None), (None, "c d e", "en", None), (None, "x", "en", "s1")]
    rows += [(1003, "rep eat ed", "en", "s3")] * 2 + [(1004, "only", "en", "é"), (1005, None, "en", "empty")]
    return rows + [(1006, "tab\tfeed\x0bsep\xa0arated", "en", "Z")]


def test_against_brute_force(spark, make_docs):
    rows = case()
    got = found(mixing.mix_report(make_docs(rows, extra=True)))
    assert got == brute(rows)
    taken = defaultdict(int)
    for r, row in zip(sorted(rows, key=lambda r: (str(r[0]), size(r[1]))), got, strict=True):
        taken[r[3]] += row[4]
        assert row[4] <= 2 * row[1]
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
    goal = targets(totals)
    assert all(abs(taken[s] - goal[s]) <= 90 for s in totals)


def test_reruns_and_partitions_agree(spark, make_docs):
    docs = make_docs(case())
    assert found(mixing.mix_report(docs)) == found(mixing.mix_report(docs.repartition(7)))


def test_mix_repeats_and_drops_rows(spark, make_docs):
    rows = [r for r in case() if r[0] is not None and r[0] != 1003]  # ids that name one row
    docs = make_docs(rows, extra=True)
    kept = mixing.mix(docs)
    assert kept.columns == docs.columns
    copies = defaultdict(int)
    for r in kept.collect():
        copies[r.doc_id] += 1
    for doc_id, n, _, _, taken in brute(rows):
        assert copies[doc_id] == (1 if n == 0 else taken // n)


def test_empty_table(spark, make_docs):
    assert mixing.mix_report(make_docs([])).collect() == [] and mixing.mix(make_docs([])).collect() == []


def test_tables_without_words(spark, make_docs):
    docs = make_docs([(1, None), (2, "")])
    assert [r.taken for r in mixing.mix_report(docs).collect()] == [0, 0]
    assert mixing.mix(docs).count() == 2


@pytest.mark.parametrize("key", [None, 7])
def test_rows_of_one_id_come_near_the_target(spark, make_docs, key):
    """Sums only, whatever the hash is: many rows of one id, also of one text."""
    rows = [(key, " ".join(["w"] * (1 + (i if i % 2 else 0) % 5)), "en", f"s{i % 3}") for i in range(3000)]
    rows += [(key, None, "en", "s0"), (key, "", "en", "s1")] * 3
    docs = make_docs(rows, extra=True)
    totals, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r["size"] for r in got)
    goal = targets(totals)
    for r in got:
        taken[r.target] += r.taken
    assert sorted(taken) == pytest.approx(sorted(set(goal.values())))
    assert all(abs(n - t * sum(g == pytest.approx(t) for g in goal.values())) <= 5 * 3 for t, n in taken.items())
    kept = mixing.mix(docs)
    words = sum(size(r.text) for r in kept.select("text").collect())
    assert abs(words - sum(goal.values())) <= 15 and kept.columns == docs.columns
