import random

import corpus_pipeline
from propmart.llm.common import written

EN = "the dog and the cat do not walk over there because they were tired of all that".split()
FR = "le chien et la chatte ne traversent pas où ils étaient fatigués hier au soir".split()


def tables(spark, folder, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def text(seed, words, n=60):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "s", "ing"]) for _ in range(n))


def corpus():
    rows = [(i, text(i, EN if i % 3 else FR), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(80)]
    item = text(999, EN, 25)
    rows += [
        (100, rows[5][1], "en", "s1"),  # exact copy
        (101, rows[6][1] + " more", "en", "s1"),  # near copy
        (102, text(500, EN) + " " + item, "en", "s2"),  # benchmark passage
        (103, "12345 ... !!!", "en", "s0"),  # no letters
        (104, None, None, None),
        (105, "", "en", "s0"),
    ]
    return [(a, b, c, d, len(b or "")) for a, b, c, d in rows], [(0, item), (1, None)]


def test_decisions_take_effect(spark, tmp_dir):
    rows, items = corpus()
    tables(spark, tmp_dir, rows, items)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    columns, ids = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, tmp_dir), f"test-stage{number}")
        ids.append([r.doc_id for r in docs.select("doc_id").collect()])
        assert number == 4 or docs.columns == columns
    clean = set(range(80))
    assert set(ids[0]) == clean | {100, 101, 102}
    assert sorted(ids[1]) == sorted(clean | {102})
    assert sorted(ids[2]) == sorted(clean)
    assert set(ids[3]) <= clean and max(map(ids[3].count, ids[3])) <= 2
    words = len(" ".join(r[1] for r in rows if r[0] in clean).split())
    taken = sum(len(rows[i][1].split()) for i in ids[3])
    assert abs(taken - 1.5 * words) < 4 * 60
    assert sorted(ids[4]) == sorted(ids[3])
    starts = sorted((r.start, r.n_tokens) for r in docs.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts[:-1], starts[1:], strict=True))


def test_run_equals_the_stages_and_repeats(spark, tmp_dir):
    rows, items = corpus()
    tables(spark, tmp_dir, rows, items)
    runs = [sorted(map(tuple, corpus_pipeline.run(spark, tmp_dir).collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) > 80


def test_empty_tables(spark, tmp_dir):
    tables(spark, tmp_dir, [], [])
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []


def test_repeated_and_null_ids(spark, tmp_dir):
    rows, items = corpus()
    rows += [rows[3], (3, text(700, EN), "en", "s3", 9), (None, text(701, EN), "en", "s3", 9), (None, text(702, FR), "fr", None, 9)]
    tables(spark, tmp_dir, rows, items)
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, tmp_dir).collect()
    assert [r.doc_id for r in kept].count(3) == 2 and [r.doc_id for r in kept if r.text].count(None) == 2
    assert len({r.text for r in kept}) == len(kept)
    assert corpus_pipeline.run(spark, tmp_dir).count() > 80
