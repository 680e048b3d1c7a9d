import csv
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fixtures import listing, write_text
from propmart.sources import splitting
from propmart.sources.raw import quarantined_listings, read_csv_by_name, read_json_inferred, read_listings


def whole(pieces, make, size):
    """All records of one file, its pieces fed in runs of three."""
    held, out = make(), []
    for i in range(0, len(pieces), 3):
        found, first = held.feed(pa.array(pieces[i : i + 3], pa.binary()))
        out += [first] if first is not None else []
        out += [x[1] if isinstance(x, tuple) else x for x in found]
    left = held.end(size)
    return [x for x in [*out, left or b""] if x.strip()]


def random_json(rnd, depth=0):
    kind = rnd.randrange(6 if depth < 3 else 4)
    if kind == 0:
        return rnd.randrange(-5, 10**12)
    if kind < 4:
        return "".join(rnd.choice(['"', "\\", "}", "{", "]", "[", ",", "é", "x", "\n", "漢"]) for _ in range(rnd.randrange(6)))
    if kind == 4:
        return [random_json(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return {f"k{i}": random_json(rnd, depth + 1) for i in range(rnd.randrange(4))}


def test_json_elements_equal_a_parser():
    rnd = random.Random(1)
    for _ in range(200):
        values = [random_json(rnd) for _ in range(rnd.randrange(12))]
        raw = json.dumps(values, indent=rnd.choice([None, 1]), ensure_ascii=rnd.random() < 0.5).encode()
        pieces = raw.split(b"}")
        pieces = pieces[:-1] if not pieces[-1] else pieces
        assert [json.loads(x) for x in whole(pieces, splitting.JsonArray, len(raw))] == values


def test_csv_lines_equal_a_parser():
    rnd = random.Random(2)
    for _ in range(200):
        rows = [["".join(rnd.choice(['"', ",", "\n", "a", "é"]) for _ in range(rnd.randrange(5))) for _ in range(3)] for _ in range(rnd.randrange(1, 12))]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(rows)
        lines = whole(out.getvalue().encode().split(b"\n"), splitting.CsvLines, 0)
        assert [next(csv.reader(io.StringIO(x.decode()))) for x in lines] == rows


def test_quote_inside_an_unquoted_cell_is_a_character():
    assert not splitting.leaves_open(b'5" pipe,3', False)
    assert splitting.leaves_open(b'a,"5" pipe', False) is False
    assert splitting.leaves_open(b'a, "open', False) and not splitting.leaves_open(b'still", 2', True)
    assert splitting.leaves_open(b'still"", 2', True)


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_arrays_over_many_splits(spark, tmp_dir, tiny_splits):
    rnd = random.Random(3)
    want = []
    for name, indent, n in (("a", None, 60), ("b", 1, 25), ("c", None, 1), ("d", None, 0)):
        rows = [{"id": f"{name}{i}", "v": random_json(rnd)} for i in range(n)]
        want += rows
        write_text(f"{tmp_dir}/j/{name}.json", ("﻿" if name == "b" else "") + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n" * (name == "b"))
    write_text(f"{tmp_dir}/j/one.json", json.dumps({"id": "one", "v": "x}" * 2000}))
    want.append({"id": "one", "v": "x}" * 2000})
    pieces = splitting.fragments(spark.read, f"{tmp_dir}/j", "*.json", "}")
    assert pieces.select("__file", "__start").distinct().count() > 10
    got = [json.loads(r.value.removeprefix("﻿")) for r in splitting.json_elements(pieces).collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_cut_off_and_bad_records_cost_themselves(spark, tmp_dir, tiny_splits):
    good = [listing(i, price=i) for i in range(20)]
    texts = [json.dumps(x) for x in good]
    write_text(f"{tmp_dir}/x/a.json", "[" + ",".join([*texts[:9], '{"propertyCode": 1 "price": 2}', *texts[9:], "7"]) + "]")
    write_text(f"{tmp_dir}/x/b.json", "[" + ",\n".join([*texts[:3], '{"propertyCode": 99, "price": {"a": 1}']))
    write_text(f"{tmp_dir}/x/c.json", "[" + texts[4][:-1] + ', "price": 77}]')
    rows = read_listings(spark, f"{tmp_dir}/x", on_error="null").collect()
    assert sorted(r.propertyCode for r in rows) == sorted([*range(20), 0, 1, 2, 4])
    assert {r.price for r in rows if r.source_file == "c.json"} == {77}  # the last value of a repeated key
    bad = {(r.source_file, r.problem, r.bad_text) for r in quarantined_listings(spark, f"{tmp_dir}/x").collect()}
    assert bad == {("a.json", "not JSON", '{"propertyCode": 1 "price": 2}'), ("a.json", "not a record", "7"), ("b.json", "not JSON", '\n{"propertyCode": 99, "price": {"a": 1}')}
    with pytest.raises(Exception, match="unreadable listing record"):
        read_listings(spark, f"{tmp_dir}/x").collect()


def test_csv_line_breaks_over_many_splits(spark, tmp_dir, tiny_splits):
    rnd = random.Random(5)
    want = []
    for name in ("a", "b"):
        rows = [[f"{name}{i}", "".join(rnd.choice(['"', ",", "\n", "x", "é"]) for _ in range(rnd.choice([3, 8, 900 * (i % 17 == 0)]))) + "."] for i in range(80)]
        want += rows
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([["key", "said"], *rows])
        write_text(f"{tmp_dir}/c/{name}.csv", out.getvalue())
    rows = read_csv_by_name(spark, f"{tmp_dir}/c", {"key": ["key"], "said": ["said"]})
    got = sorted((r.key, r.said) for r in rows.collect())
    assert got == sorted((k, v.strip(" ")) for k, v in want)
    assert rows.where(F.col("said").contains("\n")).count() > 40


def test_inferred_json_in_one_aggregate(spark, tmp_dir):
    write_text(f"{tmp_dir}/i/a.json", '[{"a": 1, "b": 1.5, "c d": {"e": "x"}, "l": [1, 2], "n": null, "m": 1}, 5]')
    write_text(f"{tmp_dir}/i/b.json", '[{"a": 3000000000, "b": 2, "m": "t", "z": true}, {oops}]')
    df = read_json_inferred(spark, f"{tmp_dir}/i")
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c d": "struct<e:string>", "l": "array<bigint>", "m": "string", "n": "string", "z": "boolean", "source_file": "string", "_corrupt_record": "string"}
    rows = {(r.a, r.b, r.m, r.z, r._corrupt_record, r.source_file) for r in df.collect()}
    assert rows == {(1, 1.5, "1", None, None, "a.json"), (3000000000, 2.0, "t", True, None, "b.json"), (None, None, None, None, "5", "a.json"), (None, None, None, None, " {oops}", "b.json")}


def test_a_text_file_is_written_without_a_sort(spark, monkeypatch):
    """The task of a file held all its texts in a sort."""
    from propmart.plans.analogs import _text_files

    def no_sort(*_, **__):
        raise AssertionError("the texts of a file are sorted")

    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", no_sort)
    rows = spark.range(1000).select((F.col("id") % 3).cast("int").alias("file"), F.col("id").cast("string").alias("value")).repartition(5)
    path = _text_files(rows, "texts", ["[", "[", "["], ",", "]")
    files = spark.read.text(path, wholetext=True).collect()
    assert sorted(sorted(json.loads(f.value)) for f in files) == [list(range(i, 1000, 3)) for i in range(3)]


def test_array_files_hold_repeated_keys(spark, tmp_dir):
    from propmart.plans.analogs import q_split_arrays

    orders = spark.range(40).select((F.col("id") % 10).alias("o_orderkey"), F.lit(1000.0).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_dir}/orders.parquet")
    got = q_split_arrays(spark, tmp_dir).groupBy("propertyCode").count().collect()
    assert sorted((r.propertyCode, r["count"]) for r in got) == [(i, 8) for i in range(10)]
