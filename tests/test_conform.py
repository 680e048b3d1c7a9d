import pytest
from pyspark.sql import types as T

from propmart.functions.conform import conform
from propmart.schemas import struct_of

SCHEMA = struct_of([("code", T.IntegerType()), ("price", T.IntegerType()), ("size", T.FloatType()), ("lift", T.BooleanType())])


def test_json_number_texts_become_ints(spark):
    raw = spark.createDataFrame([("921", "149000.0", "70.5", "true")], "code string, price string, size string, lift string")
    r = conform(raw, SCHEMA).first()
    assert (r.code, r.price, r.size, r.lift) == (921, 149000, 70.5, True)


def test_fraction_raises(spark):
    raw = spark.createDataFrame([("1", "1.5", None, None)], "code string, price string, size string, lift string")
    with pytest.raises(Exception, match="whole"):
        conform(raw, SCHEMA).collect()


def test_fraction_lenient_is_null(spark):
    raw = spark.createDataFrame([("1", "1.5", "x", None)], "code string, price string, size string, lift string")
    r = conform(raw, SCHEMA, on_error="null").first()
    assert (r.code, r.price, r.size, r.lift) == (1, None, None, None)


def test_overflow_raises(spark):
    raw = spark.createDataFrame([("300",)], "rooms string")
    with pytest.raises(Exception):
        conform(raw, struct_of([("rooms", T.ByteType())])).collect()


def test_missing_required_and_optional(spark):
    raw = spark.createDataFrame([("1",)], "code string")
    with pytest.raises(ValueError, match="price"):
        conform(raw, SCHEMA)
    out = conform(raw, SCHEMA, optional=["price", "size", "lift"])
    assert out.first().asDict() == {"code": 1, "price": None, "size": None, "lift": None}
    assert out.schema == SCHEMA


def test_struct_fields_cast(spark):
    target = struct_of([("p", T.StructType([T.StructField("has", T.BooleanType()), T.StructField("price", T.FloatType())]))])
    raw = spark.createDataFrame([(("true", "12.5"),), (None,)], "p struct<has:string,price:string>")
    rows = conform(raw, target).collect()
    assert rows[0].p.has is True and rows[0].p.price == 12.5
    assert rows[1].p is None


def test_forced_string_keeps_null(spark):
    raw = spark.createDataFrame([(3,), (None,)], "floor int")
    rows = conform(raw, struct_of([("floor", T.StringType())])).collect()
    assert [r.floor for r in rows] == ["3", None]


def test_big_whole_numbers_stay_exact(spark):
    schema = T.StructType([T.StructField("v", T.LongType())])
    texts = ["9007199254740993", "9007199254740993.000", "-9223372036854775808", "1.49E5", " 7 ", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r.v for r in conform(df, schema).collect()] == [9007199254740993, 9007199254740993, -(2**63), 149000, 7, None]
    bad = spark.createDataFrame([(t,) for t in ("9223372036854775808", "0.5", "nan", "inf", "", "1e-19", "12.0000000000000000000001", ".", "e5", "1.2.3", "15e-1")], "v string")
    assert [r.v for r in conform(bad, schema, on_error="null").collect()] == [None] * 11
    whole = [("150e-1", 15), ("1.50E1", 15), ("-0.0", 0), (".0e9", 0), ("12.", 12), ("+1e3", 1000), ("0.00012e5", 12), ("1." + "0" * 40, 1)]
    df = spark.createDataFrame([(t,) for t, _ in whole], "v string")
    assert [r.v for r in conform(df, schema).collect()] == [v for _, v in whole]


def test_ranges(spark):
    schema = T.StructType([T.StructField("v", T.ShortType())])
    df = spark.createDataFrame([("0",), ("255",), ("256",), ("-1",), (None,)], "v string")
    assert [r.v for r in conform(df, schema, on_error="null", ranges={"v": (0, 255)}).collect()] == [0, 255, None, None, None]
    with pytest.raises(Exception, match="not in 0..255"):
        conform(df, schema, ranges={"v": (0, 255)}).collect()
