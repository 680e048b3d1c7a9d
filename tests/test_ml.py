from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from propmart.operators.ml import (
    evaluate,
    fit_linear_model,
    hash_split,
    linear_fit,
    one_hot_encoder,
    price_pipeline,
    regression_metrics,
    segment_average,
    string_indexers,
)

PART = "/root/testdata/sf0.001/part.parquet"


def test_segment_average_equals_full_window(spark):
    p = spark.read.parquet(PART).select("p_partkey", "p_brand", "p_type", "p_retailprice")
    p = p.union(spark.createDataFrame([(-1, None, None, 5.0), (-2, None, None, 7.0)], p.schema))
    got = segment_average(p, ["p_brand", "p_type"], "p_retailprice", "avg")
    w = Window.partitionBy("p_brand", "p_type").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = p.withColumn("avg", F.avg("p_retailprice").over(w))
    norm = lambda df: sorted((r.p_partkey, round(r.avg, 9)) for r in df.collect())
    assert norm(got) == norm(want)
    assert dict((r.p_partkey, r.avg) for r in got.where("p_partkey < 0").collect()) == {-1: 6.0, -2: 6.0}


def test_hash_split_is_deterministic(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    tr1, te1 = hash_split(o, "o_orderkey")
    tr2, _ = hash_split(o.repartition(5), "o_orderkey")
    a = sorted(r[0] for r in tr1.collect())
    assert a == sorted(r[0] for r in tr2.collect())
    assert tr1.count() + te1.count() == o.count()
    assert 0.7 < len(a) / o.count() < 0.9


def test_indexer_order_and_unseen_one_hot(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("a",)], "cat string")
    idx = string_indexers(["cat"])[0].fit(train)
    assert idx.labels == ["a", "b", "c"]  # frequency desc, ties by label
    test = spark.createDataFrame([("a",), ("zzz",)], "cat string")
    enc = one_hot_encoder(["cat"]).fit(idx.transform(train))
    out = enc.transform(idx.transform(test)).select("cat", vector_to_array("cat_encoded").alias("v")).collect()
    vec = {r.cat: r.v for r in out}
    assert vec["a"] == [1.0, 0.0, 0.0]
    assert vec["zzz"] == [0.0, 0.0, 0.0]  # unseen -> all zeros


def test_forest_pipeline_and_metrics(spark):
    p = spark.read.parquet(PART).select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    train, test = hash_split(p, "p_partkey")
    model = price_pipeline(["p_brand", "p_type"], ["p_size"], "p_retailprice", num_trees=5, max_depth=3).fit(train)
    stages = [type(s).__name__ for s in model.stages]
    assert stages == ["StringIndexerModel", "StringIndexerModel", "OneHotEncoderModel", "VectorAssembler", "RandomForestRegressionModel"]
    pred = model.transform(test)
    m = regression_metrics(pred, "p_retailprice").first()
    ev = evaluate(pred, "p_retailprice")
    assert abs(m.rmse - ev["rmse"]) < 1e-6 and abs(m.mae - ev["mae"]) < 1e-6 and abs(m.r2 - ev["r2"]) < 1e-6


def test_linear_fit_matches_estimator(spark):
    p = spark.read.parquet(PART)
    closed = linear_fit(p, "p_retailprice", "p_size").first()
    lr = fit_linear_model(p, "p_retailprice", ["p_size"])
    assert abs(closed.slope - lr.coefficients[0]) < 1e-6
    assert abs(closed.intercept - lr.intercept) < 1e-4


def test_linear_model_on_rows_made_here(spark):
    """S13 + M8: three (price, average rent) rows; rent ~ price by least squares."""
    import numpy as np

    rows = [(120000.0, 500.0), (90000.0, 610.5), (210000.0, 1000.25)]
    df = spark.createDataFrame(rows, "price double, avg_rent double")
    model = fit_linear_model(df, "avg_rent", ["price"])
    slope, intercept = np.polyfit([r[0] for r in rows], [r[1] for r in rows], 1)
    assert abs(model.coefficients[0] - slope) < 1e-9
    assert abs(model.intercept - intercept) < 1e-6
    closed = linear_fit(df, "avg_rent", "price").first()
    assert abs(closed.slope - slope) < 1e-9 and closed.n == 3


def test_gradient_descent_steps(spark):
    import math
    import random

    from propmart.operators.ml import sgd_linear

    rnd = random.Random(2)
    rows = [("g", rnd.random(), rnd.random(), rnd.random()) for _ in range(50)] + [("h", 0.5, 1.0, 2.0), ("h", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, a double, b double, y double")

    def plain(data, step, iterations, tolerance):
        w = [0.0, 0.0]
        for i in range(1, iterations + 1):
            g = [sum((w[0] * a + w[1] * b - y) * x[j] for a, b, y in data for x in [(a, b)]) / len(data) for j in range(2)]
            new = [w[j] - step / math.sqrt(i) * g[j] for j in range(2)]
            moved, w = math.dist(new, w), new
            if moved < tolerance * max(math.hypot(*w), 1.0):
                return w, i
        return w, iterations

    for step, iterations, tolerance in ((1.0, 100, 0.001), (0.5, 7, 0.0), (1.0, 100, 0.05)):
        got = {r.k: (r.weights, r.steps) for r in sgd_linear(df, "y", ["a", "b"], ["k"], step, iterations, tolerance).collect()}
        for key in ("g", "h"):
            w, n = plain([r[1:] for r in rows if r[0] == key and None not in r], step, iterations, tolerance)
            assert got[key][1] == n
            assert all(abs(p - q) < 1e-9 for p, q in zip(got[key][0], w, strict=True))
    assert sgd_linear(df.limit(0), "y", ["a"]).count() == 0
