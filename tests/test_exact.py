import math
import random

import pytest
from pyspark.sql import functions as F

from propmart.operators.exact import exact_average, exact_sums


@pytest.fixture(scope="module")
def values():
    rnd = random.Random(6)
    groups = {
        "prices": [round(rnd.uniform(1, 10**6), 2) for _ in range(3000)],
        "wide": [rnd.choice([-1, 1]) * rnd.random() * 2.0 ** rnd.randrange(-200, 200) for _ in range(500)],
        "cancel": [1e300, 1.0, -1e300, 1e-200, -1.0],
        "tie": [1.0, 2.0**-53, 2.0**-106],
        "tie even": [1.0, 2.0**-53],
        "negative": [-0.1] * 11,
        "zero": [0.0, -0.0, None],
        "none": [None],
        "nan": [1.0, float("nan")],
        "inf": [float("inf"), 2.0],
        "one": [rnd.random()],
    }
    for i in range(150):
        groups[f"g{i}"] = [rnd.uniform(-1, 1) * 10 ** rnd.randrange(0, 20) for _ in range(rnd.randrange(1, 40))]
    return groups


def test_sums_are_exact_and_the_same_for_every_partitioning(spark, values):
    rows = [(k, v) for k, vs in values.items() for v in vs]
    seen = []
    for seed, parts in ((1, 1), (2, 3), (3, 7)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        seen.append({r.k: (r.total, r.n) for r in exact_sums(df, ["k"], "v").collect()})
    assert all(repr(sorted(s.items())) == repr(sorted(seen[0].items())) for s in seen)
    for k, vs in values.items():
        there = [v for v in vs if v is not None]
        total, n = seen[0][k]
        assert n == len(there)
        want = math.fsum(there) if there else None
        assert total == want or (want is not None and math.isnan(want) and math.isnan(total)), k


def test_average_and_empty(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", None)], "k string, v double")
    got = {r.k: r.avg for r in exact_average(df, ["k"], F.col("v") * 2).collect()}
    assert got == {"a": math.fsum([0.2, 0.4, 0.6]) / 3, "b": None}
    assert exact_sums(df.limit(0), ["k"], "v").count() == 0
