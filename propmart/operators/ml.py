"""Price model and model metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.schemas import ML_CATEGORICAL, ML_LABEL, ML_NUMERIC, ML_SEED, SEGMENT_COLUMNS


MAX_DEPTH = 5  # of the forest's trees


def segment_average(
    df: DataFrame, by: Sequence[str] = SEGMENT_COLUMNS, value: str = ML_LABEL, out: str = "avg"
) -> DataFrame:
    """``avg(value) over (partition by by... rows unbounded both ways)``.

    Same values as that window, computed as an aggregate joined back on the
    segment keys (null-safe, as window partitions group nulls together).  The
    aggregate combines map-side; adaptive execution broadcasts a small one and
    splits hot segments of a large one.  Nothing is sorted per segment and no
    job runs when the plan is built.
    """
    by = list(by)
    seg = df.groupBy(*by).agg(F.avg(value).alias(out))
    seg = seg.select(*[F.col(c).alias(f"__seg{i}") for i, c in enumerate(by)], out)
    cond = None
    for i, c in enumerate(by):
        e = df[c].eqNullSafe(F.col(f"__seg{i}"))
        cond = e if cond is None else cond & e
    return df.join(seg, cond, "inner").select(*[df[c] for c in df.columns], F.col(out))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """M6: deterministic train/test split on ``md5(key)``.

    The first 60 bits of the MD5 of the key's text are compared with the
    fraction, so any fraction is met to about one row in its key count.
    Unlike ``randomSplit`` the result does not depend on partitioning or row
    order.
    """
    in_train = split_label(F.col(key), train_fraction) == "train"
    return df.where(in_train), df.where(~in_train)


SPLIT_HEX = 15  # hexadecimal digits compared: 60 bits


def split_label(key, train_fraction: float = 0.8):
    """Column 'train'/'test' of ``hash_split``; a null key is hashed as empty text."""
    threshold = int(train_fraction * 16**SPLIT_HEX)
    text = F.coalesce(key.cast("string"), F.lit(""))
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, SPLIT_HEX), 16, 10).cast("long")
    return F.when(place < threshold, F.lit("train")).otherwise(F.lit("test"))


def string_indexers(categorical: Sequence[str] = ML_CATEGORICAL) -> list[StringIndexer]:
    """M1: label -> index by frequency desc (ties by label), unseen kept."""
    return [
        StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep", stringOrderType="frequencyDesc")
        for c in categorical
    ]


def one_hot_encoder(categorical: Sequence[str] = ML_CATEGORICAL) -> OneHotEncoder:
    """M2: one-hot with the last slot dropped: an unseen label encodes as zeros."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in categorical],
        outputCols=[f"{c}_encoded" for c in categorical],
        dropLast=True,
    )


def price_pipeline(
    categorical: Sequence[str] = ML_CATEGORICAL,
    numeric: Sequence[str] = ML_NUMERIC,
    label: str = ML_LABEL,
    seed: int = ML_SEED,
    num_trees: int = 20,
    max_depth: int = MAX_DEPTH,
) -> Pipeline:
    """M1-M5: indexers, encoders, assembler (M3), random forest (M4, fixed seed),
    in that order as one pipeline (M5)."""
    assembler = VectorAssembler(
        inputCols=list(numeric) + [f"{c}_encoded" for c in categorical], outputCol="features", handleInvalid="error"
    )
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed
    )
    return Pipeline(stages=[*string_indexers(categorical), one_hot_encoder(categorical), assembler, forest])


def model_input(df: DataFrame, numeric: Sequence[str] = ML_NUMERIC, label: str = ML_LABEL) -> DataFrame:
    """Rows the assembler can take: label and numeric features not null."""
    cond = F.col(label).isNotNull()
    for c in numeric:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M7: score rows with a fitted pipeline."""
    return model.transform(df)


def linear_fit(df: DataFrame, label: str, feature: str, by: Sequence[str] = ()) -> DataFrame:
    """M8 (one feature): least-squares slope and intercept per group, one aggregate."""
    aggs = [
        F.regr_slope(F.col(label), F.col(feature)).alias("slope"),
        F.regr_intercept(F.col(label), F.col(feature)).alias("intercept"),
        F.regr_count(F.col(label), F.col(feature)).alias("n"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def sgd_linear(
    df: DataFrame, label: str, features: Sequence[str], by: Sequence[str] = (), step: float = 1.0, iterations: int = 100, tolerance: float = 0.001
) -> DataFrame:
    """M8: least squares by gradient descent over all rows, without intercept.

    From weights 0, iteration i subtracts ``step / sqrt(i)`` times the mean
    gradient ``(w.x - y) x``, and the descent stops after ``iterations`` or
    once the weights move by less than ``tolerance * max(|w|, 1)``.  The
    mean gradient depends on the rows through their second moments alone, so
    one aggregate of k * (k + 3) / 2 sums per group serves all iterations,
    which are then folded over the moments.  Rows with a null are left out; a
    group without rows gives none.  Columns: ``by``, weights (array in the
    order of ``features``), steps (iterations made).
    """
    k = len(features)
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    rows = df.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in (*x, y)]))
    sums = [F.avg(x[i] * x[j]).alias(f"__m{i}_{j}") for i in range(k) for j in range(i, k)] + [F.avg(x[i] * y).alias(f"__b{i}") for i in range(k)]
    moments = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *sums).where("__n > 0")
    m = lambda i, j: F.col(f"__m{min(i, j)}_{max(i, j)}")

    def advance(state: Column, i: Column) -> Column:
        w = state["w"]
        rate = F.lit(float(step)) / F.sqrt(i.cast("double"))
        new = F.array(*[F.get(w, F.lit(a)) - rate * (reduce(lambda p, q: p + q, [m(a, b) * F.get(w, F.lit(b)) for b in range(k)]) - F.col(f"__b{a}")) for a in range(k)])
        norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda t, e: t + e * e))
        moved = norm(F.zip_with(new, w, lambda p, q: p - q))
        done = moved < F.lit(float(tolerance)) * F.greatest(norm(new), F.lit(1.0))
        return F.when(state["done"], state).otherwise(F.struct(new.alias("w"), (state["steps"] + 1).alias("steps"), done.alias("done")))

    start = F.struct(F.array(*[F.lit(0.0)] * k).alias("w"), F.lit(0).alias("steps"), F.lit(False).alias("done"))
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, advance)
    return moments.select(*by, folded.alias("s")).select(*by, F.col("s.w").alias("weights"), F.col("s.steps").alias("steps"))


def fit_linear_model(df: DataFrame, label: str, features: Sequence[str]):
    """M8 (any number of features): ``pyspark.ml`` linear regression."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="lr_features").transform(model_input(df, features, label))
    return LinearRegression(featuresCol="lr_features", labelCol=label, solver="normal").fit(assembled)


def regression_metrics(pred: DataFrame, label: str = ML_LABEL, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rmse, mae and r2 in one aggregate (r2 against the label mean).

    Same definitions as ``RegressionEvaluator``; rows with a null label or
    prediction are ignored.  Where all labels are equal (or there is one row)
    r2 is undefined and null.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = pred.where(y.isNotNull() & p.isNotNull())
    err = y - p
    aggs = [
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(y).alias("n"),
    ]
    return both.groupBy(*by).agg(*aggs) if by else both.agg(*aggs)


def evaluate(pred: DataFrame, label: str = ML_LABEL, prediction: str = "prediction") -> dict[str, float]:
    """A7 as the evaluator computes it (one small job per metric)."""
    out = {}
    for metric in ("rmse", "r2", "mae"):
        out[metric] = RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(pred)
    return out
