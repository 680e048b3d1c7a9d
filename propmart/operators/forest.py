"""A saved forest as a table of nodes, and scoring by joins with it (M4, M5, M7).

The table can be queried (which features split, how many rows a node saw) and
scored with in plain DataFrame operations, wherever the fitted model itself
cannot be loaded.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propmart.operators.ml import MAX_DEPTH


def forest_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of the forest in a saved pipeline (K5), a row each.

    Columns tree, node (0 is a tree's root), prediction, n_rows, gain, left and
    right (null in a leaf), feature, threshold (of a number) and categories
    (that go left, of a category).
    """
    raw = spark.read.parquet(f"{model_path.rstrip('/')}/stages/*RandomForest*/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    number = F.col("split.numCategories") < 0
    value = F.col("split.leftCategoriesOrThreshold")
    return raw.select(
        "tree", F.col("id").alias("node"), "prediction", F.col("rawCount").alias("n_rows"), F.when(inner, F.col("gain")).alias("gain"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & number, F.get(value, F.lit(0))).alias("threshold"), F.when(inner & ~number, value).alias("categories"),
    )


def score_with_nodes(df: DataFrame, nodes: DataFrame, key: str, features: str = "features", depth: int = MAX_DEPTH, out: str = "prediction") -> DataFrame:
    """M7: (key, prediction) of rows with a feature vector, by one join per level.

    ``key`` must tell rows apart.  The node table is bounded by trees and depth
    and is broadcast, so rows stay where they are until the trees' answers
    meet: these are added in the order of the trees, as the model does, so
    predictions are the model's to the last bit.
    """
    n_trees = nodes.agg(F.max("tree")).first()[0] + 1
    rows = df.select(F.col(key), vector_to_array(F.col(features)).alias("__x")).withColumn("__tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).withColumn("__node", F.lit(0))
    table = F.broadcast(nodes.select(F.col("tree").alias("__t"), F.col("node").alias("__n"), "prediction", "left", "right", "feature", "threshold", "categories"))
    here = lambda r: r.join(table, (F.col("__tree") == F.col("__t")) & (F.col("__node") == F.col("__n")))
    value = F.get("__x", F.col("feature"))
    goes_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("categories", value))
    for _ in range(depth):
        step = F.when(F.col("left").isNull(), F.col("__node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        rows = here(rows).select(key, "__x", "__tree", step.alias("__node"))
    answers = F.array_sort(F.collect_list(F.struct("__tree", "prediction")))
    found = here(rows).groupBy(key).agg(answers.alias("__answers"))
    total = F.aggregate("__answers", F.lit(0.0), lambda s, a: s + a["prediction"])
    return found.select(key, (total / F.lit(float(n_trees))).alias(out))
