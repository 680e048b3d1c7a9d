"""The forest learns: it beats the mean on labels that depend on its inputs."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from propmart.operators.ml import hash_split, regression_metrics
from propmart.plans.analogs import QUERIES


def test_forest_beats_the_mean_predictor(spark):
    pred = QUERIES["M4_forest"](spark, SF_ORACLE).cache()
    m = regression_metrics(pred, "paid").first()
    mean = pred.agg(F.avg("paid")).first()[0]
    base = regression_metrics(pred.withColumn("prediction", F.lit(mean)), "paid").first()
    assert m.r2 > 0.5 and m.rmse < 0.7 * base.rmse and m.mae < 0.8 * base.mae


def test_metrics_of_equal_labels_have_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0, "a"), (1.0, 3.0, "a"), (5.0, 4.0, "b")], "price double, prediction double, g string")
    got = {r.g: (r.rmse, r.mae, r.r2, r.n) for r in regression_metrics(df, "price", "prediction", by=["g"]).collect()}
    assert got == {"a": (2.0**0.5, 1.0, None, 2), "b": (1.0, 1.0, None, 1)}


def test_small_fractions_get_their_share(spark):
    for fraction in (0.003, 0.5, 0.8):
        train, test = hash_split(spark.range(20_000), "id", fraction)
        n = train.count()
        assert n + test.count() == 20_000 and abs(n - 20_000 * fraction) < 4 * (20_000 * fraction * (1 - fraction)) ** 0.5
    train, test = hash_split(spark.createDataFrame([(None,), (1,)], "id long"), "id")
    assert train.count() + test.count() == 2


def test_node_table_predicts_as_the_model_does(spark, tmp_dir):
    from pyspark.ml import PipelineModel

    from propmart.operators.forest import forest_nodes, score_with_nodes
    from propmart.operators.ml import price_pipeline
    from propmart.sources.sinks import save_model

    rows = [(i, "abcde"[i % 5], float(i % 13), float((i * 7) % 100), float((i % 13) * 3 + ord("abcde"[i % 5]) % 3 + i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, kind string, x double, z double, y double")
    pipe = price_pipeline(categorical=["kind"], numeric=["x", "z"], label="y", num_trees=7, max_depth=4)
    save_model(pipe.fit(df), f"{tmp_dir}/m")
    scored = PipelineModel.load(f"{tmp_dir}/m").transform(df)
    nodes = forest_nodes(spark, f"{tmp_dir}/m")
    assert nodes.where("node = 0").count() == 7 and nodes.where("left IS NULL").count() == nodes.where("left IS NOT NULL").count() + 7
    got = {r.id: r.prediction for r in score_with_nodes(scored, nodes, "id", depth=4).collect()}
    assert got == {r.id: r.prediction for r in scored.collect()}
