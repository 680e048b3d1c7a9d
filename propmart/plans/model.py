"""Price model on the formatted listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propmart.operators.ml import hash_split, model_input, predict, price_pipeline, regression_metrics, segment_average
from propmart.schemas import FORMATTED_LISTING_SCHEMA, ML_CATEGORICAL, ML_LABEL, ML_NUMERIC, ML_SEED, ML_TRAIN_FRACTION, PREDICTION_COLUMNS
from propmart.session import checkpoint_dir, cut_lineage
from propmart.sources.parquet import read_zone
from propmart.sources.sinks import save_model, write_zone

def train_price_model(
    spark: SparkSession,
    listings: DataFrame,
    model_path: str | None = None,
    seed: int = ML_SEED,
    train_fraction: float = ML_TRAIN_FRACTION,
    key: str = "propertyCode",
    materialize: bool = False,
):
    """Split, fit, save, score and measure.

    Returns (model, predictions, metrics).  The indexers read the training
    rows once each and the forest persists its own bagged copy of them, so a
    training set that is a filter over a written table (the formatted zone)
    needs nothing more: a lost executor re-reads the table.  When the input
    comes out of a long computed plan, ``materialize=True`` writes the
    training rows to the cluster's checkpoint folder first.
    """
    rows = model_input(listings, ML_NUMERIC, ML_LABEL)
    train, test = hash_split(rows, key, train_fraction)
    if materialize:
        if checkpoint_dir(spark) is None:
            raise RuntimeError("materialize=True needs spark.checkpoint.dir")
        train = cut_lineage(train)
    model = price_pipeline(ML_CATEGORICAL, ML_NUMERIC, ML_LABEL, seed).fit(train)
    if model_path:
        save_model(model, model_path)
    predictions = predict(model, test)
    metrics = regression_metrics(predictions, ML_LABEL, "prediction")
    return model, predictions.select(*PREDICTION_COLUMNS), metrics


def build_model(spark: SparkSession, formatted_dir: str, model_path: str, seed: int = ML_SEED, segments_path: str | None = None):
    """G4 entry: read formatted listings, train, save.

    ``segments_path`` also writes every listing next to the mean price of its
    segment (W1).
    """
    listings = read_zone(spark, f"{formatted_dir.rstrip('/')}/idealista", FORMATTED_LISTING_SCHEMA)
    if segments_path:
        write_zone(segment_average(listings), segments_path)
    return train_price_model(spark, listings, model_path, seed)
