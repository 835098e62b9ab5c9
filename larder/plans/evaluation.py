"""Score stored predictions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from larder.operators import metrics
from larder.sources import store


def evaluate_stored(spark: SparkSession, predictions_path: str, metrics_path: str) -> str | None:
    """Write the metric table of stored predictions and return the best model's name."""
    table = metrics.evaluate(store.read_predictions(spark, predictions_path))
    store.write_metrics(table, metrics_path)
    best = metrics.best_model(table).first()
    return None if best is None else best["model"]
