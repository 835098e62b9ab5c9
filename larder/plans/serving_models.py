"""Models that are trained once and then serve every forecast of the same data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from larder.models import lines
from larder.sources import store


def train_and_save(features: DataFrame, folder: str, grid=lines.GRID) -> DataFrame:
    """Train the line of every level, save each, and write the registry after all of them.

    A folder without a registry is not complete, whatever models it holds already, so a
    run that was interrupted is done again.
    """
    spark = features.sparkSession
    fitted = lines.fit(features, grid)
    entries = [
        (x.level, store.write_model(lines.as_model(x), folder, x.level), lines.FAMILY, x.val_rmse, x.n_train, x.n_val, x.n_test)
        for x in fitted
    ]
    return store.write_registry(spark, entries, folder)


def ensure_saved(spark: SparkSession, features, folder: str, grid=lines.GRID) -> str:
    """The folder, after training if it has no registry yet; `features()` is then asked for the rows."""
    try:
        trained = not store.saved_models(spark, folder).isEmpty()
    except AnalysisException:
        trained = False
    if not trained:
        train_and_save(features(), folder, grid)
    return folder
