"""Build the stored feature tables of all levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators.encoding import with_first_seen
from larder.operators.features import all_level_features
from larder.operators.star import Star
from larder.schemas import CODED_IDS, LEVELS
from larder.sources import store


def build_feature_store(star: Star, folder: str) -> str:
    """Write the features of all levels, then each level again with its id codes.

    The sales are read once, for the plain features. Codes are made per level
    from the stored rows of that level alone. Returns the folder of the coded
    tables; code columns that a level does not use are NULL.
    """
    spark = star.sales.sparkSession
    plain, coded = f"{folder}/plain", f"{folder}/coded"
    store.write_features(all_level_features(star), plain)
    for level, keys in LEVELS.items():
        rows = store.read_features(spark, plain, level)
        if rows is None:
            continue
        with_codes = with_first_seen(rows, keys)
        codes = [f"{c}_enc" for c in CODED_IDS]
        missing = {c: F.lit(None).cast("int") for c in codes if c not in with_codes.columns}
        ordered = [c for c in rows.columns if c != "level"] + codes + ["level"]
        store.write_features(with_codes.withColumns(missing).select(*ordered), coded)
    return coded
