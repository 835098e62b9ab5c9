"""Exact quantiles equal NumPy's for every kind of values, however narrow the steps."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import explore, quantiles

RNG = np.random.default_rng(8)
SHARES = (0.0, 0.1, 0.5, 0.75, 0.999, 1.0)
VALUES = {
    "even number": RNG.normal(size=1000),
    "odd number": RNG.normal(size=1001),
    "over the whole range of doubles": 2.0 ** RNG.integers(-1000, 1000, 900) * RNG.choice([-1, 1], 900),
    "far outliers": np.concatenate([RNG.normal(size=500), [1e300, -1e300]]),
    "one value in a third of the rows": np.concatenate([np.full(400, 3.5), RNG.gamma(2, 3, 800)]),
    "constant": np.full(70, 2.0),
    "single": np.array([4.0]),
}


@pytest.mark.parametrize("kind", VALUES)
def test_equals_numpy(spark, kind):
    values = VALUES[kind]
    counts = spark.createDataFrame([("a", float(v), 1) for v in values] + [("b", 1.0, 2), ("b", None, 9)],
                                   "scale string, x double, n long").groupBy("scale", "x").agg(F.sum("n").alias("n"))
    got = quantiles.quantiles(counts, SHARES, cuts=4, held=8)
    for share in SHARES:
        assert got["a", share] == pytest.approx(np.quantile(values, share), rel=1e-12)
        assert got["b", share] == 1.0


def test_no_rows_and_missing_values(spark):
    counts = spark.createDataFrame([("a", None, 3)], "scale string, x double, n long")
    assert quantiles.quantiles(counts) == {}
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "sales_qty double")
    got = {r.scale: r for r in explore.summary(explore.value_counts(df)).collect()}
    assert got["raw"].n_rows == 2 and got["raw"].median == 2.5 and got["raw"].high == 4.0


def test_values_that_are_not_counted_together(spark):
    counts = spark.createDataFrame([("a", 1.0, 1)] + [("a", 2.0, 1)] * 50 + [("a", 3.0, 1)] * 49, "scale string, x double, n long")
    assert quantiles.quantiles(counts, (0.0, 0.4, 0.5, 1.0), cuts=4, held=8) == {
        ("a", 0.0): 1.0, ("a", 0.4): 2.0, ("a", 0.5): 2.0, ("a", 1.0): 3.0}


def test_many_distinct_doubles(spark):
    """More values than a task should hold: none reaches the driver but the last few thousand."""
    df = spark.range(2_000_001).select((F.pmod(F.col("id") * 1_000_003, F.lit(2_000_001)) / 7).alias("x"))
    counts = df.select(F.lit("a").alias("scale"), "x", F.lit(1).alias("n"))
    assert quantiles.quantiles(counts, (0.25, 0.5)) == {("a", 0.25): 500_000 / 7, ("a", 0.5): 1_000_000 / 7}
