"""Lines from moments equal lines from rows; saved models serve without training."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from larder.catalog import queries as catalog
from larder.models import lines
from larder.operators import features, rollup
from larder.plans import forecasting, serving_models
from larder.schemas import FEATURES, LEVELS
from larder.sources import store
from larder.sources.driver_tables import fingerprint

LEVEL = "5_subgroup_province"


@pytest.fixture(scope="module")
def table(month_star):
    return features.all_level_features(month_star).persist()


@pytest.fixture(scope="module")
def by_hand(table):
    """Inputs, target and day of each row by level, as arrays."""
    found = {}
    for level, data in table.toPandas().groupby("level"):
        x = data[list(FEATURES)].astype(float).fillna(0).to_numpy()
        days = np.array([d.day for d in data.full_date])
        found[level] = x, data.log_sales_qty.to_numpy(dtype=float), days
    return found


@pytest.fixture(scope="module")
def moments(table):
    return {(r.level, r.split): lines.Moments.of(r) for r in lines.moment_rows(table).collect()}


def test_moments_equal_those_of_the_rows(by_hand, moments):
    assert {level for level, _ in moments} == set(LEVELS)
    for level, (x, y, days) in by_hand.items():
        for split, here in (("train", days <= 21), ("val", (days > 21) & (days <= 26)), ("test", days > 26)):
            m, both = moments[level, split], np.column_stack([x, y])[here]
            assert m.n == len(both)
            assert m.mean == pytest.approx(both.mean(axis=0), rel=1e-9, abs=1e-9)
            assert m.cov == pytest.approx(np.cov(both.T, bias=True), rel=1e-7, abs=1e-7)


def test_the_free_line_equals_least_squares(by_hand, moments):
    for level, (x, y, days) in by_hand.items():
        intercept, weights = lines.solve(moments[level, "train"])
        full = np.column_stack([np.ones(len(x)), x])
        want = full @ np.linalg.lstsq(full[days <= 21], y[days <= 21], rcond=None)[0]
        assert (intercept + x @ weights)[days <= 21] == pytest.approx(want[days <= 21], abs=1e-6)
        val = (days > 21) & (days <= 26)
        direct = np.sqrt(np.mean((intercept + x[val] @ weights - y[val]) ** 2))
        assert lines.rmse(moments[level, "val"], intercept, weights) == pytest.approx(direct, rel=1e-6)


@pytest.mark.parametrize("l1,l2", [(0.0, 0.1), (0.05, 0.0), (0.02, 0.3)])
def test_shrunk_lines_are_at_their_least(by_hand, l1, l2, moments):
    """No weight can move either way and lower the objective, computed from the rows."""
    x, y, days = by_hand[LEVEL]
    x, y = x[days <= 21], y[days <= 21]
    _, weights = lines.solve(moments[LEVEL, "train"], l1, l2)
    spread = x.std(axis=0)
    spread[spread < 1e-9] = 1.0
    unit, u = (x - x.mean(axis=0)) / spread, weights * spread

    def objective(u):
        miss = y - y.mean() - unit @ u
        return miss @ miss / (2 * len(y)) + l1 * np.abs(u).sum() + l2 / 2 * u @ u

    least = objective(u)
    for i in range(len(u)):
        for step in (1e-3, -1e-3):
            moved = u.copy()
            moved[i] += step
            assert objective(moved) >= least - 1e-9
    if not l1:
        inner = unit.T @ unit / len(y)
        assert u == pytest.approx(np.linalg.solve(inner + l2 * np.eye(len(u)), unit.T @ (y - y.mean()) / len(y)), abs=1e-6)


def test_the_setting_with_the_least_validation_error_is_kept(table, moments):
    for line in lines.fit(table):
        errors = [lines.rmse(moments[line.level, "val"], *lines.solve(moments[line.level, "train"], **s)) for s in lines.GRID]
        assert line.val_rmse == min(errors) and line.setting == lines.GRID[int(np.argmin(errors))]


def test_levels_that_cannot_train_have_no_line(table):
    early = table.where(F.dayofmonth("full_date") <= 26)
    late = table.where(F.dayofmonth("full_date") > 21)
    assert lines.fit(early) == [] and lines.fit(late) == [] and lines.fit(table.limit(0)) == []
    assert lines.predicted([], table).isEmpty()
    kept = table.where(~F.dayofmonth("full_date").between(22, 26))
    assert all(x.val_rmse is None and x.n_val == 0 and x.setting == lines.GRID[0] for x in lines.fit(kept))


def test_missing_inputs_count_as_zero_and_rows_without_a_log_are_left_out(table):
    level = table.where(F.col("level") == LEVEL)
    holed = level.withColumn("lag_3", F.when(F.col("lag_1") > 10, F.lit(float("nan"))).otherwise(F.col("lag_3")))
    zeroed = level.withColumn("lag_3", F.when(F.col("lag_1") > 10, 0.0).otherwise(F.col("lag_3")))
    (a,), (b,) = lines.fit(holed), lines.fit(zeroed)
    assert a.weights == pytest.approx(b.weights, rel=1e-6) and a.intercept == pytest.approx(b.intercept, rel=1e-6)
    nulled = level.withColumn("log_sales_qty", F.when(F.dayofmonth("full_date") != 12, F.col("log_sales_qty")))
    assert lines.fit(nulled)[0].n_train == level.where("dayofmonth(full_date) <= 21 and dayofmonth(full_date) <> 12").count()


def test_forecasts_of_all_levels_equal_the_saved_models(spark, table, tmp_path):
    folder = str(tmp_path / "m")
    registry = serving_models.train_and_save(table, folder)
    assert {r.level for r in registry.collect()} == set(LEVELS)
    got = lines.predicted(lines.fit(table), table)
    for r in registry.collect():
        inputs = table.where(F.col("level") == r.level).where("dayofmonth(full_date) > 26").withColumn(
            "is_weekend", F.col("is_weekend").cast("int")).fillna(0.0, list(FEATURES))
        want = store.load_model(r.path).transform(inputs).select(F.expm1("prediction").alias("p"))
        mine = sorted(x.predicted for x in got.where(F.col("level") == r.level).collect())
        assert mine == pytest.approx(sorted(x.p for x in want.collect()), rel=1e-9)


def test_models_are_trained_once(spark, table, tmp_path):
    folder = str(tmp_path / "m")
    asked = []

    def source():
        asked.append(1)
        return table

    serving_models.ensure_saved(spark, source, folder)
    serving_models.ensure_saved(spark, source, folder)
    assert len(asked) == 1
    level, _ = store.load_preferred(spark, folder)
    assert level == LEVEL


def test_an_interrupted_run_is_done_again(spark, table, tmp_path):
    folder = str(tmp_path / "m")
    (line, *_) = lines.fit(table)
    store.write_model(lines.as_model(line), folder, line.level)
    with pytest.raises(FileNotFoundError):
        store.load_preferred(spark, folder)
    (tmp_path / "m" / "registry" / "run" / "_temporary").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        store.load_preferred(spark, folder)
    serving_models.ensure_saved(spark, lambda: table, folder)
    assert store.saved_models(spark, folder).count() == len(LEVELS)


def test_a_loaded_model_serves_what_the_fitted_one_does(spark, month_star, table, tmp_path):
    serving_models.train_and_save(table, str(tmp_path / "m"))
    level, loaded = store.load_preferred(spark, str(tmp_path / "m"))
    fitted = lines.as_model(next(x for x in lines.fit(table) if x.level == level))
    daily = rollup.rollup_level(month_star, level)
    a, b = (rows(forecasting.one_day_forecast(m, daily, LEVELS[level], day(32)), *LEVELS[level][::2], "forecast")
            for m in (loaded, fitted))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert [r[2] for r in a] == pytest.approx([r[2] for r in b], rel=1e-9)


def test_forecast_queries_do_not_train(spark, folder, monkeypatch):
    catalog.models_of(spark, folder)

    def no_training(*_):
        raise AssertionError("trained again")

    monkeypatch.setattr(lines, "fit", no_training)
    for name in ("model_preference", "model_registry", "one_day_forecast", "forecast_record"):
        assert not catalog.QUERIES[name](spark, folder).isEmpty()


def test_the_mark_of_the_files_changes_with_them(spark, month_star, tmp_path):
    for name in ("lineitem", "part", "supplier", "nation"):
        month_star.stores.write.parquet(str(tmp_path / f"{name}.parquet"))
    before = fingerprint(spark, str(tmp_path))
    assert fingerprint(spark, str(tmp_path)) == before
    month_star.stores.limit(1).write.mode("append").parquet(str(tmp_path / "part.parquet"))
    assert fingerprint(spark, str(tmp_path)) != before
