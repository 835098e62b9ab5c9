from __future__ import annotations

import datetime as dt
import statistics

import numpy as np
import pytest
from conftest import day, rows, sale
from pyspark.sql import functions as F

from larder.operators import metrics, replenish, serving, split
from larder.operators.serving import Request

PAIRS = "level string, model string, actual double, predicted double"


def scored(spark, pairs):
    data = [("l", "m", a, p) for a, p in pairs]
    return metrics.evaluate(spark.createDataFrame(data, PAIRS)).first()


def test_metrics_equal_a_hand_computation(spark):
    pairs = [(10.0, 12.0), (20.0, 15.0), (4.0, 4.5), (8.0, -1.0)]
    a, p = np.array(pairs).T
    r = scored(spark, pairs)
    rel = abs(a - p) / a
    assert r.RMSE == pytest.approx(np.sqrt(((a - p) ** 2).mean()), abs=1e-4)
    assert r.MAE == pytest.approx(abs(a - p).mean(), abs=1e-4)
    assert r.MAPE == pytest.approx(rel.mean() * 100, abs=0.01)
    assert r.PRED25 == 50.0  # exactly a quarter off does not count
    floor = np.maximum(np.minimum(a, p), 1e-6)
    assert r.MBRE == pytest.approx((abs(a - p) / floor).mean() * 100, rel=1e-9)
    assert r.MIBRE == pytest.approx((abs(a - p) / np.maximum(a, p)).mean() * 100, abs=0.01)
    assert r.mean_bias_pct == pytest.approx(((p - a) / a).mean() * 100, abs=0.01)
    assert r.N == 4


def test_missing_values_are_skipped_but_counted(spark):
    nan = float("nan")
    r = scored(spark, [(10.0, 11.0), (nan, 3.0), (5.0, nan), (None, 1.0), (0.0, 2.0)])
    assert r.N == 5
    assert r.MAE == pytest.approx(1.5)  # the zero actual counts here, not in percentages
    # A missing forecast has no error but is a miss: one of two is near.
    assert r.MAPE == pytest.approx(10.0) and r.PRED25 == 50.0


def test_metric_without_a_valid_row_is_missing(spark):
    r = scored(spark, [(0.0, 1.0), (-2.0, 1.0)])
    assert r.MAPE is None and r.PRED25 is None and r.MBRE is None
    assert r.RMSE is not None


def test_metric_order_for_positive_forecasts(spark):
    rng = np.random.default_rng(1)
    r = scored(spark, [tuple(map(float, x)) for x in rng.uniform(1, 50, (200, 2))])
    assert r.MIBRE <= r.MAPE <= r.MBRE and r.RMSE >= r.MAE and 0 <= r.PRED25 <= 100


def test_best_model_has_least_mean_mape(spark):
    table = spark.createDataFrame(
        [("a", 10.0), ("a", 30.0), ("b", 15.0), ("b", 16.0), ("c", None)], "model string, MAPE double"
    )
    assert metrics.best_model(table).first().model == "b"


def test_split_by_day_of_month(spark):
    df = spark.createDataFrame([(dt.date(2026, m, d),) for m in (3, 4) for d in (1, 21, 22, 26, 27)], "full_date date")
    got = rows(split.with_split(df), "full_date", "split")
    assert [s for _, s in got] == ["train", "train", "val", "val", "test"] * 2
    assert split.fit_rows(split.with_split(df)).count() == 8


# --- orders ---------------------------------------------------------------

def order_of(spark, forecast, cv, inventory):
    df = spark.createDataFrame([(forecast, cv, inventory)], "f double, cv double, i double")
    return replenish.stock_status(replenish.with_order(df, "f", "cv", "i")).first()


def test_order_rule_at_its_boundaries(spark):
    at_limit = order_of(spark, 10.0, 0.0, 30.0)
    assert at_limit.import_suggestion == 0 and at_limit.status == "ok" and at_limit.days_of_cover == 3
    assert order_of(spark, 10.0, 0.0, 30.01).import_suggestion == 0
    short = order_of(spark, 10.0, 0.2, -4.0)
    assert short.import_suggestion == 16.0 and short.safety_factor_pct == 20.0
    assert short.status == "alert" and short.is_short and short.days_of_cover is None
    capped = order_of(spark, 10.0, 5.0, 12.0)
    assert capped.safety_factor_pct == 40.0 and capped.import_suggestion == 2.0
    assert capped.status == "warn"


def test_subgroup_lines_equal_a_loop(month_star):
    cutoff = day(31)
    rolled = serving.serving_rollup(month_star, Request(day(30)), cutoff)
    data = rolled.collect()
    got = {r.subgroup_id: r for r in replenish.subgroup_details(rolled).collect()}
    assert set(got) == {r.subgroup_id for r in data}
    for group, line in got.items():
        mine = [r for r in data if r.subgroup_id == group]
        daily = [
            sum(r.sales_qty for r in mine if r.full_date == d)
            for d in sorted({r.full_date for r in mine})
        ]
        inventory = sum(r.opening_inventory for r in mine) / len(daily)
        cv = statistics.pstdev(daily[-7:]) / (statistics.mean(daily[-7:]) + 1e-6)
        safety = min(0.40, 0.15 + 0.25 * cv)
        forecast = daily[-1] * 1.05
        order = 0 if inventory > 3 * forecast else max(0, forecast * (1 + safety) - inventory)
        assert line.predicted_qty == pytest.approx(forecast, abs=0.006)
        assert line.opening_inventory == pytest.approx(inventory, abs=0.006)
        assert line.import_suggestion == pytest.approx(order, abs=0.006)
        assert line.safety_factor_pct == pytest.approx(safety * 100, abs=0.06)


def test_short_subgroup_uses_the_fixed_variation(make_star):
    star = make_star([sale(day(n), 1, 1, n * 10, "0") for n in (1, 2)])
    rolled = serving.serving_rollup(star, Request(day(3)), day(2))
    (line,) = replenish.subgroup_details(rolled).collect()
    assert line.safety_factor_pct == pytest.approx(18.8)  # 15 + 25 * 0.15, rounded
    assert line.subgroup_name == "leaf" and line.maingroup_name == "greens"


# --- serving --------------------------------------------------------------

def sold_days(star, request, cutoff):
    return [r.full_date for r in serving.serving_daily(
        serving.serving_rollup(star, request, cutoff)).orderBy("full_date").collect()]


def test_date_bounds_of_a_request(make_star):
    star = make_star([sale(day(n), 1, 1, n) for n in range(1, 6)])
    cutoff = star.cutoff()
    assert cutoff == day(5)
    assert sold_days(star, Request(day(4)), cutoff) == [day(1), day(2), day(3)]
    assert sold_days(star, Request(day(5)), cutoff)[-1] == day(4)
    assert sold_days(star, Request(day(9)), cutoff)[-1] == day(5)
    assert Request(day(9)).rollout_days(cutoff) == 4 and Request(day(5)).rollout_days(cutoff) == 0


def test_filters_of_a_request(make_star):
    star = make_star([sale(day(1), p, s, 1) for p in (1, 5, 7) for s in (1, 3)])
    count = lambda **f: serving.requested_sales(star, Request(day(2), **f), day(1)).count()
    assert count() == 6
    assert count(province_id=0, store_id="") == 6
    assert count(store_id="A") == 3 and count(province_id=200) == 3
    assert count(maingroup_id=1) == 4
    assert count(maingroup_id=2, subgroup_id=10) == 2  # the subgroup wins
    assert count(province_id=999) == 0


def test_latest_rows_are_repeatable(month_star):
    rolled = serving.serving_rollup(month_star, Request(day(31)), day(31))
    a, b = (rows(serving.latest_rows(rolled, 7)) for _ in range(2))
    assert a == b and len(a) == 7


def test_many_subgroups_a_day_leave_the_history_whole(make_star):
    products = [(i, i, f"p{i}", i, f"s{i}", 1, "all") for i in range(1, 401)]
    star = make_star([sale(day(n), i, 1, 1) for n in range(1, 10) for i in range(1, 401)], products=products)
    rolled = serving.serving_rollup(star, Request(day(10)), day(9))
    daily = serving.serving_daily(rolled).withColumn("k", F.lit(1))
    assert [r.sales_qty for r in daily.collect()] == [400.0] * 9
    r = serving.point_features(serving.series_state(daily, ["k"]), F.lit(day(10))).first()
    assert [r[f"lag_{i}"] for i in range(1, 8)] == [400.0] * 7
    assert serving.recent_history(daily, ["k"]).count() == 7


def test_a_missing_quantity_counts_as_zero_in_all_point_features(spark):
    state = spark.createDataFrame([(1, [3.0, None, 4.0, 0.0, 7.0, None, 7.0])], "k int, h array<double>")
    r = serving.point_features(state, F.lit(day(9))).first()
    series = [3, 0, 4, 0, 7, 0, 7]
    assert [r[f"lag_{i}"] for i in range(1, 8)] == series[::-1]
    assert r.rolling_mean_7 == pytest.approx(3.0) and r.rolling_std_7 == pytest.approx(statistics.pstdev(series))


@pytest.mark.parametrize("length", [1, 3, 6, 7, 8])
def test_point_features_of_short_and_long_series(make_star, length):
    star = make_star([sale(day(n), 1, 1, n * n) for n in range(1, length + 1)])
    daily = serving.serving_daily(serving.serving_rollup(star, Request(day(20)), day(19)))
    state = serving.series_state(daily.withColumn("k", F.lit(1)), ["k"])
    r = serving.point_features(state, F.lit(day(9))).first()
    series = [n * n for n in range(1, length + 1)]
    assert [r[f"lag_{i}"] for i in range(1, 8)] == [
        series[-i] if i <= length else 0 for i in range(1, 8)
    ]
    assert r.rolling_mean_7 == pytest.approx(statistics.mean(series[-7:]))
    want = statistics.pstdev(series[-7:]) if length >= 7 else 0
    assert r.rolling_std_7 == pytest.approx(want)
    assert (r.day_of_week, r.is_weekend, r.week_of_month) == (0, 0, 2)


def test_recent_history_is_scaled(make_star):
    star = make_star([sale(day(n), 1, 1, n, brought="20") for n in range(1, 10)])
    daily = serving.serving_daily(serving.serving_rollup(star, Request(day(20)), day(19)))
    got = serving.recent_history(daily.withColumn("k", F.lit(1)), ["k"]).orderBy("full_date").collect()
    assert [r.full_date for r in got] == [day(n) for n in range(3, 10)]
    assert got[0].label == "03/03" and got[0].short_label == "03-03"
    assert got[0].sales_ratio == pytest.approx(3 / 20) and got[0].import_ratio == 1
