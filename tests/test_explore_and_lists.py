from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import day, rows, sale
from pyspark.sql import functions as F

from larder.functions import calendar
from larder.operators import explore, lists, star


@pytest.fixture(scope="module")
def quantities(spark):
    data = np.random.default_rng(5).gamma(2.0, 9.0, 700).round(2) + 0.01
    return spark.createDataFrame([(float(x),) for x in data], "sales_qty double"), data


def test_summary_and_density_equal_brute_force(quantities):
    df, data = quantities
    counts = explore.value_counts(df.withColumn("sales_qty", F.col("sales_qty").cast("decimal(18,3)")))
    for r in explore.summary(counts).collect():
        x = data if r.scale == "raw" else np.log1p(data)
        assert r.n_rows == 700
        assert r["mean"] == pytest.approx(x.mean())
        assert r["median"] == pytest.approx(np.median(x))
        assert r["std"] == pytest.approx(x.std(ddof=1))
    for scale, x in (("raw", data), ("log1p", np.log1p(data))):
        h = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min(), x.max(), explore.GRID)
        want = np.exp(-((grid[:, None] - x) / h) ** 2 / 2).mean(axis=1) / (h * math.sqrt(2 * math.pi))
        got = explore.density(counts).where(F.col("scale") == scale).orderBy("point").collect()
        assert [r.density for r in got] == pytest.approx(want.tolist())


def test_histogram_equals_numpy_and_keeps_empty_bins(quantities):
    df, data = quantities
    got = explore.histogram(explore.value_counts(df)).where("scale = 'raw'").orderBy("bin").collect()
    want, edges = np.histogram(data, bins=60)
    assert [r.n for r in got] == want.tolist()
    assert [r.bin_low for r in got] == pytest.approx(edges[:-1].tolist())
    assert sum(r.density for r in got) * (edges[1] - edges[0]) == pytest.approx(1)


def test_constant_column_has_a_histogram_and_no_density(spark):
    counts = explore.value_counts(spark.createDataFrame([(4.0,)] * 5, "sales_qty double"))
    bins = explore.histogram(counts).where("scale = 'raw' and n > 0").collect()
    assert [r.n for r in bins] == [5]
    assert explore.density(counts).where("density is not null").isEmpty()


def test_correlation_of_constant_and_missing_values(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 7.0, 5.0), (4.0, 6.0, 5.0)],
        "lag_1 double, lag_2 double, lag_3 double",
    )
    got = {(r.feature, r.other): r["corr"] for r in explore.correlation(df).collect()}
    assert len(got) == 6
    assert got["lag_2", "lag_1"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 7, 6])[0, 1])
    assert got["lag_3", "lag_1"] is None
    assert got["lag_1", "lag_1"] == pytest.approx(1)


def test_quantity_range_is_open(make_star):
    s = make_star([sale(day(1), 1, 1, q) for q in (-1, 0, "0.001", "999.999", 1000)])
    assert star.quantity_range(s.sales).count() == 2


def test_negative_inventory_and_trend(make_star):
    s = make_star([
        sale(day(1), 1, 1, 5, "-1"), sale(day(1), 2, 1, 6), sale(day(2), 7, 1, 9), sale(day(3), 5, 2, 1),
    ])
    assert rows(explore.negative_inventory(s)) == [
        ("fruit", 0, 1, 0.0), ("greens", 1, 3, pytest.approx(100 / 3))
    ]
    trend = explore.daily_trend(s, day(1), day(2))
    assert rows(trend, "full_date", "is_weekend", "maingroup_name", "sales_qty") == [
        (day(1), True, "greens", 11.0), (day(2), False, "fruit", 9.0)
    ]
    assert explore.names_of(explore.top_groups(trend, 1)) == ["greens"]
    wide = explore.daily_pivot(trend, ["fruit", "greens"]).orderBy("full_date").collect()
    assert [tuple(r) for r in wide] == [(day(1), None, 11.0), (day(2), 9.0, None)]
    big = make_star([tuple(r) for r in s.sales.collect()], broadcast_rows=0)
    assert rows(explore.negative_inventory(big)) == rows(explore.negative_inventory(s))
    assert rows(explore.daily_trend(big, day(1), day(3))) == rows(explore.daily_trend(s, day(1), day(3)))


def test_groups_without_a_name_take_no_place_in_the_top(spark):
    trend = spark.createDataFrame(
        [(None, 50.0), ("c", 7.0), ("a", 9.0), ("b", 8.0), ("d", 1.0)], "maingroup_name string, sales_qty double")
    assert explore.names_of(explore.top_groups(trend)) == ["a", "b", "c"]
    assert rows(explore.trend_of(trend, ["a", "c"])) == [("a", 9.0), ("c", 7.0)]


def test_lists(make_star):
    s = make_star([sale(day(1), 1, 1, 1), sale(day(1), 8, 1, 1), sale(day(1), 9, 1, 1)])
    assert rows(lists.provinces(s)) == [(100, "North"), (200, "South")]
    assert ("D", "") in rows(lists.stores(s))
    assert rows(lists.stores(s, 200)) == [("C", "Gamma")]
    # Main group 2 sold through the pear; group 3 sold but has no name.
    assert rows(lists.maingroups(s)) == [(1, "greens"), (2, "fruit")]
    # The pear's subgroup sold, but its name holds a digit; roots did not sell.
    assert rows(lists.subgroups(s)) == [(10, "leaf")]
    assert rows(lists.subgroups(s, 2)) == []


def test_calendar_fields(spark):
    dates = {r.full_date: r for r in calendar.calendar(spark, day(1), day(31)).collect()}
    assert len(dates) == 31
    first, second, last = dates[day(1)], dates[day(2)], dates[day(31)]
    assert tuple(first) == (20260301, day(1), 6, "Chủ nhật", 1, True, True, False)
    assert tuple(second) == (20260302, day(2), 0, "Thứ 2", 1, False, False, False)
    assert tuple(last) == (20260331, day(31), 1, "Thứ 3", 5, False, False, True)
    assert all(r.day_of_week == d.weekday() for d, r in dates.items())


def test_correlation_is_stable_far_from_zero_and_on_empty_tables(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=500)
    y = 0.3 * x + rng.normal(size=500)
    df = spark.createDataFrame([(float(a) + 1e9, float(b) - 1e9, float("nan")) for a, b in zip(x, y)],
                               "lag_1 double, lag_2 double, lag_3 double").repartition(7)
    got = {(r.feature, r.other): r["corr"] for r in explore.correlation(df).collect()}
    assert got["lag_2", "lag_1"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    assert got["lag_3", "lag_3"] is None and got["lag_3", "lag_1"] is None
    none = explore.correlation(df.limit(0)).collect()
    assert len(none) == 6 and all(r["corr"] is None for r in none)


def test_correlation_is_one_grouped_aggregate(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "lag_1 double, lag_2 double")
    plan = explore.correlation(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("covar_pop(a") <= 2 and "corr(" not in plan
