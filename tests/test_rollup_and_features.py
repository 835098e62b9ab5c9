from __future__ import annotations

import math
import statistics

import pytest
from conftest import PRODUCTS, STORES, day, rows, sale
from pyspark.sql import functions as F

from larder.operators import features, rollup
from larder.schemas import KEY_COLUMNS, LAGS, LEVELS, MEASURES


def test_grouping_sets_equal_six_rollups(month_star):
    together = rollup.rollup_all_levels(month_star)
    for level, keys in LEVELS.items():
        columns = ["full_date", "day_of_week", "week_of_month", *keys, *MEASURES]
        one = rollup.rollup_level(month_star, level).select(*columns)
        same = together.where(F.col("level") == level).select(*columns)
        assert one.exceptAll(same).isEmpty() and same.exceptAll(one).isEmpty()


def test_totals_are_equal_at_every_level(month_star):
    total = month_star.sales.agg(F.sum("sales_qty").cast("double")).first()[0]
    sums = rollup.rollup_all_levels(month_star).groupBy("level").agg(F.sum("sales_qty"))
    assert [r[1] for r in sums.collect()] == pytest.approx([total] * 6)


def test_unknown_keys_are_ignored(month_star):
    named = rollup.rollup(month_star, ["maingroup_id", "colour"])
    assert "colour" not in named.columns and "maingroup_id" in named.columns


def test_sales_without_a_dimension_row_vanish(make_star):
    star = make_star([sale(day(1), 1, 1, 2), sale(day(1), 99, 1, 3), sale(day(1), 1, 99, 4)])
    assert rows(rollup.rollup(star, ["maingroup_id"]), "maingroup_id", "sales_qty") == [(1, 2.0)]


def test_sum_of_decimals_is_exact(make_star):
    star = make_star([sale(day(1), 1, 1, "0.1"), sale(day(1), 2, 1, "0.2")])
    assert rows(rollup.rollup(star, ["maingroup_id"]), "sales_qty") == [(0.3,)]


def test_large_dimensions_take_the_shuffle_path(make_star, month_star):
    """No broadcast allowed: hot keys are split off, the rest is shuffled."""
    big = make_star(
        [tuple(r) for r in month_star.sales.collect()], broadcast_rows=0
    )
    assert not big.is_small("products")
    got = features.all_level_features(big).drop("rolling_mean_7", "rolling_std_7", "cv_7")
    want = features.all_level_features(month_star).select(*got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_missing_key_stays_in_rollup_but_not_in_features(make_star):
    star = make_star([sale(day(n), 1, 4, n) for n in range(1, 11)])
    level = "2_category_province"
    assert rollup.rollup_level(star, level).count() == 10
    assert features.level_features(star, level).isEmpty()
    assert features.all_level_features(star).where(F.col("level") == level).isEmpty()
    assert features.level_features(star, "1_category_national").count() == 3


def test_lags_count_rows_not_days(make_star):
    days = [1, 2, 3, 5, 6, 7, 8, 9]
    star = make_star([sale(day(n), 1, 1, n) for n in days])
    (row,) = features.level_features(star, "6_subgroup_store").collect()
    assert row.full_date == day(9)
    assert [row[name] for name in LAGS] == [8, 7, 6, 5, 3, 2, 1]
    assert row.rolling_mean_7 == pytest.approx(32 / 7)
    deviation = statistics.stdev([8, 7, 6, 5, 3, 2, 1])
    assert row.rolling_std_7 == pytest.approx(deviation)
    assert row.cv_7 == pytest.approx(deviation / (32 / 7 + 1e-6))
    assert row.log_sales_qty == pytest.approx(math.log1p(9))


@pytest.mark.parametrize("length, kept", [(1, 0), (3, 0), (6, 0), (7, 0), (8, 1)])
def test_first_seven_rows_are_dropped(make_star, length, kept):
    star = make_star([sale(day(n), 1, 1, n) for n in range(1, length + 1)])
    assert features.level_features(star, "6_subgroup_store").count() == kept


def test_log_is_missing_where_it_does_not_exist(make_star):
    last = {8: 0, 9: -1, 10: -2}
    star = make_star([sale(day(n), 1, 1, last.get(n, 5)) for n in range(1, 11)])
    table = features.level_features(star, "6_subgroup_store").orderBy("full_date")
    assert [r.log_sales_qty for r in table.collect()] == [0.0, None, None]


def test_missing_sums_are_skipped_by_the_statistics(spark):
    data = [(1, day(n), None if n == 3 else float(n)) for n in range(1, 11)]
    daily = spark.createDataFrame(data, "k int, full_date date, sales_qty double")
    table = {r.full_date: r for r in features.series_features(daily, ["k"]).collect()}
    assert set(table) == {day(8), day(9)}  # the seventh lag of day 10 is missing
    assert table[day(8)].rolling_mean_7 == pytest.approx((1 + 2 + 4 + 5 + 6 + 7) / 6)
    assert table[day(8)].rolling_std_7 == pytest.approx(statistics.stdev([1, 2, 4, 5, 6, 7]))


def test_order_of_input_rows_does_not_matter(make_star, month_star):
    shuffled = make_star([tuple(r) for r in month_star.sales.orderBy(F.rand(3)).collect()])
    a, b = (features.level_features(s, "5_subgroup_province") for s in (month_star, shuffled))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count()


def test_levels_merge_a_subgroup_of_two_main_groups(make_star):
    products = [*PRODUCTS, (30, 1, "x", 10, "leaf", 2, "fruit")]
    star = make_star([sale(day(1), 1, 1, 2), sale(day(1), 30, 1, 3)], products, STORES)
    assert rows(rollup.rollup_level(star, "4_subgroup_national"), "subgroup_id", "sales_qty") == [(10, 5.0)]
    assert len(rows(rollup.rollup_level(star, "1_category_national"))) == 2


def test_long_table_has_all_columns(month_star):
    table = features.all_level_features(month_star)
    assert set(KEY_COLUMNS) | set(LAGS) | {"level", "cv_7", "log_sales_qty"} <= set(table.columns)
    assert not [f for f in table.schema if f.dataType.typeName() == "decimal"]
