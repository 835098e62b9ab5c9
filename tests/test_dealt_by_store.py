"""Levels made where the sales were dealt by store, and from grouping sets, are the same."""

import re

from conftest import rows

from larder.models.naive import repeated, with_last_known
from larder.operators import features, rollup, star
from larder.schemas import KEY_COLUMNS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_levels_by_store_equal_grouping_sets(month_star, monkeypatch):
    dealt = rows(rollup.rollup_all_levels(month_star))
    assert len(rollup.level_parts(month_star)) == 2
    monkeypatch.setattr(rollup, "STORES_A_TASK", 1_000)
    assert len(rollup.level_parts(month_star)) == 1
    assert rows(rollup.rollup_all_levels(month_star)) == dealt


def test_series_by_store_move_once(spark, month_star, monkeypatch):
    monkeypatch.setattr(star, "LEAST_ROWS_A_TASK", 100)
    monkeypatch.setattr(rollup, "STORES_A_TASK", 0)
    month_star._tasks.clear()
    cells, keys = rollup.level_parts(month_star)[0]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        known = with_last_known(features.series_features(cells, keys), keys)
        assert len(re.findall(r"Exchange hashpartitioning\(store_ref", plan(known))) == 1
        assert not re.findall(r"Exchange hashpartitioning\([^)]*(date_key|main_ref|sub_ref)", plan(known))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        month_star._tasks.clear()


def test_last_known_by_stand_ins_equals_by_keys(month_star):
    keys = ("level", *KEY_COLUMNS)
    stepped = repeated(features.all_level_features(month_star, step=with_last_known), keys)
    assert rows(stepped) == rows(repeated(with_last_known(features.all_level_features(month_star), keys), keys))


def test_tasks_grow_with_the_sales(month_star, monkeypatch):
    monkeypatch.setattr(star, "ROWS_A_TASK", 100)
    month_star._tasks.clear()
    try:
        assert month_star.tasks() == -(-month_star.sales.count() // 100)
    finally:
        month_star._tasks.clear()


def test_stored_tables_are_read_by_column(spark):
    from larder.session import checkpointed

    kept = checkpointed(spark.createDataFrame([(1, "a"), (2, None)], "a int, b string"))
    assert rows(kept) == [(1, "a"), (2, None)]
    assert "ReadSchema: struct<a:int>" in plan(kept.select("a"))


def test_cells_are_written_where_they_are_made(spark, month_star, tmp_path):
    from larder.plans import daily_cells

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = plan(daily_cells.cells_of(month_star))
        assert len(re.findall(r"Exchange hashpartitioning\(_month", found)) <= 1
        assert not re.findall(r"Exchange hashpartitioning\((date_key|month#)", found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    kept = daily_cells.with_stored_cells(month_star, str(tmp_path / "cells")).cells
    assert rows(kept, *daily_cells.cells_of(month_star).columns[:1]) == rows(
        daily_cells.cells_of(month_star), "full_date")
