"""Levels of stored cells go by numbers of their groups, not by names."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.operators import rollup
from larder.plans import daily_cells
from larder.schemas import LEVELS


def test_levels_of_cells_move_numbers_only(spark, month_star, tmp_path):
    served = month_star.served_from(daily_cells.stored_cells(spark, daily_cells.build(month_star, str(tmp_path / "c"))))
    star = rollup.star_of_cells(served)
    assert {f.dataType.typeName() for f in star.sales.select("date_key", "product_key", "store_key").schema} <= {"long", "integer"}
    assert star.sales.count() == served.cells.count()
    got, wanted = (sorted(map(str, rollup.rollup_all_levels(s).collect())) for s in (served, month_star))
    assert got == wanted


def test_missing_keys_of_cells_stay(spark, month_star, tmp_path):
    cells = daily_cells.stored_cells(spark, daily_cells.build(month_star, str(tmp_path / "c")))
    blank = cells.withColumns({"store_id": F.lit(None).cast("string"), "subgroup_name": F.lit(None).cast("string")})
    served = month_star.served_from(blank)
    found = rollup.rollup_all_levels(served).collect()
    assert {r.level for r in found} == set(LEVELS)
    one = rollup.rollup_level(served, "6_subgroup_store")
    of_all = [str(tuple(r[c] for c in one.columns)) for r in found if r.level == "6_subgroup_store"]
    assert sorted(str(tuple(r)) for r in one.collect()) == sorted(of_all)
