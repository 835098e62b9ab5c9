"""Daily roll-ups of the star, one level at a time or all six at once.

Sales are grouped by date key and by integer stand-ins of the product and store
groups; names are attached to the far fewer sums. Decimal measures are summed as
whole numbers of their smallest unit, which is exact in any order. So exchanges
carry fixed-width numbers only.

Of all levels, those by store have nearly as many rows as there are sales. Sales are
therefore dealt by store once, in tasks of a bounded number of rows, and the cells and
series of these levels are made where the sales are; only the few cells of the other
levels move again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.star import PRODUCT_GROUP, STORE_GROUP, Star
from larder.schemas import CALENDAR_COLUMNS, KEY_COLUMNS, LEVELS, MEASURES
from larder.session import checkpointed

MAIN, SUB = ("maingroup_id", "maingroup_name"), ("subgroup_id", "subgroup_name")
PROVINCE, STORE = ("province_id", "province_name"), ("store_id",)
# The stand-in columns of the long form and the keys each stands for.
STAND_INS = {"main_ref": MAIN, "sub_ref": SUB, "province_ref": PROVINCE, "store_ref": STORE}
# Sales are dealt by store only if a task gets at least so many stores on average.
STORES_A_TASK = 4


def _scales(star: Star) -> dict[str, int]:
    """Digits after the point of each measure; 0 for one that is not decimal."""
    types = {m: star.sales.schema[m].dataType for m in MEASURES}
    return {m: t.scale if isinstance(t, T.DecimalType) else 0 for m, t in types.items()}


def _units(star: Star) -> list[Column]:
    """Measures in whole smallest units."""
    return [
        (F.col(m) * 10 ** s).cast("long").alias(m) if s else F.col(m)
        for m, s in _scales(star).items()
    ]


def _sums() -> list[Column]:
    return [F.sum(m).alias(m) for m in MEASURES]


def _double_sums() -> list[Column]:
    return [F.sum(m).cast("double").alias(m) for m in MEASURES]


def _as_double(star: Star, df: DataFrame) -> DataFrame:
    return df.withColumns({
        m: F.col(m).cast("double") / 10 ** s if s else F.col(m).cast("double")
        for m, s in _scales(star).items()
    })


def _grouped_sales(star: Star, products: dict, stores: dict) -> DataFrame:
    """Sales with the stand-ins of the given product and store groupings.

    If a dimension is too large to broadcast, sales move once, by its key.
    """
    sales = star.sales.select("date_key", "product_key", "store_key", *_units(star))
    sales = star.join(sales, "products", star.stand_ins("products", products))
    return star.join(sales, "stores", star.stand_ins("stores", stores)).drop(
        "product_key", "store_key"
    )


# --- one level ------------------------------------------------------------

def level_units(star: Star, keys) -> DataFrame:
    """Daily sums by the stand-ins of the product part and the store part of the keys, in whole units."""
    groups = {
        PRODUCT_GROUP: [k for k in keys if k in MAIN + SUB],
        STORE_GROUP: [k for k in keys if k in PROVINCE + STORE],
    }
    sales = _grouped_sales(
        star, {PRODUCT_GROUP: groups[PRODUCT_GROUP]}, {STORE_GROUP: groups[STORE_GROUP]}
    )
    cells = sales.groupBy("date_key", PRODUCT_GROUP, STORE_GROUP).agg(*_sums())
    return star.with_dates(cells, "full_date", *CALENDAR_COLUMNS)


def level_cells(star: Star, keys) -> DataFrame:
    """The same with the measures as doubles."""
    return _as_double(star, level_units(star, keys)).drop("date_key")


def exact_cells(star: Star) -> DataFrame:
    """Daily sums by all key columns, measures as decimals: what every level can be summed from.

    Sales are dealt by month and some days of it, so that the cells can be written by month where
    they are made, and what moves are numbers and not names.
    """
    tasks = star.tasks()
    # Several keys a task, and a month in at least four.
    days = min(31, max(4, -(-tasks // 20)))
    sales = _grouped_sales(
        star, {PRODUCT_GROUP: MAIN + SUB}, {STORE_GROUP: PROVINCE + STORE}
    ).withColumns({
        "_month": F.floor(F.col("date_key") / 100), "_days": F.pmod("date_key", F.lit(days)),
    })
    dealt = sales.where(F.col("date_key").isNotNull()).repartition(tasks, "_month", "_days")
    cells = dealt.groupBy("date_key", "_month", "_days", PRODUCT_GROUP, STORE_GROUP).agg(*_sums()).drop("_month", "_days")
    cells = with_level_keys(star, star.with_dates(cells, "full_date", *CALENDAR_COLUMNS), KEY_COLUMNS)
    return cells.withColumns({
        m: (F.col(m).cast("decimal(20,0)") * F.lit(f"{10 ** -s:.{s}f}").cast(f"decimal({s},{s})"))
        for m, s in _scales(star).items() if s
    })


def with_level_keys(star: Star, cells: DataFrame, keys) -> DataFrame:
    """Replace the stand-ins of level cells by the keys themselves."""
    named = star.with_names(cells, "products", PRODUCT_GROUP, [k for k in keys if k in MAIN + SUB])
    named = star.with_names(
        named, "stores", STORE_GROUP, [k for k in keys if k in PROVINCE + STORE]
    )
    rest = [c for c in cells.columns if c not in (PRODUCT_GROUP, STORE_GROUP)]
    front = ["full_date", *CALENDAR_COLUMNS]
    return named.select(*front, *keys, *[c for c in rest if c not in front])


def rollup(star: Star, keys) -> DataFrame:
    """One row per day and group; names that are no key column are ignored."""
    keys = [k for k in keys if k in KEY_COLUMNS]
    if star.cells is not None:
        return star.cells.groupBy("full_date", *CALENDAR_COLUMNS, *keys).agg(*_double_sums())
    return with_level_keys(star, level_cells(star, keys), keys)


def rollup_level(star: Star, level: str) -> DataFrame:
    return rollup(star, LEVELS[level])


# --- all levels -----------------------------------------------------------

def _referred_sales(star: Star) -> DataFrame:
    return _grouped_sales(
        star, {"main_ref": MAIN, "sub_ref": SUB}, {"province_ref": PROVINCE, "store_ref": STORE}
    )


def base_cells(star: Star) -> DataFrame:
    """Sums of the finest grain that all six levels can be made from."""
    return _referred_sales(star).groupBy("date_key", *STAND_INS).agg(*_sums())


def _dated(star: Star, cells: DataFrame) -> DataFrame:
    return _as_double(star, star.with_dates(cells, "full_date", *CALENDAR_COLUMNS)).drop("date_key")


def _level_sets(cells: DataFrame, levels) -> DataFrame:
    """Levels as grouping sets over cells that have their stand-ins; the others are NULL."""
    refs = [s for s in STAND_INS if any(s in _stand_ins_of(level) for level in levels)]
    sets = [["date_key", *_stand_ins_of(level)] for level in levels]
    summed = cells.groupingSets(sets, "date_key", *refs).agg(*_sums())
    return summed.select(
        "date_key", *[(F.col(s) if s in refs else F.lit(None).cast("long")).alias(s) for s in STAND_INS], *MEASURES)


def level_parts(star: Star) -> list[tuple[DataFrame, tuple[str, ...]]]:
    """Daily sums of all levels, stand-ins that a level does not use NULL, in parts; each with the stand-ins that part its series.

    The sales are read and joined once. With many stores they are dealt by store, and what
    a store's levels need stays in its task, also a window over the series. With few stores, of
    which a task might get too much, the levels are grouping sets over the base cells.
    """
    tasks = star.tasks()
    if star.groups("stores", STORE, "store_ref").count() < STORES_A_TASK * tasks:
        return [(_dated(star, _level_sets(base_cells(star), list(LEVELS))), tuple(STAND_INS))]
    # The dates' inner join needs a key; asked for here, both parts read the same dealt sales.
    dealt = _referred_sales(star).where(F.col("date_key").isNotNull()).repartition(tasks, "store_ref")
    base = dealt.groupBy("date_key", *STAND_INS).agg(*_sums())
    by_store = [level for level in LEVELS if "store_ref" in _stand_ins_of(level)]
    others = [level for level in LEVELS if level not in by_store]
    refs = [s for s in STAND_INS if s != "store_ref"]
    # Exploded, not grouping sets: the store stays the column that the rows were dealt by.
    kinds = F.array(*[
        F.struct(*[(F.col(s) if s in _stand_ins_of(level) else F.lit(None)).cast("long").alias(s) for s in refs])
        for level in by_store])
    used = [s for s in refs if any(s in _stand_ins_of(level) for level in by_store)]
    stores = base.select("date_key", "store_ref", *MEASURES, F.explode(kinds).alias("kind")).select(
        "date_key", "store_ref", *MEASURES, *[f"kind.{s}" for s in used]
    ).groupBy("date_key", *used, "store_ref").agg(*_sums())
    stores = stores.select(
        "date_key", *[(F.col(s) if s in (*used, "store_ref") else F.lit(None).cast("long")).alias(s) for s in STAND_INS], *MEASURES)
    # Dealt over as many tasks: of these sums, too, a task gets no more in larger tables.
    few = _level_sets(base.repartition(tasks, "date_key", *refs).groupBy("date_key", *refs).agg(*_sums()), others)
    return [(_dated(star, stores), (*used, "store_ref")), (_dated(star, few), tuple(refs))]


def all_level_cells(star: Star) -> DataFrame:
    """Daily sums of all levels; stand-ins that a level does not use are NULL."""
    return reduce(DataFrame.unionByName, [cells for cells, _ in level_parts(star)])


def _stand_ins_of(level: str) -> list[str]:
    return [s for s, keys in STAND_INS.items() if set(keys) <= set(LEVELS[level])]


def with_all_keys(star: Star, cells: DataFrame) -> DataFrame:
    """Add the level name and replace the stand-ins by the key columns."""
    level = F.lit(None).cast("string")
    for name in LEVELS:
        used = _stand_ins_of(name)
        here = F.lit(True)
        for s in STAND_INS:
            here = here & (F.col(s).isNotNull() if s in used else F.col(s).isNull())
        level = F.when(here, name).otherwise(level)
    named = cells.withColumn("level", level)
    for ref, keys in STAND_INS.items():
        table = "products" if keys in (MAIN, SUB) else "stores"
        named = star.with_names(named, table, ref, keys, how="left")
    front = ["level", "full_date", *CALENDAR_COLUMNS, *KEY_COLUMNS]
    rest = [c for c in cells.columns if c not in STAND_INS and c not in front]
    return named.select(*front, *rest)


def rollup_all_levels(star: Star) -> DataFrame:
    """The six levels in one long table; keys a level does not use are NULL."""
    if star.cells is not None:
        star = star_of_cells(star)
    return with_all_keys(star, all_level_cells(star))


def _numbered(cells: DataFrame, columns, key: str) -> DataFrame:
    """The distinct values of some columns with a number each, stored so that the numbers stay."""
    return checkpointed(cells.select(*columns).distinct().withColumn(key, F.monotonically_increasing_id()))


def star_of_cells(star: Star) -> Star:
    """Stored cells as a star of their own: a dimension each of their days, product groups and store groups.

    The groups are those of the cells, which the dimensions of the star may no longer hold, and may be NULL.
    """
    found = Star(
        sales=star.cells,
        dates=_numbered(star.cells, ("full_date", *CALENDAR_COLUMNS), "date_key"),
        products=_numbered(star.cells, MAIN + SUB, "product_key"),
        stores=_numbered(star.cells, PROVINCE + STORE, "store_key"),
        broadcast_rows=star.broadcast_rows,
    )
    found.tasks()
    sales = star.cells.select("full_date", *CALENDAR_COLUMNS, *KEY_COLUMNS, *MEASURES)
    for name, key in (("dates", "date_key"), ("products", "product_key"), ("stores", "store_key")):
        columns = [c for c in found.dimension(name).columns if c != key]
        renamed = found.dimension(name).select(key, *[F.col(c).alias(f"_{c}") for c in columns])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
        sales = sales.join(F.broadcast(renamed) if found.is_small(name) else renamed, same).drop(*renamed.columns[1:], *columns)
    found.sales = sales.select("date_key", "product_key", "store_key", *MEASURES)
    return found
