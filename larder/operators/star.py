"""The star schema and its joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import numeric
from larder.plans import joins

PRODUCT_GROUP, STORE_GROUP = "product_group", "store_group"
# Sales that a task gets where they are dealt out, and the fewest that are worth a task.
ROWS_A_TASK, LEAST_ROWS_A_TASK = 200_000, 10_000
_SURROGATE = {"products": "product_key", "stores": "store_key", "dates": "date_key"}


def tasks_for(rows: int) -> int:
    """The least number of tasks that so many rows are dealt over."""
    return max(1, -(-rows // ROWS_A_TASK))


@dataclass
class Star:
    """Four tables: daily sales and the dimensions of date, product and store.

    Where the date key is computed from a source column, `source_within` gives the
    sales of a date range (first day, day after the last; None is open) filtered on
    that column, so that the range reaches the files. The dates may be given as a
    function, which is asked once, by the first join that needs them. With stored
    daily cells, roll-ups and requests are answered from these instead of the sales.
    """

    sales: DataFrame
    dates: DataFrame | Callable[[], DataFrame]
    products: DataFrame
    stores: DataFrame
    broadcast_rows: int = joins.BROADCAST_ROWS
    source_within: Callable[[dt.date | None, dt.date | None], DataFrame] | None = None
    cells: DataFrame | None = None
    _small: dict[str, bool] = field(default_factory=dict, repr=False)
    _hot: dict[str, DataFrame | None] = field(default_factory=dict, repr=False)
    _cutoff: list[dt.date | None] = field(default_factory=list, repr=False)
    _tasks: list[int] = field(default_factory=list, repr=False)

    def tasks(self) -> int:
        """Tasks over which sales are dealt, so that none holds more rows in larger tables; counted once."""
        if not self._tasks:
            rows = self.sales.count()
            cores = self.sales.sparkSession.sparkContext.defaultParallelism
            self._tasks.append(max(tasks_for(rows), min(cores, rows // LEAST_ROWS_A_TASK)))
        return self._tasks[0]

    def dimension(self, name: str) -> DataFrame:
        found = getattr(self, name)
        if not isinstance(found, DataFrame):
            found = found()
            setattr(self, name, found)
        return found

    def is_small(self, name: str) -> bool:
        """Whether a dimension may be broadcast; counted once, up to the limit."""
        if name not in self._small:
            self._small[name] = joins.fits(self.dimension(name), self.broadcast_rows)
        return self._small[name]

    def hot(self, name: str) -> DataFrame | None:
        """Keys of a large dimension that hold a large share of the sales."""
        if self.is_small(name):
            return None
        if name not in self._hot:
            self._hot[name] = joins.hot_keys(self.sales, _SURROGATE[name])
        return self._hot[name]

    def join(self, df: DataFrame, name: str, dim: DataFrame, aggregated: bool = False) -> DataFrame:
        """Join rows with something that has one row per key of a dimension.

        Sums by that key and others hold few rows a key, so hot keys matter for
        single sales only.
        """
        hot = None if aggregated else self.hot(name)
        small = self.is_small(name)
        tasks = None if small or aggregated else self.tasks()
        return joins.lookup(df, dim, _SURROGATE[name], small, hot=hot, tasks=tasks)

    def _with(self, df: DataFrame, name: str, columns, aggregated: bool) -> DataFrame:
        dim = self.dimension(name).select(_SURROGATE[name], *columns)
        return self.join(df, name, dim, aggregated)

    def with_dates(self, df: DataFrame, *columns: str) -> DataFrame:
        return self._with(df, "dates", columns, aggregated=True)

    def with_products(self, df: DataFrame, *columns: str, aggregated: bool = False) -> DataFrame:
        return self._with(df, "products", columns, aggregated)

    def with_stores(self, df: DataFrame, *columns: str, aggregated: bool = False) -> DataFrame:
        return self._with(df, "stores", columns, aggregated)

    def groups(self, name: str, columns, ref: str) -> DataFrame:
        """Distinct values of some dimension columns and a stand-in: their least key."""
        return self.dimension(name).groupBy(*columns).agg(F.min(_SURROGATE[name]).alias(ref))

    def stand_ins(self, name: str, refs: dict[str, tuple[str, ...]]) -> DataFrame:
        """Per dimension key the stand-in of each grouping; 0 for an empty one."""
        df = self.dimension(name)
        for ref, columns in refs.items():
            if not columns:
                df = df.withColumn(ref, F.lit(0))
                continue
            groups = self.groups(name, columns, ref)
            renamed = groups.select(ref, *[F.col(c).alias(f"_{c}") for c in columns])
            same = reduce(
                lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
            )
            df = df.join(renamed, same)
        return df.select(_SURROGATE[name], *refs)

    def with_names(self, df: DataFrame, name: str, ref: str, columns, how: str = "inner"):
        """Attach the columns that a stand-in stands for.

        Groups are often few even where the dimension is large, so they are
        counted themselves, once for the same columns.
        """
        if not columns:
            return df
        groups = self.groups(name, columns, ref)
        small = self.is_small(name)
        if not small:
            grouping = f"{name} by {', '.join(columns)}"
            if grouping not in self._small:
                self._small[grouping] = joins.fits(groups, self.broadcast_rows)
            small = self._small[grouping]
        return joins.lookup(df, groups, ref, small, how)

    def sales_within(self, start: dt.date | None = None, before: dt.date | None = None) -> DataFrame:
        """Sales from a first day on, strictly before another one."""
        sales = self.sales if self.source_within is None else self.source_within(start, before)
        key = F.col("date_key")
        if start is not None:
            sales = sales.where(key >= int(start.strftime("%Y%m%d")))
        if before is not None:
            sales = sales.where(key < int(before.strftime("%Y%m%d")))
        return sales

    def between(self, start: dt.date | None = None, before: dt.date | None = None) -> Star:
        """The star of the sales from a first day on, strictly before another one, without cells."""
        return replace(
            self, sales=self.sales_within(start, before), source_within=None, cells=None, _hot={}, _cutoff=[], _tasks=[]
        )

    def served_from(self, cells: DataFrame) -> Star:
        """The same star with stored daily cells."""
        return replace(self, cells=cells, _cutoff=[])

    def cutoff(self) -> dt.date | None:
        """The last day with a sale; looked up once."""
        if not self._cutoff and self.cells is not None:
            self._cutoff.append(self.cells.agg(F.max("full_date")).first()[0])
        if not self._cutoff:
            last = self.sales.agg(F.max("date_key").alias("date_key"))
            self._cutoff.append(self.with_dates(last, "full_date").agg(F.max("full_date")).first()[0])
        return self._cutoff[0]


def with_groups(star: Star, products=(), stores=(), sales: DataFrame | None = None) -> DataFrame:
    """Sales with the asked-for columns of product and store.

    Both joins are inner whether or not a column is asked for: a sale without a
    row in a dimension does not exist for the roll-ups. Dates are joined after
    aggregating by date key, when there are far fewer rows.
    """
    sales = star.sales if sales is None else sales
    return star.with_stores(star.with_products(sales, *products), *stores)


def full_star(star: Star) -> DataFrame:
    """Every sale with the descriptive columns of its date, product and store."""
    joined = with_groups(
        star,
        products=("maingroup_id", "maingroup_name", "subgroup_id", "subgroup_name"),
        stores=("store_id", "store_name", "province_id", "province_name"),
    )
    return star.with_dates(joined, "full_date", "day_of_week", "is_weekend", "week_of_month")


def quantity_range(sales: DataFrame, low: float = 0, high: float = 1000) -> DataFrame:
    """Sales whose quantity lies strictly between two bounds."""
    return sales.where(numeric.in_range(F.col("sales_qty"), low, high))
