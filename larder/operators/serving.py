"""What a forecast request reads: filtered sales, daily series, recent history."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.functions import calendar, numeric
from larder.operators.star import Star, with_groups
from larder.schemas import CALENDAR_COLUMNS, LAG_DAYS, LAGS

_GROUP = ("subgroup_id", "subgroup_name", "maingroup_id", "maingroup_name")
_SUMS = ("sales_qty", "opening_inventory", "import_qty")


@dataclass(frozen=True)
class Request:
    """A forecast date and optional filters; an empty value means no filter."""

    forecast_date: dt.date
    province_id: Any = None
    store_id: Any = None
    maingroup_id: Any = None
    subgroup_id: Any = None

    def is_rolling(self, cutoff: dt.date) -> bool:
        return self.forecast_date > cutoff

    def rollout_days(self, cutoff: dt.date) -> int:
        return max(0, (self.forecast_date - cutoff).days)

    def before(self, cutoff: dt.date) -> dt.date:
        """Sales strictly before this date are the history of the request."""
        return cutoff + dt.timedelta(days=1) if self.is_rolling(cutoff) else self.forecast_date


def request_filter(request: Request) -> Column:
    """Conjunction of the given filters; a subgroup wins over a main group."""
    wanted = {"store_id": request.store_id, "province_id": request.province_id}
    if request.subgroup_id:
        wanted["subgroup_id"] = request.subgroup_id
    else:
        wanted["maingroup_id"] = request.maingroup_id
    condition = F.lit(True)
    for column, value in wanted.items():
        if value:
            condition = condition & (F.col(column) == F.lit(value))
    return condition


def requested_sales(star: Star, request: Request, cutoff: dt.date) -> DataFrame:
    """Joined sales that a request is about. The date bound reaches the scan."""
    sales = star.sales_within(before=request.before(cutoff))
    joined = with_groups(star, products=_GROUP, stores=("store_id", "province_id"), sales=sales)
    return joined.where(request_filter(request))


def cells_before(cells: DataFrame, before: dt.date) -> DataFrame:
    """Stored cells strictly before a day; later months are not listed at all."""
    return cells.where(
        (F.col("month") <= before.year * 100 + before.month) & (F.col("full_date") < F.lit(before))
    )


def serving_rollup(star: Star, request: Request, cutoff: dt.date) -> DataFrame:
    """Daily sums per subgroup, over all matching sales or their stored cells."""
    if star.cells is not None:
        days = ("full_date", *CALENDAR_COLUMNS)
        found = cells_before(star.cells, request.before(cutoff)).where(request_filter(request))
        return found.groupBy(*days, *_GROUP).agg(*[F.sum(m).cast("double").alias(m) for m in _SUMS])
    cells = requested_sales(star, request, cutoff).groupBy("date_key", *_GROUP).agg(
        *[F.sum(m).cast("double").alias(m) for m in _SUMS]
    )
    return star.with_dates(cells, "full_date", *CALENDAR_COLUMNS).select(
        "full_date", *CALENDAR_COLUMNS, *_GROUP, *_SUMS
    )


def latest_rows(rolled: DataFrame, n: int) -> DataFrame:
    """The newest n daily rows; rows of one day are ordered by group, so the cut is repeatable."""
    return rolled.orderBy(
        F.desc("full_date"), "maingroup_id", "subgroup_id", "maingroup_name", "subgroup_name"
    ).limit(n)


def serving_daily(rolled: DataFrame) -> DataFrame:
    """One row a day. Calendar fields depend on the date alone, so min is exact."""
    return rolled.groupBy("full_date").agg(
        *[F.sum(m).alias(m) for m in _SUMS],
        *[F.min(c).alias(c) for c in CALENDAR_COLUMNS],
    )


def last_rows(daily: DataFrame, keys, n: int = LAG_DAYS) -> DataFrame:
    """The newest n rows of each series, numbered from the newest."""
    w = Window.partitionBy(*keys).orderBy(F.desc("full_date"))
    return daily.withColumn("back", F.row_number().over(w)).where(F.col("back") <= n)


def recent_history(daily: DataFrame, keys) -> DataFrame:
    """The last seven days of each series, labelled and scaled for display.

    Quantities are relative to the largest sale or import of the window, which
    counts as at least 1.
    """
    recent = last_rows(daily, keys)
    sold, brought = F.col("sales_qty"), F.coalesce(F.col("import_qty"), F.lit(0.0))
    peak = F.greatest(
        F.max(F.greatest(sold, brought)).over(Window.partitionBy(*keys)), F.lit(1.0)
    )
    return recent.withColumn("peak", peak).select(
        *keys, "full_date",
        F.date_format("full_date", "dd/MM").alias("label"),
        F.date_format("full_date", "MM-dd").alias("short_label"),
        "sales_qty", "import_qty",
        (sold / F.col("peak")).alias("sales_ratio"),
        (brought / F.col("peak")).alias("import_ratio"),
    )


def series_state(daily: DataFrame, keys) -> DataFrame:
    """Per series the last seven quantities, oldest first, and the newest inventory.

    Seven rows a series are all that a forecast needs, so the collected array
    has a fixed length.
    """
    entries = F.array_sort(F.collect_list(F.struct("full_date", "sales_qty", "opening_inventory")))
    recent = last_rows(daily, keys).groupBy(*keys).agg(entries.alias("entries"))
    return recent.select(
        *keys,
        F.transform("entries", lambda e: e["sales_qty"]).alias("h"),
        F.element_at("entries", -1)["opening_inventory"].alias("opening_inventory"),
        F.element_at("entries", -1)["full_date"].alias("last_date"),
    )


def point_features(state: DataFrame, target: Column) -> DataFrame:
    """The feature row of a target date from the last quantities of a series.

    A lag beyond the series is 0, and so is a missing quantity, in lags, mean and
    deviation alike. The mean is over what there is; the deviation is that of the
    population here, and 0 for fewer than seven days.
    """
    h = F.col("h")
    size = F.size(h)
    filled = lambda x: F.coalesce(x, F.lit(0.0))
    total = F.aggregate(h, F.lit(0.0), lambda a, x: a + filled(x))
    with_mean = state.withColumns({
        **{
            name: F.coalesce(F.try_element_at(h, F.lit(-i)), F.lit(0.0))
            for i, name in enumerate(LAGS, start=1)
        },
        "rolling_mean_7": F.coalesce(F.try_divide(total, size), F.lit(0.0)),
    })
    mean = F.col("rolling_mean_7")
    squares = F.aggregate(h, F.lit(0.0), lambda a, x: a + (filled(x) - mean) * (filled(x) - mean))
    with_std = with_mean.withColumn(
        "rolling_std_7",
        F.when(size >= LAG_DAYS, F.sqrt(squares / LAG_DAYS)).otherwise(F.lit(0.0)),
    )
    return with_std.withColumns({
        "cv_7": numeric.variation(F.col("rolling_std_7"), mean),
        "day_of_week": calendar.day_of_week(target),
        "is_weekend": calendar.is_weekend(target).cast("int"),
        "week_of_month": calendar.week_of_month(target),
    })

