"""The four data sets of the exploration report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from larder.operators import explore
from larder.operators.star import Star, quantity_range
from larder.session import checkpointed


def distribution(star: Star, sample: int | None = None) -> dict[str, DataFrame]:
    """Summary, histogram and density of the quantities, raw and on the log scale.

    All sales are used unless a sample size is given. They are read once, for the
    table of frequencies.
    """
    sold = quantity_range(star.sales).select("sales_qty")
    if sample is not None:
        sold = explore.random_sample(sold, sample)
    counts = checkpointed(explore.value_counts(sold))
    return {
        "summary": explore.summary(counts),
        "histogram": explore.histogram(counts),
        "density": explore.density(counts),
    }


def trend(star: Star, start: dt.date, end: dt.date, groups: int = 3) -> DataFrame | None:
    """Daily quantity of the largest main groups, a column each; None without sales."""
    daily = explore.daily_trend(star, start, end)
    names = sorted(explore.names_of(explore.top_groups(daily, groups)))
    if not names:
        return None
    return explore.daily_pivot(explore.trend_of(daily, names), names)


def report(star: Star, level_one: DataFrame | None, start: dt.date, end: dt.date) -> dict:
    """Everything the report shows; a part without data is None."""
    return {
        "distribution": distribution(star),
        "negative_inventory": explore.negative_inventory(star),
        "daily_trend": trend(star, start, end),
        "correlation": None if level_one is None else explore.correlation(level_one),
    }
