"""Exploration: distributions, inventory quality, daily trend, correlation."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.numeric import log1p, nan_to_null, present
from larder.operators import quantiles
from larder.operators.star import Star
from larder.schemas import LAGS

BINS = 60
GRID = 400


# --- sampling -------------------------------------------------------------

def random_sample(df: DataFrame, n: int = 100_000, seed: int = 1) -> DataFrame:
    """A uniform sample of n rows, or all rows if there are no more.

    Rows are drawn in the order of a hash of all their columns and the seed, so the
    sample depends on neither the order of rows nor the partitions, and a task
    that runs again draws the same. Rows that are equal in every column follow
    each other; add a key to draw them apart.

    A sort of everything would send n rows of every task to one. One counting
    pass finds the smallest power-of-two share of the hashes that still holds n
    rows; only that share, some 2n rows, is ordered.
    """
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns
    ]))
    drawn = df.withColumn("_order", order)
    place = F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / 2.0 ** 32
    shares = [2.0 ** -k for k in range(32)]
    counts = drawn.agg(*[F.count_if(place < s).alias(f"n{k}") for k, s in enumerate(shares)]).first()
    share = min((s for s, held in zip(shares, counts) if held >= n), default=1.0)
    return drawn.where(place < share).orderBy("_order").limit(n).drop("_order")


# --- distribution ---------------------------------------------------------

def value_counts(df: DataFrame, column: str = "sales_qty") -> DataFrame:
    """Each value once with its frequency, on the raw and on the log scale.

    A decimal quantity between 0 and 1000 has at most a million values, so what
    follows works on a bounded table, whatever the number of sales; a double column may
    have as many values as rows, and nothing that follows holds them in one task. Store
    the table where more than one result is made from it. NaN counts as missing.
    """
    df = df.withColumn(column, nan_to_null(F.col(column))) if dict(df.dtypes)[column] in ("double", "float") else df
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    x = F.col(column).cast("double")
    return counted.select(
        "n", F.explode(F.array(
            F.struct(F.lit("raw").alias("scale"), x.alias("x")),
            F.struct(F.lit("log1p").alias("scale"), log1p(F.col(column)).alias("x")),
        )).alias("v"),
    ).select("v.scale", "v.x", "n")


def spread(counts: DataFrame) -> DataFrame:
    """Rows, mean, deviation and range of each scale, by frequency."""
    x, n = F.col("x"), F.col("n")
    rows = F.sum(n)
    mean = F.try_divide(F.sum(x * n), rows)
    squares = F.sum(x * x * n) - F.try_divide(F.sum(x * n) * F.sum(x * n), rows)
    return counts.groupBy("scale").agg(
        rows.alias("n_rows"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.try_divide(squares, rows - 1), F.lit(0.0))).alias("std"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    )


def summary(counts: DataFrame) -> DataFrame:
    """The same with the exact median, found by narrowing ranges (two values reach the driver)."""
    median = F.lit(None).cast("double")
    for (scale, _), value in quantiles.quantiles(counts).items():
        median = F.when(F.col("scale") == scale, F.lit(value)).otherwise(median)
    return spread(counts).select("scale", "n_rows", "mean", median.alias("median"), "std", "low", "high")


def histogram(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Equal-width density histogram of each scale; the last bin is closed.

    A constant column gets a range of width one around its value.
    """
    flat = F.when(F.col("high") == F.col("low"), F.lit(0.5)).otherwise(F.lit(0.0))
    ranges = spread(counts).select(
        "scale", "n_rows", (F.col("low") - flat).alias("low"), (F.col("high") + flat).alias("high")
    )
    width = (F.col("high") - F.col("low")) / bins
    placed = counts.join(F.broadcast(ranges), "scale").select(
        "scale", "n",
        F.least(F.width_bucket("x", "low", "high", F.lit(bins)), F.lit(bins)).alias("bin"),
    )
    filled = placed.groupBy("scale", "bin").agg(F.sum("n").alias("n"))
    edges = ranges.select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin")
    )
    n = F.coalesce(F.col("n"), F.lit(0))
    return edges.join(filled, ["scale", "bin"], "left").select(
        "scale", "bin",
        (F.col("low") + (F.col("bin") - 1) * width).alias("bin_low"),
        n.cast("long").alias("n"),
        F.try_divide(n.cast("double"), F.col("n_rows") * width).alias("density"),
    )


def density(counts: DataFrame, points: int = GRID) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth by Scott's rule.

    Every distinct value adds its weighted kernel to the grid points of its own
    scale. The grid has a fixed length and the sums combine on the map side, so
    one exchange of a grid per task is all that moves.
    """
    ranges = spread(counts).select(
        "scale", "n_rows", "low", "high",
        (F.col("std") * F.pow(F.col("n_rows").cast("double"), F.lit(-0.2))).alias("h"),
    )
    tasks = counts.sparkSession.sparkContext.defaultParallelism
    placed = counts.repartition(tasks, "x").join(F.broadcast(ranges), "scale").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    grid = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / (points - 1)
    z = F.try_divide(grid - F.col("x"), F.col("h"))
    kernel = F.col("n") * F.exp(-z * z / 2)
    scale = F.col("n_rows") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return placed.groupBy("scale", "point").agg(
        F.first(grid).alias("x"),
        F.try_divide(F.sum(kernel), F.first(scale)).alias("density"),
    )


# --- inventory and trend --------------------------------------------------

def negative_inventory(star: Star) -> DataFrame:
    """Share of rows with negative inventory per main group, smallest first."""
    flag = F.col("is_negative_inventory").cast("int")
    sales = star.sales.select("product_key", flag.alias("neg"), F.lit(1).alias("one"))
    if not star.is_small("products"):
        sales = sales.groupBy("product_key").agg(F.sum("neg").alias("neg"), F.sum("one").alias("one"))
    pct = F.try_divide(F.col("neg_count").cast("double"), F.col("total_count")) * 100
    return (
        star.with_products(sales, "maingroup_name", aggregated=True).groupBy("maingroup_name")
        .agg(F.sum("neg").alias("neg_count"), F.sum("one").alias("total_count"))
        .withColumn("pct_neg", pct)
        .orderBy("pct_neg", "maingroup_name")
    )


def daily_trend(star: Star, start: dt.date, end: dt.date) -> DataFrame:
    """Daily quantity per main group inside a closed date range.

    The date key is the date itself as yyyyMMdd, so the range reaches the scan.
    """
    sales = star.sales_within(start, end + dt.timedelta(days=1))
    sales = sales.select("date_key", "product_key", "sales_qty")
    total = F.sum("sales_qty").alias("sales_qty")
    if not star.is_small("products"):
        sales = sales.groupBy("date_key", "product_key").agg(total)
    named = star.with_products(sales, "maingroup_name", aggregated=True)
    daily = named.groupBy("date_key", "maingroup_name").agg(total)
    return star.with_dates(daily, "full_date", "is_weekend").select(
        "full_date", "is_weekend", "maingroup_name", F.col("sales_qty").cast("double")
    )


def top_groups(trend: DataFrame, k: int = 3) -> DataFrame:
    """The k named main groups with the largest total, ties by name."""
    return (
        trend.where(F.col("maingroup_name").isNotNull()).groupBy("maingroup_name").agg(F.sum("sales_qty").alias("total_qty"))
        .orderBy(F.desc("total_qty"), "maingroup_name").limit(k)
    )


def names_of(groups: DataFrame) -> list[str]:
    """The names in a short list of groups, in its order."""
    return [r["maingroup_name"] for r in groups.select("maingroup_name").collect()]


def trend_of(trend: DataFrame, names: list[str]) -> DataFrame:
    """The trend of the named groups."""
    return trend.where(F.col("maingroup_name").isin(names))


def daily_pivot(trend: DataFrame, names: list[str]) -> DataFrame:
    """One column per named main group, one row per day."""
    return trend.groupBy("full_date").pivot("maingroup_name", names).agg(F.sum("sales_qty"))


# --- correlation ----------------------------------------------------------

# The features that are correlated.
CORRELATED = LAGS + ("rolling_mean_7", "rolling_std_7", "cv_7", "day_of_week", "is_weekend")

# Labels of the features that have a shorter one.
LABELS = {
    "rolling_mean_7": "roll_mean7",
    "rolling_std_7": "roll_std7",
    "day_of_week": "day_of_wk",
}


def correlation(features: DataFrame, names=CORRELATED) -> DataFrame:
    """Lower triangle of the correlation matrix, one row per pair of features.

    A row gives its values once for every pair, null where a side is missing, and one
    grouped aggregate holds the centred moments of all pairs; tasks merge theirs before
    the exchange, so what moves is a row per pair and task. A pair with a constant side,
    or without a common row, is NULL.
    """
    names = present(features, names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    values = F.array(*[nan_to_null(F.col(c)) for c in names])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs])
    each = features.select(values.alias("values"), F.explode(cells).alias("cell")).select(
        "cell.*", F.get("values", F.col("cell.i")).alias("a"), F.get("values", F.col("cell.j")).alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    moments = each.select("i", "j", F.when(both, F.col("a")).alias("a"), F.when(both, F.col("b")).alias("b")).groupBy(
        "i", "j").agg(F.covar_pop("a", "b").alias("ab"), F.var_pop("a").alias("aa"), F.var_pop("b").alias("bb"))
    spread = F.sqrt("aa") * F.sqrt("bb")
    labels = F.array(*[F.lit(LABELS.get(n, n)) for n in names])
    # Pairs come from the names, so that a table without rows has them too.
    every = features.sparkSession.range(1).select(F.explode(cells).alias("cell")).select("cell.*")
    return every.join(moments, ["i", "j"], "left").select(
        F.get(labels, F.col("i")).alias("feature"), F.get(labels, F.col("j")).alias("other"),
        F.when(spread > 0, F.try_divide("ab", spread)).alias("corr"))
