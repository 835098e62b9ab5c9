"""From forecasts to order quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.functions import numeric
from larder.schemas import LAG_DAYS

# Fixed values of the ordering rule.
BASE_SAFETY = 0.15
SAFETY_PER_CV = 0.25
MAX_SAFETY = 0.40
OVERSTOCK = 3
UPLIFT = 0.05
SHORT_SERIES_CV = 0.15
ALERT_SHARE = 0.5
ERROR_GROWTH_PCT = 2


def safety_factor(cv: Column) -> Column:
    """Grows with the variation of the series, up to a ceiling."""
    return F.least(F.lit(MAX_SAFETY), F.lit(BASE_SAFETY) + cv * SAFETY_PER_CV)


def order_quantity(forecast: Column, safety: Column, inventory: Column) -> Column:
    """What is missing to the forecast plus safety; nothing when over-stocked."""
    need = F.greatest(F.lit(0.0), forecast * (1 + safety) - inventory)
    return F.when(inventory > forecast * OVERSTOCK, F.lit(0.0)).otherwise(need)


def with_order(df: DataFrame, forecast: str, cv: str, inventory: str) -> DataFrame:
    """Append the rounded forecast, inventory, safety percentage and order."""
    safety = safety_factor(F.col(cv))
    order = order_quantity(F.col(forecast), safety, F.col(inventory))
    return df.withColumns({
        "predicted_qty": F.round(F.col(forecast), 2),
        "safety_factor_pct": F.round(safety * 100, 1),
        "import_suggestion": F.round(order, 2),
        "opening_inventory": F.round(F.col(inventory), 2),
    })


def stock_status(df: DataFrame) -> DataFrame:
    """Append the status of an order line and the days its inventory covers."""
    order = F.coalesce(F.col("import_suggestion"), F.lit(0.0))
    qty = F.coalesce(F.col("predicted_qty"), F.lit(0.0))
    stock = F.coalesce(F.col("opening_inventory"), F.lit(0.0))
    covered = (stock > 0) & (qty > 0)
    return df.withColumns({
        "status": F.when(order > qty * ALERT_SHARE, "alert").when(order > 0, "warn").otherwise("ok"),
        "days_of_cover": F.when(covered, F.round(F.try_divide(stock, qty)).cast("long")),
        "is_short": ~covered,
    })


def uplifted(last: Column) -> Column:
    """The simple forecast of a group: its last day plus a fixed uplift."""
    return last * (1 + UPLIFT)


def subgroup_details(rolled: DataFrame) -> DataFrame:
    """Forecast and order of every subgroup from its own daily rows.

    The inventory is the mean over days. The variation is that of the last seven
    days (population deviation), or a fixed value for fewer than three days.
    Names come from the newest row. One aggregate brings rows down to a day per
    subgroup; one window and one more aggregate work on that.
    """
    names = F.struct("subgroup_name", "maingroup_name")
    first_names = F.min_by(names, F.struct("maingroup_id", "maingroup_name", "subgroup_name"))
    daily = rolled.where(F.col("subgroup_id").isNotNull()).groupBy("subgroup_id", "full_date").agg(
        F.sum("sales_qty").alias("sales_qty"),
        F.sum("opening_inventory").alias("inventory"),
        first_names.alias("names"),
    )
    back = F.row_number().over(Window.partitionBy("subgroup_id").orderBy(F.desc("full_date")))
    recent = F.when(F.col("back") <= LAG_DAYS, F.col("sales_qty"))
    lines = daily.withColumn("back", back).groupBy("subgroup_id").agg(
        F.try_divide(F.sum("inventory"), F.count("*")).alias("inventory"),
        F.count("*").alias("days"),
        F.max_by("names", "full_date").alias("names"),
        F.max_by("sales_qty", "full_date").alias("last_qty"),
        numeric.variation(F.stddev_pop(recent), F.avg(recent)).alias("cv"),
    ).withColumns({
        "forecast": uplifted(F.col("last_qty")),
        "cv": F.when(F.col("days") >= 3, F.col("cv")).otherwise(F.lit(SHORT_SERIES_CV)),
    })
    return with_order(lines, "forecast", "cv", "inventory").select(
        F.nullif("subgroup_id", F.lit(0)).alias("subgroup_id"),
        "names.subgroup_name", "names.maingroup_name",
        "predicted_qty", "opening_inventory", "import_suggestion", "safety_factor_pct",
    )
