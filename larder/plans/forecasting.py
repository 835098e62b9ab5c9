"""Forecasts for a date: one day ahead, or rolled out past the data."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators import replenish, serving
from larder.operators.serving import Request
from larder.operators.star import Star
from larder.schemas import LAG_DAYS
from larder.session import checkpointed

CHECKPOINT_EVERY = 5


def predict_quantity(model: PipelineModel, state: DataFrame, target: Column) -> DataFrame:
    """Append `forecast` and the features for a target date to a series state.

    Model inputs that are no serving feature, such as codes, are 0.
    """
    rows = serving.point_features(state, target)
    names = model.stages[0].getInputCols()
    extra = [n for n in names if n not in rows.columns]
    rows = rows.withColumns({n: F.lit(0.0) for n in extra})
    scored = model.transform(rows).withColumn("forecast", F.expm1("prediction"))
    return scored.select(*state.columns, "cv_7", "forecast")


def one_day_forecast(model: PipelineModel, daily: DataFrame, keys, day: dt.date) -> DataFrame:
    """Forecast a day for every series from its rows before that day."""
    state = serving.series_state(daily.where(F.col("full_date") < F.lit(day)), keys)
    return predict_quantity(model, state, F.lit(day))


def recursive_forecast(
    model: PipelineModel, daily: DataFrame, keys, cutoff: dt.date, days: int
) -> DataFrame:
    """Forecast `days` days past the cutoff for every series at once.

    Each step predicts a day, appends it to the seven kept quantities and goes
    on. Steps are narrow: no rows move after the state is built. The lineage is
    cut every few steps, so that the plan stays small.
    """
    state = serving.series_state(daily.where(F.col("full_date") <= F.lit(cutoff)), keys)
    state = state.withColumns({
        "cv_7": F.lit(None).cast("double"), "forecast": F.lit(None).cast("double")
    })
    for step in range(1, days + 1):
        target = F.lit(cutoff + dt.timedelta(days=step))
        stepped = predict_quantity(model, state.drop("cv_7", "forecast"), target)
        h = F.concat("h", F.array("forecast"))
        state = stepped.withColumn(
            "h", F.when(F.size(h) > LAG_DAYS, F.slice(h, -LAG_DAYS, LAG_DAYS)).otherwise(h)
        )
        if step % CHECKPOINT_EVERY == 0 and step < days:
            state = checkpointed(state)
    return state


def forecast_series(
    model: PipelineModel, daily: DataFrame, keys, request_date: dt.date, cutoff: dt.date
) -> DataFrame:
    """Forecast and order of every series for a date, rolled out if past the data."""
    if request_date > cutoff:
        days = (request_date - cutoff).days
        forecasts = recursive_forecast(model, daily, keys, cutoff, days)
    else:
        forecasts = one_day_forecast(model, daily, keys, request_date)
    return replenish.with_order(forecasts, "forecast", "cv_7", "opening_inventory")


def forecast_record(
    star: Star, model: PipelineModel, model_name: str, request: Request, cutoff: dt.date,
) -> DataFrame:
    """The answer to a forecast request as one nested row.

    Holds the forecast and order over all matching sales, the last seven days,
    and a line per subgroup, of which there are as many as the dimension has.
    Raises if no sale matches.
    """
    rolled = checkpointed(serving.serving_rollup(star, request, cutoff))
    daily = serving.serving_daily(rolled).withColumn("one", F.lit(1))
    if daily.isEmpty():
        raise ValueError("no data for this filter")
    total = forecast_series(model, daily, ["one"], request.forecast_date, cutoff)
    entry = F.struct(F.col("full_date").alias("date"), "sales_qty", "import_qty")
    history = serving.last_rows(daily, ["one"]).groupBy("one").agg(
        F.array_sort(F.collect_list(entry)).alias("history")
    )
    lines = replenish.stock_status(replenish.subgroup_details(rolled))
    details = lines.groupBy(F.lit(1).alias("one")).agg(
        F.array_sort(F.collect_list(F.struct(*lines.columns))).alias("details")
    )
    days = request.rollout_days(cutoff)
    return replenish.stock_status(
        total.join(history, "one").join(details, "one", "left")
    ).select(
        F.lit(request.forecast_date).alias("forecast_date"),
        "predicted_qty", "opening_inventory", "safety_factor_pct", "import_suggestion",
        "status", "days_of_cover", "is_short",
        F.lit(model_name).alias("model_used"),
        F.lit(request.is_rolling(cutoff)).alias("is_rolling"),
        F.lit(days).alias("rollout_days"),
        F.lit(days * replenish.ERROR_GROWTH_PCT).alias("error_growth_pct"),
        "history", "details",
    )


def as_json(record: DataFrame) -> DataFrame:
    """The record as one JSON text."""
    return record.select(F.to_json(F.struct(*record.columns)).alias("record"))
