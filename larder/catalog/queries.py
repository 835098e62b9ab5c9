"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import calendar
from larder.models import boosting, lines
from larder.models.arima import arima_forecast, autoregressions
from larder.models.naive import repeated, with_last_known
from larder.models.regressors import feature_columns, feature_vector
from larder.operators import (
    encoding, explore, features, lists, metrics, replenish, rollup, serving, split, star,
)
from larder.operators.serving import Request
from larder.operators.star import Star
from larder.plans import daily_cells, forecasting, monthly_features, serving_models, training
from larder.schemas import FEATURES, KEY_COLUMNS, LAGS, LEVELS, MEASURES
from larder.session import checkpointed, shared_folder
from larder.sources import store
from larder.sources.driver_tables import fingerprint, star_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERIES_LEVEL = "5_subgroup_province"
TREND_START, TREND_END = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
PROVINCE, MAINGROUP = 3, "ECONOMY"
SAMPLE_ROWS, LATEST_ROWS = 5_000, 300
# Tree counts of the levels that are trained one by one.
SMALL_GBT_GRID = (
    {"maxIter": 5, "maxDepth": 3, "stepSize": 0.3},
    {"maxIter": 8, "maxDepth": 3, "stepSize": 0.2},
)


# Sums of decimals and their lags are the nearest doubles already.
EXACT = (*MEASURES, *LAGS)


def rounded(df: DataFrame, exact=(), digits: int = 6) -> DataFrame:
    """Decimals to doubles, doubles to a number of digits unless they are exact."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.DoubleType) and f.name not in exact:
            c = F.round(c, digits).alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str | None = None, exact=()):
    """Register a function of a star as a query, rounding its doubles."""
    def register(build: Callable[[Star], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: rounded(build(star_of(spark, folder)), exact)
        return build
    return register


# --- scan, join, roll-up, features ----------------------------------------

@query()
def star_scan(s: Star) -> DataFrame:
    return s.sales


@query()
def star_join(s: Star) -> DataFrame:
    return star.full_star(s)


@query(exact=EXACT)
def rollup_all_levels(s: Star) -> DataFrame:
    return rollup.rollup_all_levels(s)


@query(exact=EXACT)
def features_all_levels(s: Star) -> DataFrame:
    return features.all_level_features(s)


for _i, _level in enumerate(LEVELS, start=1):
    query(f"rollup_level{_i}", EXACT)(lambda s, level=_level: rollup.rollup_level(s, level))
    query(f"features_level{_i}", EXACT)(lambda s, level=_level: features.level_features(s, level))


def _codes(s: Star, kind: str) -> DataFrame:
    codes, _ = encoding.all_codes(features.all_level_features(s))
    return codes.where(F.col("kind") == kind).drop("kind")


query("factorize_codes")(lambda s: _codes(s, encoding.FIRST))
query("label_codes")(lambda s: _codes(s, encoding.LABEL))


@query("feature_vector")
def _feature_vector(s: Star) -> DataFrame:
    level = "2_category_province"
    keys = LEVELS[level]
    coded = encoding.encoded(features.level_features(s, level), keys)
    names = feature_columns(coded, keys, with_codes=True)
    return feature_vector(coded, names).select(*keys, "full_date", "log_sales_qty", *names)


# --- lists ----------------------------------------------------------------

query("dim_lists")(lists.provinces)
query("store_list")(lists.stores)
query("store_list_of_province")(lambda s: lists.stores(s, PROVINCE))
query("maingroup_list")(lists.maingroups)
query("subgroup_list")(lists.subgroups)
query("subgroup_list_of_maingroup")(lambda s: lists.subgroups(s, MAINGROUP))


# --- exploration ----------------------------------------------------------

def _quantities(s: Star) -> DataFrame:
    return checkpointed(explore.value_counts(star.quantity_range(s.sales)))


@query()
def qty_range(s: Star) -> DataFrame:
    return star.quantity_range(s.sales).select("date_key", "product_key", "store_key", "sales_qty")


@query()
def qty_sample(s: Star) -> DataFrame:
    columns = ("date_key", "product_key", "store_key", "sales_qty", "sales_revenue")
    drawn = explore.random_sample(star.quantity_range(s.sales).select(*columns), SAMPLE_ROWS)
    return drawn.select("sales_qty")


query("qty_summary")(lambda s: explore.summary(_quantities(s)))
query("qty_histogram")(lambda s: explore.histogram(_quantities(s)))
query("qty_kde")(lambda s: explore.density(_quantities(s)))
query("negative_inventory")(explore.negative_inventory)


def _trend(s: Star) -> DataFrame:
    return explore.daily_trend(s, TREND_START, TREND_END)


query("daily_trend")(_trend)
query("top3_groups")(lambda s: explore.top_groups(_trend(s)))
query("daily_trend_top3")(
    lambda s: explore.trend_of(_trend(s), explore.names_of(explore.top_groups(_trend(s)))))


@query()
def daily_pivot(s: Star) -> DataFrame:
    trend = _trend(s)
    names = explore.names_of(explore.top_groups(trend))
    wide = explore.daily_pivot(explore.trend_of(trend, names), names)
    return wide.withColumnsRenamed({n: f"top{i}" for i, n in enumerate(names, start=1)})


@query()
def correlation_long(s: Star) -> DataFrame:
    return explore.correlation(features.level_features(s, "1_category_national"))


@query("calendar")
def _calendar(s: Star) -> DataFrame:
    return calendar.date_range_of(s.with_dates(s.sales.select("date_key").distinct(), "full_date"))


@query()
def weekend_dates(s: Star) -> DataFrame:
    return _calendar(s).where("is_weekend").select(
        "full_date", F.date_format("full_date", "dd/MM").alias("label")
    )


# --- split, baseline, metrics ---------------------------------------------

@query()
def temporal_split(s: Star) -> DataFrame:
    return split.with_split(features.all_level_features(s)).select(
        "level", *KEY_COLUMNS, "full_date", "split", (F.col("split") != "test").alias("is_fit")
    )


@query()
def split_counts(s: Star) -> DataFrame:
    return split.split_counts(features.all_level_features(s))


query("naive_forecast")(
    lambda s: repeated(features.all_level_features(s, step=with_last_known), ("level", *KEY_COLUMNS)))


def _baselines(s: Star) -> DataFrame:
    """Two forecasts with a closed form, on every level at once."""
    rows = features.all_level_features(s, step=with_last_known)
    forecast = lambda model, value, kept: F.struct(
        F.lit(model).alias("model"), value.alias("predicted"), kept.alias("kept")
    )
    both = F.array(
        forecast("naive", F.col("last_qty"), F.col("is_eligible")),
        forecast("uplift", replenish.uplifted(F.col("lag_1")), F.lit(True)),
    )
    return rows.select("level", F.col("sales_qty").alias("actual"), F.explode(both).alias("f")).where(
        "f.kept"
    ).select("level", "f.model", "actual", "f.predicted")


query("metrics")(lambda s: metrics.evaluate(_baselines(s)))
query("best_model")(lambda s: metrics.best_model(metrics.evaluate(_baselines(s))))


# --- serving and replenishment --------------------------------------------

@query()
def serving_filter(s: Star) -> DataFrame:
    cutoff = s.cutoff()
    return serving.requested_sales(s, Request(cutoff, province_id=PROVINCE), cutoff).select(
        "date_key", "product_key", "store_id", "province_id", "subgroup_id", "maingroup_id", *MEASURES
    )


def _served(s: Star) -> DataFrame:
    cutoff = s.cutoff()
    return serving.serving_rollup(s, Request(cutoff), cutoff)


query("serving_rollup")(_served)
query("serving_latest")(lambda s: serving.latest_rows(_served(s), LATEST_ROWS))
query("serving_daily")(lambda s: serving.serving_daily(_served(s)))


def _daily(s: Star) -> DataFrame:
    return rollup.rollup_level(s, SERIES_LEVEL)


def _state(s: Star) -> DataFrame:
    return serving.series_state(_daily(s), LEVELS[SERIES_LEVEL])


query("recent_history")(lambda s: serving.recent_history(_daily(s), LEVELS[SERIES_LEVEL]))


@query()
def point_features(s: Star) -> DataFrame:
    rows = serving.point_features(_state(s), F.date_add("last_date", 1))
    return rows.select(*LEVELS[SERIES_LEVEL], *FEATURES)


@query()
def order_plan(s: Star) -> DataFrame:
    rows = serving.point_features(_state(s), F.date_add("last_date", 1))
    rows = rows.withColumn("forecast", replenish.uplifted(F.col("lag_1")))
    return replenish.with_order(rows, "forecast", "cv_7", "opening_inventory").select(
        *LEVELS[SERIES_LEVEL],
        "predicted_qty", "opening_inventory", "safety_factor_pct", "import_suggestion",
    )


query("stock_status")(lambda s: replenish.stock_status(order_plan(s)))


@query()
def subgroup_details(s: Star) -> DataFrame:
    return replenish.subgroup_details(_served(s))


# --- stored cells and features --------------------------------------------

def cells_folder(spark: SparkSession, folder: str) -> str:
    return f"{shared_folder(spark)}/larder-cells-{fingerprint(spark, folder)}"


def stored(name: str, exact=()):
    """Register a function of a star whose daily cells the first such query stores."""
    def register(build: Callable[[Star], DataFrame]):
        QUERIES[name] = lambda spark, folder: rounded(
            build(daily_cells.with_stored_cells(star_of(spark, folder), cells_folder(spark, folder))), exact)
        return build
    return register


stored("daily_cells")(lambda s: s.cells)
stored("rollup_all_levels_stored", EXACT)(rollup.rollup_all_levels)


def _served_province(s: Star) -> DataFrame:
    cutoff = s.cutoff()
    return serving.serving_rollup(s, Request(cutoff, province_id=PROVINCE), cutoff)


stored("serving_rollup_stored")(_served)
stored("serving_province_stored")(_served_province)
stored("serving_daily_stored")(lambda s: serving.serving_daily(_served(s)))
stored("subgroup_details_stored")(lambda s: replenish.subgroup_details(_served(s)))


@stored("features_refreshed", EXACT)
def _features_refreshed(s: Star) -> DataFrame:
    """Features of all months but the last two, then refreshed by these: the whole table."""
    spark = s.sales.sparkSession
    first = (s.cutoff().replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    table = f"{shared_folder(spark)}/larder-monthly-{uuid.uuid4().hex}"
    earlier = s.served_from(s.cells.where(F.col("full_date") < F.lit(first)))
    monthly_features.update(earlier, table)
    monthly_features.update(s, table, first)
    return monthly_features.stored_features(spark, table)


# --- saved models ---------------------------------------------------------

def models_of(spark: SparkSession, folder: str) -> str:
    """The folder with the models of all levels, trained by the first query that needs them.

    It is named after the files they are trained from, so other data have other models.
    """
    models = f"{shared_folder(spark)}/larder-models-{fingerprint(spark, folder)}"
    table = lambda: checkpointed(features.all_level_features(star_of(spark, folder)))
    return serving_models.ensure_saved(spark, table, models)


def served(build: Callable[[Star, str], DataFrame]):
    """Register a function of a star and the folder of its models as a query."""
    QUERIES[build.__name__] = lambda spark, folder: rounded(build(star_of(spark, folder), models_of(spark, folder)))
    return build


def _registry(s: Star, models: str) -> DataFrame:
    return store.saved_models(s.sales.sparkSession, models)


@served
def model_registry(s: Star, models: str) -> DataFrame:
    return _registry(s, models).select("level", "family", "n_train", "n_val", "n_test")


@served
def model_preference(s: Star, models: str) -> DataFrame:
    return store.preferred(_registry(s, models)).select("level")


def _loaded_forecast(s: Star, models: str, days: int) -> DataFrame:
    """The forecast of every series of the preferred model's level."""
    level, model = store.load_preferred(s.sales.sparkSession, models)
    keys, cutoff = LEVELS[level], s.cutoff()
    daily = rollup.rollup_level(s, level)
    return forecasting.forecast_series(model, daily, keys, cutoff + dt.timedelta(days=days), cutoff).drop("h")


@served
def one_day_forecast(s: Star, models: str) -> DataFrame:
    return _loaded_forecast(s, models, 0)


@served
def recursive_forecast(s: Star, models: str) -> DataFrame:
    return _loaded_forecast(s, models, 7)


@served
def forecast_record(s: Star, models: str) -> DataFrame:
    cutoff = s.cutoff()
    level, model = store.load_preferred(s.sales.sparkSession, models)
    return forecasting.forecast_record(s, model, level, Request(cutoff), cutoff)


# --- forecasts of a fixed line, which SQL can follow step by step ----------

# Weights of a line on the log quantity. They are arbitrary and small, so that a
# forecast rolled out over days stays near the series.
FIXED_BASE = 0.5
FIXED_LINE = {
    "lag_1": 0.02, "lag_3": 0.005, "lag_7": 0.01, "rolling_mean_7": 0.015, "rolling_std_7": -0.005,
    "cv_7": 0.1, "day_of_week": 0.02, "is_weekend": -0.1, "week_of_month": 0.01,
}
ROLLOUT_DAYS = 7


def fixed_model() -> PipelineModel:
    terms = " + ".join(f"{w}D * {name}" for name, w in FIXED_LINE.items())
    return PipelineModel([
        VectorAssembler(inputCols=list(FEATURES), outputCol="inputs"),
        SQLTransformer(statement=f"SELECT *, {FIXED_BASE}D + {terms} AS prediction FROM __THIS__"),
    ])


def _fixed_forecast(s: Star, days: int) -> DataFrame:
    cutoff = s.cutoff()
    return forecasting.forecast_series(
        fixed_model(), _daily(s), LEVELS[SERIES_LEVEL], cutoff + dt.timedelta(days=days), cutoff).drop("h")


query("one_day_forecast_fixed")(lambda s: _fixed_forecast(s, 0))
query("recursive_forecast_fixed")(lambda s: _fixed_forecast(s, ROLLOUT_DAYS))


def _record_fixed(s: Star) -> DataFrame:
    cutoff = s.cutoff()
    record = forecasting.forecast_record(s, fixed_model(), "fixed", Request(cutoff), cutoff)
    return record.withColumns({
        "n_history": F.size("history"), "n_details": F.size("details"),
        "history_qty": F.aggregate("history", F.lit(0.0), lambda a, h: a + h["sales_qty"]),
        "details_qty": F.aggregate("details", F.lit(0.0), lambda a, d: a + d["predicted_qty"]),
    }).drop("history", "details")


query("forecast_record_fixed")(_record_fixed)
stored("forecast_record_stored")(_record_fixed)


def _boosted(s: Star):
    return boosting.train(checkpointed(features.all_level_features(s)))


@query("gbt_forecast")
def _gbt_forecast(s: Star) -> DataFrame:
    fitted, rows = _boosted(s)
    keys = [F.col(k).cast("string").alias(k) for k in KEY_COLUMNS]
    return boosting.predicted(fitted, rows).select(
        "level", F.lit("gbt").alias("model"), *keys, "full_date", "actual", "predicted")


query("feature_importance")(lambda s: boosting.importance(_boosted(s)[0], s.sales.sparkSession))


@query()
def linear_forecast(s: Star) -> DataFrame:
    table = checkpointed(features.all_level_features(s))
    return lines.predicted(lines.fit(table), table)


query("training_moments")(lambda s: lines.correlations(checkpointed(features.all_level_features(s))))


ALL_KEYS = ("level", *KEY_COLUMNS)

# The two levels by store hold nearly as many rows each as there are sales.
query("arima_forecast")(lambda s: arima_forecast(features.all_level_features(s), ALL_KEYS, 2 * s.tasks()))
query("ar_coefficients")(lambda s: autoregressions(features.all_level_features(s), ALL_KEYS, 2 * s.tasks()))


@query()
def predictions(s: Star) -> DataFrame:
    table = checkpointed(features.all_level_features(s))
    return training.all_predictions(
        lambda level: table.where(F.col("level") == level),
        gbt_grid=SMALL_GBT_GRID,
    )


def predictions_folder(spark: SparkSession, folder: str) -> str:
    """The stored predictions of all families and levels; the first query that needs them trains what is missing.

    The folder is named after the files and the settings, so trees of other settings are not taken for these.
    """
    settings = f"{zlib.crc32(repr((boosting.GRID, lines.GRID)).encode()):08x}"
    path = f"{shared_folder(spark)}/larder-predictions-{fingerprint(spark, folder)}-{settings}"
    table = lambda: checkpointed(features.all_level_features(star_of(spark, folder)))
    training.resume(table, path, spark)
    return f"{path}/predictions"


def _stored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return store.read_predictions(spark, predictions_folder(spark, folder))


QUERIES["predictions_stored"] = lambda spark, folder: rounded(_stored_predictions(spark, folder).select(
    "level", "model", *KEY_COLUMNS, "full_date", "actual", "predicted"))
QUERIES["metrics_stored"] = lambda spark, folder: rounded(metrics.evaluate(_stored_predictions(spark, folder)))
QUERIES["best_model_stored"] = lambda spark, folder: rounded(
    metrics.best_model(metrics.evaluate(_stored_predictions(spark, folder))))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
