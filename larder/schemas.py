"""Table schemas, aggregation levels and the other fixed values of the workload."""

from __future__ import annotations

from pyspark.sql import types as T

SALES_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("product_key", T.IntegerType()),
    T.StructField("store_key", T.IntegerType()),
    T.StructField("sales_qty", T.DecimalType(18, 3)),
    T.StructField("sales_revenue", T.DecimalType(18, 2)),
    T.StructField("import_qty", T.DecimalType(18, 3)),
    T.StructField("opening_inventory", T.DecimalType(18, 3)),
    T.StructField("is_negative_inventory", T.BooleanType()),
])

DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("week_of_month", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_month_start", T.BooleanType()),
    T.StructField("is_month_end", T.BooleanType()),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_key", T.IntegerType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("subgroup_id", T.IntegerType()),
    T.StructField("subgroup_name", T.StringType()),
    T.StructField("maingroup_id", T.IntegerType()),
    T.StructField("maingroup_name", T.StringType()),
])

STORE_SCHEMA = T.StructType([
    T.StructField("store_key", T.IntegerType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("province_id", T.IntegerType()),
    T.StructField("province_name", T.StringType()),
])

# The names and keys of the six levels.
LEVELS: dict[str, tuple[str, ...]] = {
    "1_category_national": ("maingroup_id", "maingroup_name"),
    "2_category_province": ("maingroup_id", "maingroup_name", "province_id", "province_name"),
    "3_category_store": ("maingroup_id", "maingroup_name", "store_id"),
    "4_subgroup_national": ("subgroup_id", "subgroup_name"),
    "5_subgroup_province": ("subgroup_id", "subgroup_name", "province_id", "province_name"),
    "6_subgroup_store": ("subgroup_id", "subgroup_name", "store_id"),
}

# Every column a level may group by, in the order the long tables hold them.
KEY_COLUMNS = (
    "maingroup_id", "maingroup_name", "subgroup_id", "subgroup_name",
    "province_id", "province_name", "store_id",
)
CALENDAR_COLUMNS = ("day_of_week", "is_weekend", "week_of_month")
MEASURES = ("sales_qty", "sales_revenue", "import_qty", "opening_inventory")

# Fixed values of the feature set and of the split by day of month.
LAG_DAYS = 7
TRAIN_END_DAY = 21
VAL_END_DAY = 26
EPS = 1e-6

LAGS = tuple(f"lag_{i}" for i in range(1, LAG_DAYS + 1))
ROLLING = ("rolling_mean_7", "rolling_std_7", "cv_7")
FEATURES = LAGS + ROLLING + CALENDAR_COLUMNS

# Ids that get a first-seen code, in the order their code columns are appended.
CODED_IDS = ("store_id", "province_id", "subgroup_id", "maingroup_id")

# Which saved model answers a forecast request, best first.
MODEL_PREFERENCE = (
    "5_subgroup_province", "4_subgroup_national", "2_category_province", "1_category_national",
)

