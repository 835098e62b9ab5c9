"""The test tables seen as a star schema.

The mapping is arbitrary but fixed and carries no business meaning. Measures are
computed in whole hundredths, so that they are exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.calendar import calendar, date_key
from larder.operators.star import Star


def sales(
    spark: SparkSession, folder: str, start: dt.date | None = None, before: dt.date | None = None
) -> DataFrame:
    """Line items as sales, of a range of shipping dates if one is given."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    shipped = items.schema["l_shipdate"].dataType
    if start is not None:
        items = items.where(F.col("l_shipdate") >= F.lit(start).cast(shipped))
    if before is not None:
        items = items.where(F.col("l_shipdate") < F.lit(before).cast(shipped))
    # The source holds doubles of two digits; as whole hundredths they are exact.
    cents = lambda name: F.rint(F.col(name) * 100).cast("long")
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    money = lambda c: c.cast("decimal(15,0)") * hundredth
    half_up = lambda c, unit: F.floor((c + unit // 2) / F.lit(float(unit)))
    qty, price = cents("l_quantity"), cents("l_extendedprice")
    stock = price - 500_000  # price / 1000 - 5, in steps of 0.00001
    inventory = F.signum(stock) * half_up(F.abs(stock), 1000)
    return items.select(
        date_key(F.to_date("l_shipdate")).alias("date_key"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_suppkey").alias("store_key"),
        money(qty).alias("sales_qty"),
        money(half_up(price * (100 - cents("l_discount")), 100)).alias("sales_revenue"),
        money(half_up(qty * (100 + cents("l_tax")), 100)).alias("import_qty"),
        money(inventory).alias("opening_inventory"),
        (inventory < 0).alias("is_negative_inventory"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    parts = spark.read.parquet(f"{folder}/part.parquet")
    number = F.regexp_replace("p_brand", "[^0-9]", "").cast("int")
    lettered = F.translate("p_brand", "#0123456789", " abcdefghij")
    return parts.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        number.alias("subgroup_id"),
        F.when(number < 20, lettered).otherwise(F.col("p_brand")).alias("subgroup_name"),
        F.col("p_type").alias("maingroup_id"),
        F.col("p_type").alias("maingroup_name"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet")
    nations = spark.read.parquet(f"{folder}/nation.parquet")
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey).select(
        F.col("s_suppkey").alias("store_key"),
        F.col("s_suppkey").cast("string").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_nationkey").alias("province_id"),
        F.col("n_name").alias("province_name"),
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """The days from the first to the last shipping date."""
    day = F.to_date("l_shipdate")
    first, last = spark.read.parquet(f"{folder}/lineitem.parquet").agg(F.min(day), F.max(day)).first()
    return calendar(spark, first, last) if first else calendar(spark, dt.date(1970, 1, 1), dt.date(1970, 1, 1))


def star_of(spark: SparkSession, folder: str) -> Star:
    return Star(
        sales=sales(spark, folder),
        source_within=lambda start, before: sales(spark, folder, start, before),
        dates=lambda: dates(spark, folder),
        products=products(spark, folder),
        stores=stores(spark, folder),
    )


def fingerprint(spark: SparkSession, folder: str) -> str:
    """A text that changes with the files of the star's tables: paths, sizes and times, no content."""
    files = None
    for name in ("lineitem", "part", "supplier", "nation"):
        of = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/{name}.parquet")
        of = of.select("path", "length", "modificationTime")
        files = of if files is None else files.union(of)
    mark = F.xxhash64("path", "length", "modificationTime")
    found = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("mark")).first()
    return f"{found['n']}-{found['mark'] & (1 << 64) - 1:016x}"
