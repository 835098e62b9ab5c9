"""Reading the star schema from files, catalog tables or a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.star import Star
from larder.schemas import DATE_SCHEMA, PRODUCT_SCHEMA, SALES_SCHEMA, STORE_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A UTF-8 CSV file with a header; a byte-order mark is skipped."""
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)


def read_dates(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, DATE_SCHEMA)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCT_SCHEMA)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, low: int, high: int, partitions: int,
    column: str = "date_key", **options: str,
) -> DataFrame:
    """A database table, read in parallel by ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=low,
                 upperBound=high, numPartitions=partitions, **options)
        .load()
    )


def parse_dates(df: DataFrame, *columns: str) -> DataFrame:
    """Turn text or timestamp columns into dates."""
    return df.withColumns({c: F.to_date(c) for c in columns if c in df.columns})


def star_from_parquet(spark: SparkSession, folder: str) -> Star:
    """The four tables as Parquet folders sales, dates, products and stores."""
    return Star(
        sales=read_parquet(spark, f"{folder}/sales", SALES_SCHEMA),
        dates=read_parquet(spark, f"{folder}/dates", DATE_SCHEMA),
        products=read_parquet(spark, f"{folder}/products", PRODUCT_SCHEMA),
        stores=read_parquet(spark, f"{folder}/stores", STORE_SCHEMA),
    )


def star_from_catalog(
    spark: SparkSession, sales: str = "FACT_DAILY_SALES", dates: str = "DIM_DATE",
    products: str = "DIM_PRODUCT", stores: str = "DIM_STORE",
) -> Star:
    """The four tables by their catalog names."""
    return Star(*(spark.table(name) for name in (sales, dates, products, stores)))
