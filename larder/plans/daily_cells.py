"""Daily sums by subgroup and store, stored by month.

A forecast request, a level's roll-up and the last day are answered from these
cells, which are at most one row a day, subgroup and store however many sales are
behind them. Sums are kept as decimals, so summing them again is exact. A refresh
reads and rewrites the months from a day on; the others keep their files.

The schema is written last and marks the folder as complete, so a build that was
interrupted is done again. A month that has lost all its sales keeps its cells, as
sales are only added or corrected.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import rollup
from larder.operators.star import Star


def cells_of(star: Star) -> DataFrame:
    """The cells of all sales of a star, with the month as yyyyMM."""
    month = (F.year("full_date") * 100 + F.month("full_date")).cast("int")
    return rollup.exact_cells(star).withColumn("month", month)


def _write(cells: DataFrame, folder: str, replaced: str) -> None:
    # The cells are dealt by month and days already, so that a month is a few files and no task holds it all.
    (
        cells.write.partitionBy("month").mode("overwrite")
        .option("partitionOverwriteMode", replaced).parquet(f"{folder}/months")
    )


def build(star: Star, folder: str) -> str:
    """Write the cells of all sales anew."""
    cells = cells_of(star)
    _write(cells, folder, "static")
    cells.limit(0).write.mode("overwrite").parquet(f"{folder}/schema")
    return folder


def refresh(star: Star, folder: str, since: dt.date) -> str:
    """Rewrite the months from the one of a day on, reading no earlier sales."""
    _write(cells_of(star.between(since.replace(day=1))), folder, "dynamic")
    return folder


def stored_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The stored cells; an AnalysisException if there are none."""
    schema = spark.read.parquet(f"{folder}/schema").schema
    return spark.read.schema(schema).parquet(f"{folder}/months")


def with_stored_cells(star: Star, folder: str) -> Star:
    """The star served from the cells of a folder, which are built if the folder is not complete."""
    spark = star.sales.sparkSession
    try:
        return star.served_from(stored_cells(spark, folder))
    except AnalysisException:
        return star.served_from(stored_cells(spark, build(star, folder)))
