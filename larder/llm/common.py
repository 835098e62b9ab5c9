"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import checkpointed

__all__ = ["bounded_sample", "checkpointed", "fresh", "read", "shared_folder", "stored", "text_of"]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the given folder, through Spark's own reader."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the checkpoint folder, which all executors share.

    On a cluster that is the folder of spark.checkpoint.dir; a local master
    without that setting uses the checkpoint folder of the session.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        checkpointed(spark.range(1))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/larder-{uuid.uuid4().hex}"


def stored(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Write a frame as Parquet in the shared folder and read it again.

    It cuts the lineage like a checkpoint, and later reads take only the
    columns that they need. The writer looks at the size of a row group only after 100 rows, and holds it
    until then; of rows that are large themselves, a group gets so many.
    """
    folder = shared_folder(df.sparkSession)
    options = {} if group_rows is None else {"parquet.block.row.count.limit": group_rows}
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near the given ones that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        own = f"_{name}"
        while own.lower() in taken:
            own += "_"
        taken.add(own.lower())
        found.append(own)
    return found


def text_of(column: str | Column) -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bounded_sample(rows: DataFrame, n: int, column: str, seed: int) -> list:
    """At most n values of a column, drawn by a hash of the row.

    The share of hashes that is drawn comes from the number of rows, so the tasks
    together send the driver about n rows, however many there are. A limit
    guards against tables of equal rows, whose hashes are equal too.
    """
    total = rows.count()
    if not total:
        return []
    cells = 1 << 30
    draw = F.pmod(F.xxhash64(*rows.columns, F.lit(seed)), F.lit(cells))
    share = min(1.0, (n + 4 * n ** 0.5) / total)
    found = rows.select(draw.alias("draw"), F.col(column).alias("value")).where(F.col("draw") < int(share * cells) + 1)
    return [r.value for r in sorted(found.limit(2 * n).collect(), key=lambda r: (r.draw, r.value))[:n]]
