"""Lookup joins: broadcast behind a size check, salted shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension of this many narrow rows is some 100 MB in executor memory; wide ones
# are bounded by the size of their values as text.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128_000_000

# Keys with at least 1/HOT_KEYS of the rows are spread; there are at most HOT_KEYS.
HOT_KEYS = 2_000
HOT_SAMPLE = 0.01
SALTS = 1024


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame has at most so many rows and bytes; reads no more rows than that."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup(
    facts: DataFrame, dim: DataFrame, key: str, small: bool,
    how: str = "inner", hot: DataFrame | None = None, tasks: int | None = None,
) -> DataFrame:
    """Join facts with a dimension that has one row per key ("inner" or "left").

    A small dimension is broadcast, so the facts do not move. A larger one is
    joined by shuffle. There the rows of each hot key are spread over many
    buckets by a hash of their other columns, and the few dimension rows of hot
    keys are repeated for every bucket. Both sides may be dealt over a number of tasks.
    """
    if small:
        return facts.join(F.broadcast(dim), key, how)
    if hot is None:
        return _dealt(facts, tasks, key).join(_dealt(dim, tasks, key), key, how)
    marked = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[c for c in facts.columns if c != key]), F.lit(SALTS)).cast("int")
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = facts.join(marked, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))
    ).drop("_hot")
    repeated = dim.join(marked, key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    ).drop("_hot")
    on = (key, "_salt")
    return _dealt(salted, tasks, *on).join(_dealt(repeated, tasks, *on), [*on], how).drop("_salt")


def _dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    return df if tasks is None else df.repartition(tasks, *keys)


def hot_keys(facts: DataFrame, key: str, fraction: float = HOT_SAMPLE) -> DataFrame | None:
    """Keys that hold a large share of the rows, at most HOT_KEYS of them, or None.

    The sample only steers the plan. A key it misses goes through the shuffle
    join like the others; no row is left out either way.
    """
    sample = facts.sample(fraction=fraction, seed=17).where(F.col(key).isNotNull())
    counts = sample.groupBy(key).count()
    total = counts.agg(F.sum("count")).scalar()
    hot = counts.where(F.col("count") * HOT_KEYS >= total).select(key).limit(HOT_KEYS)
    rows = hot.collect()
    if not rows:
        return None
    return facts.sparkSession.createDataFrame(rows, hot.schema)
