"""Interleaving sources so that every prefix holds their target weights.

Each source has a weight, a whole number of ticks out of W, which is so fine that
rounding moves no target by a block over any length met. Block k of a source with
n ticks must run at or after its release floor(k W / n) and before its deadline
ceil((k + 1) W / n). Earliest deadline first among the released blocks keeps every
block in its window, so that at no time a source is a whole block ahead or behind.
One task of Spark makes the plan, which holds the blocks that there are; it keeps
a few numbers a source and sends the blocks on as it goes. Neither rows nor sources
pass through the driver.

A source's rows are ordered by a hash of their id. Running character counts, first
of hash buckets and then within them, put a row into the block in which its first
character falls; a large source is spread over many buckets.

Every row keeps its place once: nothing is dropped or repeated. When a source has run
out, the others stay in their windows, and slots in which none is released are empty.
Until the first one runs out every prefix is within one block of each target.

Defined results: null sources are one source of their own; null and empty texts
count no characters and share the block of their neighbours; rows that repeat are
ordered among themselves arbitrarily but lie side by side; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import checkpointed, stored, text_of

RESOLUTION = 1 << 44
PLAN_ROWS = 50_000
BLOCK_CHARS = 32_768
BUCKET_ROWS = 1_000
TEMPER = 0.7


def ticks(weights: list[float], resolution: int = RESOLUTION) -> list[int]:
    """Whole ticks in proportion to weights, one at least each, by largest remainders."""
    if not weights:
        return []
    if min(weights) <= 0:
        raise ValueError("weights must be positive")
    total = sum(weights)
    exact = [max(1.0, w / total * max(resolution, len(weights))) for w in weights]
    found = [int(x) for x in exact]
    spare = max(0, round(sum(exact)) - sum(found))
    for i in sorted(range(len(exact)), key=lambda i: (found[i] - exact[i], i))[:spare]:
        found[i] += 1
    return found


def plan_of(shares: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Earliest deadline first over the given blocks of each source.

    Gives source, block, release, slot, deadline, by slot. A slot in which no block
    is released is passed over.
    """
    length = sum(shares)
    waiting = [(0, i) for i in range(len(shares)) if blocks[i]]  # release of the next block, source
    done = [0] * len(shares)
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[i] + 1) * length // shares[i]), i, release))
        deadline, i, release = heapq.heappop(ready)
        yield i, done[i], release, slot, deadline
        done[i] += 1
        if done[i] < blocks[i]:
            heapq.heappush(waiting, (done[i] * length // shares[i], i))
        slot += 1


def round_of(shares: list[int]) -> list[tuple[int, int, int]]:
    """Earliest deadline first over one round: (source, block in round, slot), by slot."""
    return [(i, k, slot) for i, k, _, slot, _ in plan_of(shares, shares)]


PLAN = ("source string, source_ticks bigint, round_ticks bigint, block bigint, release bigint, slot bigint, "
        "deadline bigint")


def _weighted(totals: DataFrame, weights: dict | None, temper: float) -> DataFrame:
    """The totals of sources with their weights."""
    if weights is None:
        return totals.withColumn("weight", F.pow(F.greatest("chars", F.lit(1)).cast("double"), F.lit(float(temper))))
    given = totals.sparkSession.createDataFrame(
        [("0" if s is None else f"1{s}", float(w)) for s, w in weights.items()], "source string, weight double")
    found = checkpointed(totals.join(given, "source", "left"))
    missing = found.where("weight is null")
    if some := [r.source[1:] if r.source[0] == "1" else None for r in missing.limit(3).collect()]:
        raise ValueError(f"no weight for {missing.count()} sources, such as {some}")
    if not found.where("not weight > 0").isEmpty():
        raise ValueError("weights must be positive")
    return found


def _plan(weighted: DataFrame, resolution: int, block_chars: int) -> DataFrame:
    """Stored: the columns of PLAN for every block of every source, made by one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts:
            return
        sources = pd.concat(parts).sort_values("source")
        names = sources["source"].tolist()
        shares = ticks(sources["weight"].tolist(), resolution)
        length = sum(shares)
        # A row without characters may begin a block after the last character.
        blocks = [c // block_chars + 1 for c in sources["chars"].tolist()]
        rows: list[tuple] = []
        columns = [c.split()[0] for c in PLAN.split(", ")]
        for i, k, release, slot, deadline in plan_of(shares, blocks):
            rows.append((names[i], shares[i], length, k, release, slot, deadline))
            if len(rows) == PLAN_ROWS:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return stored(weighted.select("source", "chars", "weight").repartition(1).mapInPandas(run, PLAN))


PLACE = ("chars", "source_ticks", "round_ticks", "block", "release", "slot", "deadline", "offset")


def _placed(
    docs: DataFrame, keep: list[str], weights: dict | None, id_column: str, text_column: str,
    source_column: str, temper: float, resolution: int, block_chars: int,
) -> DataFrame:
    """The kept columns as a struct `row`, the id as `id`, and the columns of PLACE."""
    source = F.col(source_column).cast("string")
    rows = docs.select(
        F.struct(*keep).alias("row"), F.col(id_column).alias("id"),
        F.concat(F.when(source.isNull(), "0").otherwise("1"), text_of(source)).alias("source"),
        F.length(text_of(text_column)).cast("long").alias("chars"),
        F.xxhash64(F.col(id_column).cast("string")).alias("draw"),
    )
    totals = checkpointed(rows.groupBy("source").agg(F.sum("chars").alias("chars"), F.count("*").alias("n")))
    plan = _plan(_weighted(totals, weights, temper), resolution, block_chars)
    most = totals.agg(F.max("n")).first()[0] or 1

    bits = max(0, ceil(log2(most / BUCKET_ROWS)))
    bucket = F.shiftrightunsigned("draw", 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = rows.withColumn("bucket", bucket)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = checkpointed(
        rows.groupBy("source", "bucket").agg(F.sum("chars").alias("sum"))
        .select("source", "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("source", "bucket").orderBy("draw", "id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(before, ["source", "bucket"])
        .withColumn("offset", F.col("before") + F.coalesce(F.sum("chars").over(within), F.lit(0)))
        .withColumn("block", F.floor(F.col("offset") / block_chars))
        .join(plan, ["source", "block"])
        .select("row", "id", *PLACE)
    )


def mixed(
    docs: DataFrame, weights: dict | None = None, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", temper: float = TEMPER, resolution: int = RESOLUTION,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Id and source of every row with its place in the mix, the columns of PLACE.

    Without weights (one per source, None for null) the targets are the sources'
    characters to the power `temper`, counted over all rows. The order is slot,
    then offset (characters of the source before the row), then the id.
    """
    placed = _placed(docs, [id_column, source_column], weights, id_column, text_column, source_column,
                     temper, resolution, block_chars)
    return placed.select("row.*", *PLACE)


def in_mix_order(
    docs: DataFrame, weights: dict | None = None, id_column: str = "doc_id", text_column: str = "text",
    source_column: str = "source", temper: float = TEMPER, resolution: int = RESOLUTION,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of docs, all columns as they are, sorted by their place in the mix."""
    placed = _placed(docs, docs.columns, weights, id_column, text_column, source_column,
                     temper, resolution, block_chars)
    return placed.orderBy("slot", "offset", "id").select("row.*")


def with_place(
    docs: DataFrame, columns: list[str], weights: dict | None = None, id_column: str = "doc_id",
    text_column: str = "text", source_column: str = "source", temper: float = TEMPER,
    resolution: int = RESOLUTION, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The given columns of every row with its slot and offset, which order the mix together with the id."""
    placed = _placed(docs, columns, weights, id_column, text_column, source_column,
                     temper, resolution, block_chars)
    return placed.select("row.*", "slot", "offset")
