"""Exact quantiles of any numeric column in bounded memory.

An exact percentile aggregate holds every distinct value of a group in one task.
Here the ranges that hold the wanted ranks are narrowed instead: a pass cuts each
range at values spread evenly over its distinct values (a sketch of fixed size finds
them), counts the rows of the parts exactly, and keeps the part with the rank. The
sketch only says where to cut; the counts decide. A part has about one 64th of the
distinct values, so 10^12 of them take five passes. The last few
thousand values are read in order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUTS = 64
HELD = 5_000


@dataclass
class _Range:
    """Where the value of a rank lies: above `low`, up to `high`, with `below` rows at or below `low`."""

    group: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None

    def holds(self, group: str, x: str) -> Column:
        inside = (F.col(group) == F.lit(self.group)) & F.col(x).isNotNull()
        if self.low is not None:
            inside = inside & (F.col(x) > F.lit(self.low))
        return inside if self.high is None else inside & (F.col(x) <= F.lit(self.high))


def _narrowed(counts: DataFrame, ranges: list[_Range], group: str, x: str, n: str, cuts: int) -> None:
    """Narrow every range to one of its parts, by one pass for the cuts and one for the counts."""
    shares = [i / cuts for i in range(1, cuts)]
    found = counts.agg(*[
        F.percentile_approx(F.when(r.holds(group, x), F.col(x)), shares, cuts * 20).alias(f"c{i}")
        for i, r in enumerate(ranges)
    ]).first()
    # A cut is a part of its own, so that every part is smaller than the range however often a value stands.
    part = lambda at: F.size(F.filter(at, lambda c: c < F.col(x))) * 2 + F.array_contains(at, F.col(x)).cast("int")
    parts = F.array(*[
        F.when(r.holds(group, x), F.struct(
            F.lit(i).alias("i"), part(F.array(*map(F.lit, sorted(set(found[i]))))).alias("part"),
        ))
        for i, r in enumerate(ranges)
    ])
    rows = (
        counts.select(x, n, F.explode(parts).alias("p")).where("p is not null").groupBy("p.i", "p.part")
        .agg(F.sum(n).alias("sum"), F.count("*").alias("rows"), F.min(x).alias("least"), F.max(x).alias("most"))
        .orderBy("i", "part").collect()
    )
    settled = set()
    for row in rows:
        r = ranges[row.i]
        if row.i in settled:
            continue
        if r.below + row["sum"] <= r.rank:
            r.below += row["sum"]
            r.low = row.most
        else:
            settled.add(row.i)
            r.high, r.rows = row.most, row.rows
            if row.least == row.most:
                r.value = row.most


def _read(counts: DataFrame, ranges: list[_Range], group: str, x: str, n: str) -> None:
    """The values of ranks whose ranges hold few distinct values."""
    some = reduce(lambda a, b: a | b, [r.holds(group, x) for r in ranges])
    rows = counts.where(some).groupBy(group, x).agg(F.sum(n).alias("n")).orderBy(x).collect()
    for r in ranges:
        seen = r.below
        for row in rows:
            if row[group] == r.group and (r.low is None or row[x] > r.low):
                seen += row.n
                if seen > r.rank:
                    r.value = row[x]
                    break


def quantiles(
    counts: DataFrame, shares=(0.5,), group: str = "scale", x: str = "x", n: str = "n", cuts: int = CUTS, held: int = HELD,
) -> dict[tuple[str, float], float]:
    """Exact quantiles by (group, share), interpolated between neighbours, of values with frequencies.

    Takes few groups. A group without a value has no entry. The frame is read a few times, so it
    should be stored.
    """
    totals = counts.where(F.col(x).isNotNull()).groupBy(group).agg(F.sum(n).alias("sum"), F.count("*").alias("rows")).collect()
    ranges: dict[tuple[str, int], _Range] = {}
    for t in totals:
        for share in shares:
            place = (t["sum"] - 1) * share
            for rank in {floor(place), ceil(place)}:
                ranges[t[group], rank] = _Range(t[group], rank, t.rows)
    while wide := [r for r in ranges.values() if r.value is None and r.rows > held]:
        _narrowed(counts, wide, group, x, n, cuts)
    if left := [r for r in ranges.values() if r.value is None]:
        _read(counts, left, group, x, n)
    found = {}
    for t in totals:
        for share in shares:
            place = (t["sum"] - 1) * share
            low, high = ranges[t[group], floor(place)].value, ranges[t[group], ceil(place)].value
            found[t[group], share] = low if low == high else (ceil(place) - place) * low + (place - floor(place)) * high
    return found
