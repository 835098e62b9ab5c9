"""Near-duplicate texts by SimHash fingerprints, linked through pigeonhole blocks.

Fingerprints at most three bits apart differ in at most three of any six blocks of
their bits, so they agree on three blocks at least. Every distinct fingerprint is
put under the 20 keys that each leave three blocks out; only fingerprints under the
same key are compared, and each link is verified by its Hamming distance.

A key under which more than `bucket` fingerprints meet is not compared as it
stands: the bits that it leaves free are split into six blocks again, and so on,
until the group is small or so few bits are free that it is bounded. So no group
grows with the input and no link is lost.

Exact copies share a fingerprint and are one node. Within a group only the links of
a spanning forest are passed on. Components come from hooking and pointer
jumping over tables in the shared folder.

Defined results: a null or empty text has no shingle and the fingerprint zero, which
is linked like any other; rows that repeat are linked by their equal fingerprints;
null ids keep their row, and count as an id only where a component has no other;
an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import checkpointed, fresh, stored
from larder.llm.components import components

BITS = 64
NEAR = 3
BLOCKS = 6
WORDS = 3
SEED = 42
BUCKET = 512

# The shifts pick bit 63 down to bit 0 of a 64-bit value.
_WEIGHTS = np.left_shift(np.uint64(1), np.arange(63, -1, -1, dtype=np.uint64))


def fingerprint_of(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of one text, as a signed 64-bit value."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, -(-hashes.size // 8192)):
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(_WEIGHTS[2 * counts > hashes.size].sum(dtype=np.uint64).astype(np.int64))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column as a long, computed in Arrow batches."""
    @F.pandas_udf(T.LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return of(text)


def as_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# --- blocks ---------------------------------------------------------------

def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _masks(free: tuple[int, ...]) -> list[tuple[int, tuple[int, ...]]]:
    """The ways to leave NEAR of BLOCKS blocks of the free bits out.

    Each is the mask of all bits that a key then holds, and the bits still free.
    """
    blocks = [tuple(int(b) for b in part) for part in np.array_split(np.array(free), BLOCKS)]
    found = []
    for out in combinations(range(BLOCKS), NEAR):
        left = tuple(b for i in out for b in blocks[i])
        found.append(((1 << BITS) - 1 - sum(1 << b for b in left), left))
    return found


def _forest(group: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all near fingerprints of one group, one fewer than nodes in each part."""
    values = np.unique(group)
    unsigned = values.view(np.uint64)
    label = np.arange(values.size)
    for i in range(values.size - 1):
        near = np.bitwise_count(unsigned[i + 1:] ^ unsigned[i]) <= NEAR
        if near.any():
            merged = np.unique(np.append(label[i + 1:][near], label[i]))
            if merged.size > 1:
                label[np.isin(label, merged)] = merged[0]
    return [(int(values[r]), int(values[i])) for i, r in enumerate(label) if i != r]


def _links_in(groups: DataFrame) -> DataFrame:
    """Links within groups given as arrays of fingerprints in the column fps."""
    kind = "array<struct<a:bigint,b:bigint>>"

    @F.pandas_udf(kind)
    def forest(column: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in _forest(np.array(g, np.int64))] for g in column])

    return groups.select(F.explode(forest("fps")).alias("l")).select("l.a", "l.b")


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs a, b of near fingerprints, enough of them to connect all that are linked.

    Takes distinct fingerprints in the column fp. Groups of two up to `bucket`
    are gathered and compared. The members of larger ones go on to a level in
    which their free bits are split again; after three levels at most nine bits
    are free, so that no group can hold more than 512 fingerprints.
    """
    spark = nodes.sparkSession
    free: dict[int, tuple[int, ...]] = {0: tuple(range(BITS))}
    level = nodes.select("fp")
    found: list[DataFrame] = []
    while True:
        ways: dict[int, tuple[int, ...]] = {}
        rows = []
        for parent, bits in free.items():
            for held, left in _masks(bits):
                rows.append((parent, len(ways), _signed(held)))
                ways[len(ways)] = left
        bounded = 2 ** max(map(len, ways.values())) <= BUCKET
        if not found:
            ways_of = F.explode(F.array(*[
                F.struct(F.lit(way).alias("way"), F.lit(mask).cast("bigint").alias("mask")) for _, way, mask in rows]))
            keyed = level.select("fp", ways_of.alias("w")).select("w.way", "w.mask", "fp")
        else:
            # At most 20 ** 3 narrow rows, whatever the input.
            masks = spark.createDataFrame(rows, "parent int, way int, mask bigint")
            keyed = level.join(F.broadcast(masks), "parent").distinct()
        keyed = keyed.select("way", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        groups = checkpointed(keyed.groupBy("way", "key").agg(F.count("*").alias("n")).where("n > 1"))
        members = checkpointed(keyed.join(groups, ["way", "key"]))
        small = members if bounded else members.where(F.col("n") <= bucket)
        found.append(checkpointed(_links_in(
            small.groupBy("way", "key").agg(F.collect_list("fp").alias("fps")))))
        if bounded:
            break
        large = members.where(F.col("n") > bucket)
        parents = [r.way for r in large.select("way").distinct().collect()]  # at most 400 numbers
        if not parents:
            break
        free = {way: ways[way] for way in parents}
        level = large.select(F.col("way").alias("parent"), "fp")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


# --- operators ------------------------------------------------------------

def _linked(marked: DataFrame, best: Column, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints with their component's least value of `best`, and the nodes' table."""
    nodes = stored(marked.groupBy("fp").agg(F.min(best).alias("best")))
    near = checkpointed(components(links(nodes.select("fp"), bucket)))
    rooted = nodes.join(near, nodes["fp"] == near["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "best")
    least = rooted.groupBy("root").agg(F.min("best").alias("best"))
    return stored(rooted.drop("best").join(least, "root").select("fp", "best")), nodes


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of docs: its id, fingerprint and component.

    The component is the smallest id among all rows that can be reached over
    links, the row itself included.
    """
    marked = stored(docs.select(F.col(id_column).alias("id"), fingerprint(F.col(text_column)).alias("fp")))
    least, _ = _linked(marked, F.col("id"), bucket)
    return marked.join(least, "fp").select(
        F.col("id").alias(id_column), as_digits(F.col("fp")).alias("fingerprint"),
        F.col("best").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket: int = BUCKET,
) -> DataFrame:
    """The rows of docs with one row left of each component, that of the smallest id.

    Rows without an id come last; rows that share an id are told apart by a hash of
    their text, and of those that share both one stays.
    """
    flag, number, tag = fresh(docs, "no_id", "id", "tag")
    keys = {
        flag: F.col(id_column).isNull(),
        number: F.coalesce(F.col(id_column), F.lit(0)),
        # Equal texts are in one component, so no two components keep the same key.
        tag: F.xxhash64(text_column),
    }
    marked = stored(docs.select(*[c.alias(n) for n, c in keys.items()], fingerprint(F.col(text_column)).alias("fp")))
    least, _ = _linked(marked, F.struct(flag, number, tag), bucket)
    kept = checkpointed(least.select("best.*").distinct())
    names = list(keys)
    return docs.withColumns(keys).join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)
