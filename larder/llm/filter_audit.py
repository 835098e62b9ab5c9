"""What each of five filters removes, in every order, with and without the others.

Words are counted in a sparse document-term matrix. Texts are cut into shards; a shard
encodes its words by a dictionary of its own and holds, in compressed rows, which word
stands how often in which document. The shards' dictionaries are then encoded globally:
each word has one id in all shards. The sum of a row is its number of words, its number
of nonzero entries that of distinct words; they decide filters A and B. C and D come
from the characters and E from the least id of every text; all five flags of a document
are one number, and documents are counted by part and flags before any order is looked at.

    A  under 100 words                      D  holds one of # $ % & * |
    B  under 80 distinct words in 100       E  the text of a smaller id
    C  over 10 capital letters in 100 characters

A word enters the global dictionary once a shard, however often it stands there, and a
shard's words move as a few arrays, one for each range of a checksum. Ids are given within
a range: place in its sorted words times the number of ranges, plus the range; no step
numbers all words, and a task that runs again gives the same ids. Texts that are shared by more than one in 2,000 documents are met by a broadcast
of at most 2,000 rows, all others by a shuffle.

The removals of a filter over all 120 orders need no enumeration: of the orders, a
document that fails c filters is removed by each of them in 120 / c.

Defined results: a null text is empty, a null part the empty string; texts are equal by
128 bits of hash; rows that repeat an id are documents of their own, and the text of the same
id is no smaller one's; a null id is neither smaller nor larger and has no labels; an
id with several labels is good or toxic if one of them says so; null labels say nothing;
an empty table has no parts and an empty result; other columns are not touched.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import stored, text_of

FILTERS = "ABCDE"
FEWEST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
MARKS = "[#$%&*|]"
SHARD_BYTES = 8_000_000
RANGE_WORDS = 1_000_000
LEAST_RANGES = 16
HOT_SHARE = 2_000

ROW = ("doc_id", "part", "a", "b", "capitals", "marked")


# --- document-term matrix -------------------------------------------------

def _parts(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded bytes of text, one row at least."""
    size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(), dtype=np.int64)
    part = (size - 1) // most_bytes
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _one(values: pa.Array) -> pa.Array:
    """An array as the only value of a column of arrays."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _checksums(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(crc32, words.cast(pa.binary()).to_pylist()), np.int64, len(words))


def _shard(part: pa.RecordBatch) -> dict[str, pa.Array]:
    """One shard: the rows' own columns, its words by checksum, and its matrix in compressed rows."""
    text, n = part["text"], part.num_rows
    split = pc.ascii_split_whitespace(text)
    rows = np.repeat(np.arange(n, dtype=np.int64), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    encoded = words.filter(filled).dictionary_encode()
    rows, width = rows[filled.to_numpy(zero_copy_only=False)], max(1, len(encoded.dictionary))
    order = np.argsort(_checksums(encoded.dictionary), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    cells, data = np.unique(rows * width + place[encoded.indices.to_numpy()], return_counts=True)
    indptr = np.searchsorted(cells, np.arange(n + 1, dtype=np.int64) * width)
    capitals = pc.greater(
        pc.multiply(pc.count_substring_regex(text, "[A-Z]").cast(pa.int64()), 100),
        pc.multiply(pc.utf8_length(text).cast(pa.int64()), MOST_CAPITALS))
    own = {c: part[c] for c in ROW[:4]} | {"capitals": capitals, "marked": pc.match_substring_regex(text, MARKS)}
    return {c: _one(v) for c, v in own.items()} | {
        "words": _one(encoded.dictionary.take(pa.array(order))), "indptr": _one(pa.array(indptr.astype(np.int32))),
        "indices": _one(pa.array((cells % width).astype(np.int32))), "data": _one(pa.array(data.astype(np.int32))),
    }


def local_shards(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Shards with dictionaries of their own, one a row, stored."""
    text = text_of(text_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"), text.alias("text"))
    kinds = {"doc_id": rows.schema["doc_id"].dataType, "part": T.StringType(), "a": T.LongType(), "b": T.LongType(),
             "capitals": T.BooleanType(), "marked": T.BooleanType(), "words": T.StringType(),
             "indptr": T.IntegerType(), "indices": T.IntegerType(), "data": T.IntegerType()}
    schema = T.StructType([T.StructField(c, T.ArrayType(k)) for c, k in kinds.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, shard_bytes):
                yield pa.RecordBatch.from_pydict({c: _shard_column(v) for c, v in _shard(part).items()})

    # A shard is megabytes: in a row group of its own, a task that writes or reads holds one, whatever its part of the input.
    return stored(rows.mapInArrow(run, schema).withColumn("shard", F.monotonically_increasing_id()), group_rows=1)


def _shard_column(values: pa.Array) -> pa.Array:
    """Strings with 32-bit offsets, as the schema has them."""
    return values.cast(pa.list_(pa.string())) if pa.types.is_large_string(values.type.value_type) else values


def global_ids(shards: DataFrame) -> DataFrame:
    """The ids of a shard's words in the dictionary of all shards, in pieces that begin at `start`."""
    entries = shards.agg(F.sum(F.size("words"))).first()[0] or 0
    ranges = max(LEAST_RANGES, -(-entries // RANGE_WORDS))
    edges = (np.arange(ranges + 1, dtype=np.int64) << 32) // ranges

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch["words"].slice(i, 1).flatten()
                at = np.searchsorted(_checksums(words), edges)
                held = np.flatnonzero(np.diff(at))
                lists = pa.ListArray.from_arrays(pa.array(np.append(at[held], at[-1]), pa.int32()), words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held), pa.repeat(batch["shard"][i], len(held)), pa.array(at[held], pa.int32()), lists],
                    names=["range", "shard", "start", "words"])

    def encode(key: tuple, pieces: pa.Table) -> pa.Table:
        lists = pieces["words"].combine_chunks()
        encoded = lists.flatten().dictionary_encode()
        sorted_place = np.empty(len(encoded.dictionary), np.int64)
        sorted_place[pc.sort_indices(encoded.dictionary).to_numpy()] = np.arange(len(encoded.dictionary))
        ids = sorted_place[encoded.indices.to_numpy()] * ranges + key[0].as_py()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return pa.table({"shard": pieces["shard"], "start": pieces["start"],
                         "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))})

    pieces = shards.select("shard", "words").mapInArrow(cut, "range long, shard long, start int, words array<string>")
    return pieces.groupBy("range").applyInArrow(encode, "shard long, start int, ids array<long>")


def matrix(shards: DataFrame) -> DataFrame:
    """The shards with global word ids as indices of their compressed rows."""
    own = shards.drop("words")
    schema = T.StructType([
        T.StructField("indices", T.ArrayType(T.LongType())) if f.name == "indices" else f for f in own.schema])

    def encode(shard: pa.Table, ids: pa.Table) -> pa.Table:
        known = ids.sort_by("start")["ids"].combine_chunks().flatten().to_numpy()
        local = shard["indices"].combine_chunks().flatten().to_numpy()
        columns = {f: _one(pa.array(known[local])) if f == "indices" else shard[f] for f in shard.column_names}
        return pa.table(columns)

    return own.groupBy("shard").cogroup(global_ids(shards).groupBy("shard")).applyInArrow(encode, schema)


def row_counts(shards: DataFrame) -> DataFrame:
    """One row per document: its own columns, the sum of its matrix row, and its nonzero entries."""
    kinds = {c: shards.schema[c].dataType.elementType for c in ROW}
    schema = T.StructType([T.StructField(c, k) for c, k in kinds.items()]).add("n_words", T.LongType()).add(
        "n_distinct", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.slice(i, 1)
                indptr = shard["indptr"].flatten().to_numpy()
                sums = np.concatenate([[0], np.cumsum(shard["data"].flatten().to_numpy(), dtype=np.int64)])[indptr]
                yield pa.RecordBatch.from_arrays(
                    [shard[c].flatten() for c in ROW] + [pa.array(np.diff(sums)), pa.array(np.diff(indptr).astype(np.int64))],
                    names=schema.names)

    return shards.select(*ROW, "indptr", "data").mapInArrow(run, schema)


# --- flags ----------------------------------------------------------------

def with_first(rows: DataFrame) -> DataFrame:
    """Append the least id among the documents of the same text, null where there is but one."""
    groups = stored(rows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1"))
    is_hot = F.col("n") >= max(2, -(-rows.count() // HOT_SHARE))
    hot, rare = groups.where(is_hot).drop("n"), groups.where(~is_hot).drop("n")
    met = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), ["a", "b"], "left")
    return met.where("hot").drop("hot").unionByName(
        met.where("hot IS NULL").drop("hot", "first").join(rare, ["a", "b"], "left"))


def with_labels(rows: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Append whether a document is labelled good, and toxic."""
    said = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("doc_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = rows.where("doc_id IS NOT NULL").join(said, "doc_id", "left")
    unnamed = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return named.unionByName(unnamed).fillna(False, ["good", "toxic"])


def flags() -> Column:
    """The five filters that a document fails, as the bits of one number."""
    fails = (
        F.col("n_words") < FEWEST_WORDS, 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        F.col("capitals"), F.col("marked"), F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)))
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))


# --- audit ----------------------------------------------------------------

def orders() -> list[dict]:
    """Every step of every order of the filters: its filter's bit, and the bits before it."""
    found = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, start=1):
            found.append({"filter_order": "".join(FILTERS[k] for k in order), "step": step, "bit": 1 << i, "before": before})
            before |= 1 << i
    return found


def counted(flagged: DataFrame) -> DataFrame:
    """The audit of documents with part, mask, good and toxic: one row per part, order and step."""
    masks = flagged.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    each = masks.select("*", F.explode(steps).alias("o")).select("*", "o.*")
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, passed = mask.bitwiseAND(bit) > 0, mask.bitwiseAND(before) == 0
    here = fails & passed

    def total(condition, value: str = "n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0).cast("long")))

    in_all_orders = F.when(fails, F.col("n") * (F.lit(120) / F.bit_count("mask")).cast("long")).otherwise(F.lit(0))
    return each.groupBy("part", "filter_order", "step").agg(
        total(passed & ~fails).alias("kept"), total(here).alias("removed"), total(fails & ~passed).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"), F.sum(in_all_orders).cast("long").alias("shapley"))


def audit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "lang",
) -> DataFrame:
    """What every filter keeps, removes and duplicates, by part, order and step."""
    rows = stored(row_counts(matrix(local_shards(docs, id_column, text_column, part_column))))
    flagged = with_labels(with_first(rows), labels, id_column)
    return counted(flagged.select("part", flags().alias("mask"), "good", "toxic"))
