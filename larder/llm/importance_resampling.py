"""Draw the documents that look most like a target text, by importance over hashed n-grams.

Every run of one to three words is a feature, hashed into a bucket. A bucket's gain
says how much likelier it is in the target than in the documents; a document's
weight is the sum of the gains of its features. Gumbel noise from the id makes the
largest scores a sample without replacement.

Segment deduplication: line breaks are never part of a word, so they cut a text into
lines. The features within a line depend on the line alone, so each distinct line is
hashed once, its buckets count as often as the line occurs, and its weight is joined
to every document that has it. Runs of words that cross a line break belong to a pair
of neighbours and are added separately, by document.

Lines are grouped by their text, which combines on the map side. Lines that are more
than one in 2,000 of all (so at most 2,000 lines) get their weights by a broadcast, all
others by a shuffle in which no key is larger. Ranks come from counted score ranges,
each numbered on its own. The driver sees two numbers a bucket and the range ends.

Defined results: a null text is empty; a text without words has no features, weight 0
and is never drawn; a null id has the noise of an empty id and comes last among ties;
rows that repeat, also with the same id, are documents of their own (their ranks follow
each other); an empty target gives the gains of an empty target; an empty table gives an
empty result; other columns, whatever their names, are not touched. Lines are told
apart by 128 bits of hash where weights are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larder.llm.common import stored

BUCKETS = 10_000
SHORTEST = 20
SHARE = 5
HOT_SHARE = 2_000
RANGE_ROWS = 200_000
MOST_RANGES = 2_000
SLACK = 0.002
PIECE_BYTES = 4_000_000

# What each byte of a text becomes: A-Z in lower case, all that is no word's character a
# space, but the line break itself. Bytes of characters beyond ASCII stay.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b == 10 or 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


# --- features -------------------------------------------------------------

def words_of_lines(text: bytes) -> list[list[bytes]]:
    """The words of every line that has one."""
    return [words for line in text.translate(PLAIN).split(b"\n") if (words := line.split())]


def line_hashes(words: list[bytes]) -> list[int]:
    """CRC-32 of every run of one to three words within a line.

    A checksum goes on from that of the run without its last word, so no run is put together.
    """
    later = [b" " + w for w in words]
    one = list(map(crc32, words))
    two = list(map(crc32, later[1:], one))
    return one + two + list(map(crc32, later[2:], two))


def bridge_hashes(lines: list[list[bytes]]) -> list[int]:
    """CRC-32 of every run that crosses a line break, once for the line it begins in.

    Only the last two words of a line and the two words after it take part; the two
    may come from two lines where the next has one word.
    """
    found = []
    for i in range(len(lines) - 1):
        line, after = lines[i], lines[i + 1][:2]
        if len(after) == 1 and i + 2 < len(lines):
            after = after + lines[i + 2][:1]
        pair = crc32(b" " + after[0], crc32(line[-1]))
        found.append(pair)
        if len(line) > 1:
            found.append(crc32(b" ".join((line[-2], line[-1], after[0]))))
        if len(after) > 1:
            found.append(crc32(b" " + after[1], pair))
    return found


def _pieces(batch: pa.RecordBatch, text_column: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded bytes of text, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch[text_column]), 0).to_numpy()
    part = (np.cumsum(lengths, dtype=np.int64) - 1) // PIECE_BYTES
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def _texts(part: pa.RecordBatch, text_column: str) -> list[bytes]:
    return [t or b"" for t in part[text_column].cast(pa.binary()).to_pylist()]


def cut(texts: DataFrame, text_column: str, kept: list[str], with_bridges: bool) -> DataFrame:
    """The lines of every text, as words joined by a space; kept columns stay.

    With bridges come the number of words and the buckets of what crosses line breaks.
    """
    schema = texts.select(*kept).schema.add("lines", T.ArrayType(T.StringType()))
    if with_bridges:
        schema = schema.add("n_words", T.LongType()).add("bridges", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, text_column):
                found = [words_of_lines(t) for t in _texts(part, text_column)]
                columns = [part[c] for c in kept] + [
                    pa.array([[b" ".join(w) for w in lines] for lines in found], pa.list_(pa.binary())).cast(
                        pa.list_(pa.string()))]
                if with_bridges:
                    columns += [
                        pa.array([sum(map(len, lines)) for lines in found], pa.int64()),
                        pa.array([[h % BUCKETS for h in bridge_hashes(lines)] for lines in found], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.select(*kept, text_column).mapInArrow(run, schema)


def distinct_lines(texts: DataFrame, text_column: str) -> DataFrame:
    """Each distinct line once: key (a, b), occurrences n, the buckets of its features."""
    counted = cut(texts, text_column, [], False).select(F.explode("lines").alias("line")).groupBy("line").agg(
        F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, "line"):
                hashes = [line_hashes(line.split(b" ")) for line in _texts(part, "line")]
                ends = np.cumsum([0, *map(len, hashes)])
                flat = np.fromiter(chain.from_iterable(hashes), np.uint32, ends[-1]) % BUCKETS
                buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part["a"], part["b"], part["n"], buckets], names=["a", "b", "n", "buckets"])

    return counted.select(*_key(F.col("line")), "n", "line").mapInArrow(run, "a long, b long, n long, buckets array<int>")


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b")]


def documents_cut(texts: DataFrame, text_column: str, kept: list[str]) -> DataFrame:
    """Every text with its number of words, the keys of its lines, and the buckets that cross them."""
    return cut(texts, text_column, kept, True).select(
        *kept, "n_words", F.transform("lines", lambda line: F.struct(*_key(line))).alias("keys"), "bridges")


def bucket_counts(lines: DataFrame, bridges: DataFrame) -> DataFrame:
    """Occurrences of the features of every bucket: lines times their number, plus what crosses them."""
    within = lines.select(F.explode("buckets").alias("bucket"), "n")
    across = bridges.select(F.explode("bridges").alias("bucket"), F.lit(1).cast("long").alias("n"))
    return within.union(across).groupBy("bucket").agg(F.sum("n").alias("n"))


# --- gains and weights ----------------------------------------------------

def gains(documents: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket from the counts of both sides, with one added to each bucket."""
    s_all, t_all = float(sum(documents.values()) + buckets), float(sum(target.values()) + buckets)
    return [
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((documents.get(b, 0) + 1.0) * t_all)))
        for b in range(buckets)
    ]


def _collected(counts: DataFrame) -> dict[int, int]:
    return {r["bucket"]: r["n"] for r in counts.collect()}


def _summed(gain: list[int], buckets_column: str) -> Column:
    """The sum of the gains of an array of buckets; the gains are one literal of fixed length."""
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    return F.aggregate(buckets_column, F.lit(0).cast("long"), lambda total, b: total + F.get(table, b))


def weigh(rows: DataFrame, lines: DataFrame, gain: list[int]) -> DataFrame:
    """Rows (uid, doc_id, n_words, keys, bridges) with their weight, by the weights of their lines."""
    weights = lines.select("a", "b", "n", _summed(gain, "buckets").alias("w"))
    total = lines.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") >= max(2, -(-total // HOT_SHARE))
    hot = weights.where(is_hot).select("a", "b", "w")
    rare = weights.where(~is_hot).select("a", "b", "w")

    own = _summed(gain, "bridges")
    kept = ["uid", "doc_id", "n_words"]
    used = rows.where("n_words > 0").select(*kept, own.alias("own"), F.posexplode("keys").alias("at", "key"))
    used = used.select(
        *kept, F.col("key.a").alias("a"), F.col("key.b").alias("b"),
        F.when(F.col("at") == 0, F.col("own")).otherwise(F.lit(0).cast("long")).alias("own"))
    met = used.join(F.broadcast(hot), ["a", "b"], "left")
    by_hot = met.where("w IS NOT NULL").select(*kept, "own", "w")
    by_rare = met.where("w IS NULL").drop("w").join(rare, ["a", "b"]).select(*kept, "own", "w")
    worded = by_hot.union(by_rare).groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.sum(F.col("own") + F.col("w")).alias("weight"))
    wordless = rows.where("n_words = 0").select(*kept, F.lit(0).cast("long").alias("weight"))
    return worded.union(wordless)


# --- drawing --------------------------------------------------------------

def noise(doc_id: Column) -> Column:
    """A Gumbel variate in thousandths, from a digest of the id."""
    hashed = F.sha2(F.concat(F.lit("42:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def with_rank(scored: DataFrame, eligible: Column, share: int = SHARE) -> DataFrame:
    """Append the rank of the drawn rows, null for the others.

    Quantiles bound the upper part and cut it into ranges; the rows above each range
    are counted, so ranks are exact however good the quantiles are. A range
    holds some 200,000 rows, and one window numbers it.
    """
    n = scored.where(eligible).count()
    drawn = share * n // 100
    no_rank = F.lit(None).cast("long")
    if not drawn:
        return scored.withColumn("rank", no_rank)
    pieces = min(MOST_RANGES, max(1, math.ceil(drawn / RANGE_ROWS)))
    lowest = max(0.0, 1 - drawn / n - SLACK)
    cuts = [lowest + (1 - lowest) * i / pieces for i in range(pieces)]
    edges = sorted(set(scored.where(eligible).agg(F.percentile_approx("score", cuts, 20_000)).first()[0]))
    upper = scored.where(eligible & (F.col("score") >= edges[0]))
    if lowest == 0.0 or upper.count() < drawn:
        edges, upper = edges[1:], scored.where(eligible)
        lower = scored.where(~eligible)
    else:
        lower = scored.where(~(eligible & (F.col("score") >= edges[0])))
        edges = edges[1:]
    above = F.lit(0)
    if edges:
        above = F.size(F.filter(F.array(*[F.lit(int(e)) for e in edges]), lambda e: e > F.col("score")))
    ranged = upper.withColumn("_range", above)
    counts = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    offsets, seen = [], 0
    for i in range(len(edges) + 1):
        offsets.append(F.lit(seen))
        seen += counts.get(i, 0)
    order = Window.partitionBy("_range").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_words"))
    rank = F.row_number().over(order) + F.element_at(F.array(*offsets), F.col("_range") + 1)
    ranked = ranged.withColumn("rank", rank.cast("long")).drop("_range").withColumn(
        "rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.union(lower.withColumn("rank", no_rank))


def resample(
    docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    target_text: str = "text", share: int = SHARE, shortest: int = SHORTEST,
) -> DataFrame:
    """Every document with its number of features, weight, score, and rank if it is drawn."""
    named = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = stored(documents_cut(named, "text", ["uid", "doc_id"]))
    known = stored(distinct_lines(docs.select(F.col(text_column).alias("text")), "text"))
    wanted = target.select(F.col(target_text).alias("text"))
    gain = gains(
        _collected(bucket_counts(known, rows)),
        _collected(bucket_counts(distinct_lines(wanted, "text"), documents_cut(wanted, "text", []))))

    n = F.col("n_words")
    features = n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    scored = stored(weigh(rows, known, gain).select(
        "doc_id", "n_words", "weight", (F.col("weight") + noise(F.col("doc_id"))).alias("score")))
    return with_rank(scored, F.col("n_words") >= shortest, share).select(
        F.col("doc_id").alias(id_column), features.alias("n_features"), "weight", "score", "rank")
