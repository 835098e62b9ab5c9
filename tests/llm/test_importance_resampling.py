from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from larder.llm import importance_resampling as m

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10_000 for r in runs]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text)[1])
    for text in target:
        t.update(buckets_of(text)[1])
    s_all, t_all = float(sum(s.values()) + 10_000), float(sum(t.values()) + 10_000)
    rows = []
    for doc_id, text in docs:
        n, found = buckets_of(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in found)
        key = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, weight + noise, n])
    fits = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0], -r[2], -r[4]))
    drawn = 5 * len(fits) // 100
    ranks = {id(r): i for i, r in enumerate(fits[:drawn], start=1)}
    return sorted((tuple(r[:4]) + (ranks.get(id(r)),) for r in rows), key=str)


def run(spark, docs, target):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(t,) for t in target], "text string")
    return sorted((tuple(r) for r in m.resample(d, b).collect()), key=str)


ODD = [
    (1, None), (2, ""), (3, "\n\n \t"), (4, "One"), (5, "one\ntwo"), (6, "one\ntwo\nthree four\nfive"),
    (7, "A b\r\nC\x0bd\x1ceéÉ İx\n" * 9), (7, "A b\r\nC\x0bd\x1ceéÉ İx\n" * 9),
    (None, "null id " * 12), (8, "中文 words-with_marks, and more.\n" * 20), (9, ("w " * 3000) + "\n" + "v " * 3000),
]


def test_lines_are_counted_once_and_weighed_as_brute_force_does(spark):
    docs = ODD + [(100 + i, f"shared line of words\nown line {i % 7} and {i}\nx\n" * (i % 9)) for i in range(120)]
    target = ["shared line of words\nown", "more and more words", None, ""]
    assert run(spark, docs, target) == brute(docs, target)


def test_short_lines_are_bridged():
    lines = m.words_of_lines(b"a\nb\nc d\ne")
    found = Counter(h for line in lines for h in m.line_hashes(line)) + Counter(m.bridge_hashes(lines))
    words = b"a b c d e".split()
    runs = [b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert found == Counter(map(crc32, runs))


def test_hot_lines_take_the_broadcast_and_give_the_same(spark, monkeypatch):
    docs = [(i, "hot line here\n" * 3 + f"rare {i} line\n" * 8) for i in range(60)]
    expected = brute(docs, ["hot line"])
    for share in (1, 5, 10_000):
        monkeypatch.setattr(m, "HOT_SHARE", share)
        assert run(spark, docs, ["hot line"]) == expected


def test_ranks_do_not_depend_on_the_ranges(spark, monkeypatch):
    scored = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit(30).cast("long").alias("n_words"), F.lit(0).cast("long").alias("weight"),
        (F.col("id") % 37).cast("long").alias("score"))
    best = sorted(range(4000), key=lambda i: (-(i % 37), i))[:200]
    for rows in (10, 50, 10_000):
        monkeypatch.setattr(m, "RANGE_ROWS", rows)
        ranked = m.with_rank(scored, F.col("n_words") >= 20)
        assert ranked.count() == 4000
        found = ranked.where("rank IS NOT NULL").orderBy("rank").collect()
        assert [(r["rank"], r["doc_id"]) for r in found] == list(enumerate(best, start=1))


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert m.resample(docs, target).count() == 0
    extra = spark.createDataFrame(
        [(1, "some words", 5, 6, 7, "u", "k")], "doc_id long, text string, weight int, score int, rank int, uid string, keys string")
    [row] = m.resample(extra, target).collect()
    assert (row["doc_id"], row["n_features"], row["rank"]) == (1, 3, None)


@pytest.mark.parametrize("text", ["x" * 200_000, "ab " * 100_000, "\n" * 100_000])
def test_long_texts(spark, text):
    assert run(spark, [(1, text)], ["ab"]) == brute([(1, text)], ["ab"])
