from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from larder.llm import filter_audit as m

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Every filter applied to every document in every order."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    ids = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            ids[text or ""] = min(ids.get(text or "", doc_id), doc_id)
    flagged = []
    for doc_id, text, part in docs:
        text = text or ""
        words = WORD.findall(text)
        flagged.append((part or "", doc_id, {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and ids[text] < doc_id}))
    rows, shapley = {}, Counter()
    for part in {f[0] for f in flagged}:
        own = [f for f in flagged if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(own)))
            for step, f in enumerate(order, start=1):
                here = [i for i in left if own[i][2][f]]
                gone = [i for i in range(len(own)) if i not in left]
                left = [i for i in left if not own[i][2][f]]
                shapley[part, f] += len(here)
                rows[part, order, step] = [
                    len(left), len(here), sum(own[i][2][f] for i in gone),
                    sum(x[2][f] and sum(x[2].values()) == 1 for x in own),
                    sum(own[i][1] in good for i in here), sum(own[i][1] in toxic for i in here)]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in rows.items())


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


DOCS = [
    (1, words(120), "en"), (2, words(120), "en"), (2, words(120), "en"), (None, words(120), "en"), (3, None, None), (4, "", "en"),
    (5, "", ""), (6, words(99), "de"), (7, words(100) + " #", "de"), (8, "ABCD " * 130, "de"), (9, "a\x0bb\x1cc d\x85e " * 30, "de"),
    (10, words(110).upper() + " $ & |", "fr"), (11, words(80) + " " + words(20), "fr"), (12, "x" * 100_000, "fr"), (13, words(50_000), "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (6, 1, 1), (8, 0, 1), (8, 1, 0), (None, 1, 1), (11, None, None), (99, 1, 1), (7, 1, None)]


def test_equals_brute_force(spark):
    found = m.audit(*frames(spark, DOCS, LABELS)).select(*COLUMNS)
    assert sorted(map(tuple, found.collect())) == brute(DOCS, LABELS)


def test_shards_share_one_dictionary(spark, monkeypatch):
    monkeypatch.setattr(m, "RANGE_WORDS", 10)
    texts = [f"the {i % 5} of {i % 3} {'the ' * (i % 4)}end{i}" for i in range(200)] + [""]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    local = m.local_shards(docs, shard_bytes=300)
    assert local.count() > 10
    words_at = local.select("shard", "words")
    ids = m.global_ids(local)
    by_word, by_id = {}, {}
    lists = {r["shard"]: r["words"] for r in words_at.collect()}
    for r in ids.collect():
        for k, i in enumerate(r["ids"]):
            word = lists[r["shard"]][r["start"] + k]
            assert by_word.setdefault(word, i) == i and by_id.setdefault(i, word) == word
    assert set(by_word) == {w for t in texts for w in t.split()}

    counts = {}
    for s in m.matrix(local).collect():
        for row, doc_id in enumerate(s["doc_id"]):
            span = slice(s["indptr"][row], s["indptr"][row + 1])
            counts[doc_id] = {by_id[i]: n for i, n in zip(s["indices"][span], s["data"][span])}
    assert counts == {i: dict(Counter(t.split())) for i, t in enumerate(texts)}


def test_a_task_writes_and_reads_one_shard_at_a_time(spark):
    docs = [(i, words(20, 20 * i), "en") for i in range(60)]
    shards = m.local_shards(frames(spark, docs, [])[0].coalesce(1), shard_bytes=200)
    (file,) = shards.inputFiles()
    found = pq.ParquetFile(file.removeprefix("file:")).metadata
    assert found.num_rows > 20
    assert {found.row_group(i).num_rows for i in range(found.num_row_groups)} == {1}


def test_copies_met_by_broadcast_or_shuffle_are_the_same(spark, monkeypatch):
    docs = [(i, "copy" if i % 3 == 0 else f"text {i // 2}", "en") for i in range(60)]
    expected = brute(docs, [])
    for share in (2, 30, 10_000):
        monkeypatch.setattr(m, "HOT_SHARE", share)
        assert sorted(map(tuple, m.audit(*frames(spark, docs, [])).select(*COLUMNS).collect())) == expected


def test_empty_tables_and_clashing_columns(spark):
    docs, labels = frames(spark, [], [])
    assert m.audit(docs, labels).count() == 0
    extra = docs.withColumns({c: F.lit(1) for c in ("part", "a", "words", "mask", "good", "first", "n_words", "shard")})
    one = spark.createDataFrame([(1, "x", "en", *[1] * 8)], extra.schema)
    assert m.audit(one, labels.withColumn("good", F.lit("x"))).count() == 600
    assert m.audit(docs.union(spark.createDataFrame([(1, "", None)], docs.schema)), labels).select("part").distinct().collect()[0][0] == ""
