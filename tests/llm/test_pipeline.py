from __future__ import annotations

import corpus_pipeline
import pytest
import sentencepiece
from larder.llm import mixing, pu_classifier, secret_scan, sentencepiece_tokens, simhash
from larder.llm.common import stored
from larder.llm.queries import queries


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Each stage's input and output, rows as tuples in the order of the table."""
    folder = folder.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = []
    for _, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder))
        found.append((docs, out))
        docs = out
    return folder, found


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_all_but_the_last_stage_keep_the_columns(steps):
    _, found = steps
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "secret scans", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    for before, after in found[:-1]:
        assert after.columns == before.columns and after.schema.simpleString() == before.schema.simpleString()


def test_each_stage_equals_its_operator(spark, steps):
    folder, found = steps
    docs, kept = found[0]
    good = pu_classifier.classify(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1")
    assert rows(kept) == rows(docs.join(good.select("doc_id"), "doc_id", "left_semi").select(docs.columns))

    docs, kept = found[1]
    least = simhash.near_duplicates(docs).where("doc_id = component_id")
    assert rows(kept) == rows(docs.join(least.select("doc_id"), "doc_id", "left_semi").select(docs.columns))

    docs, kept = found[2]
    spans = {r.doc_id: r.spans for r in secret_scan.scan(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert any(spans.values())
    for r in kept.collect():
        text, at = "", 0
        cut = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans[r.doc_id].split(",") if x))
        for start, end, kind in cut:
            if end > at:
                text += texts[r.doc_id][at:max(at, start)] + f"<secret:{kind}>"
                at = end
        text += texts[r.doc_id][at:]
        if not cut:
            assert r.text == texts[r.doc_id]
        elif all(a[1] <= b[0] for a, b in zip(cut, cut[1:])):
            assert r.text == text and r.n_chars == len(text)
        assert not any(texts[r.doc_id][a:b] in r.text for a, b, _ in cut)

    docs, kept = found[3]
    assert rows(kept) == rows(docs)
    place = {r.doc_id: (r.slot, r.offset, r.doc_id) for r in mixing.mixed(docs).collect()}
    order = [r.doc_id for r in mixing.in_mix_order(docs).collect()]
    assert order == sorted(place, key=place.get)

    docs, out = found[4]
    reference = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_tokens.read_model())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert r.ids == reference.encode(texts[r.doc_id]) and r.parity and r.round_trip


def test_the_order_of_the_mix_survives_writing_and_reading(steps):
    _, found = steps
    docs, out = found[3][0], found[-1][1]
    order = [r.doc_id for r in mixing.in_mix_order(docs).collect()]
    assert [r.doc_id for r in out.orderBy("slot", "offset", "doc_id").collect()] == order


def test_run_gives_every_row_its_place_in_the_plan(spark, folder):
    out = stored(corpus_pipeline.run(spark, folder))
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    holders = {}
    for r in out.collect():
        holders.setdefault(r.slot, set()).add(source[r.doc_id])
    assert len(holders) > 1 and all(len(s) == 1 for s in holders.values())


def test_run_gives_the_last_stage(spark, folder, steps):
    small = corpus_pipeline.run(spark, folder).collect()
    assert small and {"doc_id", "ids"} <= set(small[0].asDict())


def test_stages_take_empty_and_odd_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0), (2, "a" * 200_000, "x", None, 5)],
        docs.schema)
    for given in (docs.limit(0), odd):
        at = given
        for _, stage in corpus_pipeline.STAGES:
            at = stored(stage(spark, at, folder))
        assert at.count() <= given.count()


def test_ten_queries_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries()] == list(range(1, 11))
