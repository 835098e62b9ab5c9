from __future__ import annotations

import zlib

import numpy as np
import pytest
from larder.llm import pu_classifier as pu


def test_features_are_finite_for_any_text():
    for text in (None, "", " ", "\n\n", "a", "é" * 50_000, "|" * 10, "\x00", "a b\n" * 3000):
        found = pu.features_of(text)
        assert found.shape == (len(pu.FEATURES),) and np.isfinite(found).all()


def test_gradient_of_the_risk_is_that_of_finite_differences():
    rng = np.random.default_rng(0)
    p, u = rng.normal(1, 1, (40, 20)), rng.normal(0, 1, (60, 20))

    def risk(model, prior):
        gp, gu = model.raw(p), model.raw(u)
        return prior * pu._loss(gp).mean() + max(0, pu._loss(-gu).mean() - prior * pu._loss(-gp).mean())

    before = pu.STEPS
    try:
        pu.STEPS = 1
        one = risk(pu.fit(p, u, 0.4), 0.4)
        pu.STEPS = 60
        many = risk(pu.fit(p, u, 0.4), 0.4)
    finally:
        pu.STEPS = before
    assert many < one


def test_learning_from_positives_and_unlabelled_finds_prior_and_classes():
    rng = np.random.default_rng(3)
    positive, negative = rng.normal(1.5, 1, (6000, 20)), rng.normal(-1.5, 1, (3000, 20))
    unlabelled = np.vstack([positive[2000:], negative[:2000]])
    first = pu.fit(positive[:1000], unlabelled[::2], None)

    def tally(x):
        return np.bincount(np.minimum(pu.CELLS - 1, (first.scores(x) * pu.CELLS).astype(int)), minlength=pu.CELLS).astype(float)

    prior = pu.prior_of(tally(unlabelled[1::2]), tally(positive[1000:2000]))
    assert abs(prior - 2 / 3) < 0.06
    model = pu.fit(positive[:2000], unlabelled, prior)
    assert (model.scores(positive[2000:]) >= 0.5).mean() > 0.97
    assert (model.scores(negative[2000:]) < 0.5).mean() > 0.97


@pytest.fixture(scope="module")
def tables(spark, folder):
    big = folder.replace("0.001", "0.01")
    return spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")


def test_held_out_accuracy_and_that_held_out_labels_are_not_read(spark, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in pu.classify(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [i for i in truth if got[i].held_out]
    assert np.mean([got[i].predicted == truth[i] for i in held]) >= 0.97
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) quality", "toxic")
    again = {r.doc_id: r.score for r in pu.classify(docs, turned).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)


def test_ids_sources_and_languages_do_not_matter(spark, tables):
    docs, labels = tables
    text = "The same words, in order. " * 10
    two = spark.createDataFrame([(10 ** 9, text, "de", "src0", 1), (10 ** 9 + 1, text, "xx", None, None)], docs.schema)
    got = pu.classify(docs.union(two), labels).where(f"doc_id >= {10 ** 9}").collect()
    assert got[0].score == got[1].score


def test_accepted_keeps_rows_as_they_are(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "x", "y", 0)], docs.schema)
    every = docs.union(odd).withColumnRenamed("n_chars", "score")
    kept = pu.accepted(every, labels)
    assert kept.columns == every.columns
    good = {r.doc_id for r in pu.classify(every, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good


def test_without_positives_and_empty(spark, tables):
    docs, labels = tables
    none = pu.classify(docs.limit(5), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert pu.classify(docs.limit(0), labels).collect() == []
    assert pu.accepted(docs.limit(0), labels).collect() == []
