"""Quality of texts by learning from trusted positives and unlabelled text.

Features are statistics of a whole text: shares of character classes, word and line
repetition, word lengths. The classifier has one hidden layer; it minimises the
non-negative unbiased risk of positive-unlabelled learning with the logistic loss,

    prior * E+[l(g)] + max(0, Eu[l(-g)] - prior * E+[l(-g)]),

where E+ is over trusted positives and Eu over unlabelled texts. When the second
part falls below zero a step undoes it, so the risk cannot be driven negative by
overfitting.

The class prior is estimated, not given: a first classifier tells positives from
unlabelled texts; the least ratio of the two tail functions of its score, over all
labelled and unlabelled rows, bounds the share of positives from above and is used.

Labels are read only from rows outside the held-out fold, and negative labels are
not used at all. Positives and unlabelled texts that are fitted are bounded samples
by a hash (parameters `positives` and `unlabelled`); the prior counts all rows.

Defined results: a null or empty text has all-zero features and a score like any
other; null ids are not held out; an id whose labels disagree is not used; without
any positive every score is 0.5; an empty table gives an empty result; other columns
are not touched.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_sample, stored

POSITIVES = 10_000
UNLABELLED = 20_000
HIDDEN = 16
STEPS = 300
RATE = 0.01
DECAY = 1e-3
HELD_OUT = (3, 1)
CELLS = 400
SEED = 7

FEATURES = (
    "log_bytes", "log_words", "upper", "lower", "digit", "beyond_ascii", "stop", "clause", "loud", "bar",
    "symbol", "quote_bracket", "other_ascii", "word_length", "line_words", "distinct_words", "top_word",
    "same_as_before", "dup_lines", "ends_stopped",
)

_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((
    bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", bytes(range(128, 256)), b".", b",;:", b"!?",
    b"|", b"#*$%&<>~^=+@\\_", b"'\"()[]{}/-`",
), start=1):
    _CLASS[list(_chars)] = _i
_CLASS[list(b" \t\n\r\x0b\x0c")] = 12
_CLASSES = 13


def features_of(text: str | None) -> np.ndarray:
    """The statistics of one text, in the order of FEATURES."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    found = np.zeros(len(FEATURES), np.float32)
    if not words:
        return found
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=counts, minlength=_CLASSES)
    inked = max(1.0, classes.sum() - classes[12])
    n = len(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    tally = Counter(words)
    letters = max(1.0, classes[1] + classes[2])
    found[:] = (
        np.log1p(len(data)), np.log1p(n), classes[1] / letters, classes[2] / letters, classes[3] / inked,
        classes[4] / inked, classes[5] / n, classes[6] / n, classes[7] / n, classes[8] / n, classes[9] / n,
        classes[10] / n, classes[0] / inked, inked / n, np.log1p(n / len(lines)), len(tally) / n,
        max(tally.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines),
    )
    return found


def features(text: Column) -> Column:
    """The statistics of a text column, as an array of floats."""
    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(t) for t in texts], dtype=object)

    return of(text)


def held_out(id_column: str | Column) -> Column:
    """Whether a row lies in the held-out fold, by the checksum of its id as text."""
    folds, fold = HELD_OUT
    checksum = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return checksum % folds == fold


# --- model ----------------------------------------------------------------

class Model:
    """Standardised features, one hidden layer of tanh units and a direct linear path."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, parts: list[np.ndarray]):
        self.mean, self.scale, self.parts = mean, scale, parts

    def shaped(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        w, b, v, u, c = self.parts
        z = self.shaped(x)
        return np.tanh(z @ w + b) @ v + z @ u + c[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def _slope(g: np.ndarray) -> np.ndarray:
    """Derivative of the logistic loss log(1 + exp(-g))."""
    return -1 / (1 + np.exp(np.clip(g, -40, 40)))


def _loss(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -g)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Model:
    """Minimise the non-negative risk; without a prior, tell positives from unlabelled texts.

    Full batches of the bounded samples, adaptive steps, a fixed seed: the same
    rows give the same model.
    """
    rng = np.random.default_rng(SEED)
    both = np.vstack([positive, unlabelled])
    model = Model(both.mean(axis=0), both.std(axis=0) + 1e-3, [])
    p, u = model.shaped(positive), model.shaped(unlabelled)
    d = both.shape[1]
    model.parts = [
        rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN),
        np.zeros(d), np.zeros(1),
    ]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in model.parts]

    def forward(z):
        w, b, v, lin, c = model.parts
        h = np.tanh(z @ w + b)
        return h, h @ v + z @ lin + c[0]

    def backward(z, h, slope):
        w, b, v, lin, c = model.parts
        inner = np.outer(slope, v) * (1 - h * h)
        return [z.T @ inner, inner.sum(axis=0), h.T @ slope, z.T @ slope, np.array([slope.sum()])]

    for step in range(1, STEPS + 1):
        hp, gp = forward(p)
        hu, gu = forward(u)
        if prior is None:
            grads = [a + b for a, b in zip(
                backward(p, hp, _slope(gp) / len(p)), backward(u, hu, -_slope(-gu) / len(u)))]
        else:
            negative = _loss(-gu).mean() - prior * _loss(-gp).mean()
            keep = backward(p, hp, prior * _slope(gp) / len(p))
            rest = [a + b for a, b in zip(
                backward(u, hu, -_slope(-gu) / len(u)), backward(p, hp, prior * _slope(-gp) / len(p)))]
            grads = [a + b for a, b in zip(keep, rest)] if negative >= 0 else [-r for r in rest]
        for i, (x, grad) in enumerate(zip(model.parts, grads)):
            grad = grad + DECAY * x
            m, s = moments[i]
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return model


def score(values: Column, model: Model) -> Column:
    """The model's score of a column of features."""
    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.vstack(rows.to_numpy()).astype(np.float64)) if len(rows) else [])

    return of(values)


def text_score(text: Column, model: Model | None) -> Column:
    """The model's score of a text column, straight from the text."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(
            model.scores(np.vstack([features_of(t) for t in texts]).astype(np.float64)) if len(texts) else [])

    return of(text)


# --- learning from tables -------------------------------------------------

def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """At most n rows' features, drawn by a hash of the id and the features."""
    found = bounded_sample(rows.select("id", "x"), n, "x", SEED)
    return np.array(found, np.float64).reshape(len(found), len(FEATURES))


def _half(which: int) -> Column:
    """Whether a row is in one of two halves, by a hash of the id."""
    return F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(2)) == which


def prior_of(every: np.ndarray, positive: np.ndarray) -> float:
    """The least ratio of tails, all rows over positives, from counts by score.

    Tails of few positives are noisy: those with under half of them are left out. The
    least of noisy ratios lies rather too low than too high, which is the safe side:
    with too high a prior the risk meets its bound before the negatives are learned.
    """
    above, share = every[::-1].cumsum()[::-1] / every.sum(), positive[::-1].cumsum()[::-1] / positive.sum()
    solid = share >= 0.5
    return float(np.clip((above[solid] / share[solid]).min(), 0.05, 0.98))


def _tally(rows: DataFrame, first: Model) -> np.ndarray:
    cell = F.least(F.lit(CELLS - 1), F.floor(score(F.col("x"), first) * CELLS).cast("int"))
    counts = np.zeros(CELLS)
    for r in rows.groupBy(cell.alias("cell")).count().collect():
        counts[r.cell] = r["count"]
    return counts


def train(
    found: DataFrame, labels: DataFrame, id_column: str = "doc_id", label_column: str = "quality",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> tuple[Model | None, float | None]:
    """Model and class prior from features (columns id, x) and a table of labels.

    For the prior, a first classifier is fitted on each half of the rows, by a hash of
    the id, and read off its scores of all rows of the other half; the mean counts.
    """
    agreed = labels.where(~held_out(id_column)).groupBy(F.col(id_column).alias("id")).agg(
        F.min(label_column).alias("low"), F.max(label_column).alias("high"))
    trusted = stored(found.join(agreed.where("low = 1 and high = 1").select("id"), "id", "left_semi"))
    p = _sample(trusted, positives)
    if not len(p):
        return None, None
    u = _sample(found, unlabelled)
    priors = []
    for half in (0, 1):
        first_p, first_u = _sample(trusted.where(_half(half)), positives), _sample(found.where(_half(half)), unlabelled)
        if len(first_p) and len(first_u):
            first = fit(first_p, first_u, None)
            every, positive = _tally(found.where(_half(1 - half)), first), _tally(trusted.where(_half(1 - half)), first)
            if every.sum() and positive.sum():
                priors.append(prior_of(every, positive))
    prior = sum(priors) / len(priors) if priors else 0.5
    return fit(p, u, prior), prior


def _features(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return stored(docs.select(F.col(id_column).alias("id"), features(F.col(text_column)).alias("x")))


def classify(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> DataFrame:
    """Every row's id with held_out, score and predicted. Texts are read once."""
    found = _features(docs, id_column, text_column)
    model, _ = train(found, labels, id_column, label_column, positives, unlabelled)
    value = F.lit(0.5) if model is None else score(F.col("x"), model)
    return found.select(F.col("id").alias(id_column), held_out("id").alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> DataFrame:
    """The rows of docs, all columns, whose score is at least 0.5."""
    model, _ = train(_features(docs, id_column, text_column), labels, id_column, label_column, positives, unlabelled)
    return docs.where(text_score(F.col(text_column), model) >= 0.5)
