"""Rule statistics of texts, and an isolation forest over them.

Each text's words, characters, symbols, duplicate lines and repeated word windows are
counted over the whole text. Two fixed rules fail a text outright. The others are
judged by an isolation forest: trees of random splits, each grown on a few texts;
a text that few splits set apart is anomalous. The forest is grown on a bounded
sample by a hash (parameter `sample`), and scores every text. The threshold comes
from a histogram of the scores of all labelled rows: the one that best tells the
two labels apart while it rejects at most a small share of the good ones.

Defined results: a null or empty text has no words and fails; rows that repeat and
null ids keep their rows; an id whose labels disagree does not calibrate; without
labels nothing but the fixed rules rejects; an empty table gives an empty result;
other columns are not touched.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import bounded_sample, stored

LEAST_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"

SAMPLE = 20_000
TREES = 100
LEAVES = 256
CELLS = 1_000
MOST_GOOD_REJECTED = 0.005
SEED = 11

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
    "n_upper", "n_letters", "n_stops", "n_adjacent",
)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3:0xD0] = True


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of word ids which occurs twice or more."""
    n = ids.size - window + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    for i in range(1, window):
        # Number the prefixes anew, so that keys stay exact for any vocabulary.
        pair = key * (int(ids.max()) + 1) + ids[i:n + i]
        key = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    often = np.bincount(key)[key] > 1
    covered = np.zeros(ids.size + 1, np.int64)
    covered[:n] += often
    covered[window:] -= often
    return int((covered.cumsum() > 0).sum())


def counts_of(text: str | None) -> list[int]:
    """The counts of one text, in the order of COUNTS."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0, 0, sum(map(text.count, SYMBOLS)), *[0] * (len(COUNTS) - 3)]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    lines = [line for line in data.split(b"\n") if line.split()]
    tally = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    blanks = sum(int(tally[c]) for c in b" \t\n\r\x0b\x0c")
    return [
        len(words), len(text) - blanks, sum(int(tally[ord(c)]) for c in SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(ids), len(lines), len(number), int(tally[_UPPER].sum()), int(tally[_LETTER].sum()),
        int(tally[46] + tally[33] + tally[63]), int((ids[1:] == ids[:-1]).sum()),
    ]


def counts(text: Column) -> Column:
    """The counts of a text column, as an array of longs."""
    @F.pandas_udf("array<bigint>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([counts_of(t) for t in texts], dtype=object)

    return of(text)


def statistics(c: np.ndarray) -> np.ndarray:
    """Rule statistics of rows of counts: shares and means that do not grow with the text.

    Repeated lines and windows have fixed rules of their own; as shares they are
    zero in most texts, and a forest would call every other value anomalous.
    """
    n, chars, symbols, _, _, _, _, upper, letters, _, adjacent = c.T.astype(np.float64)
    words = np.maximum(n, 1)
    return np.stack([
        chars / words, symbols / words, upper / np.maximum(letters, 1), letters / np.maximum(chars, 1), adjacent / words,
    ], axis=1)


# --- forest ---------------------------------------------------------------

def _typical(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values."""
    n = np.asarray(n, np.float64)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees as arrays: split column (-1 in leaves), bound, children, depth with what is missing."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, leaves: int = LEAVES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.leaves = min(leaves, len(rows))
        self.trees = [
            self._grow(rows[rng.choice(len(rows), self.leaves, replace=False)], rng) for _ in range(trees)
        ]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        deepest = int(np.ceil(np.log2(max(2, len(rows)))))
        column, bound, left, depth = [], [], [], []
        waiting = [(rows, 0, self._node(column, bound, left, depth))]
        while waiting:
            some, level, at = waiting.pop()
            low, high = some.min(axis=0), some.max(axis=0)
            open_columns = np.flatnonzero(high > low)
            if level >= deepest or len(some) < 2 or not open_columns.size:
                depth[at] = level + float(_typical(len(some)))
                continue
            c = int(rng.choice(open_columns))
            cut = rng.uniform(low[c], high[c])
            column[at], bound[at] = c, cut
            left[at] = self._node(column, bound, left, depth)
            right = self._node(column, bound, left, depth)
            below = some[:, c] <= cut
            waiting += [(some[below], level + 1, left[at]), (some[~below], level + 1, right)]
        return np.array(column), np.array(bound), np.array(left), np.array(depth)

    @staticmethod
    def _node(column: list, bound: list, left: list, depth: list) -> int:
        column.append(-1)
        bound.append(0.0)
        left.append(0)
        depth.append(0.0)
        return len(column) - 1

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1): two to the power of minus the mean depth over the typical one."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for column, bound, left, depth in self.trees:
            at = np.zeros(len(rows), np.int64)
            inner = column[at] >= 0
            while inner.any():
                some = at[inner]
                right = rows[every[inner], column[some]] > bound[some]
                at[inner] = left[some] + right
                inner = column[at] >= 0
            total += depth[at]
        return 2.0 ** -(total / len(self.trees) / max(1e-9, float(_typical(self.leaves))))


def scored(counts_column: Column, forest: Forest) -> Column:
    """The anomaly score of a column of counts."""
    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(forest.scores(statistics(np.vstack(rows.to_numpy()))) if len(rows) else [], dtype="float64")

    return of(counts_column)


def _base_failed() -> Column:
    n, repeat = F.col("c")[0], F.col("c")[4]
    return (n < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n)


def threshold(rated: DataFrame, labels: DataFrame, id_column: str, label_column: str) -> float:
    """The score above which a text is rejected, from all labelled rows that pass the fixed rules.

    Takes columns id, score, base_failed. Only a histogram reaches the driver.
    """
    agreed = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.min(label_column).alias("low"), F.max(label_column).alias("high")).where("low = high")
    cell = F.least(F.lit(CELLS - 1), F.floor(F.col("score") * CELLS).cast("int"))
    found = (
        rated.where(~F.col("base_failed")).join(agreed, "id")
        .groupBy(cell.alias("cell"), F.col("low").alias("label")).count().collect()
    )
    tally = np.zeros((2, CELLS))
    for r in found:
        if r.label in (0, 1):
            tally[r.label, r.cell] += r["count"]
    if not tally[0].sum() or not tally[1].sum():
        return 1.0
    above = tally[:, ::-1].cumsum(axis=1)[:, ::-1] / tally.sum(axis=1, keepdims=True)
    allowed = above[1] <= MOST_GOOD_REJECTED
    gain = np.where(allowed, above[0] - above[1], -1.0)
    return float(gain.argmax() / CELLS) if gain.max() > 0 else 1.0


def judge(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", sample: int = SAMPLE,
) -> DataFrame:
    """Every row's id, counts, base_failed, kept and anomaly score. Texts are read once."""
    found = stored(docs.select(F.col(id_column).alias("id"), counts(F.col(text_column)).alias("c")))
    some = bounded_sample(found.where(~_base_failed()), sample, "c", SEED)
    if some:
        forest = Forest(statistics(np.array(some)))
        rated = stored(found.select("id", "c", _base_failed().alias("base_failed"), scored(F.col("c"), forest).alias("score")))
        bound = threshold(rated, labels, id_column, label_column)
    else:
        rated = found.select("id", "c", _base_failed().alias("base_failed"), F.lit(0.0).alias("score"))
        bound = 1.0
    return rated.select(
        F.col("id").alias(id_column), *[F.col("c")[i].alias(name) for i, name in enumerate(COUNTS[:5])],
        "base_failed", (~F.col("base_failed") & (F.col("score") < bound)).alias("kept"),
        F.round("score", 6).alias("anomaly"),
    )
