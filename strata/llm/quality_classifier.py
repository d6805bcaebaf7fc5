"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade <= k) = logistic(threshold_k - w . x): one weight vector for all grades
and ordered thresholds (the first free, the others by positive steps). ``x``
holds hashed lower-case words and hashed word shapes (runs of letter, digit and
sign classes, repeats of the word before), each block as square roots of counts
scaled to length one, so a text's length does not matter.

Fitting takes at most ``max_rows`` labelled rows (smallest hashes of the ids)
to the driver as sparse rows; scoring is one pass over the texts with the
weights (2 ** word_bits + 2 ** shape_bits numbers) broadcast.

Defined results: null and empty texts have x = 0 and score by the thresholds
alone; rows without a grade are not learnt from; grades that do not occur keep
their place; with fewer than two grades nothing is learnt and all weights are 0;
repeated rows score alike; other columns are returned as they were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WordHasher, carried, restored, written

WORD_BITS, SHAPE_BITS = 15, 12
_REPEAT = 1  # hash of the mark for a word equal to the one before


def _byte_classes() -> np.ndarray:
    """Lower-case letter, capital, digit and beyond-ASCII bytes by class; signs stand for themselves."""
    c = np.arange(256, dtype=np.uint8)
    c[97:123], c[65:91], c[48:58], c[128:] = 97, 65, 48, 97
    return c


class Features:
    """Sparse features of a text."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.classes = _byte_classes()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(indices, values), indices ascending."""
        data = (text or "").encode()
        h, start, end = self.hasher.words(data)
        if not len(h):
            return np.empty(0, np.int64), np.empty(0)
        c = self.classes[np.frombuffer(data, np.uint8)]
        opens = np.ones(len(c), bool)
        opens[1:] = c[1:] != c[:-1]
        opens[start] = True
        at = np.concatenate(([0], np.cumsum(opens)))
        shape = self.hasher.spans(c[opens], at[start], at[end])
        again = np.full(int((h[1:] == h[:-1]).sum()), _REPEAT, np.uint64)
        words = _block(h & np.uint64((1 << WORD_BITS) - 1))
        shapes = _block(np.concatenate((shape, again)) & np.uint64((1 << SHAPE_BITS) - 1))
        return np.concatenate((words[0], shapes[0] + (1 << WORD_BITS))), np.concatenate((words[1], shapes[1]))


def _block(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, n = np.unique(h.astype(np.int64), return_counts=True)
    return i, np.sqrt(n / n.sum())


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def above(self, z: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, by row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(z)[:, None], -30, 30)))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, ridge: float = 1e-4, steps: int = 200) -> OrdinalModel:
    """Adam on the mean negative log likelihood; thresholds as one offset and log steps."""
    size = (1 << WORD_BITS) + (1 << SHAPE_BITS)
    k = n_grades - 1
    counts = np.bincount(grades, minlength=n_grades).astype(float) + 0.5
    share = np.cumsum(counts)[:-1] / counts.sum()
    start = np.log(share / (1 - share))
    if len(set(grades.tolist())) < 2:
        return OrdinalModel(np.zeros(size), start)
    index = np.concatenate([r[0] for r in rows]).astype(np.int64)
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    p = np.concatenate((np.zeros(size), [start[0]], np.log(np.maximum(np.diff(start), 1e-3))))
    m, v = np.zeros_like(p), np.zeros_like(p)
    lower, upper = grades - 1, grades  # thresholds around a grade; -1 and k stand for the ends
    for t in range(1, steps + 1):
        gaps = np.exp(p[size + 1 :])
        theta = p[size] + np.concatenate(([0.0], np.cumsum(gaps)))
        z = np.bincount(row, value * p[index], len(rows))
        cdf = 1 / (1 + np.exp(-np.clip(theta[None, :] - z[:, None], -30, 30)))
        full = np.concatenate((np.zeros((len(z), 1)), cdf, np.ones((len(z), 1))), axis=1)
        slope = full * (1 - full)
        i = np.arange(len(z))
        prob = np.maximum(full[i, upper + 1] - full[i, lower + 1], 1e-9)
        up, down = slope[i, upper + 1] / prob, slope[i, lower + 1] / prob
        by_z = (up - down) / len(z)  # derivative of -log prob
        by_theta = np.zeros(k)
        np.add.at(by_theta, upper[upper < k], -up[upper < k] / len(z))
        np.add.at(by_theta, lower[lower >= 0], down[lower >= 0] / len(z))
        later = np.cumsum(by_theta[::-1])[::-1]  # a step moves every threshold after it
        g = np.concatenate((np.bincount(index, value * by_z[row], size) + ridge * p[:size], [later[0]], later[1:] * gaps))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return OrdinalModel(p[:size], p[size] + np.concatenate(([0.0], np.cumsum(np.exp(p[size + 1 :])))))


def fit(
    docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
    max_rows: int = 8_000, **settings,
) -> OrdinalModel:
    """Fit on at most ``max_rows`` ids of ``ratings`` (id, grade 0 .. n_grades - 1), each with one text (of a repeated id the least)."""
    sample = (
        ratings.where(F.col(grade_col).between(0, n_grades - 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(grade_col).cast("int")).alias("_grade"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for pdf in batches:
            got = [features(t) for t in pdf["_text"]]
            yield pd.DataFrame({
                "grade": pdf["_grade"], "i": [x[0].astype(np.int32).tobytes() for x in got], "v": [x[1].astype(np.float32).tobytes() for x in got],
            })

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = written(
        texts.join(F.broadcast(sample), "_id").groupBy("_id", "_grade").agg(F.min("_text").alias("_text")).select("_text", "_grade").mapInPandas(sparse, "grade int, i binary, v binary"), "graded"
    ).toPandas()  # bounded by max_rows
    pairs = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32).astype(float)) for i, v in zip(rows["i"], rows["v"])]
    return fit_ordinal(pairs, rows["grade"].to_numpy(np.int64), n_grades, **settings)


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least_grade: int = 1, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``_expected_grade``, ``_tail`` (probability of ``least_grade`` or more) and ``_selected``;
    columns of these names are replaced."""
    columns = [c for c in docs.columns if c not in ("_expected_grade", "_tail", "_selected")]
    docs = carried(docs, _text=F.col(f"`{text_col}`"))
    handed = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # workers need not know the class

    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features, m = Features(), OrdinalModel(*handed.value)
        for texts in batches:
            z = np.zeros(len(texts))
            for r, t in enumerate(texts):
                i, v = features(t)
                z[r] = m.weights[i] @ v
            above = m.above(z)
            yield pd.DataFrame({"expected": above.sum(axis=1), "tail": above[:, least_grade - 1]})

    rated = F.pandas_udf(rate, "expected double, tail double")
    return (
        docs.withColumn("_rated", rated("_text"))
        .withColumns({"_expected_grade": F.col("_rated.expected"), "_tail": F.col("_rated.tail"), "_selected": F.col("_rated.tail") >= threshold})
        .select(*restored(docs, columns), "_expected_grade", "_tail", "_selected")
    )
