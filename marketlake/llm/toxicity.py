"""Toxicity scores: character n-grams, scaled by naive Bayes log-count ratios, in a linear classifier.

Texts are UTF-8 bytes, A-Z lower-cased, all other ASCII characters a blank, so that an n-gram sees where
a word starts and ends. An n-gram counts once for a text, however long the text is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD_TABLE, fold, table_batches, utf8

#: Lengths of the n-grams in bytes, and the number of hash buckets of each length.
ORDERS, BITS = (4, 5, 6), 19
#: Labelled texts of either class that the classifier is fitted on, at most.
PER_CLASS = 2500
#: A log-count ratio counts if it is this many standard errors from zero; others scale their feature to zero.
SURE = 4.0


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each between blanks, and where each starts."""
    parts = [b" ".join(t.translate(WORD_TABLE).split()) for t in texts]
    starts = np.cumsum([0] + [len(p) + 2 for p in parts])
    return np.frombuffer(b" " + b"  ".join(parts) + b" ", np.uint8), starts


def buckets(data: np.ndarray, order: int) -> np.ndarray:
    """Hash bucket of the n-gram that starts at each byte."""
    n = max(0, len(data) - order + 1)
    code = np.zeros(n, np.uint32)
    for i in range(order):
        code *= np.uint32(0x01000193)
        code ^= data[i : i + n]
    code *= np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - BITS)


def features(texts: list[bytes], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) once for each feature of a text; ``used`` keeps the marked features only."""
    data, starts = joined(texts)
    rows, ids = [], []
    for k, order in enumerate(ORDERS):
        found = buckets(data, order)
        where = np.arange(len(found)) if used is None else np.flatnonzero(used[k << BITS : (k + 1) << BITS][found])
        row = np.searchsorted(starts, where, "right") - 1
        inside = where + order <= starts[row + 1]  # not over the blanks between two texts
        rows.append(row[inside])
        ids.append((found[where[inside]].astype(np.int64)) + (k << BITS))
    size = len(ORDERS) << BITS
    both = np.unique(np.concatenate(rows) * size + np.concatenate(ids))
    return both // size, both % size


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        row, feature = features(texts, self.weights != 0)
        sums = np.bincount(row, self.weights[feature], len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -40, 40)))


def fit(texts: list[bytes], labels: np.ndarray, prior: float, rounds: int = 150, rate: float = 0.02, ridge: float = 1e-4) -> Model:
    """Logistic regression on the scaled features, by full gradients with adaptive steps.

    prior: share of label 1 where the texts come from; the bias is moved from the sample's share to it.
    One label only, or none: every text gets the prior.
    """
    size, n1 = len(ORDERS) << BITS, int(labels.sum())
    n0 = len(labels) - n1
    limit = 1e-4
    at = float(np.log(np.clip(prior, limit, 1 - limit) / (1 - np.clip(prior, limit, 1 - limit))))
    if not n1 or not n0:
        return Model(np.zeros(size, np.float32), at)
    # two passes over the sample: counts first, then the features that count
    size_of = 128
    c1, c0 = np.full(size, 0.5), np.full(size, 0.5)
    for start in range(0, len(texts), size_of):
        row, col = features(texts[start : start + size_of])
        toxic = labels[row + start] == 1
        c1 += np.bincount(col[toxic], minlength=size)
        c0 += np.bincount(col[~toxic], minlength=size)
    ratio = np.log(c1 / (n1 + 1)) - np.log(c0 / (n0 + 1))
    ratio[np.abs(ratio) < SURE * np.sqrt(1 / c1 + 1 / c0)] = 0
    used = np.flatnonzero(ratio)
    place = np.zeros(size, np.int32)
    place[used] = np.arange(len(used))
    rows, cols = [], []
    for start in range(0, len(texts), size_of):
        row, col = features(texts[start : start + size_of], ratio != 0)
        rows.append((row + start).astype(np.int32))
        cols.append(place[col])
    row, col = np.concatenate(rows), np.concatenate(cols)
    scale = ratio[used]
    value = scale[col]
    w, y = np.zeros(len(used) + 1), labels.astype(float)  # the last is the bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col] * value, len(labels)) + w[-1], -40, 40)))
        error = (p - y) / len(labels)
        slope = np.append(np.bincount(col, error[row] * value, len(used)) + ridge * w[:-1], error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    b, w = w[-1], w[:-1]
    weights = np.zeros(size, np.float32)
    weights[used] = w * scale
    return Model(weights, b + at - float(np.log(n1 / n0)))


def train(docs: DataFrame, labels: DataFrame, train_fold, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """Fits on at most ``per_class`` texts of either label among the rows for which ``train_fold`` holds.

    The choice goes by a hash of the id. Labels that are null or belong to no document are not used.
    """
    known = labels.filter(train_fold & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    share = known.agg(F.avg("y")).first()[0]
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [known.filter(F.col("y") == y).distinct().orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).join(F.broadcast(chosen), "id")
    rows = texts.select("text", "y").toPandas()
    # rows come in any order: sorted, so that a repeated run fits the same weights
    rows = rows.assign(text=[bytes(t) if t is not None else b"" for t in rows["text"]]).sort_values(["y", "text"])
    return fit(list(rows["text"]), rows["y"].to_numpy(np.int64), float(share or 0.0))


def _scored(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(model.score(utf8(batch.column("text"))))], ["key", "score"]
            )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row, from the whole text alone; null and empty texts get the bias.

    Repeated rows and ids get a row each; an empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    kind = dict(picked.dtypes)["key"]
    scored = picked.mapInArrow(_scored(model), f"key {kind}, score double")
    return scored.select(F.col("key").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""

    @F.pandas_udf("double")
    def toxic(texts: pd.Series) -> pd.Series:
        scores = []
        held, size = [], 0
        for text in texts:
            held.append((text or "").encode())
            size += len(held[-1])
            if size > 4 << 20:
                scores.append(model.score(held))
                held, size = [], 0
        return pd.Series(np.concatenate([*scores, model.score(held)]))

    return docs.filter(toxic(F.col(text_col)) < 0.5)


def training_rows(id_col: str = "doc_id"):
    """The rows that labels may be learnt from: crc32 of the id modulo 5 is not 0."""
    return fold(id_col, 5) != 0
