"""Language of texts: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

A text is the mean of the embeddings of its subwords, byte n-grams inside blank-separated words. The
model is trained by stochastic gradient descent. As it is linear, the product of embeddings and output
weights is one table, and a text's logits are the mean of table rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import fold, row_key, table_batches, utf8

ORDERS, BITS, WIDTH = (2, 3, 4), 16, 16
#: Texts of a language that the model is fitted on, at most, and of these the share that calibrates it.
PER_LANGUAGE, CALIBRATE = 1_500, 0.2
#: Largest share of accepted calibration texts that may be wrong.
WRONG = 0.01
#: Digits, punctuation and white space separate; A-Z are lower-cased.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in one array, each text between blanks, and where each starts."""
    parts = [b" ".join(t.translate(LETTERS).split()) for t in texts]
    starts = np.cumsum([0] + [len(p) + 2 for p in parts])
    return np.frombuffer(b" " + b"  ".join(parts) + b" ", np.uint8), starts


def subwords(data: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram at each byte; the last bytes have none."""
    n = max(0, len(data) - order + 1)
    code = np.full(n, order, np.uint32)
    for i in range(order):
        code *= np.uint32(0x01000193)
        code ^= data[i : i + n]
    code *= np.uint32(0x9E3779B1)
    return code >> np.uint32(32 - BITS)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    sharpness: float = 1.0
    least: float = 0.0
    held: dict = field(default_factory=dict)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        data, starts = joined(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.zeros(len(texts))
        for order in ORDERS:
            found = subwords(data, order)
            bounds = np.minimum(starts[:-1], len(found))
            ends = np.maximum(bounds, starts[1:] - order + 1)
            full = ends > bounds
            if not full.any():
                continue
            # rows of the texts and the gaps between them, in turn
            cuts = np.stack([bounds[full], np.minimum(ends[full], len(found))], 1).ravel()
            pad = np.concatenate([found, np.zeros(1, found.dtype)])
            sums[full] += np.add.reduceat(self.table[pad], cuts, axis=0, dtype=np.float64)[::2]
            counts[full] += ends[full] - bounds[full]
        return sums / np.maximum(counts, 1)[:, None] + self.bias

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(language index, probability after calibration)."""
        z = self.logits(texts) * self.sharpness
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        return p.argmax(1), p.max(1)


def _bags(texts: list[bytes]) -> list[np.ndarray]:
    bags = []
    for text in texts:
        data, _ = joined([text])
        bags.append(np.concatenate([subwords(data, n) for n in ORDERS]).astype(np.uint16))
    return bags


def fit(texts: list[bytes], labels: list[str], epochs: int = 4, rate: float = 0.5, pieces: int = 600, seed: int = 3) -> Model:
    """Stochastic gradient descent over pieces of up to ``pieces`` bytes; then temperature and rejection bound from texts left out."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    y_all = np.array([languages.index(x) for x in labels])
    aside = rng.random(len(texts)) < CALIBRATE if len(texts) >= 50 else np.zeros(len(texts), bool)
    cut, y = [], []
    for i in np.flatnonzero(~aside):
        body = texts[i].translate(LETTERS)
        for start in range(0, len(body), pieces):
            cut.append(body[start : start + pieces])
            y.append(y_all[i])
    y = np.array(y)
    embed = rng.normal(0, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    weight = (len(y) / np.maximum(np.bincount(y, minlength=len(languages)), 1) / len(languages)).astype(np.float32)
    bags, size = _bags(cut), 32
    steps = epochs * -(-len(cut) // size)
    for step in range(steps):
        if step % -(-len(cut) // size) == 0:
            order = rng.permutation(len(cut))
        chosen = order[(step % -(-len(cut) // size)) * size :][:size]
        lengths = np.array([len(bags[i]) for i in chosen])
        chosen, lengths = chosen[lengths > 0], lengths[lengths > 0]
        if not len(chosen):
            continue
        ids = np.concatenate([bags[i] for i in chosen])
        mean = np.add.reduceat(embed[ids], np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
        z = mean @ out + bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(chosen)), y[chosen]] -= 1
        p *= weight[y[chosen]][:, None] / len(chosen)
        now = rate * (1 - step / steps)
        back = (p @ out.T) / lengths[:, None]
        out -= now * 4 * mean.T @ p
        bias -= now * p.sum(0)
        unique, inverse = np.unique(ids, return_inverse=True)
        change = np.zeros((len(unique), WIDTH), np.float32)
        owner = np.repeat(np.arange(len(chosen)), lengths)
        for k in range(WIDTH):
            change[:, k] = np.bincount(inverse, back[owner, k], len(unique))
        embed[unique] -= now * 400 * change
    model = Model(languages, np.ascontiguousarray(embed @ out), bias.astype(np.float64))
    left = [texts[i] for i in np.flatnonzero(aside)]
    if left:
        truth = y_all[aside]
        z = np.concatenate([model.logits(left[i : i + 200]) for i in range(0, len(left), 200)])

        def loss(sharp: float) -> float:
            s = z * sharp
            s = s - s.max(1, keepdims=True)
            return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), truth]).mean())

        model.sharpness = float(min(np.geomspace(0.1, 20, 60), key=loss))
        s = z * model.sharpness
        p = np.exp(s - s.max(1, keepdims=True))
        p = (p / p.sum(1, keepdims=True)).max(1)
        right = z.argmax(1) == truth
        order = np.argsort(-p, kind="stable")
        share = np.cumsum(~right[order]) / np.arange(1, len(p) + 1)
        good = np.flatnonzero(share <= WRONG)
        model.least = float(p[order][good[-1]]) if len(good) else 1.0
    return model


def train(docs: DataFrame, train_fold, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fits on at most ``per_language`` texts of every language among the rows for which ``train_fold`` holds.

    The choice goes by a hash of id and text, in one pass over the rows of all languages; equal rows count
    once (a language of which three quarters are equal rows may give fewer texts). Rows without language or text are not used. Below 50 texts nothing is left out to calibrate
    on, and every text is accepted.
    """
    known = docs.filter(train_fold & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    one, two = row_key(id_col, text_col)
    keyed = known.select(one.alias("k1"), two.alias("k2"), F.col(lang_col).alias("y"), F.col(text_col).cast("binary").alias("text"))
    # hashes are spread evenly: of a large language only the low ones need a rank
    counts = known.groupBy(F.col(lang_col).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    low = F.col("k1") / F.lit(2.0**64) + 0.5 <= F.lit(4.0 * per_language) / F.col("n")
    ranked = keyed.select("y", "k1", "k2").join(counts, "y").filter(low).withColumn("rank", F.dense_rank().over(Window.partitionBy("y").orderBy("k1", "k2")))
    chosen = ranked.filter(F.col("rank") <= per_language).select("y", "k1", "k2").distinct()
    found = keyed.join(F.broadcast(chosen), ["y", "k1", "k2"]).dropDuplicates(["y", "k1", "k2"])
    rows = found.select("text", "y").toPandas()
    rows = rows.assign(text=[bytes(t) for t in rows["text"]]).sort_values(["y", "text"])
    return fit(list(rows["text"]), list(rows["y"]))


def _predicted(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table_batches(batches, 1 << 20):
            raw = batch.column("text").to_pylist()
            lettered = [t is not None and any(map(str.isalpha, t)) for t in raw]
            n = len(raw)
            names, scores, sure = ["und"] * n, [0.0] * n, [False] * n
            if model.languages:
                which, p = model.predict(utf8(batch.column("text")))
                for i in range(n):
                    if lettered[i]:
                        names[i], scores[i], sure[i] = model.languages[which[i]], float(p[i]), bool(p[i] >= model.least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure)],
                ["id", "lang_pred", "score", "accepted"],
            )

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) for every row, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0. accepted says whether the calibrated
    score reaches the bound at which at most ``WRONG`` of the texts left out for calibration are wrong;
    a caller that wants rejected texts as ``und`` reads it so. Repeated rows and ids keep a row each.
    Without a row to learn from every text is ``und``. An empty table gives no rows.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(picked.dtypes)["id"]
    out = picked.mapInArrow(_predicted(model), f"id {kind}, lang_pred string, score double, accepted boolean")
    return out.withColumnRenamed("id", id_col)


def training_rows(id_col: str = "doc_id"):
    """The rows that languages may be learnt from: crc32 of the id modulo 3 is not 1."""
    return fold(id_col, 3) != 1
