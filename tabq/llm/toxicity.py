"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words of a text (hashed, without punctuation), trained with
numpy on the driver from confirmed toxic texts and unlabelled ones. The risk of calling unlabelled
texts clean is corrected by what the positives among them, of share `prior`, contribute; where that
estimate falls below zero, the step undoes it instead of overfitting it. Weights shrink towards zero,
so that long texts gather no noise: only words that tell toxic texts apart count.

Training rows are bounded samples: the texts whose ids have the smallest hashes. Scoring reads all
texts whole.

Defined results: NULL and empty texts get the score of a text without words. Without positives the
score is 0 everywhere. Equal rows get equal results, one each; an empty table gives no rows. New
columns replace those of the same name in the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import append, column_bytes, hashes, slices

SIZE = 1 << 18
POSITIVES, UNLABELLED = 4_000, 12_000  # training texts, at most
FEWEST = 6  # training texts that a word must be in
SHRINK, SHRINK_CHOSEN = 6e-4, 2e-5
THRESHOLD = 0.7
_PUNCTUATION = b"".join(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())


def features(text: bytes) -> np.ndarray:
    """Distinct hashed words, sorted."""
    words = set(text.lower().translate(None, _PUNCTUATION).split())
    return np.unique(hashes(list(words)) % np.uint64(SIZE)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        return float(_sigmoid(self.bias + self.weights[features(text)].sum()))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: list[np.ndarray], positive: np.ndarray, prior: float) -> Model:
    """Choose words with shrinking weights, then fit the chosen ones' weights with hardly any."""
    counts = np.bincount(np.concatenate(rows), minlength=SIZE)
    chosen = descend(rows, positive, prior, np.flatnonzero(counts >= FEWEST), SHRINK)
    return descend(rows, positive, prior, np.flatnonzero(chosen.weights), SHRINK_CHOSEN)


def descend(rows: list[np.ndarray], positive: np.ndarray, prior: float, kept: np.ndarray,
            shrink: float, rounds: int = 300, rate: float = 0.05) -> Model:
    """Minimise prior R+(P) + max(0, R-(U) - prior R-(P)) with logistic loss over the kept words.
    positive: which rows are confirmed; the others are unlabelled."""
    number = np.full(SIZE, -1)
    number[kept] = np.arange(len(kept))
    columns = [number[r] for r in rows]
    columns = [c[c >= 0] for c in columns]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
    column = np.concatenate(columns)
    w, bias = np.zeros(len(kept) + 1), np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    p, u = positive / positive.sum(), ~positive / max(1, (~positive).sum())
    for step in range(1, rounds + 1):
        z = bias + w[-1] + np.bincount(row, w[column], len(rows))
        chance = _sigmoid(z)  # the slope of the loss of "clean"; of "toxic" it is chance - 1
        clean = np.logaddexp(0, z)
        corrected = (u - prior * p) * chance
        if ((u - prior * p) * clean).sum() < 0:
            slope = -corrected  # undo the overfitted part
        else:
            slope = prior * p * (chance - 1) + corrected
        gradient = np.append(np.bincount(column, slope[row], len(kept)), slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        size = rate / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-5)
        w -= size * first / (1 - 0.9 ** step)
        limit = size * shrink
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - limit[:-1], 0)
    weights = np.zeros(SIZE)
    weights[kept] = w[:-1]
    return Model(weights, float(bias + w[-1]))


def _features(batches):
    for batch in (part for whole in batches for part in slices(whole)):
        found = [features(t) for t in column_bytes(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("positive"), pa.array(found, pa.list_(pa.int32()))],
            names=["positive", "features"])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          prior: float | None = None) -> Model:
    """Train on confirmed texts (labels where toxic is 1) and on unlabelled ones. The prior is the
    share of toxic among all labels, if not given."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("toxic")).where(
        "id is not null and toxic is not null")
    if prior is None:
        prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    order = F.xxhash64("id")
    sure = known.where("toxic = 1").select("id").distinct().orderBy(order, "id").limit(positives)
    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id is not null")
    some = named.select("id").distinct().orderBy(F.desc(order), "id").limit(unlabelled)
    chosen = sure.withColumn("positive", F.lit(True)).union(some.withColumn("positive", F.lit(False)))
    rows = named.join(F.broadcast(chosen), "id").select("positive", "text").mapInArrow(
        _features, "positive boolean, features array<int>").toArrow()
    positive = rows.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    if not 0 < prior < 1 or not positive.any():
        return Model(np.zeros(SIZE), -30.0)
    found = [np.array(x.values, np.int32) for x in rows.column("features")]
    return train(found, positive, prior)


def predict(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD,
            keep: list[str] | None = None) -> DataFrame:
    """df's columns `keep` (default: all), a score from 0 to 1 and the prediction."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        own = shared.value
        scores = [own.score(t) for t in column_bytes(batch, text)]
        return [scores, [int(s >= threshold) for s in scores]]

    return append(df, work, "score double, predicted int", keep)
