"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled documents, the unlabelled sample is any text of the
corpus. The share of positives in it is estimated from how many unlabelled texts reach
the scores that positives reach. The model is a sum of step functions of dense text
statistics, trained on the non-negative unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

with logistic loss, so its sigmoid is a probability of good quality.

The fit sees ``SAMPLE`` documents of either kind in expectation, chosen by a hash of
doc_id, whatever the size of the corpus; every document is scored whole. Labels of rows
with crc32(doc_id) mod 5 = 0 are held out and never read for the fit.

Cases: a null text is scored as an empty one. Without any labelled positive every
score is 0.5. Repeated rows are scored each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text_stats import STATS, text_stats
from shelfline.llm.words import slices

#: Labelled positives, and as many unlabelled documents, that the fit takes in expectation.
SAMPLE = 12_000
STEPS = 24
ROUNDS = 800
WEIGHT_DECAY = 3e-5
THRESHOLD = 0.3


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


@dataclass
class StepModel:
    """Sum of step functions: one weight per statistic and interval."""

    cuts: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float

    def active(self, stats: np.ndarray) -> np.ndarray:
        """Index of the weight that each statistic of each row uses."""
        first = np.cumsum([0, *(len(c) + 1 for c in self.cuts)])
        return np.column_stack([first[j] + np.searchsorted(c, stats[:, j], side="left") for j, c in enumerate(self.cuts)])

    def raw(self, active: np.ndarray) -> np.ndarray:
        return self.weights[active].sum(axis=1) + self.bias

    def score(self, stats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.active(stats)), -30, 30)))


def _descend(model: StepModel, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> None:
    """Adam on the non-negative risk, or (prior None) on the plain positive against unlabelled loss."""
    size = len(model.weights) + 1
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, ROUNDS + 1):
        model.weights, model.bias = theta[:-1], theta[-1]
        p = 1 / (1 + np.exp(-np.clip(model.raw(positive), -30, 30)))
        u = 1 / (1 + np.exp(-np.clip(model.raw(unlabelled), -30, 30)))
        # derivatives of the mean losses by the raw score
        if prior is None:
            on_p, on_u = (p - 1) / len(p), u / len(u)
        else:
            negative = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
            if negative >= 0:
                on_p, on_u = prior * (p - 1) / len(p) - prior * p / len(p), u / len(u)
            else:  # the unlabelled part is below zero, so it is overfitted: step back on it
                on_p, on_u = prior * p / len(p), -u / len(u)
        gradient = np.zeros(size)
        for active, on in ((positive, on_p), (unlabelled, on_u)):
            gradient[:-1] += np.bincount(active.ravel(), weights=np.repeat(on, active.shape[1]), minlength=size - 1)
            gradient[-1] += on.sum()
        gradient[:-1] += WEIGHT_DECAY * theta[:-1]
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    model.weights, model.bias = theta[:-1], theta[-1]


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the smallest ratio of the two shares above a score.

    Only scores that two fifths of the positives reach count, and each ratio carries a
    margin for its sampling error.
    """
    cuts = np.quantile(positive, np.linspace(0.0, 0.6, 31))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    margin = 0.25 / np.sqrt(max(len(unlabelled), 1))
    return float(np.clip(((u + margin) / p).min(), 0.02, 0.98))


def cut_points(values: np.ndarray) -> np.ndarray:
    """Quantiles of all values, and of those above the smallest: many statistics are zero mostly."""
    grid = np.linspace(0, 1, STEPS + 1)[1:-1]
    above = values[values > values.min()]
    return np.unique(np.r_[values.min(), np.quantile(values, grid), np.quantile(above, grid[::2]) if len(above) else []])


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> StepModel:
    both = np.concatenate([positive, unlabelled])
    if not len(positive) or not len(unlabelled):
        return StepModel([np.zeros(0)] * both.shape[1], np.zeros(both.shape[1]), 0.0, 0.5)
    cuts = [cut_points(both[:, j]) for j in range(both.shape[1])]
    model = StepModel(cuts, np.zeros(sum(len(c) + 1 for c in cuts)), 0.0, 0.5)
    p, u = model.active(positive), model.active(unlabelled)
    _descend(model, p[::2], u[::2], None)
    rest_p, rest_u = (p[1::2], u[1::2]) if len(p) > 1 and len(u) > 1 else (p, u)
    model.prior = class_prior(model.raw(rest_p), model.raw(rest_u))
    _descend(model, p, u, model.prior)
    return model


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        stats = text_stats(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("kind"), pa.array(list(stats), pa.list_(pa.float64()))], names=["kind", "stats"]
        )


def chance(rows: int, wanted: int, seed: str) -> F.Column:
    """True for about ``wanted`` of ``rows`` rows, by doc_id."""
    share = min(1.0, wanted / max(rows, 1))
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> StepModel:
    """Fit on positives among ``labels`` (doc_id, quality) and on unlabelled ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    good = labels.where("quality = 1 and doc_id is not null").where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.where(chance(good.count(), sample, "good")).distinct()
    positives = docs.join(F.broadcast(good), "doc_id", "left_semi").select(F.lit(1).alias("kind"), "text")
    others = docs.where(~held_out()).where(chance(docs.count(), sample, "any")).select(F.lit(0).alias("kind"), "text")
    rows = positives.union(others).mapInArrow(_stats, "kind int, stats array<double>").toPandas()
    stats = np.array(rows["stats"].tolist()).reshape(-1, len(STATS))
    kind = rows["kind"].to_numpy()
    order = np.lexsort(stats.T)  # the fit must not depend on the order of the rows
    stats, kind = stats[order], kind[order]
    return fit(stats[kind == 1], stats[kind == 0])


def scored(docs: DataFrame, model: StepModel) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = model.score(text_stats(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def drop_poor(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` that reach the threshold; all columns stay. One pass, without a shuffle of texts."""
    model = train(docs, labels)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.score(text_stats(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, schema)
