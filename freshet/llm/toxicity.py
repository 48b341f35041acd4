"""Toxicity by class-conditional Kneser-Ney models.

The context of a word is its class: toxic or ordinary. Counts are continuation counts, of the distinct words found before
it in texts of the class, so that copies of a text count once. A discount D under 1 is taken from each, and the mass that
this frees goes to one backoff distribution that both classes share, the Kneser-Ney one: a word's number of classes, over
the sum of these. D is set for each class so that both free the same mass; a word that neither knows thus decides nothing,
and one found once or twice decides little.

A toxic text is an ordinary one with a share of toxic expressions, so its model draws a word from the toxic distribution
with probability ``MIX`` and from the ordinary one otherwise. A document's log-likelihoods under both, their difference
divided by its number of words to the power ``NORM``, are compared by a logistic curve with a positive slope, which is
fitted on documents that the counts have not seen: the score rises with that difference and depends on nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import labelled
from freshet.llm import textkernel as tk
from freshet.session import ensure_importable

#: Bound of the sample that is fitted on the driver, for each class.
PER_CLASS = 2500
#: Share of toxic expressions in a toxic text.
MIX = 0.001
FOLDS = 4
#: Power of a text's words by which its log-likelihood difference is divided.
NORM = 0.75


@dataclass
class Models:
    """Probabilities of the known words, by sorted hash, in ordinary and in toxic text; the last is of an unknown one."""

    keys: np.ndarray
    ordinary: np.ndarray
    toxic: np.ndarray

    def place(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, len(self.keys))

    def differences(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log-likelihood of each text under the toxic model minus that under the ordinary one, by length."""
        w = tk.words(data, offsets)
        at = self.place(w.hashes)
        each = np.log1p(MIX * (self.toxic[at] / self.ordinary[at] - 1))
        return np.bincount(w.row, weights=each, minlength=len(w.counts)) / np.maximum(w.counts, 1) ** NORM


def discount(counts: np.ndarray) -> float:
    """Ney's estimate from how many words have a count of one and of two."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return one / (one + 2 * two) if one else 0.5


def kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (words + an unknown one, classes) from continuation counts (words, classes)."""
    known = counts > 0
    shared = np.append(known.sum(axis=1), 1.0)  # the unknown word counts as found in one class
    shared /= shared.sum()
    total, types = counts.sum(axis=0), known.sum(axis=0)
    mass = min(discount(counts[:, c]) * types[c] / total[c] for c in range(counts.shape[1]))
    taken = mass * total / types
    own = np.where(known, counts - taken, 0) / total
    return np.vstack([own, np.zeros(counts.shape[1])]) + mass * shared[:, None], taken


def count(texts: list[str], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and their continuation counts (words, classes), slice by slice."""
    pairs, words, classes = [], [], []
    for lo, hi, data, offsets in tk.slices(pa.array(texts, pa.string())):
        w = tk.words(data, offsets)
        if len(w.hashes):
            before = np.concatenate(([tk.U64(tk.START)], w.hashes[:-1]))
            before[np.concatenate(([True], w.row[1:] != w.row[:-1]))] = tk.U64(tk.START)
            own = label[lo:hi][w.row].astype(np.uint8)
            pair, once = np.unique(tk.mix(before * tk.U64(3) + w.hashes) ^ (own * tk.U64(0xC2B2AE3D27D4EB4F)), return_index=True)
            pairs.append(pair)
            words.append(w.hashes[once])
            classes.append(own[once])
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros((0, 2))
    _, once = np.unique(np.concatenate(pairs), return_index=True)
    keys, inverse = np.unique(np.concatenate(words)[once], return_inverse=True)
    own = np.concatenate(classes)[once]
    return keys, np.stack([np.bincount(inverse, weights=own == c, minlength=len(keys)) for c in (0, 1)], axis=1)


def fit_models(texts: list[str], label: np.ndarray) -> Models:
    """Both models; equal ones, which compare nothing, where a class has no word."""
    keys, counts = count(texts, label)
    if not len(keys) or not counts.sum(axis=0).all():
        return Models(np.zeros(0, np.uint64), np.ones(1), np.ones(1))
    p, _ = kneser_ney(counts)
    return Models(keys, p[:, 0], p[:, 1])


@dataclass
class Model:
    models: Models
    #: Intercept and slope.
    curve: tuple[float, float]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = self.curve[0] + self.curve[1] * self.models.differences(data, offsets)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit_curve(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-6) -> tuple[float, float]:
    """Logistic intercept and slope by Newton steps; the slope is at least 0."""
    scale = max(float(x.std()), 1e-9)
    z = np.column_stack([np.ones(len(x)), x / scale])
    w, penalty = np.zeros(2), ridge * np.diag([0.0, 1.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - label)) / len(z) + penalty @ w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z / len(z) + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), max(0.0, float(w[1])) / scale


def fit(texts: list[str], label: np.ndarray, toxic_share: float | None = None) -> Model:
    """Models from all rows; the curve on each fold by models from the others. Without both classes every score is
    that of no evidence."""
    label = np.asarray(label)
    if len(set(label.tolist())) < 2:
        return Model(fit_models([], label), (-3.0, 0.0))
    fold = np.empty(len(texts), dtype=int)
    for c in (0, 1):  # folds have their share of both classes
        at = np.flatnonzero(label == c)
        fold[at] = np.arange(len(at)) % FOLDS
    x = np.zeros(len(texts))
    for f in range(FOLDS):
        here, other = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        models = fit_models([texts[i] for i in other], label[other])
        for lo, hi, data, offsets in tk.slices(pa.array([texts[i] for i in here], pa.string())):
            x[here[lo:hi]] = models.differences(data, offsets)
    share = label.mean() if toxic_share is None else toxic_share
    weight = np.where(label == 1, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9))
    return Model(fit_models(texts, label), fit_curve(x, label, weight))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS, fold=None) -> Model:
    """A model fitted on the driver to at most ``per_class`` labelled rows of each class, those with the least id hashes.
    Null texts count as empty; rows with a null id, or without a label of 0 or 1, are not learned from, and of rows that
    repeat an id one is; without rows of both classes every text has one score; other columns are ignored."""
    fold = F.lit(True) if fold is None else fold
    rows = labelled.sample(docs, labels, label, per_class, fold, id_col, text_col)
    counts = {r[0]: r[1] for r in labels.where(F.col(label).isin(0, 1) & fold).groupBy(label).count().collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit(rows["text"].tolist(), rows["label"].to_numpy(), toxic_share=share)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """``id_col, score, predicted`` of every row: the probability that it is toxic, and 1 from ``least``. Null and empty
    texts are scored as empty; repeated rows alike; an empty table gives an empty result; other columns are ignored."""
    spark = ensure_importable(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        own = sent.value
        for batch in batches:
            for lo, hi, data, offsets in tk.slices(batch.column(1)):
                s = own.score(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(s), pa.array((s >= least).astype(np.int32))], [id_col, "score", "predicted"]
                )

    given = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, f"`{id_col}` long, score double, predicted int")
