"""Bradley-Terry quality classifier: scores learned from preference pairs, threshold by score quantile.

Each document labelled good is set against each one labelled bad; the weights minimise the mean logistic loss of the
difference of their features over all these pairs. Features are statistics of the text alone. The verdict's threshold is
the quantile of all training scores at the share of bad documents, and is where the reported score, a logistic curve,
crosses 0.5.

Pairs are never made. What a document adds to gradient and Hessian is its features times a function of its score, a sum
over the other class that depends on how that class's scores are spread. So a pass spreads each document linearly over the
two nearest of ``BINS`` scores and adds up its weight and its features there, by class; these sums stay of one size, and
the pairs of bins stand for all pairs of documents. The features of the labelled documents are written once.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import textkernel as tk
from freshet.llm.storage import discard, save
from freshet.session import ensure_importable

#: Scores over which documents are spread while fitting, and ranges by which a quantile is found.
BINS, RANGES = 1024, 8192
#: Tasks of a pass over the features; each sends the driver one table of sums.
TASKS = 32
BAD, GOOD = 0, 1
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "mark": b"!?", "stop": b".,;:", "space": b" \t\n\r\x0b\x0c", "line": b"\n"}


def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.int8)
    out[list(chars)] = 1
    return out


_LUTS = [_lut(c) for c in _CLASSES.values()] + [(np.arange(256) >= 128).astype(np.int8)]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text; those of an empty text are zero."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    counts = []
    for lut in _LUTS:
        total = np.concatenate(([0], np.cumsum(lut[data], dtype=np.int64)))
        counts.append((total[offsets[1:]] - total[offsets[:-1]]) / some)
    w = tk.words(data, offsets)
    words = np.maximum(w.counts, 1)
    length = np.bincount(w.row, weights=w.ends - w.starts, minlength=n) / words
    row, sh = tk.shingles(w, 3)
    shingled = np.maximum(np.bincount(row, minlength=n), 1)
    pair = tk.mix(sh ^ (row.astype(np.uint64) * tk.U64(0x9E3779B97F4A7C15)))
    _, first = np.unique(pair, return_index=True)
    repeated = 1 - np.bincount(row[first], minlength=n) / shingled
    repeated[w.counts == 0] = 0
    own = tk.mix(w.hashes ^ (w.row.astype(np.uint64) * tk.U64(0x9E3779B97F4A7C15)))
    _, first = np.unique(own, return_index=True)
    distinct = np.bincount(w.row[first], minlength=n) / np.sqrt(words)
    shares = np.stack(counts + [repeated], axis=1)
    return np.column_stack([
        shares, np.sqrt(shares), np.log1p(w.counts), np.log1p(w.counts) ** 2 / 10, (w.counts < 10).astype(float), length / 10,
        np.abs(length - 5.5) / 10, np.log1p(distinct),
    ])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    temperature: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def raw(self, x: np.ndarray) -> np.ndarray:
        # rounded, as the last bits of a product depend on how many rows it has, and equal texts are to tie
        return np.round(self.standard(x) @ self.weights, 9)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = (self.raw(x) - self.threshold) / self.temperature
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _pass(rows: DataFrame, sums) -> dict | None:
    """What ``sums(features, labels)``, a dict of arrays, gives for all rows: batch by batch and task by task added up,
    but for ``min`` and ``max``. None without rows."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.float64).reshape(batch.num_rows, -1)
                got = sums(x, batch.column(1).to_numpy(zero_copy_only=False))
                total = got if total is None else _folded(total, got)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["sums"])

    total = None
    for row in rows.coalesce(TASKS).mapInArrow(run, "sums binary").toLocalIterator():
        got = pickle.loads(row[0])
        total = got if total is None else _folded(total, got)
    return total


_FOLD = {"min": np.minimum, "max": np.maximum}


def _folded(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: _FOLD.get(k, np.add)(a[k], b[k]) for k in a}


def _spread(s: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The lower of the two bins beside each score, and the share of the upper."""
    at = np.clip((s + reach) / (2 * reach) * (BINS - 1), 0, BINS - 1)
    low = np.minimum(at.astype(np.int64), BINS - 2)
    return low, at - low


def _binned(values: np.ndarray, low: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Column sums by bin."""
    return np.stack([np.bincount(low, v * (1 - share), BINS) + np.bincount(low + 1, v * share, BINS) for v in values.T], axis=1)


def fit(rows: DataFrame, ridge: float = 1e-3) -> Model:
    """Newton steps on the mean logistic loss of all good-bad differences of ``x`` (features as bytes) by ``label``, in
    passes over the rows. With one class only, the model scores every text 0.5."""
    n = len(features(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0])
    got = _pass(rows, lambda x, y: {"class": np.bincount(y, minlength=2).astype(float), "sum": x.sum(axis=0)})
    if got is None or not got["class"].all():
        return Model(np.zeros(n), np.ones(n), np.zeros(n), 0.0, 1.0)
    size, pairs = got["class"].sum(), got["class"].prod()
    mean = got["sum"] / size
    scale = np.sqrt(_pass(rows, lambda x, y: {"square": ((x - mean) ** 2).sum(axis=0)})["square"] / size)
    scale[scale < 1e-9] = 1
    model = Model(mean, scale, np.zeros(n), 0.0, 1.0)
    for _ in range(30):
        reach = max(1.0, 8 * float(np.abs(model.weights).sum()))

        def spread(x, y, model=model, reach=reach):
            z = model.standard(x)
            low, share = _spread(z @ model.weights, reach)
            ones = np.column_stack([np.ones(len(z)), z])
            return {k: _binned(ones[y == k], low[y == k], share[y == k]) for k in (BAD, GOOD)}

        got = _pass(rows, spread)
        (bad, bad_x), (good, good_x) = ((got[k][:, 0], got[k][:, 1:]) for k in (BAD, GOOD))
        centres = np.linspace(-reach, reach, BINS)
        p = 1 / (1 + np.exp(np.clip(centres[:, None] - centres, -30, 30)))  # that good at i loses to bad at j
        gradient = (bad_x.T @ (good @ p) - good_x.T @ (p @ bad)) / pairs + ridge * model.weights
        p *= 1 - p
        own = {BAD: good @ p, GOOD: p @ bad}

        def squares(x, y, model=model, reach=reach, own=own):
            z = model.standard(x)
            low, share = _spread(z @ model.weights, reach)
            each = np.where(y == GOOD, *((own[k][low] * (1 - share) + own[k][low + 1] * share) for k in (GOOD, BAD)))
            return {"square": (z * each[:, None]).T @ z}

        cross = good_x.T @ p @ bad_x
        hessian = (_pass(rows, squares)["square"] - cross - cross.T) / pairs + ridge * np.eye(n)
        step = np.linalg.solve(hessian, gradient)
        model.weights = model.weights - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    bads = int(round(bad.sum()))
    model.threshold = (_ranked(rows, model, bads) + _ranked(rows, model, bads + 1)) / 2
    return model


def _ranked(rows: DataFrame, model: Model, rank: int) -> float:
    """The ``rank``-th least score of all rows (from 1): the range that holds it, divided until it holds one value."""
    low = -8 * float(np.abs(model.weights).sum()) - 1
    high = -low
    while low < high:

        def counted(x, y, low=low, high=high):
            s = model.raw(x)
            at = np.clip(((s - low) / (high - low) * RANGES), 0, RANGES - 1).astype(np.int64)
            at, s, under = at[(s >= low) & (s <= high)], s[(s >= low) & (s <= high)], np.array([(s < low).sum()])
            out = {"under": under, "count": np.bincount(at, minlength=RANGES), "min": np.full(RANGES, np.inf), "max": np.full(RANGES, -np.inf)}
            np.minimum.at(out["min"], at, s)
            np.maximum.at(out["max"], at, s)
            return out

        got = _pass(rows, counted)
        k = int(np.searchsorted(got["under"][0] + np.cumsum(got["count"]), rank))
        low, high = float(got["min"][k]), float(got["max"][k])
    return low


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", fold=None) -> Model:
    """A model of all rows with a label of 0 or 1 whose ``fold`` holds. Null texts count as empty; rows with a null id are
    not learned from, and of rows that repeat an id one is, that of the least features; other columns are ignored."""
    ensure_importable(docs.sparkSession)
    fold = F.lit(True) if fold is None else fold

    def measure(batches):
        for batch in batches:
            for lo, hi, data, offsets in tk.slices(batch.column(1)):
                x = [row.tobytes() for row in features(data, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(x, pa.binary())], ["_id", "x"])

    marked = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & fold).groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label).cast("int").alias("label"))
    given = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    measured = given.mapInArrow(measure, "_id long, x binary").groupBy("_id").agg(F.min("x").alias("x"))
    rows = save(measured.join(marked, "_id").select("x", "label"), "features")
    model = fit(rows)
    discard(rows)
    return model


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` of every row: score in 0 to 1, predicted 1 from 0.5. Null and empty texts are scored
    as empty; repeated rows alike; an empty table gives an empty result; other columns are ignored."""
    ensure_importable(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in tk.slices(batch.column(1)):
                s = model.score(features(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [id_col, "score", "predicted"]
                )

    given = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, f"`{id_col}` long, score double, predicted int")
