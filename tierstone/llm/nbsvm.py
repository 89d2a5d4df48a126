"""Quality classifier: naive Bayes features for a linear support vector machine.

Features are indicators of word n-grams in two spellings: as the words are, and as their shape
(letters, case, digits, symbols, and whether a word repeats the one before), hashed to a fixed
number. Class log-count ratios come from all training rows, summed in Spark; the indicators are
scaled by them, and a linear hinge-loss model is fitted by dual coordinate descent on a bounded
sample of training rows. The margin becomes a score by a logistic curve fitted to the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tierstone.llm.words import WordHasher, mix, text_blocks
from tierstone.sources import stage

_U = np.uint64
BITS = 18


@dataclass(frozen=True)
class Fit:
    """``sample`` bounds the distinct texts that the hinge-loss model is fitted on, and ``features``
    the features they have together (four bytes each on the driver); half of each class, the
    least hashes, a few more by chance. The counts use all rows."""

    sample: int = 12_000
    features: int = 12_000_000
    smoothing: float = 1.0
    cost: float = 1.0
    mix_in: float = 0.25  # of the plain mean weight, as in interpolated models of this kind
    epochs: int = 12
    seed: int = 7


# --- features ---------------------------------------------------------------------------

# Byte classes of a word's shape: lower case, upper case, digits, other letters, symbols as they are.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[128:] = 1
_CLASS[[32, 9, 10, 11, 12, 13]] = 0


def _shapes(data: np.ndarray, hasher: WordHasher, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' shapes: runs of a byte class count once. Also where each text's end."""
    kinds = _CLASS[data]
    keep = np.ones(len(kinds), dtype=bool)
    keep[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 0)
    keep[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    # white space stays a space, so that shapes split as the words do; 1, 2 and 3 are no white space
    short = kinds[keep]
    return hasher.words(np.where(short == 0, 32, short).astype(np.uint8), before[ends])


def _features(words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Distinct hashed n-grams of one text. A text without words has the feature of its end."""
    salt = [_U(x) for x in (0x51, 0x52, 0x53, 0x54, 0x55)]
    if not len(words):
        return np.zeros(1, dtype=np.int64)
    again = np.zeros(len(words), dtype=np.uint64)
    again[1:] = words[1:] == words[:-1]
    spelled = mix(shapes + again)
    grams = [mix(words ^ salt[0]), mix(spelled ^ salt[1])]
    if len(words) > 1:
        grams.append(mix(words[:-1] * salt[2] + words[1:]))
        grams.append(mix(spelled[:-1] * salt[3] + spelled[1:]))
    if len(words) > 2:
        grams.append(mix((spelled[:-2] * salt[4] + spelled[1:-1]) * salt[4] + spelled[2:]))
    hashed = np.concatenate(grams) >> _U(64 - BITS)
    return np.unique(hashed).astype(np.int64)


def _each_text(batch: pa.RecordBatch, column: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Features of the batch's texts; a null text is empty."""
    for _, _, data, ends in text_blocks(batch, column):
        words, word_ends = hasher.words(data, ends)
        shapes, shape_ends = _shapes(data, hasher, ends)
        w = s = 0
        for we, se in zip(word_ends.tolist(), shape_ends.tolist()):
            yield _features(words[w:we], shapes[s:se])
            w, s = we, se


# --- fitting ----------------------------------------------------------------------------


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, fit: Fit) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise ``|w|^2 / 2 + cost * hinge losses`` (weighted by class).

    One dual variable per row, visited in random order; each step is exact for its variable.
    The features of row ``i`` are ``rows[i]`` with the values ``values[rows[i]]``, and a bias.
    """
    random = np.random.default_rng(fit.seed)
    # what a feature adds to a margin: its weight times its value, which steps change by the square
    added, square, bias, alpha = np.zeros(len(values)), values * values, 0.0, np.zeros(len(rows))
    norm = [float(square[r].sum()) + 1.0 for r in rows]
    share = {k: max(1, int((y == k).sum())) for k in (-1, 1)}
    cost = np.where(y > 0, fit.cost * len(y) / (2 * share[1]), fit.cost * len(y) / (2 * share[-1]))
    for _ in range(fit.epochs):
        moved = 0.0
        for i in random.permutation(len(rows)):
            gradient = y[i] * (added[rows[i]].sum() + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                added[rows[i]] += step * square[rows[i]]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    w = np.divide(added, values, out=np.zeros(len(values)), where=values != 0)
    return w, bias


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to the share of label 1."""
    a, b, t = 1.0, 0.0, (y > 0).astype(np.float64)
    n1, n0 = t.sum(), len(t) - t.sum()
    t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g, h = np.array([((p - t) * margin).sum(), (p - t).sum()]), p * (1 - p)
        hessian = np.array([[(h * margin * margin).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]])
        step = np.linalg.solve(hessian + 1e-6 * np.eye(2), g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-6), b


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, features: np.ndarray) -> float:
        margin = float(self.weights[features].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35))))


def with_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", broadcast_rows: int = 4_000_000) -> DataFrame:
    """The rows of ``docs`` that have a label, for :func:`train`, which reads them several times.

    Labels (a key and a number) are broadcast if they are counted to be few, so that no text is
    shuffled; else the texts are joined to them once, and written.
    """
    if labels.count() <= broadcast_rows:
        return docs.join(F.broadcast(labels), key)
    return stage(docs.join(labels, key), "labelled")


def train(docs: DataFrame, label: str, fit: Fit = Fit(), text: str = "text") -> Model:
    """A model of ``label`` (0 or 1) from the labelled rows; rows with null labels are left out.

    With one class only, every score is that class's smoothed share; without rows it is 0.5. Rows
    count one by one, whatever their ids, so null and repeated ids make no difference here;
    :func:`with_labels` gives a label to every row that has its id, and to none without an id.
    """
    labelled = docs.where(F.col(label).isin(0, 1))
    labelled = labelled.select(F.col(label).cast("int").alias("y"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, n = WordHasher(), np.zeros((2, 1 << BITS), dtype=np.int64), np.zeros((2, 2), dtype=np.int64)
        for batch in batches:
            for y, features in zip(batch.column(0).to_pylist(), _each_text(batch, 1, hasher)):
                seen[y, features] += 1
                n[y] += 1, len(features)
        for y in (0, 1):  # one row per class and feature that the task saw; -1 has texts, -2 features
            at = np.flatnonzero(seen[y])
            if n[y, 0]:
                at, counts = np.append(at, [-1, -2]), np.append(seen[y, at], n[y])
                columns = [pa.array(np.full(len(at), y)), pa.array(at), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["y", "feature", "n"])

    # at most two rows per feature reach the driver, however many documents there are
    totals = labelled.mapInArrow(count, "y long, feature long, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"),
    ).toPandas()
    rows = totals[totals["feature"] == -1]
    n1, n0 = (int(rows[c].iloc[0]) if len(rows) else 0 for c in ("n1", "n0"))
    all_features = totals[totals["feature"] == -2]
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2)
        return Model(np.zeros(1 << BITS), 0.0, 1.0, float(np.log(share / (1 - share))))
    totals = totals[totals["feature"] >= 0]
    pos, neg = np.full(1 << BITS, fit.smoothing), np.full(1 << BITS, fit.smoothing)
    pos[totals["feature"]] += totals["n1"]
    neg[totals["feature"]] += totals["n0"]
    ratio = np.log((pos / (n1 + 2 * fit.smoothing)) / (neg / (n0 + 2 * fit.smoothing)))
    ratio[(pos + neg) == 2 * fit.smoothing] = 0  # never seen in training

    # copies of a text count once here, so that no group of copies can fill the sample
    long_ = {k: int(all_features[c].iloc[0]) / n for k, c, n in ((1, "n1", n1), (0, "n0", n0))}  # features of a text
    hashed = labelled.select("y", F.xxhash64("text").alias("h"), "text")
    per_class = hashed.select("y", "h").distinct().groupBy("y").agg(F.count("*").alias("n"))
    distinct = {r["y"]: r["n"] for r in per_class.collect()}
    bars = {k: min(1.0, fit.sample / 2 / n, fit.features / 2 / (n * long_[k])) for k, n in distinct.items()}
    unit = F.col("h") / F.lit(2.0**64) + 0.5
    chosen = hashed.where(unit <= F.when(F.col("y") == 1, bars[1]).otherwise(bars[0]))
    chosen = chosen.groupBy("y", "h").agg(F.min("text").alias("text")).select("y", "h", "text")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, packer = WordHasher(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            found = [packer.compress(np.diff(x, prepend=0).astype("<i4").tobytes()) for x in _each_text(batch, 2, hasher)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["y", "h", "features"])

    # packed gaps between features: one or two bytes each; unpacked four
    picked = sorted(chosen.mapInArrow(listed, "y int, h long, features binary").collect(), key=lambda r: (r["y"], r["h"]))
    y = np.array([1 if r["y"] else -1 for r in picked])
    unpacker = zstandard.ZstdDecompressor()
    x = [np.cumsum(np.frombuffer(unpacker.decompress(r["features"]), "<i4"), dtype=np.int32) for r in picked]
    scale = 1 / np.sqrt(np.mean([float(ratio[r] @ ratio[r]) for r in x]) + 1e-12)
    w, bias = dual_coordinate_descent(x, ratio * scale, y, fit)
    w = (1 - fit.mix_in) * w + fit.mix_in * np.abs(w).mean()
    weights = w * ratio * scale
    margin = np.array([weights[r].sum() for r in x]) + bias
    return Model(weights, bias, *_logistic(margin, y))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of scores for the column of texts."""
    weights = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def scores(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        return pa.array([weights.value.score(x) for x in _each_text(batch, 0, WordHasher())], pa.float64())

    return scores(docs[f"`{text}`"])
