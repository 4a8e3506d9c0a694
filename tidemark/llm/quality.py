"""Quality classifier by naive-Bayes support vectors.

* Indicators.  A text's n-grams: bytes in threes, words and pairs of words (split at white space, A-Z lower-cased),
  and the number of its words as a power of two.  Each is hashed to one of ``2 ** BITS`` places; a place is on or off.
* Ratios.  r = log of the place's share among texts of label 1 over its share among texts of label 0, from counts
  over *all* labelled training rows.
* Classifier.  Rows are indicators times r, scaled to length one.  A linear classifier with hinge loss is fitted
  to them by dual coordinate descent on a random sample of about ``sample_rows`` training rows (the documented
  bound); its weights are drawn part of the way to their mean size, so that a place that the sample never shows
  still counts by its ratio.
* Score.  A logistic curve over the margin, fitted to the sample, gives the score of every row from its text alone.

The text is joined with its label once; that pass combines the counts per task and writes the sampled rows. The
driver holds ``2 ** BITS`` numbers and the sample, whatever the input's size.

Defined results: null and empty texts have the word-count indicator alone; rows with a null id are held out;
several labels of one id count as their least; null labels are ignored; without training rows of both labels every
score is 1 (or 0 if all are 0); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, each, materialize, ship, text_or_empty

BITS = 18
PLACES = 1 << BITS
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BITS)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)
# white space becomes 0, and A-Z are lower-cased, in the bytes that make words
_FOLD = np.array([0 if c in (9, 10, 11, 12, 13, 32) else c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64)


def _place(codes: np.ndarray, family: int) -> np.ndarray:
    return ((codes + np.uint64(family)) * _SPREAD ^ (codes >> np.uint64(29))) * _SPREAD >> _SHIFT


def places(text: str) -> np.ndarray:
    """Sorted distinct places of the text's n-grams."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    folded = _FOLD[data]
    inside = folded != 0
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = np.flatnonzero(start)
    found = [_place(np.array([len(first).bit_length()], np.uint64), 1)]
    if len(data) >= 3:
        wide = data.astype(np.uint64)
        found.append(_place(wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16), 2 << 32))
    if len(first):
        at = np.arange(len(data)) - first[np.maximum(np.cumsum(start) - 1, 0)]
        word = np.add.reduceat(folded * _POWERS[at & 63], first)
        found.append(_place(word, 3))
        if len(word) > 1:
            found.append(_place(word[:-1] * np.uint64(31) + word[1:], 4))
    out = np.concatenate(found).astype(np.int32)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


@dataclass(frozen=True)
class Model:
    """Weight of each place, bias, and the logistic curve's slope and offset."""
    weights: np.ndarray
    lengths: np.ndarray         # squared ratio of each place
    bias: float
    slope: float
    offset: float

    def score(self, text: str) -> float:
        at = places(text)
        margin = self.weights[at].sum() / math.sqrt(max(1e-12, self.lengths[at].sum())) + self.bias
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.slope * margin + self.offset))))


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: crc32(id as text) mod 3 = 1, and rows without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


_LEARNED = "place int, n1 long, n0 long, y int, on array<int>"


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, y, sampled) -> the sampled rows' places, then the task's counts by place."""
    counts = np.zeros((2, PLACES), np.int64)

    def out(place: list, n1: list, n0: list, y: list, on: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            (place, n1, n0, y, on), (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())), strict=True)],
            names=["place", "n1", "n0", "y", "on"])

    for b in batches:
        ys, kept = [], []
        for text, y, sampled in zip(*[each(b.column(i)) for i in range(3)], strict=True):
            at = places(text)
            counts[y, at] += 1
            if sampled:
                ys.append(y)
                kept.append(at)
        if ys:
            none = [None] * len(ys)
            yield out(none, none, none, ys, kept)
    at = np.flatnonzero(counts.sum(axis=0))
    none = [None] * len(at)
    yield out(at, counts[1, at], counts[0, at], none, none)


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, square: np.ndarray, y: np.ndarray, c: float, epochs: int,
                            tolerance: float = 1e-2, seed: int = 1) -> tuple[np.ndarray, float]:
    """Minimises |w|^2 / 2 + c * sum of hinge losses; returns the weights times the ratios, and the bias.

    Row i has the value r[j] * scale[i] at its places j, and one constant feature.  Only r squared is needed: the
    weights are kept multiplied by r.  ``y`` is 1 or -1."""
    u, bias, alpha = np.zeros(len(square)), 0.0, np.zeros(len(rows))
    norm = np.array([s * s * square[at].sum() for at, s in zip(rows, scale, strict=True)]) + 1.0
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        most = 0.0
        for i in order:
            at = rows[i]
            g = y[i] * (scale[i] * u[at].sum() + bias) - 1.0
            old = alpha[i]
            if (old == 0 and g >= 0) or (old == c and g <= 0):
                continue
            most = max(most, abs(g))
            alpha[i] = min(max(old - g / norm[i], 0.0), c)
            step = (alpha[i] - old) * y[i]
            u[at] += step * scale[i] * square[at]
            bias += step
        if most < tolerance:
            break
    return u, bias


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (above 0) and offset of the logistic curve over the margins, by Newton steps."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-3 * (w - [1.0, 0.0]))
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = 12_000, c: float = 1.0, epochs: int = 20, mix: float = 0.5, smooth: float = 1.0) -> Model:
    """Learn from ``labels`` (id, label); ``sample_rows`` bounds the rows that the classifier is fitted to."""
    ship(docs.sparkSession)
    known = materialize(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id")).agg((F.min(label_col) > 0).cast("int").alias("__y")), "quality-labels")
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    n = rows.select("__id").join(known, "__id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__y"), F.lit(0)).alias("n1")).first()
    zero = np.zeros(PLACES)
    if not 0 < n["n1"] < n["n"]:
        return Model(zero, zero, 0.0, 1.0, -40.0 if n["n"] and not n["n1"] else 40.0)
    learned = materialize(
        rows.join(known, "__id").select("__text", "__y", (F.rand(11) < sample_rows / n["n"]).alias("s"))
        .mapInArrow(_learn, _LEARNED), "quality-learned")
    counts = learned.where("place IS NOT NULL").groupBy("place").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toArrow()
    share = np.full((2, PLACES), smooth)
    share[:, counts["place"].to_numpy()] += np.stack([counts["n0"].to_numpy(), counts["n1"].to_numpy()])
    share /= share.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    square = ratio ** 2
    sample = learned.where("on IS NOT NULL").select("y", "on").orderBy(F.xxhash64("on")).toArrow().combine_chunks()
    on, y = sample["on"].combine_chunks(), sample["y"].to_numpy()
    flat, ends = on.flatten().to_numpy(), np.cumsum(on.value_lengths().to_numpy())
    at = np.split(flat, ends[:-1])
    scale = np.array([1 / math.sqrt(max(1e-12, square[a].sum())) for a in at])
    u, bias = dual_coordinate_descent(at, scale, square, np.where(y > 0, 1.0, -1.0), c, epochs)
    # u = r * w: the weights drawn towards their mean size times the ratio
    seen = np.unique(flat)
    mean = np.abs(u[seen]).sum() / max(1e-12, np.abs(ratio[seen]).sum())
    weights = mix * u + (1 - mix) * mean * ratio
    slope, offset = _curve(np.array([weights[a].sum() * s for a, s in zip(at, scale, strict=True)]) + bias, y)
    return Model(weights, square, bias, slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = pa.array([model.score(t) for t in each(b.column(2))], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), scores], names=[id_col, "held_out", "score"])

    return (docs.select(F.col(id_col).alias("__id"), held_out(id_col).alias("__held"), text_or_empty(text_col).alias("__text"))
            .mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op13_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, documents(spark, sf_dir, "labels")))
