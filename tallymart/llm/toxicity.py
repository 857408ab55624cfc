"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Which n-grams a text has, not how often, is counted for both labels over all labelled texts. The
n-grams whose shares differ most are the features; each has the log of the ratio of its smoothed
shares as its value, and logistic regression weighs them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .common import map_batches, schema_with, slices, text_steps

ORDERS, BITS = (4, 6, 8), 18
THRESHOLD = 0.3
#: Parts in which counts of buckets are added up.
SLICES = 16
#: Features, and labelled documents whose features are weighed, the first ones by a hash of their id.
FEATURES, FIT_DOCUMENTS = 8_192, 10_000
#: A feature's shares must differ by so many standard deviations of chance, and its log ratio be at
#: least this far from 0: n-grams of a language or topic that is but somewhat commoner are left out.
DEVIATIONS, RATIO = 3.5, 1.0
SMOOTHING, PENALTY, ROUNDS = 1.0, 1e-3, 250
#: Labels up to this number are sent to the scan of the texts; more are joined by shuffle.
SENT_LABELS = 1_000_000


def _present(texts: pa.Array):
    """Distinct buckets of each text."""
    last = np.zeros((1 << BITS) + 1, np.int64)
    for _, _, data, offsets in text_steps(texts):
        data = ngrams.letters(data)
        found = [ngrams.hashed(data, offsets, order, BITS) for order in ORDERS]
        for a, b in zip(offsets[:-1], offsets[1:]):
            buckets = np.concatenate([f[a:b] for f in found])
            places = np.arange(len(buckets))
            last[buckets] = places
            distinct = buckets[last[buckets] == places]
            yield distinct[distinct < 1 << BITS]


def _counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How many texts of label 0 and 1 have each bucket, and how many there are, over all rows."""

    def run(batches):
        counts, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in slices(batches):
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for label, buckets in zip(labels, _present(batch.column(0))):
                counts[label, buckets] += 1
                rows[label] += 1
        if rows.any():
            parts = np.split(counts, SLICES, axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(SLICES), pa.int32()),
                pa.array([p.tobytes() for p in parts], pa.binary()),
                pa.array([rows.tobytes()] * SLICES, pa.binary())], ["slice", "counts", "rows"])

    def add(part: pa.Table) -> pa.Table:
        total = [sum(np.frombuffer(x, np.int64) for x in part.column(c).to_pylist()).tobytes()
                 for c in ("counts", "rows")]
        return pa.table({"slice": part.column("slice")[:1], "counts": [total[0]], "rows": [total[1]]})

    schema = "slice int, counts binary, rows binary"
    # A few tasks add up what some others counted, before one adds up a slice.
    parts = (labelled.select("text", "label").mapInArrow(run, schema)
             .withColumn("part", (F.spark_partition_id() / 32).cast("int")))

    once = parts.groupBy("slice", "part").applyInArrow(add, schema)
    total = once.groupBy("slice").applyInArrow(add, schema).orderBy("slice").collect()
    if not total:
        return np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
    return (np.concatenate([np.frombuffer(s.counts, np.int64).reshape(2, -1) for s in total], axis=1),
            np.frombuffer(total[0].rows, np.int64))


class Model:
    """A weight for each bucket, 0 for those that are no feature, and an offset."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights.astype(np.float32), offset

    def score(self, texts: pa.Array) -> np.ndarray:
        sums = np.array([self.weights[b].sum(dtype=np.float64) for b in _present(texts)])
        return 1 / (1 + np.exp(-np.clip(sums + self.offset, -50, 50)))


def _weighed(rows: list, ratios: np.ndarray, chosen: np.ndarray) -> Model:
    """Logistic regression on the ratios of the chosen buckets that each row has."""
    column = np.full(1 << BITS, -1, np.int64)
    column[chosen] = np.arange(len(chosen))
    features = [column[np.frombuffer(row.buckets, "<i4")] for row in rows]
    column_of = np.concatenate(features)
    row_of = np.repeat(np.arange(len(rows)), [len(f) for f in features])
    value = ratios[chosen][column_of]
    label = np.array([row.label for row in rows], float)
    n = len(rows)

    def gradient(w):
        margin = np.bincount(row_of, value * w[column_of], n) + w[-1]
        wrong = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - label
        return np.append(np.bincount(column_of, value * wrong[row_of], len(chosen)) / n
                         + PENALTY * w[:-1], wrong.mean())

    top = np.ones(len(chosen))
    size = 1.0
    for _ in range(15):  # the largest curvature, by power iteration
        top = np.bincount(column_of, value * np.bincount(row_of, value * top[column_of], n)[row_of],
                          len(chosen)) / n
        size = max(float(np.linalg.norm(top)), 1e-12)
        top /= size
    w = ngrams.descend(gradient, len(chosen) + 1, ROUNDS, 1 / (size / 4 + 0.5 + PENALTY))
    weights = np.zeros((1 << BITS) + 1)
    weights[chosen] = ratios[chosen] * w[:-1]
    return Model(weights, float(w[-1]))


def fit(labelled: DataFrame) -> Model:
    """A model from ``labelled`` (doc_id, text, label 0 or 1).

    Counts and ratios are those of all rows; weights are fitted on at most FIT_DOCUMENTS of them, chosen
    by a hash of id and text; repeated rows are one there. Rows
    without a label are left out; without rows of both labels every score is the share of label 1
    (one half if there is none).
    """
    labelled = labelled.where("label IN (0, 1)").select("doc_id", "text", F.col("label").cast("int"))
    counts, rows = _counts(labelled)
    if not rows.all():
        share = min(max(rows[1] / max(1, rows.sum()), 1e-6), 1 - 1e-6) if rows.sum() else 0.5
        return Model(np.zeros((1 << BITS) + 1), float(np.log(share / (1 - share))))
    shares = (counts + SMOOTHING) / (rows[:, None] + 2 * SMOOTHING)
    ratios = np.log(shares[1] / shares[0])
    both = counts.sum(0) / rows.sum()
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / rows[0] + 1 / rows[1]))
    apart = np.abs(counts[1] / rows[1] - counts[0] / rows[0]) / spread
    able = np.flatnonzero((counts.sum(0) > 0) & (apart >= DEVIATIONS) & (np.abs(ratios) >= RATIO))
    chosen = np.sort(able[np.argsort(-apart[able], kind="stable")[:FEATURES]])
    keep = np.zeros(1 << BITS, bool)
    keep[chosen] = True
    chance, share = F.xxhash64("doc_id", "text"), 0.95 * FIT_DOCUMENTS / rows.sum()
    sample = labelled.withColumn("_chance", chance)
    if share < 0.95:  # else there are no more rows than that
        sample = sample.where(F.col("_chance") < int(2.0**64 * share) - 2**63)

    def run(batch):
        found = [b[keep[b]].astype("<i4").tobytes() for b in _present(batch.column(0))]
        return pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.binary())],
                                          ["label", "_chance", "buckets"])

    sample = map_batches(sample.select("text", "label", "_chance"), run, "label int, _chance long, buckets binary")
    sample = sample.dropDuplicates(["label", "_chance"]).limit(FIT_DOCUMENTS).collect()
    return _weighed(sample, ratios, chosen)


def with_labels(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text and label of the labelled documents; a document with two labels is 1 if either is."""
    one = labels.groupBy("doc_id").agg(F.max(label).alias("label")).where("label IS NOT NULL")
    few = labels.count() <= SENT_LABELS
    return docs.select("doc_id", "text").join(F.broadcast(one) if few else one, "doc_id")


def classify(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold`` on).

    A null or empty text gets the model's offset. Other columns stay; columns called like a result
    are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    at = docs.columns.index(text)

    def run(batch):
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(model.score(batch.column(at)))], [*batch.schema.names, "score"])

    scored = map_batches(docs, run, schema_with(docs, ("score", T.DoubleType())))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
