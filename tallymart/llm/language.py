"""Language identification in two steps: the family, then the language inside it.

Features are shares of hashed byte n-grams. Families are told apart by one linear support vector
machine each, the languages of a family by one for each pair of them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .common import map_batches, schema_with, text_steps

UNDETERMINED = "und"
ORDERS, BITS = (2, 3, 4), 13
#: Labelled documents that are learnt from: of one language at most, and of all (one of each at least).
FIT_DOCUMENTS, FIT_ALL = 400, 10_000
#: Counts of languages up to this number are sent to the scan of the texts.
SENT_LANGUAGES = 100_000
#: Features are shares times this; weight of the squares of the weights; steps of the fit.
SCALE, PENALTY, ROUNDS = 30.0, 1e-4, 120

#: Languages by family. A language that is not here is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "fy", "lb", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "semitic": ("ar", "he", "mt", "am"),
    "malayic": ("id", "ms"),
}


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def _counts(texts: pa.Array):
    """Distinct buckets and their shares, for each text."""
    for _, _, data, offsets in text_steps(texts):
        data = ngrams.letters(data)
        found = [ngrams.hashed(data, offsets, order, BITS) for order in ORDERS]
        for a, b in zip(offsets[:-1], offsets[1:]):
            buckets = np.concatenate([f[a:b] for f in found])
            counts = np.bincount(buckets, minlength=(1 << BITS) + 1)[:-1]
            kept = np.flatnonzero(counts)
            yield kept.astype("<i4"), (counts[kept] / max(1, counts.sum())).astype("<f4")


def _svm(features: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights and, last, offset of a linear machine with squared hinge loss, classes balanced."""
    sign = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum()))
    weight = weight.astype(np.float32)

    def gradient(w):
        w = w.astype(np.float32)
        short = np.maximum(0, 1 - sign * (features @ w[:-1] + w[-1])) * sign * weight
        return np.append(PENALTY * w[:-1] - 2 * short @ features, -2 * short.sum())

    top = np.ones(features.shape[1], np.float32)
    for _ in range(15):  # the largest curvature, by power iteration
        top = 4 * ((weight * (features @ top)) @ features)
        size = float(np.linalg.norm(top))
        top /= max(size, 1e-12)
    return ngrams.descend(gradient, features.shape[1] + 1, ROUNDS, 1 / (size / 2 + 2.5 + PENALTY))


class Model:
    """Machines of families and of pairs, as columns of one weight matrix."""

    def __init__(self, labels: list[str], features: np.ndarray):
        labels = np.array(labels)
        self.languages = sorted(set(labels.tolist()))
        families = np.array([family_of(label) for label in labels])
        self.families = sorted(set(families.tolist()))
        self.members = {f: [x for x in self.languages if family_of(x) == f] for f in self.families}
        self.pairs = [pair for f in self.families for pair in combinations(self.members[f], 2)]
        machines = []
        if len(self.families) > 1:
            machines += [_svm(features, families == f) for f in self.families]
        for a, b in self.pairs:
            both = (labels == a) | (labels == b)
            machines.append(_svm(features[both], labels[both] == a))
        self.machines = np.array(machines).reshape(len(machines), features.shape[1] + 1)
        weights = np.zeros((len(machines), features.shape[1] + 1), np.float32)
        weights[:, :-1] = SCALE * self.machines[:, :-1]  # the last bucket counts for nothing
        self.weights = weights

    def margins(self, texts: pa.Array) -> np.ndarray:
        """What each machine says of each text."""
        out = []
        for _, _, data, offsets in text_steps(texts):
            data = ngrams.letters(data)
            total, n = np.zeros((len(self.weights), len(offsets) - 1)), 0
            for order in ORDERS:
                buckets = ngrams.hashed(data, offsets, order, BITS)
                n = n + np.maximum(0, np.diff(offsets) - order + 1)
                for k, weights in enumerate(self.weights):
                    total[k] += ngrams.sums(weights[buckets], offsets)
            out.append((total / np.maximum(1, n)).T + self.machines[:, -1])
        return np.concatenate(out) if out else np.zeros((0, len(self.weights)))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and confidence of each text."""
        margins = self.margins(texts)
        n_families = len(self.families) if len(self.families) > 1 else 0
        if n_families:
            odds = np.exp(2 * np.clip(margins[:, :n_families], -20, 20))
            shares = odds / odds.sum(1, keepdims=True)
            family, score = shares.argmax(1), shares.max(1)
        else:
            family, score = np.zeros(len(margins), int), np.ones(len(margins))
        predicted = []
        for row, f in enumerate(family):
            members = self.members[self.families[f]]
            votes = np.zeros(len(members))
            for k, (a, b) in enumerate(self.pairs):
                if a in members:
                    for_a = 1 / (1 + np.exp(-4 * np.clip(margins[row, n_families + k], -20, 20)))
                    votes[members.index(a)] += for_a
                    votes[members.index(b)] += 1 - for_a
            best = int(votes.argmax())
            predicted.append(members[best])
            score[row] *= votes[best] / max(1, len(members) - 1) if len(members) > 1 else 1
        return predicted, score


def fit(labelled: DataFrame, documents: int = FIT_DOCUMENTS, total: int = FIT_ALL) -> Model | None:
    """A model from ``labelled`` (doc_id, text, lang); None if there is no labelled text.

    It learns every language, from at most ``documents`` documents each and about ``total`` of all, the first
    by a hash of id and text; repeated rows are one. Their counts of n-grams come to the driver.
    """
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = labelled.groupBy("lang").agg(F.count("*").alias("_n")).cache()
    n = counts.count()
    documents = max(1, min(documents, total // max(1, n)))
    chance = F.xxhash64("doc_id", "text")
    # a share that holds the first ones all but surely, so that no task gets more than a few times as many
    bound = F.least(F.lit(1.0), (2.0 * documents + 50) / F.col("_n")) * 2.0**64 - 2.0**63
    near = labelled.select("text", "lang", chance.alias("_chance")).join(
        F.broadcast(counts) if n <= SENT_LANGUAGES else counts, "lang").where(F.col("_chance") <= bound)

    def run(batch):
        found = list(_counts(batch.column(2)))
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array((k.tobytes() for k, _ in found), pa.binary()),
            pa.array((v.tobytes() for _, v in found), pa.binary())], ["lang", "_chance", "buckets", "shares"])

    found = map_batches(near.select("lang", "_chance", "text"), run,
                        "lang string, _chance long, buckets binary, shares binary")
    first = F.row_number().over(W.partitionBy("lang").orderBy("_chance"))
    rows = (found.dropDuplicates(["lang", "_chance"]).withColumn("_first", first)
            .where(F.col("_first") <= documents).collect())
    counts.unpersist()
    if not rows:
        return None
    features = np.zeros((len(rows), 1 << BITS), np.float32)
    for i, row in enumerate(rows):
        features[i, np.frombuffer(row.buckets, "<i4")] = SCALE * np.frombuffer(row.shares, "<f4")
    return Model([row.lang for row in rows], features)


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1).

    A null text, one without a letter, and any text without a model are ``und`` with score 0. Other
    columns stay; columns called like a result are replaced.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "score")])
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    at = docs.columns.index(text)

    def run(batch):
        predicted, score = model.predict(batch.column(at))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(predicted), pa.array(score)],
            [*batch.schema.names, "lang_pred", "score"])

    found = map_batches(docs, run, schema_with(
        docs, ("lang_pred", T.StringType()), ("score", T.DoubleType())))
    known = has_letter(F.col(text))
    return (found.withColumn("lang_pred", F.when(known, F.col("lang_pred")).otherwise(UNDETERMINED))
            .withColumn("score", F.when(known, F.col("score")).otherwise(0.0)))

