"""Benchmark decontamination: an FM-index of each shard of documents, searched for test phrases.

A phrase is a window of 13 words of a benchmark item, or a whole shorter item. A document word inside
any occurrence of a phrase is hit. Words that no phrase has cannot be part of an occurrence, so a
shard's index holds its runs of phrase words only, each closed by a separator; that loses nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import cut, discard, schema_with, slices, small_batches, text_steps
from .fm_index import FmIndex

WINDOW = 13
#: A document is contaminated if this many times its hit words reach its words.
ONE_IN = 20
#: Pairs of a phrase and an item that one pass searches for. A larger benchmark takes more passes.
PASS_PHRASES = 200_000
#: Phrases that are handed to Spark at once.
STEP_PHRASES = 20_000

_MADE = ("n_words", "n_hit", "items", "spans")
_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _words(texts: pa.Array):
    """(row, word hashes, starts and ends in bytes, bytes) of each text."""
    for row, _, data, offsets in text_steps(texts):
        starts, ends, firsts = words.spans(data, offsets, words.ALPHABETIC)
        hashed = words.hashes(data, starts, ends, lower=True)
        for i in range(len(firsts) - 1):
            a, b = firsts[i], firsts[i + 1]
            yield (row + i, hashed[a:b], starts[a:b] - offsets[i], ends[a:b] - offsets[i],
                   data[offsets[i]:offsets[i + 1]])


class Phrases:
    """Some distinct phrases: symbols of their words, and the items each stands for.

    They are given as pairs of an item and the hashes of the phrase's words.
    """

    def __init__(self, pairs: list[tuple[str, bytes]], window: int):
        found: dict[bytes, set[str]] = {}
        for item, phrase in pairs:
            found.setdefault(phrase, set()).add(item)
        self.vocabulary = np.unique(np.frombuffer(b"".join(found), np.uint64))
        self.items = [sorted(names) for names in found.values()]
        self.lengths = np.array([len(p) // 8 for p in found], np.int64)
        self.patterns = np.zeros((len(found), window), np.int64)
        for row, pattern in enumerate(found):
            self.patterns[row, :self.lengths[row]] = self.symbols(np.frombuffer(pattern, np.uint64))
        self.least = int(self.lengths.min()) if len(found) else 0

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary of each word, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)

    def runs(self, symbols: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of phrase words that are long enough for the shortest phrase."""
        known = np.concatenate(([0], (symbols > 0).astype(np.int8), [0]))
        change = np.flatnonzero(np.diff(known))
        return [(a, b) for a, b in zip(change[::2].tolist(), change[1::2].tolist())
                if b - a >= self.least]


def search_shard(phrases: Phrases, documents: list[np.ndarray]) -> list[tuple[np.ndarray, set[str]]]:
    """For each document (word hashes): which words are hit, and the items that occur."""
    separator = len(phrases.vocabulary) + 1
    pieces, starts, homes, at = [], [], [], 0
    for number, hashed in enumerate(documents):
        symbols = phrases.symbols(hashed)
        for a, b in phrases.runs(symbols):
            pieces += [symbols[a:b], np.array([separator])]
            starts.append(at)
            homes.append((number, a))
            at += b - a + 1
    hits = [np.zeros(len(hashed), bool) for hashed in documents]
    items: list[set[str]] = [set() for _ in documents]
    if pieces and len(phrases.items):
        index = FmIndex(np.concatenate(pieces), separator)
        low, high = index.search(phrases.patterns, phrases.lengths)
        which = np.repeat(np.arange(len(low)), high - low)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(low, high) if b > a] or [low[:0]])
        places = index.locate(rows)
        run = np.searchsorted(starts, places, "right") - 1
        for phrase, place, r in zip(which.tolist(), places.tolist(), run.tolist()):
            number, first = homes[r]
            begin = first + place - starts[r]
            hits[number][begin:begin + phrases.lengths[phrase]] = True
            items[number].update(phrases.items[phrase])
    return list(zip(hits, items))


def _code_points(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte places in UTF-8 as code points."""
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return before[places]


def _pairs(benchmark: DataFrame, window: int) -> DataFrame:
    """item and phrase (hashes of its words), each pair once; null items and texts have none."""

    def run(batches):
        for batch in batches:
            items = batch.column(0)
            for row, hashed, *_ in _words(batch.column(1)):
                n = max(1, len(hashed) - window + 1) if len(hashed) else 0
                for start in range(0, n, STEP_PHRASES):
                    phrases = [hashed[i:i + window].tobytes() for i in range(start, min(n, start + STEP_PHRASES))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(items[row], len(phrases)), pa.array(phrases, pa.binary())], ["item", "phrase"])

    texts = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(
        "item IS NOT NULL AND text IS NOT NULL")
    return cut(texts.mapInArrow(run, "item string, phrase binary").distinct(), "phrases")


def _search(docs: DataFrame, phrases: Phrases, text: str, spans: bool) -> DataFrame:
    """``docs`` with _hit (first and last of each stretch of hit words) and items, added to what they have;
    n_words, n_hit and spans too if asked for.
    """
    runs = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    before = "_hit" in docs.columns
    kept = [c for c in docs.columns if c not in ("_hit", "items")]
    schema = schema_with(docs.select(*kept), ("items", T.ArrayType(T.StringType())), *(
        (("n_words", T.LongType()), ("n_hit", T.LongType()), ("spans", _SPANS)) if spans
        else (("_hit", runs),)))
    names, at = docs.columns, docs.columns.index(text)
    small_batches(docs.sparkSession)

    def stretches(hit):
        change = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        return change[::2], change[1::2] - 1

    def run(batches):
        for batch in slices(batches):
            found = list(_words(batch.column(at)))
            results = search_shard(phrases, [hashed for _, hashed, *_ in found])
            if before:
                seen = zip(batch.column(names.index("_hit")).to_pylist(), batch.column(names.index("items")).to_pylist())
                for (hit, items), (old_runs, old_items) in zip(results, seen):
                    items.update(old_items)
                    for old in old_runs:
                        hit[old["first"]:old["last"] + 1] = True
            columns = [pa.array([sorted(items) for _, items in results], pa.list_(pa.string()))]
            if spans:
                places = []
                for (_, _, starts, ends, data), (hit, _) in zip(found, results):
                    first, last = stretches(hit)
                    ends_of = np.stack([starts[first], ends[last]], 1)
                    places.append([{"start": int(a), "end": int(b)}
                                   for a, b in _code_points(data, ends_of).tolist()] if len(first) else [])
                columns += [
                    pa.array([len(hit) for hit, _ in results], pa.int64()),
                    pa.array([int(hit.sum()) for hit, _ in results], pa.int64()),
                    pa.array(places, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            else:
                columns.append(pa.array(
                    [[{"first": int(a), "last": int(b)} for a, b in zip(*stretches(hit))] for hit, _ in results],
                    pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), *columns],
                                             schema.fieldNames())

    return docs.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted names of occurring items) and spans.

    ``spans`` are the merged stretches to remove: (start, end) in code points, from the first to the
    last word of a stretch of hit words. Words are runs of ASCII digits and letters, A-Z as a-z, and
    of all characters beyond ASCII. A null or empty text has no words and no hits; an empty benchmark
    hits nothing; items of equal text are all named. Other columns stay; columns called like a result
    or ``_hit`` are replaced. A slice of an Arrow batch is a shard.

    The phrases come to the driver, and from there to the tasks, PASS_PHRASES at a time. With more than
    one pass each writes the documents with what it has found for the next.
    """
    docs = docs.select(*[c for c in docs.columns if c not in (*_MADE, "_hit")])
    pairs = _pairs(benchmark, window)
    n = max(1, math.ceil(pairs.count() / PASS_PHRASES))
    found, stored = docs, []
    for k in range(n):
        rows = pairs.where(F.pmod(F.xxhash64("item", "phrase"), F.lit(n)) == k).toArrow()
        phrases = Phrases(list(zip(*(rows.column(c).to_pylist() for c in ("item", "phrase")))), window)
        found = _search(found, phrases, text, spans=k == n - 1)
        if k < n - 1:
            found = cut(found, "hits")
            discard(*stored)
            stored = [found]
    discard(pairs)
    return found.select(*docs.columns, *_MADE)


def contaminated(n_hit="n_hit", n_words="n_words", one_in: int = ONE_IN):
    return (F.col(n_hit) > 0) & (one_in * F.col(n_hit) >= F.col(n_words))


def items_digest(items="items"):
    return F.sha2(F.concat_ws(",", items), 256)


