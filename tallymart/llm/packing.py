"""Packing by non-negative least squares over combinations of lengths.

Documents are cut into pieces of at most a window. The histogram of piece lengths, in steps of STEP
tokens, is all that the plan needs: combinations of up to three lengths that fill a window exactly are
enumerated, repeat counts solved against the histogram and rounded, and what is left is packed
greedily. Pieces then take their places by their rank among those of their length.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, map_batches, spread
from .tokens import VOCABULARY, encoder

WINDOW = 2048
#: Tokens by which lengths are told apart; a piece pads less than that.
STEP = 4
#: Id that closes each document.
END_ID = 1
ROUNDS = 600


def token_pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece; a null text has its end id only."""

    def run(batch):
        encode, end = encoder(vocabulary), struct.pack("<I", END_ID)
        names = ("start", "length", "ids_crc32", "doc_tokens")
        columns = {name: [] for name in names}
        rows = []
        for row, text in enumerate(batch.column(1).to_pylist()):
            ids = encode(text or "") + end
            total = len(ids) // 4
            for start in range(0, total, window):
                length = min(window, total - start)
                rows.append(row)
                for name, value in zip(names, (start, length,
                                               zlib.crc32(ids[4 * start:4 * (start + length)]), total)):
                    columns[name].append(value)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())),
             *[pa.array(columns[name], pa.int64()) for name in names]], ["doc_id", *names])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run,
                       "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def combinations(size: int) -> np.ndarray:
    """All ways to fill ``size`` with one to three lengths, the longest first, unused places 0."""
    found = [(size, 0, 0)]
    found += [(size - b, b, 0) for b in range(1, size // 2 + 1)]
    found += [(size - b - c, b, c) for c in range(1, size // 3 + 1)
              for b in range(c, (size - c) // 2 + 1)]
    return np.array(found)


def least_squares(parts: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeats x >= 0 of each combination with the least sum of squares of A x - histogram.

    Accelerated projected gradient steps; column j of A counts the lengths of combination j.
    """
    n = len(histogram)

    def times(x):
        total = sum(np.bincount(p, weights=x, minlength=n) for p in parts.T)
        total[0] = 0
        return total

    normal = np.zeros((n, n))
    for p in parts.T:
        for q in parts.T:
            np.add.at(normal, (p, q), 1)
    normal[0] = normal[:, 0] = 0
    step = 1 / np.linalg.eigvalsh(normal)[-1]
    x = y = np.zeros(len(parts))
    t = 1.0
    for _ in range(rounds):
        residual = times(y) - histogram
        residual[0] = 0
        new = np.maximum(0, y - step * residual[parts].sum(1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths) so that each length is used as often as ``histogram`` has it.

    ``histogram[i]`` pieces are i steps long; its last entry is the window.
    """
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    parts = combinations(size)
    used = parts[(left[parts] > 0).astype(int).sum(1) == (parts > 0).sum(1)]
    packs = []

    def take(lengths: tuple[int, ...], most: int) -> None:
        repeats = min([most, *(int(left[length]) // lengths.count(length) for length in lengths)])
        if repeats > 0:
            for length in lengths:
                left[length] -= repeats
            packs.append((repeats, lengths))

    if len(used):
        repeats = np.rint(least_squares(used, left.astype(float))).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            if repeats[j] < 1:
                break
            take(tuple(int(p) for p in used[j] if p), int(repeats[j]))
    while left.any():  # each round uses up a length
        lengths, room, free = [], size, left.copy()
        while True:
            fits = np.flatnonzero(free[:room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            lengths.append(length)
            free[length] -= 1
            room -= length
        take(tuple(lengths), int(left.max()))
    return packs


def _ranked(pieces: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``pieces`` with ``rank``, gapless from 0 for each value of ``by``.

    Very frequent values are dealt over groups by a hash of ``order``; groups start after each other.
    """
    groups = spread(pieces.sparkSession)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    counts = dealt.groupBy(by, "_group").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(by).orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(by, "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = W.partitionBy(by, "_group").orderBy(*order)
    return (dealt.withColumn("_row", F.row_number().over(inside))
            .join(F.broadcast(starts), [by, "_group"])  # lengths x groups rows at most
            .withColumn("rank", F.col("_start") + F.col("_row") - 1)
            .drop("_group", "_start", "_row"))


def pack_pieces(pieces: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """``pieces`` (with length, 1 to ``window``) with sequence_id and offset.

    Offsets are gapless from 0 and follow each other in a sequence. Every piece is placed, pieces that
    are equal in all columns too. An empty table gives none.
    """
    spark = pieces.sparkSession
    sized = pieces.withColumn("_size", F.ceil(F.col("length") / step).cast("int"))
    counts = np.zeros(window // step + 1, np.int64)
    for size, count in sized.groupBy("_size").count().collect():  # window / step rows at most
        counts[size] = count
    next_rank, first, places = np.zeros(len(counts), np.int64), 0, []
    for repeats, lengths in plan(counts):
        for slot, length in enumerate(lengths):
            low = int(next_rank[length])
            places.append((length, low, low + repeats, first, slot))
            next_rank[length] += repeats
        first += repeats
    # Rows from a list would come through Python workers, which stay beside those of the other steps.
    kinds = {"_size": pa.int32(), "_low": pa.int64(), "_high": pa.int64(), "_first": pa.int64(), "_slot": pa.int32()}
    table = spark.createDataFrame(pa.table(
        {name: pa.array([place[i] for place in places], kind) for i, (name, kind) in enumerate(kinds.items())}))
    ranked = _ranked(sized, "_size", ["doc_id", "start", "ids_crc32"])
    placed = ranked.join(F.broadcast(table), "_size").where(  # as many rows as the plan has places
        "rank >= _low AND rank < _high").withColumn(
        "sequence_id", F.col("_first") + F.col("rank") - F.col("_low"))
    before = W.partitionBy("sequence_id").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop(
        "_size", "rank", "_low", "_high", "_first", "_slot")


def pack_documents(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their sequence; other columns are ignored."""
    return pack_pieces(cut(token_pieces(docs, window, vocabulary), "pieces"), window)
