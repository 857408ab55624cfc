"""Whitening of embeddings with MLlib's distributed block matrices.

Centred rows are indexed into blocks; the transpose times the blocks is the scatter matrix, which is small
and decomposed on the driver; the blocks times the whitening matrix are the projected rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, schema_with, slices

COMPONENTS = 16
#: Entries become whole numbers: so many steps to a unit, from an offset on.
STEPS, OFFSET = 64, 1_000_000
#: Entries of more steps than this count as this many: doubles still tell them apart, and sums stay exact.
MOST_STEPS = 1 << 52
#: Rows of a block: more on large inputs, so that the list of blocks, which MLlib keeps on the driver, stays short.
BLOCK_ROWS, LARGEST_BLOCK, MOST_BLOCKS = 1024, 65_536, 100_000
#: Parts that the sum of a matrix product is made of, before they are added up.
PRODUCT_PARTS = 64

SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def _steps(vector: str):
    """The whole numbers of a vector."""
    bounded = lambda c: F.greatest(F.least(c * STEPS, F.lit(float(MOST_STEPS))), F.lit(-float(MOST_STEPS)))
    return F.transform(vector, lambda c: F.floor(bounded(c.cast("double"))) + OFFSET)


def _indexed(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df``, stored, with a gapless ``index``; and the number of rows.

    What the driver sees is one count for each task that wrote.
    """
    stored = cut(df.withColumn("place", F.monotonically_increasing_id()), name)
    task = F.shiftright("place", 33)
    counts = sorted(map(tuple, stored.groupBy(task.alias("task")).count().collect()))
    before = np.cumsum([0, *(n for _, n in counts)])
    starts = [(task, int(start)) for (task, _), start in zip(counts, before)]
    offsets = F.broadcast(df.sparkSession.createDataFrame(starts, "task long, start long"))
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored.withColumn("task", task).join(offsets, "task").withColumn("index", F.col("start") + inside)
    return rows.drop("place", "task", "start"), int(before[-1])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _sums(fit: DataFrame) -> list[int]:
    """The exact sum of each dimension of ``x``, each task's share added up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = low = 0
        for batch in slices(batches):
            x = _matrix(batch.column("x"))
            high, low = high + (x >> 20).sum(axis=0), low + (x & (1 << 20) - 1).sum(axis=0)
        if np.ndim(high):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(high)), pa.int32()), pa.array(high), pa.array(low)], ["i", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "i int, high long, low long")
    rows = parts.groupBy("i").agg(F.sum("high"), F.sum("low")).collect()
    return [(high << 20) + low for _, high, low in sorted(map(tuple, rows))]


def _centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """Adds ``centred``, x less its mean, rounded once, and ``deviation``, the sum of (n * x - S) squared.

    All is exact in whole numbers up to there; a deviation that a long cannot hold is null.
    """
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column("x")) - whole
            most = int(np.abs(x).max(initial=0)) + 1
            if most * n >= 1 << 62:
                x = x.astype(object)
            apart = x * n - rest
            centred = (apart / n).astype(np.float64)
            if (most * n) ** 2 * x.shape[1] >= 1 << 63:
                apart = apart.astype(object)
            squares = [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]
            offsets = np.arange(0, centred.size + 1, centred.shape[1], dtype=np.int32)
            columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "x"]
            names = [name for name in batch.schema.names if name != "x"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(offsets, pa.array(centred.ravel())),
                 pa.array(squares, pa.int64())], [*names, "centred", "deviation"])

    schema = schema_with(rows.drop("x"), ("centred", T.ArrayType(T.DoubleType())), ("deviation", T.LongType()))
    return rows.mapInArrow(run, schema)


def _blocks(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The rows (index, centred) as a matrix in blocks of whole rows."""
    rows = rows.select("index", array_to_vector("centred").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), n, width)
    return indexed.toBlockMatrix(min(LARGEST_BLOCK, max(BLOCK_ROWS, n // MOST_BLOCKS)), width)


def _product(left: BlockMatrix, right: BlockMatrix, parts: int) -> np.ndarray:
    """A small product of two matrices that share their long side, summed in ``parts`` parts."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def _small(spark: SparkSession, matrix: np.ndarray) -> BlockMatrix:
    """A matrix of one block."""
    block = Matrices.dense(*matrix.shape, matrix.ravel(order="F").tolist())
    return BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), *matrix.shape)


def whiten(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
           n_components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Rows whose vector is null, empty, or has an entry that is null or not finite go, and so do vectors of
    another length than most have (of equally many the longer). Entries become whole numbers x. The fit list
    holds each distinct x vector once, so that copies have no weight; means, covariance (divisor n) and the
    identity check are over this list. Components are numbered from 1 by falling variance; those without
    variance, as far as double precision can tell, are left out, so one distinct vector gives no rows. An
    empty table gives none either. Repeated rows and ids each get their rows; other columns do not matter.
    """
    spark = embeddings.sparkSession
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf)
    source = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    source = source.where(F.coalesce((F.size("vector") > 0) & ~F.exists("vector", bad), F.lit(False)))
    usual = source.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return spark.createDataFrame([], SCHEMA)
    width = usual.width
    whole = source.where(F.size("vector") == width).select("vec_id", _steps("vector").alias("x"))
    rows, n_rows = _indexed(whole, "whole_vectors")
    fit, n = _indexed(rows.select("x").distinct(), "fit_list")
    sums = _sums(fit)
    fitted = _blocks(cut(_centred(fit, n, sums), "centred_fit"), n, width)
    parts = min(PRODUCT_PARTS, fitted.numRowBlocks)
    scatter = _product(fitted.transpose(), fitted, parts) / n
    values, vectors = np.linalg.eigh((scatter + scatter.T) / 2)
    order = np.argsort(-values)[:n_components]
    order = order[values[order] > width * np.finfo(float).eps * max(values.max(), 0)]
    if not len(order):
        return spark.createDataFrame([], SCHEMA)
    matrix = _small(spark, vectors[:, order] / np.sqrt(values[order]))
    whitened = fitted.multiply(matrix)
    error = float(np.abs(_product(whitened.transpose(), whitened, parts) / n - np.eye(len(order))).max())
    explained = F.array(*[F.lit(float(v)) for v in values[order] / np.trace(scatter)])

    centred = cut(_centred(rows, n, sums), "centred_rows")
    projected = _blocks(centred, n_rows, width).multiply(matrix).toIndexedRowMatrix()
    found = MLUtils.convertVectorColumnsToML(
        callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model), "vector")
    found = found.select("index", vector_to_array("vector").alias("entries"))
    return centred.select("index", "vec_id", "deviation").join(found, "index").select(
        "vec_id", "deviation", F.posexplode("entries").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
