"""Reading tables, cutting lineage, and carrying rows through Arrow functions."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import scratch_path

#: Bytes of text that a numpy step works on at once; a longer document is a step of its own.
STEP_BYTES = 250_000
#: Bytes of an Arrow batch that a function gets at once; a longer row comes alone.
SLICE_BYTES = 4_000_000
#: Bytes at which Spark ends an Arrow batch: less than a slice, which the last row may still fill.
BATCH_BYTES, BATCH_SETTING = 3_000_000, "spark.sql.execution.arrow.maxBytesPerBatch"
#: A group of more rows is joined by broadcast. More of them than MOST_LARGE are not possible.
LARGE_GROUP, MOST_LARGE = 10_000, 100_000
#: Stored rows of a few numbers that are sent to all tasks; more of them are joined by shuffle.
SENT_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor costs no earlier stage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Deletes what ``cut`` has written, once all that was made of it is written too."""
    for df in stored:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sent(stored: DataFrame) -> DataFrame:
    """Stored rows, marked to be broadcast if they are few."""
    return F.broadcast(stored) if stored.count() <= SENT_ROWS else stored


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def spread(spark: SparkSession, least: int = 64) -> int:
    """Groups to deal a hot key over: at least as many as tasks after a shuffle."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_steps(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets of the rows in them), in steps of bounded size.

    A null text has no bytes.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + STEP_BYTES, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def give_back() -> None:
    """Returns freed memory to the system: a worker is used again by the stages to come, and keeps it else."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of bounded size: a worker's memory must not follow a batch's."""
    for batch in batches:
        rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        give_back()


def small_batches(spark: SparkSession) -> None:
    """Has this session end Arrow batches at BATCH_BYTES; a size that somebody has set is left.

    Spark ends them at 10,000 rows. With text these are tens of MB, which an executor holds several times
    for each task, outside its heap, and the worker once more.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch],
                schema: str | T.StructType) -> DataFrame:
    """``function`` on slices of the Arrow batches of ``df``."""
    small_batches(df.sparkSession)

    def run(batches):
        return map(function, slices(batches))

    return df.mapInArrow(run, schema)


def schema_with(docs: DataFrame, *more: tuple[str, T.DataType]) -> T.StructType:
    """The schema of ``docs`` with further fields."""
    return T.StructType([*docs.schema.fields, *[T.StructField(n, kind) for n, kind in more]])


def join_members(rows: DataFrame, groups: DataFrame, keys: list[str], members: str) -> DataFrame:
    """``rows`` with the columns of their group; ``members`` tells how many rows a group has.

    Groups of many rows are broadcast, so that none lands in one task. Their number is bounded: what counts
    as many grows with the number of rows.
    """
    n_rows = groups.agg(F.sum(members)).first()[0] or 0
    large = F.col(members) > max(LARGE_GROUP, n_rows // MOST_LARGE)
    many = F.broadcast(groups.where(large))
    others = rows.join(F.broadcast(groups.where(large).select(*keys)), keys, "left_anti")
    return rows.join(many, keys).unionByName(others.join(groups.where(~large), keys))


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The offsets and the values, as double, of a list array without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets, np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    return offsets - offsets[0], np.asarray(pc.cast(values, pa.float64()))
