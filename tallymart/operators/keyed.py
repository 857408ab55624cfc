"""Operators on keyed rows: first or last per key, insert if absent, upsert, key check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest row count a side may have to be broadcast. The rows are narrow (keys and a rate, under
# 100 bytes), so this is some 20 MB. Callers always have a shuffle plan for larger sides.
BROADCAST_ROWS = 200_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows, by count."""
    return df.count() <= max_rows


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before the shuffle
    (WindowGroupLimit), so a key that holds a third of all rows costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")


def insert_if_absent(
    batch: DataFrame,
    stored: DataFrame,
    keys: Sequence[str] = ("object_id",),
    order: Sequence[Column | str] = ("partition", "offset"),
    broadcast_rows: int = BROADCAST_ROWS,
    batch_rows: int | None = None,
) -> DataFrame:
    """Rows of ``batch`` to append to ``stored``: the first per key, if the key is not stored yet.

    ``stored`` is far larger than a batch and only its key columns are read. For a small batch its
    keys are broadcast to the stored side, which is then scanned without a shuffle. For a large
    one (a first load) both sides are shuffled on the key; the ranking has already shuffled the
    batch that way, and both sides then hold each key once, so no key is hot. ``batch_rows`` saves
    the count where the caller knows it.
    """
    keys = list(keys)
    first = first_per_key(batch, keys, order)
    stored_keys = stored.select(*keys)
    batch_keys = batch.select(*keys)
    if batch_rows is None:
        batch_rows = batch_keys.count()
    if batch_rows <= broadcast_rows:
        stored_keys = stored_keys.join(F.broadcast(batch_keys.distinct()), keys, "left_semi")
    return first.join(stored_keys, keys, "left_anti")


def keyed_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` put in place of those with the same key.

    A key that ``source`` holds twice is an error, as which row should win is not told.
    """
    times = Window.partitionBy(*keys)
    twice = F.raise_error(F.lit("keyed_upsert: a key of the source has several rows"))
    source = source.withColumn("_n", F.count(F.lit(1)).over(times)).where(
        F.when(F.col("_n") > 1, twice.cast("boolean")).otherwise(True)).drop("_n")
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
