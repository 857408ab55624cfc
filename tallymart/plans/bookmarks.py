"""Stored bookmarks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bookmark import next_bookmark
from ..schemas import BOOKMARKS
from ..sources.tables import Tables, read_table, replace_partitions


class BookmarkMoved(RuntimeError):
    """Another run has moved the bookmark meanwhile."""


def _stored_day(spark: SparkSession, tables: Tables, workflow_key: str) -> date | None:
    stored = read_table(spark, tables.bookmarks, BOOKMARKS).where(
        F.col("workflow_key") == workflow_key).first()
    return stored.date_to_load if stored else None


def day_to_load(spark: SparkSession, tables: Tables, workflow_key: str,
                oldest: Callable[[], DataFrame]) -> date | None:
    """The bookmarked day. Without a bookmark, the oldest day of the source; None if that is empty.

    The source is looked at only when there is no bookmark.
    """
    return _stored_day(spark, tables, workflow_key) or oldest().first()[0]


def move_past(spark: SparkSession, tables: Tables, workflow_key: str, day: date) -> None:
    """Set the bookmark to the day after ``day``. Each workflow is a partition of its own.

    Refused if the bookmark is on another day: a second run that began from the same bookmark must not set it
    back or ahead. The look and the write are two steps, so this tells runs apart that end one after the other.
    """
    stored = _stored_day(spark, tables, workflow_key)
    if stored not in (None, day):
        raise BookmarkMoved(f"{workflow_key} is on {stored}, not on {day}")
    done = spark.range(1).select(F.lit(workflow_key).alias("workflow_key"),
                                 F.lit(day).alias("day"))
    replace_partitions(next_bookmark(done), tables.bookmarks, ["workflow_key"])
