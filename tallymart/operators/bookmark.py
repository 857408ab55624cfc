"""Job bookmarks: the next day each workflow has to load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keyed import keyed_upsert


def bookmark_read(bookmarks: DataFrame, workflow_key: str, oldest: DataFrame) -> DataFrame:
    """One row with the day to load: the bookmark, or else ``oldest_day`` of the one-row ``oldest``."""
    return (
        oldest.withColumn("workflow_key", F.lit(workflow_key))
        .join(bookmarks, "workflow_key", "left")
        .select("workflow_key", F.coalesce("date_to_load", "oldest_day").alias("date_to_load"))
    )


def next_bookmark(done: DataFrame) -> DataFrame:
    """Bookmarks for the days after those in ``done`` (workflow_key, day)."""
    return done.select("workflow_key", F.date_add("day", 1).alias("date_to_load"))


def bookmark_upsert(bookmarks: DataFrame, done: DataFrame) -> DataFrame:
    """``bookmarks`` with the workflows in ``done`` moved past their day."""
    return keyed_upsert(bookmarks, next_bookmark(done), ["workflow_key"])
