"""An outbox that lives in a relational database, read through Spark's JDBC source."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_ROWS = 10_000


def day_predicates(day: date, parts: int = 24) -> list[str]:
    """Conditions that cut a day of ``sent_dttm`` into equal spans, one read task each.

    Ranges on the bare column, so that the database can use its index on it.
    """
    start = datetime.combine(day, time())
    edges = [start + timedelta(days=1) * i / parts for i in range(parts + 1)]
    return [f"sent_dttm >= TIMESTAMP '{a}' AND sent_dttm < TIMESTAMP '{b}'"
            for a, b in zip(edges, edges[1:])]


def jdbc_outbox_day(spark: SparkSession, url: str, table: str, day: date,
                    properties: dict[str, str], parts: int = 24) -> DataFrame:
    """One day of the outbox, in the shape of the Parquet outbox.

    Rows are fetched FETCH_ROWS at a time unless ``properties`` say otherwise: some drivers else hold a
    whole span in memory.
    """
    properties = {"fetchsize": str(FETCH_ROWS)} | properties
    rows = spark.read.option("preferTimestampNTZ", "true").jdbc(
        url, table, predicates=day_predicates(day, parts), properties=properties)
    return rows.select(
        F.col("object_id").cast("string").alias("object_id"),
        "object_type",
        F.col("sent_dttm").cast("timestamp_ntz").alias("sent_dttm"),
        F.col("payload").cast("string").alias("payload"),
        "load_src",
        F.to_date("sent_dttm").alias("sent_date"),
    )
