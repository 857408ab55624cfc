"""Stream of messages -> outbox table, each object once."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.envelope import accepted, read_envelope, rejected
from ..operators.keyed import insert_if_absent
from ..schemas import BATCH_INTERVAL, INGEST_BATCHES, MESSAGE_REJECTS, OUTBOX
from ..sources.tables import Tables, append_rows, read_table

log = logging.getLogger(__name__)


#: Tasks that parse a batch, for each core.
TASKS_PER_CORE = 3


def _ranges(typed: DataFrame) -> list[tuple]:
    """For each topic and partition: first and last offset, messages, rejected ones."""
    topic = F.coalesce("topic", F.lit("")) if "topic" in typed.columns else F.lit("")
    return [tuple(row) for row in typed.groupBy(topic.alias("topic"), "partition").agg(
        F.min("offset"), F.max("offset"), F.count(F.lit(1)), F.count("reason")).collect()]


def read_batches(spark: SparkSession, tables: Tables) -> DataFrame:
    """The ledger of batches; one that was run again after a failure is listed once."""
    return read_table(spark, tables.ingest_batches, INGEST_BATCHES).distinct()


def store_batch(batch: DataFrame, tables: Tables, batch_id: int | None = None, stream: str = "") -> None:
    """Add one batch to the outbox and the reject table, and with a ``batch_id`` to the ledger of batches.

    Both writes skip what is stored already, by object id and by (topic, partition, offset), so a batch that
    is run again after a failure, or a topic read again from its start, changes nothing.

    Files are sorted by type, so that an import of rates skips the row groups of transactions.

    A file, or a partition of a topic, may come as one task however large it is. Parsing is most of the work,
    so the messages are dealt out before it.
    """
    spark = batch.sparkSession
    batch = batch.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    # Kept for the two writes; the raw text only where it is stored. A lost block is computed again.
    typed = (read_envelope(batch)
             .withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
             .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        ranges = _ranges(typed)
        n_rows, n_rejected = sum(r[4] for r in ranges), sum(r[5] for r in ranges)
        log.info("%d messages, %d of them rejected", n_rows, n_rejected)
        if n_rejected < n_rows:
            new = insert_if_absent(accepted(typed), read_table(spark, tables.outbox, OUTBOX),
                                   batch_rows=n_rows - n_rejected)
            append_rows(new.select(*OUTBOX.names), tables.outbox, ["sent_date"],
                        ["object_type", "sent_dttm"])
        if n_rejected:
            position = ("topic", "partition", "offset")
            bad = insert_if_absent(
                rejected(typed), read_table(spark, tables.message_rejects, MESSAGE_REJECTS),
                keys=position, order=position, batch_rows=n_rejected)
            append_rows(bad, tables.message_rejects)
        if batch_id is not None and ranges:
            ledger = spark.createDataFrame([(stream, batch_id, *r) for r in ranges], INGEST_BATCHES)
            ledger.coalesce(1).write.mode("append").parquet(tables.ingest_batches)
    finally:
        typed.unpersist()


def start_ingest(messages: DataFrame, tables: Tables, checkpoint: str,
                 once: bool = False, interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Run ``messages`` (value, partition, offset, and topic if there are several) into the outbox.

    The source's options bound a batch; ``once`` works off what is there and stops, otherwise a batch
    starts every ``interval``. One query per outbox: two writers could both find a key absent.
    """
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        messages.writeStream
        .foreachBatch(lambda batch, batch_id: store_batch(batch, tables, batch_id, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest_available(spark: SparkSession, messages: DataFrame, tables: Tables,
                     checkpoint: str) -> DataFrame:
    """Work off all waiting messages and return the outbox."""
    start_ingest(messages, tables, checkpoint, once=True).awaitTermination()
    return read_table(spark, tables.outbox, OUTBOX)
