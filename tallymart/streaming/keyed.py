"""Ingest whose cost follows the batch: stored keys are kept as streaming state.

Two queries. The first lands the typed messages as they come, each once, by the file sink. The second keeps,
for each key, where it came first: a few numbers in a RocksDB state store, so a batch looks up and writes its
own keys only, however many are stored. A key seen for the first time is read back from the files that the
batch has landed, and added to the outbox, which no batch reads.

Payloads are shuffled only by the write that sorts them by day, some files at a time. What decides which rows
are new goes by keys and positions, and ends in one bit for each landed row. Shuffle files are deleted as soon
as a step is done: Spark leaves them until the driver collects its memory, which may be never.

State and outbox agree as long as the second query's checkpoint lives. Its own list of stored batches tells:
as long as fewer keys are listed than are stored (a lost checkpoint, a batch that died half way), each batch
is checked against the whole outbox by the exact anti join, and the short way is taken again once both are
equal.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.envelope import read_envelope, rejected
from ..operators.keyed import first_per_key, insert_if_absent
from ..schemas import BATCH_INTERVAL, MESSAGE_REJECTS, OUTBOX
from ..sources.folders import children, data_files, read_folders
from ..sources.tables import Tables, append_rows, drop_partitions, read_table

log = logging.getLogger(__name__)

LANDED = T.StructType([
    *OUTBOX.fields, *[f for f in MESSAGE_REJECTS.fields], T.StructField("landed", T.LongType())])
POSITION = ["landed", "topic", "partition", "offset"]
PLACE = ["file", "stretch", "bit"]

#: Keys go to RocksDB, and a commit uploads what has changed, not the whole store.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Spark turns this off for a query with state, and with it the layout of written files by their size.
_BY_SIZE = {"spark.sql.adaptive.enabled": "true"}
_FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Landed files are written to the outbox so many bytes for each core at a time, one file at least.
BYTES_PER_CORE = 128 << 20
FILES_AT_ONCE = 1000
#: Landed rows to one bitmap, as many as ``bitmap_construct_agg`` has bits.
BITS = 8 * 4096


@contextmanager
def _set(spark: SparkSession, options: dict[str, str]):
    """A query takes the options of the session at its start."""
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of what is run or started here are deleted at the end of each step."""
    return _set(spark, _FREED)


def _free_shuffles(kept: DataFrame) -> None:
    """The same for a frame that is kept and has been computed. A block lost later is computed from the start."""
    relation = kept._jdf.queryExecution().withCachedData()
    relation.cacheBuilder().cachedColumnBuffers().cleanShuffleDependencies(False)


@contextmanager
def _written(df: DataFrame, checkpoint: str, name: str):
    """The rows of ``df`` from files of their own, which stay as long as this lasts.

    A frame kept in memory is not enough: where a plan has it twice, as a join with itself does, Spark takes
    the rows of a stream for two different ones and computes one again.
    """
    at = f"{checkpoint}/kept={name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(at)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(at)
    finally:
        drop_partitions(df.sparkSession, checkpoint, ["kept"], [(name,)])


def _trigger(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def start_landing(messages: DataFrame, tables: Tables, checkpoint: str, once: bool = False,
                  interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Typed messages, sound or not, in one folder per batch; the file sink writes each batch once.

    A file, or a partition of a topic, may come as one task however large it is, so the messages are dealt
    out before they are parsed: a batch has one file for each core.
    """
    messages = messages.repartition(messages.sparkSession.sparkContext.defaultParallelism)
    topic = F.coalesce("topic", F.lit("")) if "topic" in messages.columns else F.lit("")
    typed = read_envelope(messages).withColumn("topic", topic)
    bad = F.col("reason").isNotNull()
    with shuffles_freed(messages.sparkSession):
        return (
            typed.withColumn("value", F.when(bad, F.col("value")))
            .withColumn("landed", F.unix_millis(F.current_timestamp()))
            .select(*LANDED.names)
            .writeStream.format("parquet").partitionBy("landed").option("path", tables.landing)
            .option("compression", "zstd")
            .option("checkpointLocation", checkpoint).trigger(**_trigger(once, interval)).start()
        )


def _key() -> F.Column:
    """What must be stored once: an object, or the position of a message at fault."""
    at = F.concat_ws(":", F.lit("at"), F.col("topic"), F.col("partition"), F.col("offset"))
    return F.when(F.col("reason").isNull(), F.col("object_id")).otherwise(at)


def new_keys(landed: DataFrame) -> DataFrame:
    """(key, position) of the keys of a stream that no earlier batch had; within a batch the least position.

    A key is new if all that is known of it is from this batch. Clocks may go back between batches.
    """
    now = F.current_timestamp()
    place = F.struct("partition", "offset", "topic", "landed")
    return (
        landed.select(_key().alias("key"), place.alias("place"), now.alias("at"))
        .groupBy("key").agg(F.min(F.struct("at", "place")).alias("first"), F.max("at").alias("last_at"))
        .where((F.col("first.at") == now) & (F.col("last_at") == now))
        .select("key", "first.place.*")
    )


def _with_place(landed: DataFrame) -> DataFrame:
    """Landed rows with the place of each: its file, the bitmap of its stretch of rows, and the bit there."""
    row = F.col("_metadata.row_index")
    return landed.select(
        "*", F.col("_metadata.file_name").alias("file"), F.floor(row / BITS).alias("stretch"),
        (row % BITS).cast("int").alias("bit"))


def located(landed: DataFrame, fresh: DataFrame) -> DataFrame:
    """The place of each new key. A landing task that was run again may have left its rows twice."""
    rows = _with_place(landed).select(
        _key().alias("key"), *POSITION, F.col("reason").isNotNull().alias("bad"), *PLACE)
    rows = rows.join(fresh, ["key", *POSITION], "left_semi")
    # A key has one position here, so the rows stand together by the join already.
    return first_per_key(rows, ["key", *POSITION], PLACE)


def marks_of(places: DataFrame) -> DataFrame:
    """Places as bitmaps, one for each stretch of a file."""
    return places.groupBy("landed", "file", "stretch").agg(F.bitmap_construct_agg("bit").alias("bits"))


def marked_rows(landed: DataFrame, marks: DataFrame) -> DataFrame:
    """The landed rows whose bit is set. The marks, an eighth of a byte for a row, go to each executor."""
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    rows = _with_place(landed).join(F.broadcast(marks), ["landed", "file", "stretch"])
    return rows.where(F.getbit(byte.cast("int"), F.col("bit") % 8) == 1).select(*LANDED.names)


class _Store:
    """Adds the new keys of each batch to outbox and reject table."""

    def __init__(self, tables: Tables, checkpoint: str):
        self.tables, self.stored_batches = tables, f"{checkpoint}/stored"
        self.checkpoint = checkpoint
        self.state_knows_all = False

    def _is_stored(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether the batch was finished before the query died, so that Spark runs it again."""
        return any(name == "_SUCCESS" for name, _, _ in children(spark, f"{self.stored_batches}/batch={batch_id}"))

    def _keys_agree(self, spark: SparkSession) -> bool:
        """As many keys listed as stored. All listed ones are stored, so the state then knows all."""
        batches = [name for name, _, _ in children(spark, self.stored_batches)]
        listed = spark.read.parquet(self.stored_batches).agg(F.sum("n_new")).first()[0] if batches else 0
        stored = (read_table(spark, self.tables.outbox, OUTBOX).count()
                  + read_table(spark, self.tables.message_rejects, MESSAGE_REJECTS).count())
        return listed == stored

    def _append(self, rows: DataFrame, exact: bool) -> None:
        """Writes the landed rows that ``rows`` has the places of, but with ``exact`` none that is stored."""
        spark, tables = rows.sparkSession, self.tables
        good, bad = rows.where(~F.col("bad")), rows.where("bad")
        if exact:
            n_good, n_bad = rows.agg(F.count_if(~F.col("bad")), F.count_if("bad")).first()
            position = ("topic", "partition", "offset")
            good = insert_if_absent(good.withColumnRenamed("key", "object_id"),
                                    read_table(spark, tables.outbox, OUTBOX), batch_rows=n_good)
            bad = insert_if_absent(bad, read_table(spark, tables.message_rejects, MESSAGE_REJECTS),
                                   keys=position, order=position, batch_rows=n_bad)
        places = ["landed", *PLACE]
        marks = marks_of(good.select(places).union(bad.select(places)))
        with _written(marks, self.checkpoint, "marks") as marks:
            rows.unpersist()
            files = marks.select("landed", "file").distinct().collect()  # no more than files in a batch
            for some in self._lots(spark, files):
                names = [path.rsplit("/", 1)[1] for path in some]
                landed = read_folders(spark, tables.landing, LANDED, some)
                new = marked_rows(landed, marks.where(F.col("file").isin(names)))
                append_rows(new.where(F.col("reason").isNull()).select(*OUTBOX.names), tables.outbox,
                            ["sent_date"], ["object_type", "sent_dttm"])
                append_rows(rejected(new), tables.message_rejects)

    def _lots(self, spark: SparkSession, files: Sequence) -> Iterator[list[str]]:
        """Paths of landed files, as many together as are written at once."""
        wanted = {(f.landed, f.file) for f in files}
        most = BYTES_PER_CORE * spark.sparkContext.defaultParallelism
        lot, size = [], 0
        for folder in sorted({landed for landed, _ in wanted}):
            for path, n_bytes in data_files(spark, f"{self.tables.landing}/landed={folder}"):
                if (folder, path.rsplit("/", 1)[1]) not in wanted:
                    continue
                if lot and (size + n_bytes > most or len(lot) == FILES_AT_ONCE):
                    yield lot
                    lot, size = [], 0
                lot.append(path)
                size += n_bytes
        if lot:
            yield lot

    def __call__(self, fresh: DataFrame, batch_id: int) -> None:
        spark = fresh.sparkSession
        if self._is_stored(spark, batch_id):
            fresh.write.format("noop").mode("overwrite").save()  # the state still has to take the batch in
            return
        with _set(spark, {**_BY_SIZE, **_FREED}), _written(fresh, self.checkpoint, "fresh") as written:
            fresh._jdf.queryExecution().toRdd().cleanShuffleDependencies(False)  # the state has all of it
            self._store(spark, written, batch_id)

    def _store(self, spark: SparkSession, fresh: DataFrame, batch_id: int) -> None:
        rows = None
        try:
            lots = fresh.groupBy("landed").count().collect()  # no more than files in a batch
            n_new = sum(lot["count"] for lot in lots)
            exact = not self.state_knows_all and not self._keys_agree(spark)
            log.info("%d new keys, %s", n_new, "checked against the outbox" if exact else "by state")
            if n_new:
                landed = read_folders(spark, self.tables.landing, LANDED,
                                      [f"{self.tables.landing}/landed={lot.landed}" for lot in lots])
                rows = located(landed, fresh).persist(StorageLevel.MEMORY_AND_DISK)
                rows.count()  # all of it is computed before its shuffle files go
                _free_shuffles(rows)
                self._append(rows, exact)
            spark.range(1).select(F.lit(n_new).cast("long").alias("n_new")).write.mode("overwrite").parquet(
                f"{self.stored_batches}/batch={batch_id}")
            self.state_knows_all = not exact
        finally:
            if rows is not None:
                rows.unpersist()


def start_keyed_store(spark: SparkSession, tables: Tables, checkpoint: str, once: bool = False,
                      interval: str = BATCH_INTERVAL, files_per_batch: int = 1000) -> StreamingQuery:
    """Landed messages into the outbox, each object once, the first one of a batch by partition and offset.

    The landing folder must exist. One query per outbox. ``spark.sql.shuffle.partitions`` of the first start
    is the number of state stores for good.
    """
    landed = (spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch)
              .parquet(tables.landing))
    with _set(spark, {**_STATE, **_FREED}):
        return (
            new_keys(landed).writeStream.outputMode("update").foreachBatch(_Store(tables, checkpoint))
            .option("checkpointLocation", checkpoint).trigger(**_trigger(once, interval)).start()
        )


def ingest_keyed_available(spark: SparkSession, messages: DataFrame, tables: Tables, checkpoint: str,
                           files_per_batch: int = 1000) -> DataFrame:
    """Land and store all waiting messages, and return the outbox."""
    start_landing(messages, tables, f"{checkpoint}/landing", once=True).awaitTermination()
    start_keyed_store(spark, tables, f"{checkpoint}/store", once=True,
                      files_per_batch=files_per_batch).awaitTermination()
    return read_table(spark, tables.outbox, OUTBOX)
