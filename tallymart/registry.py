"""One query per operator, over the fixtures of a test-data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions.time import on_days
from .operators import bookmark, conversion, envelope, keyed, metrics, ranking, staging
from .plans import compaction, datamart, import_day
from .schemas import (
    BOOKMARKS, CURRENCIES, CURRENCY, CURRENCY_KEY, GLOBAL_METRICS, MESSAGE_REJECTS, OUTBOX,
    STAGED_CURRENCIES, STAGED_TRANSACTIONS, STAGING_REJECTS, TRANSACTION, TRANSACTIONS,
    TRANSACTION_KEY,
)
from .sources import files, folders, kafka
from .sources.tables import Tables, append_rows, read_table, replace_scope, scratch_path
from .streaming import keyed as keyed_stream
from .streaming.ingest import ingest_available, read_batches

DAY = date(2024, 1, 15)
DAY_TASKS = 31
TEXT_ENVELOPE = ["partition", "offset", "object_id", "object_type", "sent_dttm", "payload", "reason"]

Query = Callable[[SparkSession, str], DataFrame]


def _span(df: DataFrame, day: str) -> tuple[date, date]:
    """The first and the last day of the data."""
    return tuple(df.agg(F.min(day), F.max(day)).first())


# --- ingest --------------------------------------------------------------------------------

def decode_envelope(spark, sf):
    return envelope.decode_envelope(fx.fx_messages(spark, sf)).select(*TEXT_ENVELOPE)


def require_fields(spark, sf):
    checked = envelope.require_fields(envelope.decode_envelope(fx.fx_messages(spark, sf)))
    return checked.select("partition", "offset", "reason")


def type_envelope(spark, sf):
    return envelope.read_envelope(fx.fx_messages(spark, sf)).select(
        *TEXT_ENVELOPE, "load_src", "sent_date")


def _ingested(spark, sf) -> Tables:
    """All messages through the stream, a few files per batch.

    The file source takes files by age. The repeats are written last, so that they arrive last.
    """
    tables = Tables(scratch_path(spark, "ingest"))
    inbox = f"{tables.root}/inbox"
    messages, repeat = fx.fx_all_messages(spark, sf), F.col("partition") == fx.REPEATS
    messages.where(~repeat).repartition(6).write.parquet(inbox)
    messages.where(repeat).repartition(2).write.mode("append").parquet(inbox)
    ingest_available(spark, files.file_messages(spark, inbox, files_per_batch=3), tables,
                     f"{tables.root}/ingest-checkpoint")
    return tables


def bounded_batches(spark, sf):
    return read_table(spark, _ingested(spark, sf).outbox, OUTBOX)


def message_rejects(spark, sf):
    tables = _ingested(spark, sf)
    return read_table(spark, tables.message_rejects, MESSAGE_REJECTS)


def ingest_batches(spark, sf):
    """The ledger of a stream whose batches are files of known content: messages and rejects of each."""
    tables = Tables(scratch_path(spark, "ledger"))
    inbox = f"{tables.root}/inbox"
    lot = F.when(F.col("partition") == fx.REPEATS, -1).otherwise(F.col("offset") % 6)
    (fx.fx_messages(spark, sf).withColumn("lot", lot).repartition("lot")
     .write.partitionBy("lot").parquet(inbox))
    ingest_available(spark, files.file_messages(spark, f"{inbox}/*", files_per_batch=1), tables,
                     f"{tables.root}/ingest-checkpoint")
    return read_batches(spark, tables).groupBy("stream", "batch_id").agg(
        F.sum("n_messages").alias("n_messages"), F.sum("n_rejected").alias("n_rejected"),
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
    ).drop("stream", "batch_id")


def _ingested_by_key(spark, sf) -> Tables:
    """Two runs by stored keys, the repeats in the second; then all again with a new checkpoint."""
    tables = Tables(scratch_path(spark, "keyed"))
    inbox = f"{tables.root}/inbox"
    messages, repeat = fx.fx_all_messages(spark, sf), F.col("partition") == fx.REPEATS
    for some in (~repeat, repeat):
        with keyed_stream.shuffles_freed(spark):
            messages.where(some).repartition(4).write.mode("append").option("compression", "zstd").parquet(inbox)
        keyed_stream.ingest_keyed_available(spark, files.file_messages(spark, inbox), tables,
                                            f"{tables.root}/checkpoint")
    keyed_stream.start_keyed_store(spark, tables, f"{tables.root}/checkpoint-2", once=True).awaitTermination()
    return tables


def keyed_ingest(spark, sf):
    return read_table(spark, _ingested_by_key(spark, sf).outbox, OUTBOX)


def keyed_ingest_rejects(spark, sf):
    return read_table(spark, _ingested_by_key(spark, sf).message_rejects, MESSAGE_REJECTS)


def _compacted(spark, sf) -> Tables:
    """An outbox of many small files, merged twice. A task writes the file of one lot for a day in DAY_TASKS."""
    tables = Tables(scratch_path(spark, "compact"))
    lot = F.pmod(F.xxhash64("object_id"), F.lit(6)).cast("int")
    task = lot * DAY_TASKS + F.pmod(F.unix_date("sent_date"), F.lit(DAY_TASKS))
    fx.fx_outbox(spark, sf).repartitionById(6 * DAY_TASKS, task).write.partitionBy("sent_date").parquet(tables.outbox)
    for _ in range(2):
        compaction.compact_outbox(spark, tables, least_files=2)
    return tables


def compact_outbox(spark, sf):
    return read_table(spark, _compacted(spark, sf).outbox, OUTBOX)


def compact_outbox_layout(spark, sf):
    """Files of each day after the merge, and rows before an earlier one of their file."""
    in_file = Window.partitionBy("sent_date", "file").orderBy("at")
    return (
        read_table(spark, _compacted(spark, sf).outbox, OUTBOX)
        .select("sent_date", "object_type", "sent_dttm", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("at"))
        .withColumn("before", F.lag(F.struct("object_type", "sent_dttm")).over(in_file))
        .groupBy("sent_date")
        .agg(F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
             F.count_if(F.col("before") > F.struct("object_type", "sent_dttm")).alias("n_unordered")))


def insert_if_absent(spark, sf):
    rows = envelope.accepted(envelope.read_envelope(fx.fx_all_messages(spark, sf)))
    stored = fx.fx_outbox(spark, sf).where(F.col("sent_date") < F.lit(DAY))
    return keyed.insert_if_absent(rows, stored).select(*OUTBOX.names)


def kafka_sink_encode(spark, sf):
    rows = fx.fx_tx(spark, sf).select(
        "operation_id", "currency_code", "amount",
        F.nullif("country", F.lit("country_0")).alias("country"))
    return kafka.kafka_sink_encode(rows)


def kafka_sink_stream(spark, sf):
    """Rows sent as a stream in two runs from one checkpoint, here to files."""
    root = scratch_path(spark, "sink")
    rows = fx.fx_tx(spark, sf).select(
        "operation_id", "currency_code", "amount",
        F.nullif("country", F.lit("country_0")).alias("country"), (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        rows.where(F.col("half") == half).drop("half").write.mode("append").parquet(f"{root}/rows")
        stream = spark.readStream.schema(rows.drop("half").schema).parquet(f"{root}/rows")
        kafka.start_sink(stream, f"{root}/checkpoint", "text", {"path": f"{root}/sent"}, once=True).awaitTermination()
    return spark.read.text(f"{root}/sent")


# --- staging import ------------------------------------------------------------------------

def oldest_outbox_day(spark, sf):
    return staging.oldest_outbox_day(fx.fx_outbox(spark, sf))


def outbox_day_slice(spark, sf):
    return (staging.outbox_day_slice(fx.fx_outbox(spark, sf), TRANSACTION, DAY)
            .select("object_id", "object_type", "sent_dttm", "sent_date"))


def _with_empty_day(spark, df, path: str, partition_by: list[str], day_column: str) -> None:
    """``df`` stored, with a folder of a day before all others that holds a file but no row."""
    append_rows(df, path, partition_by)
    first = date(1999, 12, 31)
    folder = "/".join(f"{name}={first}" for name in partition_by)
    df.where("false").drop(*partition_by).coalesce(1).write.parquet(f"{path}/{folder}")


def stored_oldest_days(spark, sf):
    """The first days of stored tables, found by folder names."""
    tables = Tables(scratch_path(spark, "oldest"))
    staged = datamart.STAGING_FOLDERS
    _with_empty_day(spark, fx.fx_outbox(spark, sf), tables.outbox, ["sent_date"], "sent_date")
    _with_empty_day(spark, fx.tx_staging(spark, sf), tables.transactions, staged, "event_date")
    outbox = folders.oldest_day_row(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date")
    staging_day = folders.oldest_day_row(spark, tables.transactions, STAGED_TRANSACTIONS, staged, "event_date")
    return outbox.withColumn("table_name", F.lit("outbox")).unionByName(
        staging_day.withColumn("table_name", F.lit("transactions")))


def stored_day_slice(spark, sf):
    """The same slice from the stored outbox, of which only the day's folder is opened."""
    tables = Tables(scratch_path(spark, "slice"))
    append_rows(fx.fx_outbox(spark, sf), tables.outbox, ["sent_date"], ["object_type", "sent_dttm"])
    day = folders.read_days(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date", DAY, DAY)
    return staging.outbox_day_slice(day, TRANSACTION, DAY).select(
        "object_id", "object_type", "sent_dttm", "sent_date")


def extract_transactions(spark, sf):
    rows = staging.outbox_day_slice(fx.fx_outbox(spark, sf), TRANSACTION, None)
    return staging.extract_transactions(rows).drop("payload")


def extract_currencies(spark, sf):
    rows = staging.outbox_day_slice(fx.fx_outbox(spark, sf), CURRENCY, None)
    return staging.extract_currencies(rows).drop("payload")


def row_contract(spark, sf):
    extracted = staging.extract_transactions(fx.fx_odd_outbox(spark, sf))
    return staging.row_contract(extracted, TRANSACTIONS).drop("payload")


def both_present_gate(spark, sf):
    return staging.both_present_gate(staging.day_counts(fx.fx_outbox(spark, sf)))


def csv_interchange(spark, sf):
    path = scratch_path(spark, "csv")
    quoted = F.concat(F.lit(' "'), F.col("country"), F.lit('", '), F.col("status"))
    files.write_csv(fx.fx_tx(spark, sf).withColumn("country", quoted).select(*TRANSACTIONS.names),
                    path)
    return files.read_csv(spark, path, TRANSACTIONS)


def csv_interchange_currencies(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(fx.fx_rates(spark, sf), path)
    return files.read_csv(spark, path, CURRENCIES)


def _stage(spark, sf, root: str) -> Tables:
    tables = Tables(root)
    replace_scope(fx.tx_staging(spark, sf), tables.transactions, STAGED_TRANSACTIONS,
                  ["load_date", "event_date"], F.lit(True), ["transaction_dt"])
    replace_scope(fx.rates_staging(spark, sf), tables.currencies, STAGED_CURRENCIES,
                  ["load_date", "event_date"], F.lit(True), ["date_update"])
    return tables


def staging_load(spark, sf):
    """Whole seconds, and a second load of the same days that must not add rows."""
    path = scratch_path(spark, "staging")
    half = F.expr("INTERVAL 0.5 SECOND")
    rows = staging.staged_transactions(
        fx.tx_staging(spark, sf).withColumn("transaction_dt", F.col("transaction_dt") + half))
    first, last = _span(rows, "load_date")
    for _ in range(2):
        replace_scope(rows, path, STAGED_TRANSACTIONS, ["load_date", "event_date"],
                      on_days(F.col("load_date"), first, last), ["transaction_dt"])
    return read_table(spark, path, STAGED_TRANSACTIONS)


def key_violations(spark, sf):
    """One day's transactions arrive under a second load date."""
    rows = fx.tx_staging(spark, sf)
    again = rows.where(F.col("load_date") == F.lit(DAY))
    return keyed.key_violations(rows.unionByName(again), TRANSACTION_KEY)


def key_violations_currencies(spark, sf):
    rows = fx.rates_staging(spark, sf)
    again = rows.where(F.col("load_date") == F.lit(DAY))
    return keyed.key_violations(rows.unionByName(again), CURRENCY_KEY)


def load_faults(spark, sf):
    """One day loaded again under a later load date, with a rate from the base currency to itself."""
    tables = _stage(spark, sf, scratch_path(spark, "faults"))
    again = DAY + timedelta(days=400)
    this_day, folders_of = F.col("load_date") == F.lit(DAY), datamart.STAGING_FOLDERS
    later = lambda df: df.where(this_day).withColumn("load_date", F.lit(again))
    rates = later(fx.rates_staging(spark, sf))
    itself = rates.limit(1).withColumn("currency_code", F.lit(420)).withColumn("currency_code_with", F.lit(420))
    append_rows(later(fx.tx_staging(spark, sf)), tables.transactions, folders_of)
    append_rows(rates.unionByName(itself), tables.currencies, folders_of)
    return import_day.load_faults(spark, tables, again, again)


def staging_layout(spark, sf):
    """Rows per folder, those whose own day is another, and those before an earlier row of their file."""
    path = scratch_path(spark, "layout")
    append_rows(fx.tx_staging(spark, sf), path, ["load_date", "event_date"], ["transaction_dt"])
    in_file = Window.partitionBy("file").orderBy("at")
    return (
        read_table(spark, path, STAGED_TRANSACTIONS)
        .select("transaction_dt", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("at"))
        .withColumn("load_date", F.regexp_extract("file", "/load_date=([^/]+)/", 1).cast("date"))
        .withColumn("event_date", F.regexp_extract("file", "/event_date=([^/]+)/", 1).cast("date"))
        .withColumn("before", F.lag("transaction_dt").over(in_file))
        .groupBy("load_date", "event_date")
        .agg(F.count(F.lit(1)).alias("n_rows"),
             F.count_if(F.to_date("transaction_dt") != F.col("event_date")).alias("n_misplaced"),
             F.count_if(F.col("before") > F.col("transaction_dt")).alias("n_unordered")))


def _bookmarks(spark, sf):
    """A bookmark per event type: the last day it was seen."""
    return fx.events(spark, sf).groupBy(F.col("event_type").alias("workflow_key")).agg(
        F.max(F.to_date("ts")).alias("date_to_load"))


def bookmark_read(spark, sf):
    """One workflow with a bookmark, one without."""
    bookmarks, oldest = _bookmarks(spark, sf), staging.oldest_outbox_day(fx.fx_outbox(spark, sf))
    return (bookmark.bookmark_read(bookmarks, "click", oldest)
            .unionByName(bookmark.bookmark_read(bookmarks, "never_run", oldest)))


def bookmark_upsert(spark, sf):
    """Two workflows finish the first day: one is known, one is new."""
    first = fx.events(spark, sf).agg(F.min(F.to_date("ts")).alias("day"))
    done = first.withColumn("workflow_key", F.explode(F.array(F.lit("click"), F.lit("never_run"))))
    return bookmark.bookmark_upsert(_bookmarks(spark, sf), done)


def _imported(spark, sf) -> Tables:
    tables = Tables(scratch_path(spark, "import"))
    append_rows(fx.fx_outbox(spark, sf), tables.outbox, ["sent_date"],
                ["object_type", "sent_dttm"])
    import_day.import_days(spark, tables, *_span(fx.fx_outbox(spark, sf), "sent_date"))
    return tables


def _imported_daily(spark, sf) -> Tables:
    """The daily job run from an empty bookmark, once for each day of the outbox; some have no rates."""
    tables = Tables(scratch_path(spark, "import"))
    append_rows(fx.fx_outbox(spark, sf), tables.outbox, ["sent_date"],
                ["object_type", "sent_dttm"])
    first, last = _span(fx.fx_outbox(spark, sf), "sent_date")
    for _ in range((last - first).days + 1):
        import_day.import_day(spark, tables)
    return tables


def import_day_runs(spark, sf):
    return read_table(spark, _imported_daily(spark, sf).transactions, STAGED_TRANSACTIONS)


def import_day_bookmark(spark, sf):
    return read_table(spark, _imported_daily(spark, sf).bookmarks, BOOKMARKS)


def import_days(spark, sf):
    return read_table(spark, _imported(spark, sf).transactions, STAGED_TRANSACTIONS)


def import_days_currencies(spark, sf):
    return read_table(spark, _imported(spark, sf).currencies, STAGED_CURRENCIES)


def import_rejects(spark, sf):
    """Import of broken payloads: what is set aside."""
    tables = Tables(scratch_path(spark, "rejects"))
    rates = fx.fx_outbox(spark, sf).where(F.col("object_type") == CURRENCY)
    rows = fx.fx_odd_outbox(spark, sf).unionByName(rates)
    append_rows(rows, tables.outbox, ["sent_date"])
    import_day.import_days(spark, tables, *_span(rows, "sent_date"))
    return read_table(spark, tables.staging_rejects, STAGING_REJECTS).drop("payload")


# --- data mart -----------------------------------------------------------------------------

def oldest_staging_day(spark, sf):
    return ranking.oldest_staging_day(fx.tx_staging(spark, sf))


def drop_test_accounts(spark, sf):
    return ranking.drop_test_accounts(fx.tx_staging(spark, sf)).select(*TRANSACTIONS.names)


def _ranked(spark, sf, rule="negative"):
    return ranking.latest_status(ranking.drop_test_accounts(fx.tx_staging(spark, sf), rule))


def latest_status(spark, sf):
    return _ranked(spark, sf)


def latest_status_since(spark, sf):
    """The pruned form for payments that end on or after a day."""
    kept = ranking.drop_test_accounts(fx.tx_staging(spark, sf))
    return ranking.latest_status(kept, since=DAY)


def done_on_day(spark, sf):
    return ranking.done_on_day(_ranked(spark, sf))


def rates_on_day(spark, sf):
    return conversion.rates_on_day(fx.rates_staging(spark, sf), None, DAY)


def convert_to_base(spark, sf):
    return conversion.convert_to_base(done_on_day(spark, sf),
                                      conversion.rates_on_day(fx.rates_staging(spark, sf)))


def convert_to_base_salted(spark, sf):
    """The plan for rates too many to broadcast."""
    return conversion.convert_to_base(
        done_on_day(spark, sf), conversion.rates_on_day(fx.rates_staging(spark, sf)),
        broadcast_rows=0)


def base_currency_rows(spark, sf):
    return conversion.base_currency_rows(done_on_day(spark, sf))


def union_branches(spark, sf):
    return conversion.union_branches(convert_to_base(spark, sf), base_currency_rows(spark, sf))


def global_metrics(spark, sf):
    return metrics.global_metrics(fx.tx_staging(spark, sf), fx.rates_staging(spark, sf))


def global_metrics_minus_one(spark, sf):
    return metrics.global_metrics(fx.tx_staging(spark, sf), fx.rates_staging(spark, sf),
                                  rule="minus_one")


def global_metrics_by_rows(spark, sf):
    """The form that joins payment by payment."""
    return metrics.metrics_of_rows(union_branches(spark, sf))


def global_metrics_wide_rates(spark, sf):
    """Rates that need more digits, before or behind the point, than the exact type has."""
    wide = (F.when(F.col("currency_code") == 430, F.lit(4e-10))
            .when(F.col("currency_code") == 440, F.lit(2.5e8)).otherwise(F.col("currency_with_div")))
    rates = fx.rates_staging(spark, sf).withColumn("currency_with_div", wide)
    return metrics.global_metrics(fx.tx_staging(spark, sf), rates)


def merge_metrics(spark, sf):
    """A mart kept under another rule up to mid-month, merged with recomputed days around it."""
    tx, rates = fx.tx_staging(spark, sf), fx.rates_staging(spark, sf)
    mart = metrics.global_metrics(tx, rates, rule="minus_one").where(
        F.col("date_update") <= F.lit(DAY))
    return metrics.merge_metrics(mart, metrics.global_metrics(tx, rates, date(2024, 1, 8)))


def update_datamart_day(spark, sf):
    """Three runs of the daily job."""
    tables = _stage(spark, sf, scratch_path(spark, "mart"))
    for _ in range(3):
        datamart.update_datamart_day(spark, tables)
    return read_table(spark, tables.global_metrics, GLOBAL_METRICS)


def update_datamart_bookmark(spark, sf):
    """The bookmark after one run of the daily job."""
    tables = _stage(spark, sf, scratch_path(spark, "mart"))
    datamart.update_datamart_day(spark, tables)
    return read_table(spark, tables.bookmarks, BOOKMARKS)


def backfill_range(spark, sf):
    """All days in one pass, over staging that holds every load."""
    tables = _stage(spark, sf, scratch_path(spark, "mart"))
    datamart.backfill_range(spark, tables, *_span(fx.tx_staging(spark, sf), "event_date"))
    return read_table(spark, tables.global_metrics, GLOBAL_METRICS)


def backfill_stored_mart(spark, sf):
    """A stored mart of all days by another rule, merged with its recomputation: rows change and go."""
    tables = _stage(spark, sf, scratch_path(spark, "mart"))
    days = _span(fx.tx_staging(spark, sf), "event_date")
    datamart.backfill_range(spark, tables, *days, rule="minus_one")
    datamart.backfill_range(spark, tables, DAY, days[1], delete_missing=True)
    return read_table(spark, tables.global_metrics, GLOBAL_METRICS)


def refresh_after_load(spark, sf):
    """A mart of the first loads, refreshed after two further ones: only days that these change."""
    tables = Tables(scratch_path(spark, "refresh"))
    tx, rates = fx.tx_staging(spark, sf), fx.rates_staging(spark, sf)
    next_day = DAY + timedelta(days=1)
    for first, last in ((None, DAY - timedelta(days=1)), (DAY, next_day), (next_day + timedelta(days=1), None)):
        loads = on_days(F.col("load_date"), first, last)
        append_rows(tx.where(loads), tables.transactions, datamart.STAGING_FOLDERS, ["transaction_dt"])
        append_rows(rates.where(loads), tables.currencies, datamart.STAGING_FOLDERS)
        if first is None:
            datamart.backfill_range(spark, tables, *_span(tx.where(loads), "event_date"))
        else:
            datamart.refresh_after_load(spark, tables, first, last or _span(tx, "load_date")[1])
    return read_table(spark, tables.global_metrics, GLOBAL_METRICS)


def messages_to_mart(spark, sf):
    """The whole pipeline: stream, import, mart."""
    tables = _ingested(spark, sf)
    sent = _span(read_table(spark, tables.outbox, OUTBOX), "sent_date")
    import_day.import_days(spark, tables, *sent)
    staged = _span(read_table(spark, tables.transactions, STAGED_TRANSACTIONS), "event_date")
    datamart.backfill_range(spark, tables, *staged)
    return read_table(spark, tables.global_metrics, GLOBAL_METRICS)


QUERIES: dict[str, Query] = {
    query.__name__: query for query in (
        decode_envelope, require_fields, type_envelope, bounded_batches, message_rejects,
        insert_if_absent, ingest_batches, keyed_ingest, keyed_ingest_rejects, compact_outbox,
        compact_outbox_layout, kafka_sink_encode, kafka_sink_stream,
        stored_oldest_days, stored_day_slice,
        oldest_outbox_day, outbox_day_slice, extract_transactions, extract_currencies,
        row_contract, both_present_gate, csv_interchange, csv_interchange_currencies,
        staging_load, key_violations, key_violations_currencies, load_faults, staging_layout, bookmark_read,
        bookmark_upsert, import_days, import_day_bookmark, import_days_currencies, import_rejects,
        oldest_staging_day, drop_test_accounts, latest_status, latest_status_since, done_on_day,
        rates_on_day, convert_to_base, convert_to_base_salted, base_currency_rows, union_branches,
        global_metrics, global_metrics_minus_one, global_metrics_by_rows, global_metrics_wide_rates,
        merge_metrics, refresh_after_load,
        update_datamart_day, update_datamart_bookmark, backfill_range, backfill_stored_mart,
        messages_to_mart,
    )
}
QUERIES["import_day"] = import_day_runs
