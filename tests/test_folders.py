"""Folders of days, swaps of files, compaction, refreshed days, and ingest by stored keys."""

import shutil
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.plans import datamart
from tallymart.plans.bookmarks import BookmarkMoved, move_past
from tallymart.plans.compaction import compact_outbox
from tallymart.plans.datamart import STAGING_FOLDERS, backfill_range, refresh_after_load
from tallymart.plans.import_day import import_days, load_faults
from tallymart.operators.keyed import keyed_upsert
from tallymart.operators.propagation import displaced_days
from tallymart.schemas import (
    GLOBAL_METRICS, OUTBOX, STAGED_CURRENCIES, STAGED_TRANSACTIONS,
)
from tallymart.sources import folders
from tallymart.sources.files import file_messages
from tallymart.sources.folders import (
    children, data_files, day_folders, oldest_day, read_days, repair, replace_files,
)
from tallymart.sources.tables import Tables, append_rows, read_table
from tallymart.streaming import keyed
from tests.test_mart import D1, D2, D3, at, rates, result, tx
from tests.test_streaming import FIRST, REJECTS, SECOND, WANT, drop_in, message, stored

DAYS = [date(2022, 10, n) for n in (1, 2, 3)]


def outbox_rows(spark, n=30, day=None):
    rows = spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("object_id"), F.lit("TRANSACTION").alias("object_type"),
        F.expr("timestamp_ntz '2022-10-01 00:00:00' + make_dt_interval(CAST(id % 3 AS INT), 0, 0, id)").alias("sent_dttm"),
        F.lit("{}").alias("payload"), F.lit("s").alias("load_src"))
    rows = rows.withColumn("sent_date", F.to_date("sent_dttm"))
    return rows if day is None else rows.where(F.col("sent_date") == F.lit(day))


@pytest.fixture
def tables(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    for _ in range(5):
        outbox_rows(spark).coalesce(1).write.mode("append").partitionBy("sent_date").parquet(tables.outbox)
    return tables


def opened(df):
    """The day folders of the files a plan reads."""
    return {part for file in df.inputFiles() for part in file.split("/") if "=" in part}


def test_only_folders_asked_for_are_opened(spark, tables):
    rows = read_days(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date", DAYS[1], DAYS[1])
    assert opened(rows) == {"sent_date=2022-10-02"} and rows.count() == 50
    assert rows.schema == OUTBOX and {r.sent_date for r in rows.collect()} == {DAYS[1]}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    assert read_days(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date", date(2030, 1, 1)).collect() == []
    assert read_days(spark, tables.root + "/none", OUTBOX, ["sent_date"], "sent_date").collect() == []


def test_import_reads_its_days_only(spark, tables, monkeypatch):
    seen = []
    plain = folders.read_folders
    monkeypatch.setattr(folders, "read_folders", lambda s, p, c, f: seen.extend(f) or plain(s, p, c, f))
    import_days(spark, tables, DAYS[2], DAYS[2])
    assert seen == [f"{tables.outbox}/sent_date=2022-10-03"]


def test_oldest_day_opens_one_day(spark, tables, monkeypatch):
    empty = f"{tables.outbox}/sent_date=2022-09-30"
    outbox_rows(spark, 0).drop("sent_date").coalesce(1).write.parquet(empty)
    (outbox_rows(spark, 3).withColumn("sent_date", F.lit(None).cast("date"))
     .write.mode("append").partitionBy("sent_date").parquet(tables.outbox))
    seen = []
    plain = folders.read_folders
    monkeypatch.setattr(folders, "read_folders", lambda s, p, c, f: seen.append(f) or plain(s, p, c, f))
    assert oldest_day(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date") == DAYS[0]
    assert seen == [[empty], [f"{tables.outbox}/sent_date=2022-10-01"]]
    assert oldest_day(spark, tables.root + "/none", OUTBOX, ["sent_date"], "sent_date") is None


def test_days_of_the_second_partition_column(spark, tmp_path):
    rows = tx(spark, [("a", 1, 430, "done", 1, at(D2)), ("b", 1, 430, "done", 1, at(D1))])
    append_rows(rows, str(tmp_path), STAGING_FOLDERS)
    found = day_folders(spark, str(tmp_path), STAGING_FOLDERS, "event_date")
    assert list(found) == [D1, D2]
    one = read_days(spark, str(tmp_path), STAGED_TRANSACTIONS, STAGING_FOLDERS, "event_date", D2)
    assert [r.operation_id for r in one.collect()] == ["a"]


def test_compaction(spark, tables):
    before = sorted(read_table(spark, tables.outbox, OUTBOX).collect())
    done = compact_outbox(spark, tables, DAYS[0], DAYS[1])
    assert [(c.day, c.files_before, c.files_after) for c in done] == [(DAYS[0], 5, 1), (DAYS[1], 5, 1)]
    assert sorted(read_table(spark, tables.outbox, OUTBOX).collect()) == before
    counts = {day: len(data_files(spark, f[0])) for day, f in
              day_folders(spark, tables.outbox, ["sent_date"], "sent_date").items()}
    assert counts == {DAYS[0]: 1, DAYS[1]: 1, DAYS[2]: 5}
    assert [c.day for c in compact_outbox(spark, tables)] == [DAYS[2]]
    assert compact_outbox(spark, tables) == []
    assert sorted(read_table(spark, tables.outbox, OUTBOX).collect()) == before
    # Targets smaller than the files leave them; a day larger than a target gets several.
    assert compact_outbox(spark, tables, target_bytes=10) == []
    assert children(spark, f"{tables.outbox}/{folders.SWAP}") == []


def test_compaction_gives_each_new_file_a_task(spark, tmp_path):
    """Dealt by hash of the day, several days would fall to one task and others would get none."""
    tables = Tables(str(tmp_path))
    rows = spark.range(400).selectExpr(
        "uuid() AS object_id", "'TRANSACTION' AS object_type", "timestamp_ntz'2022-10-01 00:00:00' AS sent_dttm",
        "'{}' AS payload", "'x' AS load_src", "date_add(date'2022-10-01', CAST(id % 20 AS int)) AS sent_date")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").partitionBy("sent_date").parquet(tables.outbox)
    assert len(compact_outbox(spark, tables, least_files=2)) == 20
    files = [path for found in day_folders(spark, tables.outbox, ["sent_date"], "sent_date").values()
             for folder in found for path, _ in data_files(spark, folder)]
    tasks = {path.rsplit("/", 1)[1].split("-")[1] for path in files}
    assert len(files) == len(tasks) == 20
    assert read_table(spark, tables.outbox, OUTBOX).count() == 800


def test_several_files_of_a_large_day(spark, tables):
    size = sum(n for _, n in data_files(spark, f"{tables.outbox}/sent_date=2022-10-01"))
    done = compact_outbox(spark, tables, DAYS[0], DAYS[0], target_bytes=size // 2)
    assert done[0].files_before == 5 and 2 <= len(data_files(spark, f"{tables.outbox}/sent_date=2022-10-01")) <= 3
    assert read_days(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date", DAYS[0], DAYS[0]).count() == 50


def test_files_added_meanwhile_stay(spark, tables, monkeypatch):
    plain = folders._carry_through

    def late(*args):
        outbox_rows(spark, day=DAYS[0]).coalesce(1).write.mode("append").partitionBy("sent_date").parquet(tables.outbox)
        plain(*args)

    monkeypatch.setattr(folders, "_carry_through", late)
    compact_outbox(spark, tables)
    assert read_table(spark, tables.outbox, OUTBOX).count() == 160


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_swap_that_broke_off_is_ended_by_the_next(spark, tables, monkeypatch, moves):
    """Dies before anything is moved, and after some files are."""
    before = sorted(read_table(spark, tables.outbox, OUTBOX).collect())
    old = [path for f in day_folders(spark, tables.outbox, ["sent_date"], "sent_date").values()
           for path, _ in data_files(spark, f[0])]
    plain = folders._file_system
    left = [moves]

    class Dying:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def rename(self, source, target):
            if source.getName().startswith("part-"):
                if not left[0]:
                    raise OSError("died")
                left[0] -= 1
            return self.files.rename(source, target)

    monkeypatch.setattr(folders, "_file_system", lambda s, p: (Dying(plain(s, p)[0]), plain(s, p)[1]))
    rows = read_table(spark, tables.outbox, OUTBOX).coalesce(1)
    with pytest.raises(OSError):
        replace_files(rows, tables.outbox, ["sent_date"], old)
    monkeypatch.undo()
    kept = read_table(spark, tables.outbox, OUTBOX).collect()
    assert not set(before) - set(kept)
    assert repair(spark, tables.outbox) == 1 and repair(spark, tables.outbox) == 0
    assert sorted(read_table(spark, tables.outbox, OUTBOX).collect()) == before
    assert not any(path.split("/")[-1] in {o.split("/")[-1] for o in old} for f in day_folders(
        spark, tables.outbox, ["sent_date"], "sent_date").values() for path, _ in data_files(spark, f[0]))


def test_what_has_no_note_is_thrown_away(spark, tables):
    outbox_rows(spark).write.partitionBy("sent_date").parquet(f"{tables.outbox}/{folders.SWAP}/x/rows")
    assert read_table(spark, tables.outbox, OUTBOX).count() == 150
    assert repair(spark, tables.outbox) == 0 and children(spark, f"{tables.outbox}/{folders.SWAP}") == []


def test_a_merge_that_died_loses_no_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    rows = [(D1, 420, 1), (D1, 430, 2), (D2, 420, 3)]
    mart = lambda some: spark.createDataFrame(some, "date_update date, currency_from int, n int").selectExpr(
        "date_update", "currency_from", "CAST(n AS DECIMAL(18, 2)) amount_total", "CAST(1 AS BIGINT) cnt_transactions",
        "CAST(1 AS DECIMAL(18, 2)) avg_transactions_per_account", "CAST(1 AS BIGINT) cnt_accounts_make_transactions")
    datamart.merge_into_mart(mart(rows), path, D1, D2)

    def die(*_):
        raise OSError("died")

    plain = folders._carry_through
    monkeypatch.setattr(folders, "_carry_through", die)
    with pytest.raises(OSError):
        datamart.merge_into_mart(mart([(D1, 420, 9)]), path, D1, D2)
    monkeypatch.setattr(folders, "_carry_through", plain)
    state = lambda: {(r.date_update, r.currency_from, int(r.amount_total))
                     for r in read_table(spark, path, GLOBAL_METRICS).collect()}
    assert state() == set(rows)
    # The next merge, of another day, ends the first one.
    assert datamart.merge_into_mart(mart([(D2, 420, 4)]), path, D2, D2) == [D2]
    assert state() == {(D1, 420, 9), (D1, 430, 2), (D2, 420, 4)}


ROWS = [("a", 1, 430, "done", 100, at(D1)), ("b", 1, 430, "done", 100, at(D1)), ("c", 2, 420, "done", 700, at(D2)),
        ("d", 3, 420, "queued", 700, at(D1)), ("e", 3, 420, "done", 5, at(D3))]
LATER = [("b", 1, 430, "chargeback", 100, at(D2)),  # takes b from D1
         ("d", 3, 420, "done", 700, at(D3)),        # adds d to D3
         ("c", 2, 420, "queued", 700, at(D1)),      # older than the winner: no change
         ("x", -1, 420, "done", 700, at(D2))]       # a test account


def staged_at(spark, tables, rows, load, new_rates=()):
    frame = tx(spark, rows).withColumn("load_date", F.lit(load))
    append_rows(frame, tables.transactions, STAGING_FOLDERS)
    if new_rates:
        append_rows(rates(spark, list(new_rates)).withColumn("load_date", F.lit(load)), tables.currencies, STAGING_FOLDERS)


def test_displaced_days(spark):
    rows = tx(spark, ROWS).withColumn("new", F.lit(False)).unionByName(tx(spark, LATER).withColumn("new", F.lit(True)))
    found = displaced_days(rows.where("account_number_from >= 0"), F.col("new"))
    assert {r.event_date for r in found.collect()} == {D1, D3}
    assert displaced_days(rows, F.lit(False)).collect() == []


def test_refresh_rewrites_the_days_that_change(spark, tmp_path):
    tables, other = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "o"))
    first = [(day, 430, 420, 2.0) for day in (D1, D2, D3)]
    staged_at(spark, tables, ROWS, D1, first)
    backfill_range(spark, tables, D1, D3)
    untouched = day_folders(spark, tables.global_metrics, ["date_update"], "date_update")[D2]
    files = data_files(spark, untouched[0])
    staged_at(spark, tables, LATER, D2)
    assert refresh_after_load(spark, tables, D2, D2) == [D1, D3]
    assert data_files(spark, untouched[0]) == files
    staged_at(spark, tables, [("f", 9, 430, "done", 50, at(D2))], D3, [(D1, 430, 420, 1.0)])
    assert refresh_after_load(spark, tables, D3, D3) == [D1, D2]  # a second rate on one, a payment on the other
    staged_at(spark, other, ROWS + LATER + [("f", 9, 430, "done", 50, at(D2))], D1, [*first, (D1, 430, 420, 1.0)])
    backfill_range(spark, other, D1, D3)
    assert result(read_table(spark, tables.global_metrics, GLOBAL_METRICS)) == result(
        read_table(spark, other.global_metrics, GLOBAL_METRICS))
    assert refresh_after_load(spark, tables, D3, D3) == []


def test_a_second_run_from_one_bookmark_is_refused(spark, tmp_path):
    tables = Tables(str(tmp_path))
    move_past(spark, tables, "w", D1)
    move_past(spark, tables, "w", D2)
    with pytest.raises(BookmarkMoved):
        move_past(spark, tables, "w", D2)


def test_upsert_refuses_a_key_given_twice(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(Exception, match="several rows"):
        keyed_upsert(target, spark.createDataFrame([("b", 2), ("b", 3)], "k string, v int"), ["k"]).collect()


# --- ingest by stored keys -----------------------------------------------------------------

def watch(monkeypatch):
    """How often the exact check against the outbox is taken."""
    calls = []
    plain = keyed.insert_if_absent
    monkeypatch.setattr(keyed, "insert_if_absent", lambda *a, **b: calls.append(1) or plain(*a, **b))
    return calls


def test_keys_are_looked_up_in_state_only(spark, tmp_path, monkeypatch):
    tables, checkpoint, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "c"), str(tmp_path / "inbox")
    calls, read = watch(monkeypatch), []
    plain = keyed.read_table
    drop_in(spark, inbox, FIRST)
    keyed.ingest_keyed_available(spark, file_messages(spark, inbox), tables, checkpoint)
    assert stored(spark, tables)[0] == {(1, "first"), (2, "first")}
    drop_in(spark, inbox, SECOND)
    drop_in(spark, inbox, FIRST)
    monkeypatch.setattr(keyed._Store, "_keys_agree", lambda self, s: True)
    monkeypatch.setattr(keyed, "read_table", lambda s, path, schema: read.append(path) or plain(s, path, schema))
    query = keyed.start_landing(file_messages(spark, inbox), tables, f"{checkpoint}/landing", once=True)
    query.awaitTermination()
    keyed.start_keyed_store(spark, tables, f"{checkpoint}/store", once=True).awaitTermination()
    assert calls == [] and read == []
    assert stored(spark, tables) == (WANT, REJECTS)


def test_landing_parses_one_file_by_many_tasks(spark, tmp_path):
    tables, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "inbox")
    drop_in(spark, inbox, [(message(n, "x"), 0, n) for n in range(200)])
    keyed.start_landing(file_messages(spark, inbox), tables, str(tmp_path / "c"), once=True).awaitTermination()
    landed = spark.read.parquet(tables.landing).groupBy("_metadata.file_name").count().collect()
    assert sum(row["count"] for row in landed) == 200 and max(row["count"] for row in landed) <= 100


def test_keyed_batch_is_joined_once_and_written_by_size(spark, tmp_path, monkeypatch):
    """New rows are found once for outbox and rejects, and a small day gets one file, not one from each task."""
    tables, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "inbox")
    drop_in(spark, inbox, [(message(n, "x"), 0, n) for n in range(200)] + [("not json", 0, 200)])
    kept, plain = [], keyed._Store._append
    monkeypatch.setattr(keyed._Store, "_append", lambda self, rows, exact: (
        kept.append(rows.storageLevel.useMemory), plain(self, rows, exact)))
    keyed.ingest_keyed_available(spark, file_messages(spark, inbox), tables, str(tmp_path / "c"))
    outbox, rejects = stored(spark, tables)
    assert len(outbox) == 200 and len(rejects) == 1 and kept == [True]
    assert len(data_files(spark, f"{tables.outbox}/sent_date=2022-10-01")) == 1


def shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {local.apply(i).getName() for i in range(local.size()) if local.apply(i).getName().startswith("shuffle_")}


def test_keyed_ingest_leaves_no_shuffle_files(spark, tmp_path):
    """With a second store that checks all keys against the outbox."""
    tables, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "inbox")
    drop_in(spark, inbox, [(message(n, "x"), 0, n) for n in range(200)] + [("not json", 0, 200)])
    before = shuffle_files(spark)
    keyed.ingest_keyed_available(spark, file_messages(spark, inbox), tables, str(tmp_path / "c"))
    keyed.start_keyed_store(spark, tables, str(tmp_path / "c2"), once=True).awaitTermination()
    for _ in range(50):  # they are deleted in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert left == set()
    assert len(stored(spark, tables)[0]) == 200


def test_new_rows_are_told_by_bits(spark, tmp_path):
    """Rows at both ends of bytes and bitmaps, in two files; nothing is shuffled to find them again."""
    n, folder = keyed.BITS + 20, str(tmp_path / "landing")
    (spark.range(2 * n, numPartitions=2).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in keyed.LANDED.fields[:-1] if f.name != "offset"],
        F.col("id").alias("offset"), F.lit(5).alias("landed"))
     .write.partitionBy("landed").parquet(folder))
    landed = spark.read.schema(keyed.LANDED).parquet(folder)
    wanted = {k + at for k in (0, n) for at in (0, 7, 8, 9, 32766, 32767, 32768, 32769, n - 1)}
    places = keyed._with_place(landed.where(F.col("offset").isin(*wanted))).select("landed", *keyed.PLACE)
    rows = keyed.marked_rows(landed, keyed.marks_of(places))
    assert sorted(row.offset for row in rows.collect()) == sorted(wanted)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_landed_twice_is_stored_once_in_several_lots(spark, tmp_path, monkeypatch):
    """The files a task has left that was run again; each file is a lot of its own."""
    tables, inbox, lots = Tables(str(tmp_path / "t")), str(tmp_path / "inbox"), []
    drop_in(spark, inbox, FIRST)
    keyed.start_landing(file_messages(spark, inbox), tables, str(tmp_path / "c/landing"), once=True).awaitTermination()
    for file in (tmp_path / "t/landing").glob("landed=*/part-*"):
        shutil.copy(file, file.with_name(f"part-9{file.name}"))
    plain = keyed.read_folders
    monkeypatch.setattr(keyed, "BYTES_PER_CORE", 1)
    monkeypatch.setattr(keyed, "read_folders", lambda s, p, c, f: lots.append(f) or plain(s, p, c, f))
    keyed.start_keyed_store(spark, tables, str(tmp_path / "c/store"), once=True).awaitTermination()
    assert stored(spark, tables) == ({(1, "first"), (2, "first")}, {(0, 3, "bad_json"), (1, 3, "bad_json")})
    assert len(lots) > 2 and all(len(lot) == 1 for lot in lots)


def test_lost_checkpoint_goes_by_the_outbox_until_state_knows_all(spark, tmp_path, monkeypatch):
    tables, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "inbox")
    drop_in(spark, inbox, FIRST)
    drop_in(spark, inbox, SECOND)
    keyed.ingest_keyed_available(spark, file_messages(spark, inbox, 1), tables, str(tmp_path / "c"))
    assert stored(spark, tables) == (WANT, REJECTS)
    calls = watch(monkeypatch)
    for _ in range(2):
        keyed.start_keyed_store(spark, tables, str(tmp_path / "c2"), once=True, files_per_batch=1).awaitTermination()
    assert calls and stored(spark, tables) == (WANT, REJECTS)
    calls.clear()
    drop_in(spark, inbox, [(SECOND[0][0], 0, 50), (SECOND[1][0].replace("0003", "0007"), 0, 51)])
    keyed.start_landing(file_messages(spark, inbox, 1), tables, str(tmp_path / "c/landing"), once=True).awaitTermination()
    keyed.start_keyed_store(spark, tables, str(tmp_path / "c2"), once=True).awaitTermination()
    assert calls == [] and stored(spark, tables) == (WANT | {(7, "first")}, REJECTS)


@pytest.mark.parametrize("place", ["after the outbox", "after the list"])
def test_a_batch_that_died_is_stored_once(spark, tmp_path, monkeypatch, place):
    tables, checkpoint, inbox = Tables(str(tmp_path / "t")), str(tmp_path / "c"), str(tmp_path / "inbox")
    drop_in(spark, inbox, FIRST)
    keyed.start_landing(file_messages(spark, inbox), tables, f"{checkpoint}/landing", once=True).awaitTermination()
    plain_append, plain_call = keyed.append_rows, keyed._Store.__call__

    def append(rows, path, *more):
        if path == tables.message_rejects and place == "after the outbox":
            raise OSError("died")
        plain_append(rows, path, *more)

    def call(self, fresh, batch_id):
        plain_call(self, fresh, batch_id)
        raise OSError("died")

    monkeypatch.setattr(keyed, "append_rows", append)
    if place == "after the list":
        monkeypatch.setattr(keyed._Store, "__call__", call)
    with pytest.raises(Exception, match="died"):
        keyed.start_keyed_store(spark, tables, f"{checkpoint}/store", once=True).awaitTermination()
    monkeypatch.undo()
    keyed.start_keyed_store(spark, tables, f"{checkpoint}/store", once=True).awaitTermination()
    assert stored(spark, tables) == ({(1, "first"), (2, "first")}, {(0, 3, "bad_json"), (1, 3, "bad_json")})


def test_import_warns_of_doubled_rates(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rate = '{"date_update": "2022-10-01 00:00:00", "currency_code": %d, "currency_code_with": 420, "currency_with_div": 2}'
    payment = ('{"operation_id": "%032x", "account_number_from": 1, "account_number_to": 2, "currency_code": 430, "country": "c",'
               ' "status": "done", "transaction_type": "t", "amount": 5, "transaction_dt": "2022-10-01 01:00:00"}')
    at_noon = "timestamp_ntz '2022-10-01 12:00:00'"
    rows = [("CURRENCY", rate % 430), ("CURRENCY", rate % 430), ("CURRENCY", rate % 420), ("CURRENCY", rate % 440),
            ("TRANSACTION", payment % 1), ("TRANSACTION", payment % 1), ("TRANSACTION", payment % 2)]
    outbox = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "object_id string, object_type string, payload string")
    outbox = outbox.withColumns({"sent_dttm": F.expr(at_noon), "load_src": F.lit("s"), "sent_date": F.expr(f"DATE({at_noon})")})
    append_rows(outbox.select(*OUTBOX.names), tables.outbox, ["sent_date"])
    assert import_days(spark, tables, DAYS[0], DAYS[0]).rate_faults == 2
    found = {(r.object_type, r.fault, r.n_rows) for r in load_faults(spark, tables, DAYS[0], DAYS[0]).collect()}
    assert found == {("CURRENCY", "repeated_key", 2), ("CURRENCY", "base_to_base", 1), ("TRANSACTION", "repeated_key", 2)}
    assert load_faults(spark, tables, DAYS[1], DAYS[1]).collect() == []
