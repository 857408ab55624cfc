"""The ingest stream over files: batches, restarts, repeats."""

import json
from datetime import date

import pytest

from tallymart.schemas import MESSAGE_REJECTS, MESSAGES, OUTBOX
from tallymart.sources.files import file_messages
from tallymart.sources.tables import Tables, read_table
from tallymart.streaming import ingest
from tallymart.streaming.ingest import ingest_available, start_ingest, store_batch


def message(number, note, day=1):
    return json.dumps({"object_id": f"{number:032x}", "object_type": "TRANSACTION",
                       "sent_dttm": f"2022-10-{day:02d}T00:00:00", "payload": {"note": note}})


FIRST = [(message(1, "first"), 0, 0), (message(2, "first"), 0, 1), (message(1, "again"), 0, 2),
         ("not json", 0, 3), ("not json", 1, 3)]
SECOND = [(message(2, "other day", day=2), 0, 4), (message(3, "first", day=2), 0, 5),
          (message(4, "late"), 1, 9), (message(4, "first"), 0, 8), ("{}", 0, 6)]
WANT = {(1, "first"), (2, "first"), (3, "first"), (4, "first")}
REJECTS = {(0, 3, "bad_json"), (1, 3, "bad_json"), (0, 6, "missing:object_id")}


def drop_in(spark, folder, rows):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(folder)


def stored(spark, tables):
    outbox = [(int(row.object_id.replace("-", ""), 16), json.loads(row.payload)["note"])
              for row in read_table(spark, tables.outbox, OUTBOX).collect()]
    rejects = [(row.partition, row.offset, row.reason)
               for row in read_table(spark, tables.message_rejects, MESSAGE_REJECTS).collect()]
    assert len(outbox) == len(set(outbox)) and len(rejects) == len(set(rejects))
    return set(outbox), set(rejects)


@pytest.fixture
def inbox(spark, tmp_path):
    """Two files; the second one is picked up in a later batch."""
    folder = str(tmp_path / "inbox")
    drop_in(spark, folder, FIRST)
    drop_in(spark, folder, SECOND)
    return folder


def run(spark, inbox, tables, checkpoint, files_per_batch=1):
    return ingest_available(spark, file_messages(spark, inbox, files_per_batch), tables, checkpoint)


def test_each_object_once(spark, inbox, tmp_path):
    tables, checkpoint = Tables(str(tmp_path / "t")), str(tmp_path / "c")
    run(spark, inbox, tables, checkpoint)
    assert stored(spark, tables) == (WANT, REJECTS)
    # the same checkpoint: nothing is waiting
    run(spark, inbox, tables, checkpoint)
    # a lost checkpoint: everything is read again, in one batch
    run(spark, inbox, tables, str(tmp_path / "c2"), files_per_batch=None)
    assert stored(spark, tables) == (WANT, REJECTS)


def test_batch_size_does_not_matter(spark, inbox, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    run(spark, inbox, tables, str(tmp_path / "c"), files_per_batch=None)
    assert stored(spark, tables) == (WANT, REJECTS)


def test_stop_and_resume(spark, tmp_path):
    tables, checkpoint = Tables(str(tmp_path / "t")), str(tmp_path / "c")
    folder = str(tmp_path / "inbox")
    drop_in(spark, folder, FIRST)
    run(spark, folder, tables, checkpoint)
    assert stored(spark, tables)[0] == {(1, "first"), (2, "first")}
    drop_in(spark, folder, SECOND)
    run(spark, folder, tables, checkpoint)
    assert stored(spark, tables) == (WANT, REJECTS)


def test_running_query_picks_up_new_files(spark, tmp_path):
    tables, folder = Tables(str(tmp_path / "t")), str(tmp_path / "inbox")
    drop_in(spark, folder, FIRST)
    query = start_ingest(file_messages(spark, folder, 1), tables, str(tmp_path / "c"),
                         interval="1 second")
    try:
        query.processAllAvailable()
        drop_in(spark, folder, SECOND)
        query.processAllAvailable()
    finally:
        query.stop()
    assert stored(spark, tables) == (WANT, REJECTS)


def test_same_position_in_two_topics(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = spark.createDataFrame([("not json", "a", 0, 5), ("not json", "b", 0, 5)],
                                 "value string, topic string, partition int, offset long")
    for _ in range(2):
        store_batch(rows, tables)
    rejects = read_table(spark, tables.message_rejects, MESSAGE_REJECTS).collect()
    assert sorted((row.topic, row.partition, row.offset) for row in rejects) == [("a", 0, 5), ("b", 0, 5)]


def test_batch_run_again_after_half_of_it_was_stored(spark, tmp_path):
    tables = Tables(str(tmp_path))
    store_batch(spark.createDataFrame(FIRST[:1], MESSAGES), tables)
    store_batch(spark.createDataFrame(FIRST, MESSAGES), tables)
    outbox, rejects = stored(spark, tables)
    assert outbox == {(1, "first"), (2, "first")} and len(rejects) == 2
    days = {row.sent_date for row in read_table(spark, tables.outbox, OUTBOX).collect()}
    assert days == {date(2022, 10, 1)}


def test_one_file_is_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    """A batch of one row group comes as one task; its messages are dealt out before they are parsed."""
    folder, sizes, plain = str(tmp_path / "inbox"), [], ingest.read_envelope
    drop_in(spark, folder, [(message(n, "x"), 0, n) for n in range(200)])

    def watched(messages):
        sizes.append([len(part) for part in messages.rdd.glom().collect()])
        return plain(messages)

    monkeypatch.setattr(ingest, "read_envelope", watched)
    tables = Tables(str(tmp_path / "t"))
    run(spark, folder, tables, str(tmp_path / "c"))
    assert len(stored(spark, tables)[0]) == 200
    assert [sum(s) for s in sizes] == [200] and max(sizes[0]) <= 50
