"""First per key, insert if absent, upsert, key check, bookmarks."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymart.operators.bookmark import bookmark_read, bookmark_upsert
from tallymart.operators.keyed import (
    first_per_key, fits_broadcast, insert_if_absent, key_violations, keyed_upsert,
)
from tallymart.operators.staging import oldest_outbox_day
from tallymart.plans.bookmarks import day_to_load, move_past
from tallymart.schemas import BOOKMARKS, OUTBOX
from tallymart.sources.tables import Tables, read_table

ARRIVALS = "object_id string, body string, partition int, offset long"


def as_set(df):
    return {tuple(row) for row in df.collect()}


def test_first_per_key_takes_the_lowest_position(spark):
    rows = [("a", "late", 0, 9), ("a", "first", 0, 2), ("a", "other partition", 1, 1),
            ("b", "only", 3, 0)]
    got = first_per_key(spark.createDataFrame(rows, ARRIVALS), ["object_id"], ["partition", "offset"])
    assert as_set(got.select("object_id", "body")) == {("a", "first"), ("b", "only")}


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_insert_if_absent_against_brute_force(spark, broadcast_rows):
    """A third of all rows share one key."""
    random.seed(7)
    rows = [("hot" if random.random() < 0.33 else f"k{random.randrange(80)}", f"body{i}",
             random.randrange(3), i) for i in range(900)]
    stored = [(f"k{i}",) for i in range(0, 120, 3)]
    want = {}
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        if (row[0],) not in stored:
            want.setdefault(row[0], row)
    got = insert_if_absent(spark.createDataFrame(rows, ARRIVALS).repartition(5),
                           spark.createDataFrame(stored, "object_id string"),
                           broadcast_rows=broadcast_rows)
    assert as_set(got) == set(want.values())


def test_insert_if_absent_prunes_before_the_shuffle(spark):
    """One row per key and task is shuffled, and the stored side is not."""
    batch = spark.createDataFrame([("a", "x", 0, 1)], ARRIVALS)
    stored = spark.createDataFrame([("b",)], "object_id string")
    plan = insert_if_absent(batch, stored)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "row_number(), 1, Partial" in physical
    assert "BroadcastHashJoin" in physical and "LeftSemi" in physical


def test_fits_broadcast(spark):
    assert fits_broadcast(spark.range(10), 10)
    assert not fits_broadcast(spark.range(11), 10)


def test_keyed_upsert(spark):
    schema = "k string, v int"
    target = spark.createDataFrame([("a", 1), ("b", 2)], schema)
    source = spark.createDataFrame([("b", 3), ("c", 4)], schema)
    merged = keyed_upsert(target, source, ["k"])
    assert as_set(merged) == {("a", 1), ("b", 3), ("c", 4)}
    assert as_set(keyed_upsert(merged, source, ["k"])) == as_set(merged)


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert as_set(key_violations(df, ["k", "v"])) == {("a", 1, 2)}


def test_bookmark_read_and_upsert(spark):
    stored = spark.createDataFrame([("w", date(2022, 10, 5))], BOOKMARKS)
    oldest = spark.createDataFrame([(date(2022, 10, 1),)], "oldest_day date")
    assert as_set(bookmark_read(stored, "w", oldest)) == {("w", date(2022, 10, 5))}
    assert as_set(bookmark_read(stored, "new", oldest)) == {("new", date(2022, 10, 1))}
    none = oldest.where("false").agg(F.min("oldest_day").alias("oldest_day"))
    assert as_set(bookmark_read(stored, "new", none)) == {("new", None)}
    done = spark.createDataFrame([("w", date(2022, 12, 31)), ("new", date(2022, 10, 1))],
                                 "workflow_key string, day date")
    assert as_set(bookmark_upsert(stored, done)) == {
        ("w", date(2023, 1, 1)), ("new", date(2022, 10, 2))}


def test_stored_bookmarks(spark, tmp_path):
    tables = Tables(str(tmp_path))
    empty = spark.createDataFrame([], OUTBOX)
    assert day_to_load(spark, tables, "w", lambda: oldest_outbox_day(empty)) is None
    move_past(spark, tables, "w", date(2022, 10, 31))
    move_past(spark, tables, "other", date(2022, 10, 1))
    move_past(spark, tables, "w", date(2022, 11, 1))
    assert day_to_load(spark, tables, "w", None) == date(2022, 11, 2)
    assert as_set(read_table(spark, tables.bookmarks, BOOKMARKS).select(*BOOKMARKS.names)) == {
        ("w", date(2022, 11, 2)), ("other", date(2022, 10, 2))}
