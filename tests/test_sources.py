"""Kafka options and encoding, JDBC predicates, CSV, table writes."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.schemas import CURRENCIES, OUTBOX, TRANSACTIONS
from tallymart.sources.files import read_csv, write_csv
from tallymart.sources.jdbc import day_predicates
from tallymart.sources.kafka import KafkaAccess, kafka_messages, kafka_sink_encode
from tallymart.sources.tables import append_rows, checkpoint_root, read_table, replace_scope

ACCESS = KafkaAccess("broker", 9091, "me", 'pa"ss\\', "payments", "/certs/ca.pem", "loader")


def test_kafka_source_options():
    options = ACCESS.source_options(max_offsets=40)
    assert options["kafka.bootstrap.servers"] == "broker:9091"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert options["kafka.ssl.truststore.location"] == "/certs/ca.pem"
    assert options["startingOffsets"] == "earliest"
    assert options["subscribe"] == "payments"
    assert options["kafka.group.id"] == "loader"
    assert options["maxOffsetsPerTrigger"] == "40"
    assert options["kafka.sasl.jaas.config"].endswith(
        'username="me" password="pa\\"ss\\\\";')
    assert "subscribe" not in ACCESS.sink_options() and ACCESS.sink_options()["topic"] == "payments"
    assert ACCESS.password not in repr(ACCESS) and "pass" not in repr(ACCESS)


def test_kafka_needs_the_connector(spark):
    with pytest.raises(Exception, match="[Kk]afka"):
        kafka_messages(spark, ACCESS)


def test_kafka_sink_encode(spark):
    df = spark.createDataFrame([(1, None, "é\"")], "a int, b string, c string")
    encoded = kafka_sink_encode(df)
    assert encoded.columns == ["value"]
    assert json.loads(encoded.first().value) == {"a": 1, "b": None, "c": "é\""}


def test_day_predicates_cover_the_day_once():
    spans = day_predicates(date(2022, 10, 1), 3)
    assert spans[0].startswith("sent_dttm >= TIMESTAMP '2022-10-01 00:00:00'")
    assert spans[-1].endswith("sent_dttm < TIMESTAMP '2022-10-02 00:00:00'")
    ends = [span.split("'")[3] for span in spans]
    starts = [span.split("'")[1] for span in spans]
    assert ends[:-1] == starts[1:]


def test_csv_round_trip(spark, tmp_path):
    texts = ["plain", "a, b", 'say "x"', '"', "", " padded ", "two\nlines", "cr\r\nlf", "back\\slash",
             "ends with \\", None]
    rows = [(f"op{i}", -i, 2, 430, text, "done", "t", 10**12, datetime(2022, 10, 1, 1, 2, 3))
            for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, TRANSACTIONS)
    path = str(tmp_path / "tx")
    write_csv(df, path, rows_per_file=4)
    assert {tuple(r) for r in read_csv(spark, path, TRANSACTIONS).collect()} == set(rows)


def test_csv_text(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2022, 10, 1), 430, None, 0.5)], CURRENCIES)
    write_csv(df, str(tmp_path / "c"))
    lines = [row.value for row in spark.read.text(str(tmp_path / "c")).collect()]
    assert lines == ["2022-10-01 00:00:00,430,NULL,0.5"]


def test_csv_value_of_a_wrong_type(spark, tmp_path):
    (tmp_path / "c.csv").write_text("2022-10-01 00:00:00,430,x,0.5\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        read_csv(spark, str(tmp_path / "c.csv"), CURRENCIES).collect()


def test_missing_table_is_empty(spark, tmp_path):
    df = read_table(spark, str(tmp_path / "none"), OUTBOX)
    assert df.count() == 0 and df.schema == OUTBOX


def test_replace_scope_touches_nothing_else(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).select(F.lit("x").alias("v"), F.lit(1).alias("k")).schema
    frame = lambda rows: spark.createDataFrame(rows, "v string, k int")
    content = lambda: {
        tuple(r) for r in read_table(spark, path, schema).select("v", "k").collect()}
    append_rows(frame([("a", 1), ("b", 2), ("c", 3)]), path, ["k"])
    assert replace_scope(frame([("A", 1)]), path, schema, ["k"], F.col("k") <= 2) == 1
    assert content() == {("A", 1), ("c", 3)}
    stored = read_table(spark, path, schema)
    assert replace_scope(stored.where("k = 3").unionByName(frame([("d", 3)])), path, schema, ["k"],
                         F.col("k") == 3) == 2
    assert content() == {("A", 1), ("c", 3), ("d", 3)}
    assert replace_scope(frame([]), path, schema, ["k"], F.lit(True)) == 0
    assert content() == set()


def test_a_hot_partition_is_split_over_files(spark, tmp_path):
    """One day holds most rows; the size limit of a write task is lowered to see the split."""
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        append_rows(rows.repartition(8), str(tmp_path / "t"), ["k"], ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.rglob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


def test_checkpoint_root_is_the_sessions(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_large_csv_is_read_by_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/large"
    spark.range(300_000).selectExpr("id", "repeat('x', 20) AS filler").coalesce(1).write.csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("filler", T.StringType())])
        split = read_csv(spark, path, schema, line_breaks=False)
        assert split.rdd.getNumPartitions() > 3
        assert split.agg({"id": "sum"}).head()[0] == sum(range(300_000))
        assert read_csv(spark, path, schema).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
