"""Message envelope, one hand-made case per rule."""

import json
import uuid
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.functions.text import canonical_uuid, json_texts, number_text
from tallymart.functions.time import parse_sent_dttm
from tallymart.operators.envelope import accepted, decode_envelope, read_envelope, rejected

ID = "3f2504e0-4f89-11d3-9a0c-0305e82c3301"
GOOD = {"object_id": ID, "object_type": "TRANSACTION", "sent_dttm": "2022-10-01T12:30:00",
        "payload": {"a": 1}}


def changed(**fields):
    return json.dumps({**GOOD, **fields})


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


CASES = [
    (json.dumps(GOOD), None),
    (json.dumps(GOOD, indent=2) + "\n", None),
    (changed(extra=[1, 2]), None),
    (changed(payload={}), None),
    (without("object_id"), "missing:object_id"),
    (without("object_type"), "missing:object_type"),
    (without("sent_dttm"), "missing:sent_dttm"),
    (without("payload"), "missing:payload"),
    ("{}", "missing:object_id"),
    ("[]", "missing:object_id"),
    ("[" + json.dumps(GOOD) + "]", "missing:object_id"),
    ("not json", "bad_json"),
    ("", "bad_json"),
    (None, "bad_json"),
    (json.dumps(GOOD)[:-1], "bad_json"),
    (json.dumps(GOOD) + " tail", "bad_json"),
    (json.dumps(GOOD) + json.dumps(GOOD), "bad_json"),
    (json.dumps(GOOD) + "," + json.dumps(GOOD), "bad_json"),
    (json.dumps(GOOD) + "]", "bad_json"),
    (json.dumps(GOOD).replace('"', "'"), "bad_json"),
    # a null is present, and fails on its type
    (changed(object_id=None), "bad_uuid"),
    (changed(sent_dttm=None), "bad_timestamp"),
    (changed(payload=None), "bad_payload"),
    (changed(object_type=None), "bad_object_type"),
    (changed(object_type=5), "bad_object_type"),
    (changed(object_id="zz"), "bad_uuid"),
    (changed(object_id=int("1" * 32)), "bad_uuid"),
    (changed(sent_dttm="01.10.2022"), "bad_timestamp"),
    (changed(sent_dttm="2022-10-01T12:30:00.5"), "bad_timestamp"),
    (changed(sent_dttm="2022-10-01T12:30:00Z"), "bad_timestamp"),
    (changed(sent_dttm="2022-10-01 12:30:00"), "bad_timestamp"),
    (changed(sent_dttm="2022-02-30T12:30:00"), "bad_timestamp"),
    (changed(sent_dttm="2022-1-2T3:4:5"), None),
    (changed(payload="x"), "bad_payload"),
    (changed(payload='{"a": 1}'), "bad_payload"),
    (changed(payload="{x"), "bad_payload"),
    (changed(payload=[{"a": 1}]), "bad_payload"),
    (changed(payload=7), "bad_payload"),
]


def messages(spark, values):
    rows = [(value, 0, offset) for offset, value in enumerate(values)]
    return spark.createDataFrame(rows, "value string, partition int, offset long")


def test_reasons(spark):
    rows = read_envelope(messages(spark, [value for value, _ in CASES])).orderBy("offset").collect()
    assert [(CASES[row.offset][0], row.reason) for row in rows] == CASES


def test_accepted_and_rejected_are_the_input(spark):
    typed = read_envelope(messages(spark, [value for value, _ in CASES]))
    good = {row.offset for row in accepted(typed).collect()}
    bad = {row.offset for row in rejected(typed).collect()}
    assert good | bad == set(range(len(CASES))) and not good & bad


def test_typed_row(spark):
    row = accepted(read_envelope(messages(spark, [CASES[0][0]]))).first()
    assert row.object_id == ID
    assert row.sent_dttm == datetime(2022, 10, 1, 12, 30)
    assert json.loads(row.payload) == {"a": 1}
    assert row.load_src == "kafka-transaction-service-input"
    assert str(row.sent_date) == "2022-10-01"


def test_payload_keeps_its_text(spark):
    text = '{"z": 1, "a": "5", "n": {"d": 1.0, "e": 100000000000000000000}}'
    value = json.dumps(GOOD).replace('{"a": 1}', text)
    row = accepted(read_envelope(messages(spark, [value]))).first()
    assert json.loads(row.payload) == json.loads(text)
    assert list(json.loads(row.payload)) == ["z", "a", "n"]


def test_bytes_and_broken_utf8(spark):
    rows = [(bytearray(json.dumps(GOOD).encode()), 0, 0),
            (bytearray(json.dumps(GOOD).encode().replace(b"TRANS", b"TR\xffNS")), 0, 1)]
    df = spark.createDataFrame(rows, "value binary, partition int, offset long")
    reasons = [row.reason for row in read_envelope(df).orderBy("offset").collect()]
    assert reasons == [None, "bad_json"]


def test_local_times_without_a_clock_reading(spark):
    """02:30 does not exist on this day in Berlin, but is a valid zone-less time."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = accepted(read_envelope(
            messages(spark, [changed(sent_dttm="2022-03-27T02:30:00")]))).first()
        assert row.sent_dttm == datetime(2022, 3, 27, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", [
    ID, ID.upper(), ID.replace("-", ""), "{" + ID + "}", "urn:uuid:" + ID,
    "3f25-04e04f8911d39a0c0305e82c3301-", "uuid:" + ID.replace("-", ""),
])
def test_uuid_forms(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(canonical_uuid(F.col("t"))).first()[0] == str(uuid.UUID(text)) == ID


@pytest.mark.parametrize("text", ["", "zz", ID[:-1], ID + "0", "g" + ID[1:], ID + "\n", " " + ID])
def test_no_uuid(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(canonical_uuid(F.col("t"))).first()[0] is None


def python_time(text):
    try:
        return datetime.strptime(text, "%Y-%m-%dT%H:%M:%S")
    except ValueError:
        return None


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32),
                          st.integers(0, 25), st.integers(0, 60), st.integers(0, 60),
                          st.booleans()), min_size=200, max_size=200))
def test_times_as_python_reads_them(spark, parts):
    texts = []
    for y, mo, d, h, mi, s, padded in parts:
        two = "02d" if padded else "d"
        texts.append(f"{y:04d}-{mo:{two}}-{d:{two}}T{h:{two}}:{mi:{two}}:{s:{two}}")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse_sent_dttm(F.col("t")).cast("string").alias("ts")).collect()
    for row in got:
        want = python_time(row.t)
        assert (row.ts is None) == (want is None), row
        if want:
            assert row.ts == want.isoformat(" "), row


def test_json_texts(spark):
    df = spark.createDataFrame([('{"a": 5, "b": "5", "c": null, "e": {"x": [1]}}',)], "j string")
    row = df.select(json_texts(F.col("j"), "abcde").alias("f")).select("f.*").first()
    assert tuple(row) == ("5", "5", None, None, '{"x": [1]}') or row.e.replace(" ", "") == '{"x":[1]}'


def test_number_text(spark):
    texts = ["1", "-1.5", "+.5", "2.", "1e3", " 7 ", "NaN", "inf", "1d", "1f", "0x1", "", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = [row.t for row in df.where(number_text(F.col("t")).isNotNull()).collect()]
    assert kept == ["1", "-1.5", "+.5", "2.", "1e3", " 7 "]


def test_one_parse_per_message(spark):
    plan = accepted(read_envelope(messages(spark, ["x"])))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("from_json(") == 3


def test_decode_keeps_every_row(spark):
    values = [value for value, _ in CASES]
    assert decode_envelope(messages(spark, values)).count() == len(values)


def test_same_key_twice(spark):
    """The last one counts, whatever the first was."""
    head = json.dumps(GOOD)[:-1]
    values = [head + ', "object_type": "CURRENCY"}', head + ', "x": 1, "x": {"y": 1, "y": 2}}',
              json.dumps(GOOD).replace('{"a": 1}', '{"a": 1, "a": 2}'),
              head + ', "payload": 5}', '{"payload": 5, ' + json.dumps(GOOD)[1:],
              head + ', "object_id": null}']
    rows = read_envelope(messages(spark, values)).orderBy("offset").collect()
    assert [row.reason for row in rows] == [None, None, None, "bad_payload", None, "bad_uuid"]
    assert rows[0].object_type == "CURRENCY" and json.loads(rows[2].payload) == {"a": 2}
