"""Outbox to staging: casts, contract, gate, reruns."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallymart.functions.time import cut_to_second
from tallymart.operators.staging import (
    both_present_gate, day_counts, extract_currencies, extract_transactions, invalid_rows,
    oldest_outbox_day, row_contract, staged_transactions, valid_rows,
)
from tallymart.plans.import_day import import_day, import_days
from tallymart.schemas import (
    CURRENCIES, CURRENCY, OUTBOX, STAGED_CURRENCIES, STAGED_TRANSACTIONS, STAGING_REJECTS,
    TRANSACTION, TRANSACTIONS,
)
from tallymart.sources.tables import Tables, append_rows, read_table, replace_scope

OP = "3f2504e0-4f89-11d3-9a0c-0305e82c3301"
TX = {"operation_id": OP, "account_number_from": 1, "account_number_to": 2, "currency_code": 430,
      "country": "country_1", "status": "done", "transaction_type": "transfer",
      "amount": 125, "transaction_dt": "2022-10-01 12:00:00"}
RATE = {"date_update": "2022-10-01 00:00:00", "currency_code": 430, "currency_code_with": 420,
        "currency_with_div": 1.07}


def outbox(spark, rows):
    """rows: (object_type, sent day, payload)"""
    data = [(f"id{i}", kind, datetime.combine(day, datetime.min.time()), json.dumps(payload), "test",
             day) for i, (kind, day, payload) in enumerate(rows)]
    return spark.createDataFrame(data, OUTBOX)


D1, D2, D3 = date(2022, 10, 1), date(2022, 10, 2), date(2022, 10, 3)


def contract(spark, **changes):
    payload = {k: v for k, v in {**TX, **changes}.items() if v != "absent"}
    rows = extract_transactions(outbox(spark, [(TRANSACTION, D1, payload)]))
    return row_contract(rows, TRANSACTIONS).first()


def test_typed_transaction(spark):
    row = contract(spark)
    assert row.reason is None
    assert row.transaction_dt == datetime(2022, 10, 1, 12)
    assert row.amount == 125 and row.load_date == D1


@pytest.mark.parametrize("changes", [
    {"amount": "125"}, {"currency_code": "430"}, {"operation_id": OP.upper()},
    {"operation_id": "{" + OP + "}"}, {"account_number_from": 10_000_000_000},
    {"country": ""}, {"country": 'a "b", c'}, {"status": 5},
])
def test_accepted_values(spark, changes):
    row = contract(spark, **changes)
    assert row.reason is None and row.operation_id == OP


@pytest.mark.parametrize("name,value", [
    ("amount", 1.5), ("amount", "1.5"), ("amount", None), ("amount", "absent"),
    ("amount", [1]), ("currency_code", 99_999_999_999), ("country", None), ("country", "absent"),
    ("operation_id", "op"), ("transaction_dt", "yesterday"), ("status", None),
])
def test_refused_values(spark, name, value):
    assert contract(spark, **{name: value}).reason == f"bad:{name}"


@pytest.mark.parametrize("rate,good", [
    (1.07, True), ("1.07", True), (1, True), (0.000001234, True), ("NaN", False), ("1d", False),
    (1e30, False), (None, False), (4e-10, True), (2.5e8, True), (1e-19, False), (0, True),
])
def test_rates(spark, rate, good):
    rows = extract_currencies(outbox(spark, [(CURRENCY, D1, {**RATE, "currency_with_div": rate})]))
    row = row_contract(rows, CURRENCIES).first()
    assert row.reason == (None if good else "bad:currency_with_div")


def test_strict_contract_fails_the_query(spark):
    rows = extract_transactions(outbox(spark, [(TRANSACTION, D1, TX),
                                               (TRANSACTION, D1, {**TX, "amount": "x"})]))
    with pytest.raises(Exception, match="id1: bad:amount"):
        valid_rows(row_contract(rows, TRANSACTIONS, strict=True)).collect()


def test_valid_and_invalid_are_the_input(spark):
    rows = extract_transactions(outbox(spark, [
        (TRANSACTION, D1, {**TX, "amount": amount}) for amount in (1, "x", 2, None)]))
    contracted = row_contract(rows, TRANSACTIONS)
    assert valid_rows(contracted).count() == 2
    assert {row.object_id for row in invalid_rows(contracted).collect()} == {"id1", "id3"}


def test_time_is_cut_not_rounded(spark):
    rows = extract_transactions(outbox(spark, [
        (TRANSACTION, D1, {**TX, "transaction_dt": "2022-10-01 23:59:59.999"})]))
    row = staged_transactions(valid_rows(row_contract(rows, TRANSACTIONS))).first()
    assert row.transaction_dt == datetime(2022, 10, 1, 23, 59, 59) and row.event_date == D1


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_cut_does_not_depend_on_the_session_zone(spark, zone):
    """02:30 does not exist on this day in Berlin."""
    df = spark.createDataFrame([(datetime(2022, 3, 27, 2, 30, 1, 999999),), (None,),
                                (datetime(1969, 12, 31, 23, 59, 59, 1),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [row[0] for row in df.select(cut_to_second(F.col("ts")).alias("ts")).collect()]
        kind = df.select(cut_to_second(F.col("ts")).alias("ts")).dtypes
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2022, 3, 27, 2, 30, 1), None, datetime(1969, 12, 31, 23, 59, 59)]
    assert kind == [("ts", "timestamp_ntz")]


def test_oldest_day(spark):
    rows = outbox(spark, [(TRANSACTION, D2, TX), (CURRENCY, D1, RATE)])
    assert oldest_outbox_day(rows).first()[0] == D1
    assert oldest_outbox_day(rows.where("false")).first()[0] is None


def test_gate(spark):
    rows = outbox(spark, [(TRANSACTION, D1, TX), (CURRENCY, D1, RATE), (TRANSACTION, D2, TX),
                          (CURRENCY, D3, RATE), ("OTHER", D3, {})])
    gated = both_present_gate(day_counts(rows)).orderBy("sent_date").collect()
    assert [tuple(row) for row in gated] == [
        (D1, 1, 1, True), (D2, 1, 0, False), (D3, 0, 1, False)]


def test_payload_is_parsed_once(spark):
    rows = extract_transactions(outbox(spark, [(TRANSACTION, D1, TX)]))
    plan = valid_rows(row_contract(rows, TRANSACTIONS))._jdf.queryExecution().toString()
    assert plan[plan.index("== Physical Plan =="):].count("from_json(") == 1


@pytest.fixture
def tables(spark, tmp_path):
    """D1 complete with one bad row; D2 without rates; D3 complete and about D1, too."""
    tables = Tables(str(tmp_path))
    append_rows(outbox(spark, [
        (TRANSACTION, D1, TX), (TRANSACTION, D1, {**TX, "amount": "x"}), (CURRENCY, D1, RATE),
        (TRANSACTION, D2, TX),
        (TRANSACTION, D3, {**TX, "status": "chargeback"}),
        (TRANSACTION, D3, {**TX, "transaction_dt": "2022-10-03 01:00:00"}),
        (CURRENCY, D3, {**RATE, "date_update": "2022-10-03 00:00:00"}),
    ]), tables.outbox, ["sent_date"])
    return tables


def staged(spark, tables):
    rows = read_table(spark, tables.transactions, STAGED_TRANSACTIONS)
    return sorted((row.load_date, row.event_date, row.status) for row in rows.collect())


ALL_STAGED = [(D1, D1, "done"), (D3, D1, "chargeback"), (D3, D3, "done")]


def test_import_days_and_rerun(spark, tables):
    for _ in range(2):
        result = import_days(spark, tables, D1, D3)
        assert (result.loaded, result.skipped, result.rejects) == ([D1, D3], [D2], 1)
        assert staged(spark, tables) == ALL_STAGED
        rejects = read_table(spark, tables.staging_rejects, STAGING_REJECTS).collect()
        assert [(row.object_id, row.reason, row.load_date) for row in rejects] == [
            ("id1", "bad:amount", D1)]
    assert read_table(spark, tables.currencies, STAGED_CURRENCIES).count() == 2


def test_rerun_of_one_load_leaves_the_other(spark, tables):
    """D1's event day is filled by two loads; loading D1 again keeps what D3's load brought."""
    import_days(spark, tables, D1, D3)
    import_days(spark, tables, D1, D1)
    assert staged(spark, tables) == ALL_STAGED


def test_rerun_clears_what_is_gone(spark, tables):
    """The outbox of D3 is rewritten without the row about D1, then without rates."""
    import_days(spark, tables, D1, D3)
    outbox(spark, [(TRANSACTION, D3, {**TX, "transaction_dt": "2022-10-03 01:00:00"}),
                   (CURRENCY, D3, RATE)]).drop("sent_date").write.mode("overwrite").parquet(
        f"{tables.outbox}/sent_date={D3}")
    import_days(spark, tables, D3, D3)
    assert staged(spark, tables) == [(D1, D1, "done"), (D3, D3, "done")]
    outbox(spark, [(TRANSACTION, D3, TX)]).drop("sent_date").write.mode("overwrite").parquet(
        f"{tables.outbox}/sent_date={D3}")
    import_days(spark, tables, D3, D3)
    assert staged(spark, tables) == [(D1, D1, "done"), (D3, D3, "done")]
    result = import_days(spark, tables, D3, D3, clear_skipped=True)
    assert result.loaded == [] and result.skipped == [D3]
    assert staged(spark, tables) == [(D1, D1, "done")]
    assert read_table(spark, tables.currencies, STAGED_CURRENCIES).count() == 1


def test_jobs_do_not_grow_with_cleared_partitions(spark, tmp_path):
    """Partitions that get no row are deleted without a job or a file for each."""
    jobs = []
    for n in (2, 20):
        path = str(tmp_path / str(n))
        rows = spark.range(n).select(F.expr("CAST(id AS STRING)").alias("v"),
                                     F.date_add(F.lit(D1), F.col("id").cast("int")).alias("load_date"))
        schema = rows.schema
        replace_scope(rows, path, schema, ["load_date"], F.lit(True))
        spark.sparkContext.setJobGroup(f"clear-{n}", "")
        assert replace_scope(rows.limit(1), path, schema, ["load_date"], F.lit(True)) == 1
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"clear-{n}")))
        spark.sparkContext.setJobGroup("", "")
        assert len(list((tmp_path / str(n)).glob("load_date=*"))) == 1
        assert read_table(spark, path, schema).count() == 1
    assert jobs[1] <= jobs[0] + 1


def test_outbox_from_elsewhere(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = outbox(spark, [(TRANSACTION, D1, TX), (CURRENCY, D1, RATE)])
    assert import_days(spark, tables, D1, D1, outbox=rows).loaded == [D1]
    assert staged(spark, tables) == [(D1, D1, "done")]


def test_strict_import_writes_nothing(spark, tables):
    with pytest.raises(Exception, match="bad:amount"):
        import_days(spark, tables, D1, D1, strict=True)
    assert staged(spark, tables) == []


def test_daily_import_follows_the_bookmark(spark, tables):
    assert import_day(spark, tables).loaded == [D1]
    assert import_day(spark, tables).skipped == [D2]
    assert import_day(spark, tables).loaded == [D3]
    assert staged(spark, tables) == ALL_STAGED
    after = import_day(spark, tables)
    assert after.loaded == [] and after.skipped == []


def test_import_of_an_empty_outbox(spark, tmp_path):
    assert import_day(spark, Tables(str(tmp_path))) is None


def test_only_the_days_partitions_are_read(spark, tables):
    rows = read_table(spark, tables.outbox, OUTBOX).where(F.col("sent_date").isin([D1]))
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sent_date" in plan
    assert len(rows.inputFiles()) >= 1
