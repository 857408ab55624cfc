"""Ranking, conversion, metrics and merge, one hand-made case per rule."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart import fixtures as fx
from tallymart.operators.conversion import (
    base_currency_rows, convert_to_base, rates_on_day, union_branches,
)
from tallymart.operators.metrics import (
    compare_metrics, global_metrics, merge_metrics, metrics_of_rows, metrics_of_sums,
)
from tallymart.operators.ranking import done_on_day, drop_test_accounts, latest_status, oldest_staging_day
from tallymart.plans.datamart import (
    backfill_range, merge_into_catalog_table, merge_into_mart, update_datamart_day,
)
from tallymart.schemas import GLOBAL_METRICS, STAGED_CURRENCIES, STAGED_TRANSACTIONS
from tallymart.sources.tables import Tables, read_table, replace_scope

D1, D2, D3 = date(2022, 10, 1), date(2022, 10, 2), date(2022, 10, 3)


def at(day, hour=12):
    return datetime(day.year, day.month, day.day, hour)


def tx(spark, rows):
    """rows: operation, from, currency, status, amount, time"""
    data = [(op, account, 99, code, "c", status, "t", amount, ts, ts.date(), ts.date())
            for op, account, code, status, amount, ts in rows]
    return spark.createDataFrame(data, STAGED_TRANSACTIONS)


def rates(spark, rows):
    """rows: day, code, code with, rate"""
    data = [(at(day, 0), code, code_with, rate, day, day) for day, code, code_with, rate in rows]
    return spark.createDataFrame(data, STAGED_CURRENCIES)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def result(df):
    return {(row.date_update, row.currency_from):
            (row.amount_total, row.cnt_transactions, row.avg_transactions_per_account,
             row.cnt_accounts_make_transactions) for row in df.collect()}


def both_forms(spark, transactions, currencies, rule="negative"):
    """Metrics of the pre-aggregated form, after checking the row-level form gives the same."""
    ranked = latest_status(drop_test_accounts(transactions, rule))
    done, day_rates = done_on_day(ranked), rates_on_day(currencies)
    rows = union_branches(convert_to_base(done, day_rates), base_currency_rows(done))
    salted = union_branches(convert_to_base(done, day_rates, broadcast_rows=0),
                            base_currency_rows(done))
    sums = result(metrics_of_sums(done, day_rates))
    assert sums == result(metrics_of_rows(rows)) == result(metrics_of_rows(salted))
    return sums


def test_test_accounts(spark):
    df = tx(spark, [(str(a), a, 420, "done", 1, at(D1)) for a in (-2, -1, 0, 5)])
    kept = lambda rule: {r.account_number_from for r in drop_test_accounts(df, rule).collect()}
    assert kept("negative") == {0, 5}
    assert kept("minus_one") == {-2, 0, 5}
    with pytest.raises(KeyError):
        drop_test_accounts(df, "all")


def test_rank_first_filter_after(spark):
    """Done on D1, reversed on D2: the payment no longer counts for D1."""
    df = tx(spark, [("a", 1, 420, "done", 100, at(D1)), ("a", 1, 420, "chargeback", 100, at(D2)),
                    ("b", 1, 420, "queued", 5, at(D1, 9)), ("b", 1, 420, "done", 5, at(D1, 10))])
    got = as_set(done_on_day(latest_status(df)).select("operation_id", "date_update"))
    assert got == {("b", D1)}


def test_payment_key_has_the_accounts(spark):
    df = tx(spark, [("a", 1, 420, "done", 1, at(D1)), ("a", 2, 420, "done", 1, at(D1))])
    assert latest_status(df).count() == 2


def test_ties_go_to_the_greater_status(spark):
    df = tx(spark, [("a", 1, 420, "done", 1, at(D1)), ("a", 1, 420, "queued", 1, at(D1))])
    assert latest_status(df).first().status == "queued"
    df = tx(spark, [("b", 1, 420, "done", 1, at(D1)), ("b", 1, 420, "chargeback", 1, at(D1))])
    assert latest_status(df).first().status == "done"


@pytest.mark.parametrize("since", [D1, D2, D3])
def test_ranking_since_a_day(spark, since):
    df = tx(spark, [("a", 1, 420, "done", 1, at(D1)), ("a", 1, 420, "chargeback", 1, at(D2)),
                    ("b", 1, 420, "done", 2, at(D2)), ("b", 1, 420, "queued", 2, at(D1)),
                    ("c", 1, 420, "done", 3, at(D3)), ("d", 1, 420, "done", 4, at(D1))])
    full = latest_status(df).where(F.to_date("transaction_dt") >= F.lit(since))
    assert as_set(latest_status(df, since)) == as_set(full)


def test_conversion_and_missing_rates(spark):
    df = tx(spark, [("a", 1, 430, "done", 1000, at(D1)), ("b", 1, 430, "done", 1000, at(D2)),
                    ("c", 2, 420, "done", 500, at(D2)), ("d", 2, 430, "done", 300, at(D1))])
    fx_rates = rates(spark, [(D1, 430, 420, 1.07), (D1, 430, 840, 9.0), (D3, 430, 420, 9.0)])
    assert both_forms(spark, df, fx_rates) == {
        (D1, 430): (Decimal("13.91"), 2, Decimal("1.00"), 2),
        (D2, 420): (Decimal("5.00"), 1, Decimal("1.00"), 1)}


def test_several_rates_of_a_pair_multiply_rows(spark):
    df = tx(spark, [("a", 1, 430, "done", 100, at(D1)), ("b", 2, 430, "done", 100, at(D1))])
    fx_rates = rates(spark, [(D1, 430, 420, 1.5), (D1, 430, 420, 2.0)])
    assert both_forms(spark, df, fx_rates) == {
        (D1, 430): (Decimal("7.00"), 4, Decimal("2.00"), 2)}


def test_base_to_base_rate_counts_twice(spark):
    df = tx(spark, [("a", 1, 420, "done", 100, at(D1))])
    assert both_forms(spark, df, rates(spark, [(D1, 420, 420, 1.0)])) == {
        (D1, 420): (Decimal("2.00"), 2, Decimal("2.00"), 1)}


def test_one_rounding_half_up(spark):
    df = tx(spark, [("a", 1, 430, "done", 1, at(D1)), ("b", 1, 440, "done", 1, at(D1)),
                    ("c", 1, 450, "done", -1, at(D1))])
    fx_rates = rates(spark, [(D1, 430, 420, 0.4999996), (D1, 440, 420, 0.5), (D1, 450, 420, 0.5)])
    assert {k[1]: v[0] for k, v in both_forms(spark, df, fx_rates).items()} == {
        430: Decimal("0.00"), 440: Decimal("0.01"), 450: Decimal("-0.01")}


def test_small_and_large_money(spark):
    big = 9_000_000_000_000_000
    df = tx(spark, [(f"a{i}", i, 430, "done", big, at(D1)) for i in range(20)])
    got = both_forms(spark, df, rates(spark, [(D1, 430, 420, 0.000000123)]))
    assert got == {(D1, 430): (Decimal("221400000.00"), 20, Decimal("1.00"), 20)}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_sum_out_of_range_is_an_error(spark, ansi):
    df = tx(spark, [(f"a{i}", i, 420, "done", 9_000_000_000_000_000_000, at(D1)) for i in range(30)])
    done, none = done_on_day(latest_status(df)), rates_on_day(rates(spark, []))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for form in (metrics_of_sums(done, none), metrics_of_rows(base_currency_rows(done))):
            with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC|out of range"):
                form.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_ratio(spark):
    df = tx(spark, [(f"a{i}", i % 3, 420, "done", 1, at(D1)) for i in range(8)])
    got = both_forms(spark, df, rates(spark, [(D1, 430, 420, 1.0)]))
    assert got[(D1, 420)] == (Decimal("0.08"), 8, Decimal("2.67"), 3)


def test_hot_currency_and_hot_account(spark):
    """A third of all rows in one currency, all from one account, against brute force."""
    rows = [(f"a{i}", 7 if i % 3 == 0 else i % 50, 430 if i % 3 == 0 else 410 + 10 * (i % 5),
             "done", i, at(D1 if i % 2 else D2)) for i in range(3000)]
    fx_rates = [(day, code, 420, code / 400) for day in (D1, D2) for code in (410, 430, 440, 450)]
    want = {}
    by_key = {(day, code): Decimal(str(rate)) for day, code, _, rate in fx_rates}
    for _, account, code, _, amount, ts in rows:
        rate = Decimal(1) if code == 420 else by_key.get((ts.date(), code))
        if rate is not None:
            total, n, accounts = want.setdefault((ts.date(), code), [0, 0, set()])
            accounts.add(account)
            want[(ts.date(), code)] = [total + amount * rate, n + 1, accounts]
    got = both_forms(spark, tx(spark, rows).repartition(6), rates(spark, fx_rates))
    assert {k: (v[0], v[1], v[3]) for k, v in got.items()} == {
        k: (round(t / 100 + Decimal("1e-9"), 2), n, len(a)) for k, (t, n, a) in want.items()}


def test_plan_of_the_mart(spark):
    """Ranked once, pruned before the shuffle, joined without broadcast of unknown size."""
    df = tx(spark, [("a", 1, 430, "done", 1, at(D1))])
    plan = global_metrics(df, rates(spark, [(D1, 430, 420, 1.0)]), D1, D2)
    text = plan._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("Window [row_number()") == 1
    assert physical.count("row_number(), 1, Partial") == 1
    assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical
    assert "ResolvedHint" not in text


def metric_row(day, code, total="1.00", n=1, avg="1.00", accounts=1):
    return (day, code, Decimal(total), n, Decimal(avg), accounts)


UNCHANGED, VANISHED = metric_row(D1, 410), metric_row(D1, 450)
TARGET = [UNCHANGED, metric_row(D1, 420), metric_row(D1, 430), VANISHED, metric_row(D3, 410)]
ONE, ALL, NEW = (metric_row(D1, 420, n=2), metric_row(D1, 430, "2.00", 2, "3.00", 3),
                 metric_row(D2, 410))
SOURCE = [UNCHANGED, ONE, ALL, NEW]


def test_merge(spark):
    target = spark.createDataFrame(TARGET, GLOBAL_METRICS)
    source = spark.createDataFrame(SOURCE, GLOBAL_METRICS)
    merged = merge_metrics(target, source)
    assert as_set(merged) == {*SOURCE, VANISHED, TARGET[4]}
    assert as_set(merge_metrics(merged, source)) == as_set(merged)
    assert as_set(merge_metrics(target, source, True, D1, D2)) == {*SOURCE, TARGET[4]}
    changes = {(row.date_update, row.currency_from): row.change
               for row in compare_metrics(target, source).collect()}
    assert changes == {(D1, 410): "unchanged", (D1, 420): "updated", (D1, 430): "updated",
                       (D2, 410): "inserted", (D1, 450): "missing", (D3, 410): "missing"}


def test_merge_into_stored_mart(spark, tmp_path):
    path = str(tmp_path / "mart")
    source = spark.createDataFrame(SOURCE, GLOBAL_METRICS)
    mart = lambda: as_set(read_table(spark, path, GLOBAL_METRICS).select(*GLOBAL_METRICS.names))
    merge_into_mart(spark.createDataFrame(TARGET, GLOBAL_METRICS), path, D1, D3)
    assert mart() == set(TARGET)
    assert merge_into_mart(source, path, D1, D2) == [D1, D2]
    assert mart() == {*SOURCE, VANISHED, TARGET[4]}
    files = {str(p) for p in tmp_path.rglob("*.parquet")}
    assert merge_into_mart(source, path, D1, D2) == []
    assert files == {str(p) for p in tmp_path.rglob("*.parquet")}
    only_d2 = source.where(F.col("date_update") == F.lit(D2))
    assert merge_into_mart(only_d2, path, D1, D2, delete_missing=True) == [D1]
    assert mart() == {NEW, TARGET[4]}


def test_catalog_merge_needs_a_table_that_supports_it(spark):
    spark.createDataFrame(TARGET, GLOBAL_METRICS).write.mode("overwrite").saveAsTable("plain_mart")
    with pytest.raises(Exception, match="MERGE"):
        merge_into_catalog_table(spark.createDataFrame(SOURCE, GLOBAL_METRICS), "plain_mart")


@pytest.fixture
def staged(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = [("a", 1, 430, "done", 100, at(D1)), ("b", 1, 430, "done", 100, at(D1)),
            ("b", 1, 430, "chargeback", 100, at(D2)), ("c", 2, 420, "done", 700, at(D3)),
            ("d", -1, 420, "done", 700, at(D1))]
    replace_scope(tx(spark, rows), tables.transactions, STAGED_TRANSACTIONS,
                  ["load_date", "event_date"], F.lit(True))
    replace_scope(rates(spark, [(D1, 430, 420, 2.0)]), tables.currencies, STAGED_CURRENCIES,
                  ["load_date", "event_date"], F.lit(True))
    return tables


MART = {(D1, 430): (Decimal("2.00"), 1, Decimal("1.00"), 1),
        (D3, 420): (Decimal("7.00"), 1, Decimal("1.00"), 1)}


def test_daily_job_equals_backfill(spark, staged, tmp_path):
    assert [update_datamart_day(spark, staged) for _ in range(3)] == [D1, D2, D3]
    daily = result(read_table(spark, staged.global_metrics, GLOBAL_METRICS))
    assert daily == MART
    assert backfill_range(spark, staged, D1, D3) == []


def test_day_job_reads_later_partitions_only(spark, staged):
    rows = read_table(spark, staged.transactions, STAGED_TRANSACTIONS)
    text = latest_status(rows, D2)._jdf.queryExecution().toString()
    scan = text[text.index("== Physical Plan =="):]
    assert "PartitionFilters: [isnotnull(event_date" in scan
    assert "country" not in scan and "transaction_type" not in scan


def test_empty_staging(spark, tmp_path):
    assert update_datamart_day(spark, Tables(str(tmp_path))) is None
    assert oldest_staging_day(spark.createDataFrame([], STAGED_TRANSACTIONS)).first()[0] is None


def test_fixture_facts(spark):
    sf = "/root/testdata/sf0.001"
    tx_rows, rate_rows = fx.tx_staging(spark, sf), fx.rates_staging(spark, sf)
    minus_one = both_forms(spark, tx_rows, rate_rows, "minus_one")
    negative = both_forms(spark, tx_rows, rate_rows, "negative")
    assert tx_rows.count() == 1000 and rate_rows.count() == 216
    assert len(minus_one) == 115
    assert sum(minus_one[key] != negative.get(key) for key in minus_one) == 3
