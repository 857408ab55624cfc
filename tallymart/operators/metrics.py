"""Turnover per day and currency, and its merge into the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import (
    AMOUNT, converted, converted_wide, exact_rate, ratio, turnover, whole_part, wide_rate,
)
from ..functions.time import on_days
from ..schemas import BASE_CURRENCY, METRICS_KEY, METRICS_VALUES
from .conversion import rates_on_day
from .ranking import done_on_day, drop_test_accounts, latest_status


def metrics_of_rows(rows: DataFrame) -> DataFrame:
    """Metrics of converted payments (the output of ``union_branches``)."""
    rate, amount = F.col("currency_with_div"), F.col("amount")
    product, wide_product = converted(amount, exact_rate(rate)), converted_wide(amount, wide_rate(rate))
    n, accounts = F.col("cnt_transactions"), F.col("cnt_accounts_make_transactions")
    return (
        rows.groupBy("date_update", F.col("currency_code").alias("currency_from"))
        .agg(
            F.sum(product).alias("total"), F.count(product).alias("n_total"),
            F.count(F.when(amount.isNotNull(), exact_rate(rate))).alias("n_exact"),
            F.sum(wide_product).alias("wide_total"), F.count(wide_product).alias("n_wide_total"),
            F.count(F.when(amount.isNotNull(), wide_rate(rate))).alias("n_wide"),
            F.count(F.lit(1)).alias("cnt_transactions"),
            F.count_distinct("account_number_from").alias("cnt_accounts_make_transactions"),
        )
        .select(*METRICS_KEY,
                turnover(whole_part(F.col("total"), F.col("n_total"), F.col("n_exact")),
                         whole_part(F.col("wide_total"), F.col("n_wide_total"), F.col("n_wide")),
                         F.col("n_wide")).alias("amount_total"),
                n, ratio(n, accounts).alias("avg_transactions_per_account"), accounts)
    )


def metrics_of_sums(done: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """The same metrics with the join moved above the aggregation.

    Join key and group key are both (day, currency), so a group's total is its sum of amounts times
    its sum of rates, and its count is payments times rates. Both sides are aggregated first and the
    join sees one row per day and currency on either side, already partitioned on the join key: no
    payment is copied or shuffled for the join, nothing has to be broadcast, and a currency with
    most of the payments shrinks inside the map tasks. The sums are decimals, so the result is equal
    to the row-level form (but for the seventh place of wide rates' products), also for several rates of one pair and for a rate from base to base.
    """
    keys = ["date_update", "currency_code"]
    sums = done.groupBy(*keys).agg(
        F.sum(F.col("amount").cast(AMOUNT)).alias("amount"),
        F.count("amount").alias("n_amounts"),
        F.count(F.lit(1)).alias("n_payments"),
        F.count_distinct("account_number_from").alias("cnt_accounts_make_transactions"),
    )
    factors = rates.where(F.col("currency_code_with") == base).groupBy(*keys).agg(
        F.sum(exact_rate(F.col("currency_with_div"))).alias("rate"),
        F.sum(wide_rate(F.col("currency_with_div"))).alias("wide_rate"),
        F.count(exact_rate(F.col("currency_with_div"))).alias("n_exact"),
        F.count(wide_rate(F.col("currency_with_div"))).alias("n_wide"),
        F.count(F.lit(1)).alias("n_rates"),
    )
    own = F.when(F.col("currency_code") == base, 1).otherwise(0)
    n, accounts = F.col("cnt_transactions"), F.col("cnt_accounts_make_transactions")
    none = F.col("n_amounts") == 0
    # One product for each part: there should be one if the part has a rate.
    expected = lambda n_rates: F.when(none, 0).otherwise((n_rates > 0).cast("int"))
    made = lambda column: column.isNotNull().cast("int")
    product = converted(F.col("amount"), F.col("rate"))
    wide_product = converted_wide(F.col("amount"), F.col("wide_rate"))
    return (
        sums.join(factors, keys, "left")
        .withColumn("rate", F.coalesce("rate", F.lit(0)) + own)
        .withColumn("n_rates", F.coalesce("n_rates", F.lit(0)) + own)
        .withColumn("n_exact", F.coalesce("n_exact", F.lit(0)) + own)
        .withColumn("n_wide", F.coalesce("n_wide", F.lit(0)))
        .where("n_rates > 0")
        .withColumn("cnt_transactions", F.col("n_payments") * F.col("n_rates"))
        .select("date_update", F.col("currency_code").alias("currency_from"),
                turnover(whole_part(product, made(product), expected(F.col("n_exact"))),
                         whole_part(wide_product, made(wide_product), expected(F.col("n_wide"))),
                         F.col("n_wide")).alias("amount_total"),
                n, ratio(n, accounts).alias("avg_transactions_per_account"), accounts)
    )


def global_metrics(
    transactions: DataFrame, currencies: DataFrame, first=None, last=None,
    rule: str = "negative", base: int = BASE_CURRENCY,
) -> DataFrame:
    """The mart's rows for the given days, all of them in one pass (all days by default)."""
    ranked = latest_status(drop_test_accounts(transactions, rule), since=first)
    return metrics_of_sums(done_on_day(ranked, first, last),
                           rates_on_day(currencies, first, last), base)


def compare_metrics(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full outer join on the key; ``change`` says what a merge does with each row.

    ``inserted``, ``updated`` (any metric differs), ``unchanged``, or ``missing`` (in the target only).
    """
    t, s = target.alias("t"), source.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in METRICS_KEY]
    differs = F.lit(False)
    for name in METRICS_VALUES:
        differs = differs | ~F.col(f"t.{name}").eqNullSafe(F.col(f"s.{name}"))
    in_target, in_source = F.col("t.date_update").isNotNull(), F.col("s.date_update").isNotNull()
    change = (F.when(~in_target, "inserted").when(~in_source, "missing")
              .when(differs, "updated").otherwise("unchanged"))
    return t.join(s, on, "full_outer").select(
        *[F.coalesce(f"s.{k}", f"t.{k}").alias(k) for k in METRICS_KEY],
        *[F.when(in_source, F.col(f"s.{v}")).otherwise(F.col(f"t.{v}")).alias(v)
          for v in METRICS_VALUES],
        change.alias("change"),
    )


def merge_metrics(
    target: DataFrame, source: DataFrame, delete_missing: bool = False, first=None, last=None,
) -> DataFrame:
    """``target`` after the merge of ``source``.

    Rows of the target without a partner stay, unless ``delete_missing`` clears them for the days
    from ``first`` to ``last`` (all days by default).
    """
    compared = compare_metrics(target, source)
    if delete_missing:
        gone = (F.col("change") == "missing") & on_days(F.col("date_update"), first, last)
        compared = compared.where(~gone)
    return compared.drop("change")
