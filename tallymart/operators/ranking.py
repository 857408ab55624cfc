"""Latest status per payment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import on_days
from ..schemas import DONE, PAYMENT_KEY, TEST_ACCOUNT
from .keyed import first_per_key

# What the mart needs of a transaction; the other columns are never read.
RANKED_COLUMNS = [*PAYMENT_KEY, "currency_code", "status", "amount", "transaction_dt"]


def oldest_staging_day(transactions: DataFrame) -> DataFrame:
    """One row with the first event day; NULL for empty staging. Reads the partition column."""
    return transactions.agg(F.min("event_date").alias("oldest_day"))


def drop_test_accounts(transactions: DataFrame, rule: str = "negative") -> DataFrame:
    """``negative`` drops every account below zero, ``minus_one`` only the account -1."""
    account = F.col("account_number_from")
    keep = {"negative": account >= 0, "minus_one": account != TEST_ACCOUNT}
    return transactions.where(keep[rule])


def latest_status(transactions: DataFrame, since=None) -> DataFrame:
    """The last row of each payment over all statuses and days.

    With ``since``, only payments whose last row lies on or after that day are returned. Rows
    before it can then neither win nor change a winner, so they are not read at all: the condition
    prunes ``event_date`` partitions where the table has them.

    Ties in time go to the greater status; code and amount make the order total, so that a task
    run again after a lost executor picks the same row.
    """
    if since is not None:
        day = "event_date" if "event_date" in transactions.columns else "transaction_dt"
        transactions = transactions.where(on_days(F.to_date(day), since, None))
    order = [F.desc(name) for name in ("transaction_dt", "status", "currency_code", "amount")]
    return first_per_key(transactions.select(*RANKED_COLUMNS), PAYMENT_KEY, order)


def done_on_day(ranked: DataFrame, first=None, last=None) -> DataFrame:
    """Payments whose last status is ``done``, reached in the given days (all days by default).

    Comes after the ranking: filtering before it would bring back payments reversed later.
    """
    return (
        ranked
        .withColumn("date_update", F.to_date("transaction_dt"))
        .where((F.col("status") == DONE) & on_days(F.col("date_update"), first, last))
        .select("account_number_from", "account_number_to", "currency_code", "amount",
                "operation_id", "date_update")
    )
