"""Which days of the mart a load changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BASE_CURRENCY, DONE, PAYMENT_KEY
from .ranking import RANKED_COLUMNS

#: The order of a payment's rows, the last one wins; as in ``latest_status``.
_ORDER = ["transaction_dt", "status", "currency_code", "amount"]


def displaced_days(transactions: DataFrame, is_new: Column) -> DataFrame:
    """(event_date) of the days that gain or lose a payment by the rows that are new.

    A payment counts on the day of its last row if that is done, so a reversal on the next day takes it from
    the day before. Only payments with a new row matter; the winner without the new rows and the winner with
    them come from one aggregation of these, in which a payment with many rows shrinks in the map tasks.
    Test accounts are taken out before, as the mart does.
    """
    rows = transactions.select(*RANKED_COLUMNS, is_new.alias("new"))
    touched = rows.where("new").select(*PAYMENT_KEY).distinct()
    # Null keys are one payment to the mart, but never meet in a join; they are rare and kept whole.
    known = F.lit(True)
    for name in PAYMENT_KEY:
        known = known & F.col(name).isNotNull()
    mine = rows.where(known).join(touched, PAYMENT_KEY, "left_semi").unionByName(rows.where(~known))
    place = F.struct(*_ORDER)
    winners = mine.groupBy(*PAYMENT_KEY).agg(
        F.max(place).alias("after"), F.max(F.when(~F.col("new"), place)).alias("before"))
    moved = winners.where(~F.col("after").eqNullSafe(F.col("before")))
    counted = lambda name: F.when(F.col(f"{name}.status") == DONE, F.to_date(f"{name}.transaction_dt"))
    days = moved.select(F.explode(F.array(counted("before"), counted("after"))).alias("event_date"))
    return days.where("event_date IS NOT NULL").distinct()


def repriced_days(currencies: DataFrame, is_new: Column, base: int = BASE_CURRENCY) -> DataFrame:
    """(event_date) of the days with new rates to the base currency."""
    mine = currencies.where(is_new & (F.col("currency_code_with") == base))
    return mine.select(F.to_date("date_update").alias("event_date")).distinct()
