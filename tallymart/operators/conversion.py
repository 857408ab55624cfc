"""Rates, and conversion of single payments to the base currency.

The mart itself does not join payment by payment, see ``metrics``; these are the row-level forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import on_days
from ..schemas import BASE_CURRENCY
from .keyed import BROADCAST_ROWS, fits_broadcast

CONVERTED_COLUMNS = ["account_number_from", "account_number_to", "amount", "currency_code",
                     "currency_with_div", "date_update"]
SALTS = 64


def rates_on_day(currencies: DataFrame, first=None, last=None) -> DataFrame:
    """Rates of the given days (all days by default), with the day as a DATE."""
    if "event_date" in currencies.columns:
        currencies = currencies.where(on_days(F.col("event_date"), first, last))
    return (
        currencies
        .where(on_days(F.to_date("date_update"), first, last))
        .select("currency_code", "currency_code_with", "currency_with_div",
                F.to_date("date_update").alias("date_update"))
    )


def convert_to_base(
    done: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Payments with their rate to the base currency; those without a rate that day are dropped.

    A few currencies hold most payments, so shuffling payments on (day, currency) would put them
    in a few tasks. Rates within the limit are broadcast. Beyond it the payments are spread over
    SALTS parts of each key by their operation id, and each rate is copied once per part.
    """
    to_base = rates.where(F.col("currency_code_with") == base).drop("currency_code_with")
    keys = ["currency_code", "date_update"]
    if fits_broadcast(to_base, broadcast_rows):
        joined = done.join(F.broadcast(to_base), keys)
    else:
        salted = done.withColumn("salt", F.pmod(F.xxhash64("operation_id"), F.lit(SALTS)))
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
        joined = salted.join(to_base.withColumn("salt", copies), [*keys, "salt"])
    return joined.select(*CONVERTED_COLUMNS)


def base_currency_rows(done: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Payments already in the base currency, with rate 1."""
    return (done.where(F.col("currency_code") == base)
            .withColumn("currency_with_div", F.lit(1.0))
            .select(*CONVERTED_COLUMNS))


def union_branches(converted_rows: DataFrame, base_rows: DataFrame) -> DataFrame:
    """Both branches, duplicates kept."""
    return converted_rows.unionByName(base_rows)
