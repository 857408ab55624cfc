"""Faults of a load that the mart would carry on: keys given twice, and rates from the base to itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BASE_CURRENCY, CURRENCY, CURRENCY_KEY, TRANSACTION, TRANSACTION_KEY
from .keyed import key_violations

REPEATED, BASE_TO_BASE = "repeated_key", "base_to_base"


def _listed(found: DataFrame, object_type: str, fault: str, keys: list[str]) -> DataFrame:
    parts = [F.col(name).cast("string") for name in keys]
    return found.select(F.lit(object_type).alias("object_type"), F.lit(fault).alias("fault"),
                        F.concat_ws("|", *parts).alias("key"), "n_rows")


def rate_faults(currencies: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """(object_type, fault, key, n_rows): rates given twice, which multiply payments, and rates from the base
    currency to itself, which count its payments once more."""
    to_itself = currencies.where((F.col("currency_code") == base) & (F.col("currency_code_with") == base))
    counted = to_itself.groupBy(*CURRENCY_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return _listed(key_violations(currencies, CURRENCY_KEY), CURRENCY, REPEATED, CURRENCY_KEY).unionByName(
        _listed(counted, CURRENCY, BASE_TO_BASE, CURRENCY_KEY))


def transaction_faults(transactions: DataFrame) -> DataFrame:
    """The same for transactions given twice; the ranking leaves one of them. Reads the key columns only."""
    return _listed(key_violations(transactions, TRANSACTION_KEY), TRANSACTION, REPEATED, TRANSACTION_KEY)
