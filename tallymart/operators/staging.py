"""Outbox day -> typed staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import exact_rate, wide_rate
from ..functions.text import canonical_uuid, json_texts, number_text
from ..functions.time import cut_to_second, on_days
from ..schemas import CURRENCIES, CURRENCY, TRANSACTION, TRANSACTIONS
from .once import computed_once


def oldest_outbox_day(outbox: DataFrame) -> DataFrame:
    """One row with the first sent day; NULL for an empty outbox.

    ``sent_date`` is the partition column, so no data page is read.
    """
    return outbox.agg(F.min("sent_date").alias("oldest_day"))


def outbox_day_slice(outbox: DataFrame, object_type: str, first, last=None) -> DataFrame:
    """Messages of one type sent on ``first``, or from ``first`` to ``last``."""
    last = first if last is None else last
    return outbox.where((F.col("object_type") == object_type)
                        & on_days(F.col("sent_date"), first, last))


def _extract(outbox_slice: DataFrame, names) -> DataFrame:
    return (
        outbox_slice
        .withColumn("fields", json_texts(F.col("payload"), names))
        .select("object_id", "payload", F.col("sent_date").alias("load_date"),
                *[F.col(f"fields.{name}").alias(name) for name in names])
    )


def extract_transactions(outbox_slice: DataFrame) -> DataFrame:
    """The nine payload members as text, with the message's id, payload and day."""
    return _extract(outbox_slice, TRANSACTIONS.names)


def extract_currencies(outbox_slice: DataFrame) -> DataFrame:
    """The four payload members as text, with the message's id, payload and day."""
    return _extract(outbox_slice, CURRENCIES.names)


def _typed_column(name: str, data_type: str):
    text = F.col(name)
    if name == "operation_id":
        return canonical_uuid(text)
    if data_type == "double":
        return number_text(text).try_cast("double")
    return text.try_cast(data_type)


def row_contract(extracted: DataFrame, schema, strict: bool = False) -> DataFrame:
    """Cast every field of ``schema``; ``reason`` names the first one that is missing or unfit.

    A rate must also fit a decimal type the mart computes with, and not become 0 in it. With ``strict`` the first bad row
    fails the query; otherwise it stays, marked, for ``valid_rows`` and ``invalid_rows`` to split.
    """
    typed = extracted.select(
        "object_id", "payload", "load_date",
        *[_typed_column(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields],
    )
    faults = [F.when(F.col(name).isNull(), f"bad:{name}") for name in schema.names]
    if "currency_with_div" in schema.names:
        rate = F.col("currency_with_div")
        faults.append(F.when(exact_rate(rate).isNull() & wide_rate(rate).isNull(),
                             "bad:currency_with_div"))
    reason = F.coalesce(*faults)
    if strict:
        message = F.concat(F.lit("row contract broken, object "), F.col("object_id"), F.lit(": "),
                           reason)
        reason = F.when(reason.isNotNull(), F.raise_error(message)).cast("string")
    return computed_once(typed.withColumn("reason", reason))


def valid_rows(contracted: DataFrame) -> DataFrame:
    """Rows that keep the contract, without the message columns."""
    return contracted.where(F.col("reason").isNull()).drop("reason", "object_id", "payload")


def invalid_rows(contracted: DataFrame) -> DataFrame:
    return (contracted.where(F.col("reason").isNotNull())
            .select("object_id", "payload", "reason", "load_date"))


def staged_transactions(valid: DataFrame) -> DataFrame:
    """Stored form: time cut to seconds, event day added."""
    return (valid.withColumn("transaction_dt", cut_to_second(F.col("transaction_dt")))
            .withColumn("event_date", F.to_date("transaction_dt")))


def staged_currencies(valid: DataFrame) -> DataFrame:
    """Stored form: time cut to seconds, event day added."""
    return (valid.withColumn("date_update", cut_to_second(F.col("date_update")))
            .withColumn("event_date", F.to_date("date_update")))


def day_counts(outbox: DataFrame) -> DataFrame:
    """Messages of either type per sent day; reads the type column only."""
    return outbox.groupBy("sent_date").agg(
        F.count_if(F.col("object_type") == TRANSACTION).alias("n_transactions"),
        F.count_if(F.col("object_type") == CURRENCY).alias("n_currencies"),
    )


def both_present_gate(counts: DataFrame) -> DataFrame:
    """Mark the days that may be loaded: those with transactions and with rates.

    A day without either is not loaded, although the bookmark moves past it; ``loaded`` = false
    is the list of such days.
    """
    loaded = (F.col("n_transactions") > 0) & (F.col("n_currencies") > 0)
    return counts.withColumn("loaded", loaded)
