"""Outbox -> staging, for a day or a range of days."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import on_days
from ..operators.faults import rate_faults, transaction_faults
from ..operators.staging import (
    both_present_gate, day_counts, extract_currencies, extract_transactions, invalid_rows,
    row_contract, staged_currencies, staged_transactions, valid_rows,
)
from ..schemas import (
    CURRENCIES, CURRENCY, OUTBOX, STAGED_CURRENCIES, STAGED_TRANSACTIONS, STAGING_REJECTS,
    TRANSACTION, TRANSACTIONS,
)
from ..sources.folders import day_folders, oldest_day_row, read_days, read_folders
from ..sources.tables import Tables, replace_scope
from .bookmarks import day_to_load, move_past

WORKFLOW_KEY = "outbox_to_staging"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ImportResult:
    loaded: list[date]
    skipped: list[date]
    rejects: int
    #: Rates given twice or from the base currency to itself, over the event days of these loads.
    rate_faults: int = 0


# object type: extractor, contract, stored form, stored schema, table, sort columns
_KINDS = {
    TRANSACTION: (extract_transactions, TRANSACTIONS, staged_transactions, STAGED_TRANSACTIONS,
                  "transactions", ["transaction_dt"]),
    CURRENCY: (extract_currencies, CURRENCIES, staged_currencies, STAGED_CURRENCIES,
               "currencies", ["date_update", "currency_code"]),
}


def _load(outbox: DataFrame, tables: Tables, kind: str, days: list[date], n_messages: int, scope,
          strict: bool) -> int:
    """Replace the staged rows of one kind in scope; returns how many rows broke the contract."""
    extract, contract, staged, schema, table, sort_by = _KINDS[kind]
    messages = outbox.where((F.col("object_type") == kind) & F.col("sent_date").isin(days))
    contracted = row_contract(extract(messages), contract, strict)
    n_staged = replace_scope(staged(valid_rows(contracted)), getattr(tables, table), schema,
                             ["load_date", "event_date"], scope, sort_by)
    n_rejects = n_messages - n_staged
    # The usual load without rejects needs no second pass over the payloads.
    rejects = invalid_rows(contracted).withColumn("object_type", F.lit(kind)) if n_rejects else None
    replace_scope(rejects, tables.staging_rejects, STAGING_REJECTS, ["object_type", "load_date"],
                  scope & (F.col("object_type") == kind), spark=outbox.sparkSession)
    return n_rejects


def _event_days(spark: SparkSession, path: str, schema, first: date, last: date) -> DataFrame:
    """Staged rows of the event days that some loads have rows for, from whatever load."""
    loads = day_folders(spark, path, ["load_date"], "load_date", first, last)
    days = [day for folders in loads.values() for folder in folders
            for day in day_folders(spark, folder, ["event_date"], "event_date")]
    if not days:
        return spark.createDataFrame([], schema)
    found = day_folders(spark, path, ["load_date", "event_date"], "event_date", min(days), max(days))
    return read_folders(spark, path, schema, [f for day, folders in found.items() if day in days for f in folders])


def load_faults(spark: SparkSession, tables: Tables, first: date, last: date, rates_only: bool = False) -> DataFrame:
    """Faults of the loads from ``first`` to ``last``, also against earlier loads of the same event days.

    Reads key columns of the staged files, not the messages again.
    """
    found = rate_faults(_event_days(spark, tables.currencies, STAGED_CURRENCIES, first, last))
    if rates_only:
        return found
    return found.unionByName(transaction_faults(
        _event_days(spark, tables.transactions, STAGED_TRANSACTIONS, first, last)))


def import_days(spark: SparkSession, tables: Tables, first: date, last: date,
                strict: bool = False, clear_skipped: bool = False,
                outbox: DataFrame | None = None) -> ImportResult:
    """Load all days from ``first`` to ``last`` in one job per table; a rerun changes nothing.

    The days that pass the gate become a list in the plan (no longer than the range has days), so
    that only their outbox partitions are read. Staging is partitioned by the day of loading: a
    rerun replaces what that load wrote, and rows of the same event day from other loads stay.

    What an earlier load staged for a day that is now skipped, or no longer in the outbox, stays as
    well, unless ``clear_skipped`` asks for it to go. ``outbox`` may come from elsewhere, such as a
    database read day by day; by default it is the stored table.
    """
    if outbox is None:
        # One list of files, those of the range, for counts and rows.
        outbox = read_days(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date", first, last)
    in_range = outbox.where(on_days(F.col("sent_date"), first, last))
    days = both_present_gate(day_counts(in_range)).orderBy("sent_date").collect()
    loaded = [row.sent_date for row in days if row.loaded]
    skipped = [row.sent_date for row in days if not row.loaded]
    n_messages = {TRANSACTION: sum(row.n_transactions for row in days if row.loaded),
                  CURRENCY: sum(row.n_currencies for row in days if row.loaded)}
    log.info("from %s to %s: %s messages in %d days; skipped %s", first, last, n_messages,
             len(loaded), skipped)
    if not loaded and not clear_skipped:
        return ImportResult(loaded, skipped, 0)
    load_date = F.col("load_date")
    scope = on_days(load_date, first, last) if clear_skipped else load_date.isin(loaded)
    rejects = sum(_load(outbox, tables, kind, loaded, n_messages[kind], scope, strict)
                  for kind in _KINDS)
    log.info("%d payloads broke the row contract", rejects)
    faults = load_faults(spark, tables, loaded[0], loaded[-1], rates_only=True).count() if loaded else 0
    if faults:
        log.warning("%d rates are given twice or from the base currency to itself; see load_faults", faults)
    return ImportResult(loaded, skipped, rejects, faults)


def import_day(spark: SparkSession, tables: Tables, strict: bool = False,
               workflow_key: str = WORKFLOW_KEY) -> ImportResult | None:
    """Load the bookmarked day, or the oldest, and move the bookmark. None if the outbox is empty."""
    day = day_to_load(spark, tables, workflow_key,
                      lambda: oldest_day_row(spark, tables.outbox, OUTBOX, ["sent_date"], "sent_date"))
    if day is None:
        return None
    result = import_days(spark, tables, day, day, strict)
    move_past(spark, tables, workflow_key, day)
    return result
