"""Staging -> mart, for a day or a range of days."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import on_days
from ..operators.metrics import compare_metrics, global_metrics
from ..operators.propagation import displaced_days, repriced_days
from ..operators.ranking import drop_test_accounts
from ..schemas import (
    GLOBAL_METRICS, METRICS_KEY, METRICS_VALUES, STAGED_CURRENCIES, STAGED_TRANSACTIONS,
)
from ..sources.folders import (
    data_files, day_folders, oldest_day_row, read_days, read_folders, repair, replace_files,
)
from ..sources.tables import Tables, checkpoint_root, laid_out, read_table
from .bookmarks import day_to_load, move_past

WORKFLOW_KEY = "staging_to_mart"
STAGING_FOLDERS = ["load_date", "event_date"]

log = logging.getLogger(__name__)


def merge_into_mart(source: DataFrame, path: str, first: date, last: date,
                    delete_missing: bool = False, days: list[date] | None = None) -> list[date]:
    """Merge ``source`` (days from ``first`` to ``last``, or just ``days`` of these) into the mart.

    Returns the days rewritten; only days with a changed row are. The compared rows are checkpointed first:
    the ranking behind ``source`` then runs once. New files are written aside and swapped in, and the next
    merge ends a swap that broke off. The mart has one row per day and currency.
    """
    spark = source.sparkSession
    checkpoint_root(spark)
    repair(spark, path)
    folders = day_folders(spark, path, ["date_update"], "date_update", first, last)
    folders = {day: found for day, found in folders.items() if days is None or day in days}
    target = read_folders(spark, path, GLOBAL_METRICS, [f for found in folders.values() for f in found])
    compared = compare_metrics(target, source).checkpoint()
    changes = ["inserted", "updated"] + (["missing"] if delete_missing else [])
    changed = [row.date_update for row in
               compared.where(F.col("change").isin(changes)).select("date_update").distinct()
               .collect()]
    log.info("from %s to %s: %d days changed", first, last, len(changed))
    if changed:
        touched = F.col("date_update").isin(changed)
        merged = compared.where(touched)
        if delete_missing:
            merged = merged.where("change != 'missing'")
        old = [file for day in changed for folder in folders.get(day, ())
               for file, _ in data_files(spark, folder)]
        replace_files(laid_out(merged.drop("change"), ["date_update"], ["currency_from"]), path,
                      ["date_update"], old)
    return sorted(changed)


def merge_into_catalog_table(source: DataFrame, table: str) -> None:
    """The same merge as one atomic statement, for catalogs whose tables support MERGE."""
    target = table.rsplit(".", 1)[-1]
    matches, differs = F.lit(True), F.lit(False)
    for key in METRICS_KEY:
        matches = matches & (F.col(f"{target}.{key}") == F.col(f"source.{key}"))
    for name in METRICS_VALUES:
        differs = differs | ~F.col(f"{target}.{name}").eqNullSafe(F.col(f"source.{name}"))
    (source.alias("source").mergeInto(table, matches)
     .whenMatched(differs).updateAll().whenNotMatched().insertAll().merge())


def backfill_range(spark: SparkSession, tables: Tables, first: date, last: date,
                   rule: str = "negative", delete_missing: bool = False) -> list[date]:
    """Recompute all days from ``first`` to ``last`` in one pass and merge them."""
    return merge_into_mart(_metrics(spark, tables, first, last, rule), tables.global_metrics, first, last,
                           delete_missing)


def _metrics(spark: SparkSession, tables: Tables, first: date, last: date, rule: str) -> DataFrame:
    """The mart's rows of some days, from the folders of staging that can matter for them."""
    return global_metrics(
        read_days(spark, tables.transactions, STAGED_TRANSACTIONS, STAGING_FOLDERS, "event_date", first),
        read_days(spark, tables.currencies, STAGED_CURRENCIES, STAGING_FOLDERS, "event_date", first, last),
        first, last, rule)


def refresh_after_load(spark: SparkSession, tables: Tables, first_load: date, last_load: date,
                       rule: str = "negative") -> list[date]:
    """Bring the mart up to date with the loads from ``first_load`` to ``last_load``; returns the days rewritten.

    A payment reversed on the next day changes a day that was merged before. Only the days are recomputed
    where a payment of these loads counts now or counted without them, and those with new rates. The result
    is that of recomputing all days, as long as the mart was up to date before the loads and these only
    added rows; a load that replaced an earlier one needs ``backfill_range``. Groups that are gone go.
    """
    staged = read_table(spark, tables.transactions, STAGED_TRANSACTIONS)
    loaded = on_days(F.col("load_date"), first_load, last_load)
    rates = read_days(spark, tables.currencies, STAGED_CURRENCIES, STAGING_FOLDERS, "load_date",
                      first_load, last_load)
    changed = displaced_days(drop_test_accounts(staged, rule), loaded).unionByName(
        repriced_days(rates, F.lit(True))).distinct()
    days = sorted(row.event_date for row in changed.collect())  # no more than days of the data
    log.info("loads from %s to %s change %d days", first_load, last_load, len(days))
    if not days:
        return []
    metrics = _metrics(spark, tables, days[0], days[-1], rule).where(F.col("date_update").isin(days))
    return merge_into_mart(metrics, tables.global_metrics, days[0], days[-1], delete_missing=True, days=days)


def update_datamart_day(spark: SparkSession, tables: Tables, rule: str = "negative",
                        workflow_key: str = WORKFLOW_KEY) -> date | None:
    """Merge the bookmarked day, or the oldest, then move the bookmark. None if staging is empty."""
    day = day_to_load(
        spark, tables, workflow_key,
        lambda: oldest_day_row(spark, tables.transactions, STAGED_TRANSACTIONS, STAGING_FOLDERS, "event_date"))
    if day is None:
        return None
    backfill_range(spark, tables, day, day, rule)
    move_past(spark, tables, workflow_key, day)
    return day
