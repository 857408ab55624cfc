"""Expressions on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_sent_dttm(text: Column) -> Column:
    """``year-month-dayThour:minute:second`` as TIMESTAMP_NTZ, else NULL.

    One or two digits per part; fractions and zones are refused. A cast, not a parse by pattern:
    the pattern functions go through the session time zone, where some local times do not exist.
    """
    shape = text.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\z")
    return F.when(shape, text.try_cast("timestamp_ntz"))


def cut_to_second(ts: Column) -> Column:
    """Drop the fraction of a second.

    ``date_trunc`` would go through the session time zone and back, see above.
    """
    second = F.extract(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(secs=second - F.floor(second))


def on_days(day: Column, first, last) -> Column:
    """``first <= day <= last``; either bound may be None."""
    condition = F.lit(True)
    if first is not None:
        condition = condition & (day >= F.lit(first).cast("date"))
    if last is not None:
        condition = condition & (day <= F.lit(last).cast("date"))
    return condition
