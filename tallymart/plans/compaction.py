"""Small files of the outbox, merged day by day."""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass
from datetime import date
from itertools import accumulate

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..schemas import OUTBOX
from ..sources.folders import data_files, day_folders, read_folders, repair, replace_files
from ..sources.tables import Tables

log = logging.getLogger(__name__)

TARGET_BYTES = 128 << 20
#: A day with fewer small files than this is left alone.
LEAST_FILES = 4


@dataclass(frozen=True)
class Compacted:
    day: date
    files_before: int
    files_after: int


def compact_outbox(spark: SparkSession, tables: Tables, first: date | None = None, last: date | None = None,
                   target_bytes: int = TARGET_BYTES, least_files: int = LEAST_FILES) -> list[Compacted]:
    """Merge the small files (under half of ``target_bytes``) of the days from ``first`` to ``last``.

    Each day gets as many new files as its small ones fill, so a day with most of the messages is written by
    many tasks; rows stay sorted by type and time. Only the files found at the start are replaced: a stream
    may add to the outbox meanwhile. A second run finds nothing to do, and one after a run that died first
    ends what that had begun. The lists on the driver are of files of the days asked for.
    """
    repair(spark, tables.outbox)
    old, parts, days = [], [], []
    for day, folders in day_folders(spark, tables.outbox, ["sent_date"], "sent_date", first, last).items():
        files = [file for folder in folders for file in data_files(spark, folder)]
        small = [(path, size) for path, size in files if 2 * size < target_bytes]
        if len(small) < least_files:
            continue
        n_parts = max(1, math.ceil(sum(size for _, size in small) / target_bytes))
        old += [path for path, _ in small]
        parts.append((day, n_parts))
        days.append(Compacted(day, len(files), len(files) - len(small) + n_parts))
    if old:
        starts = list(accumulate((n for _, n in parts), initial=0))
        numbered = [(*part, start) for part, start in zip(parts, starts)]
        wanted = F.broadcast(spark.createDataFrame(numbered, "sent_date date, parts int, start int"))  # a row per day
        # One task writes one file. Dealt by hash of the day, several would fall to one task.
        task = F.col("start") + F.pmod(F.xxhash64("object_id"), F.col("parts")).cast("int")
        rows = (read_folders(spark, tables.outbox, OUTBOX, old).join(wanted, "sent_date")
                .repartitionById(starts[-1], task)
                .sortWithinPartitions("sent_date", "object_type", "sent_dttm").select(*OUTBOX.names))
        replace_files(rows, tables.outbox, ["sent_date"], old)
    log.info("%d files of %d days replaced", len(old), len(days))
    return days
