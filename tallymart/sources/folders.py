"""Partition folders by name: which days there are, reading only some, and swapping files in them.

Listing a partitioned table lists every file of it, and a minimum over a partition column opens every
footer. Here only folder names are listed, and only the folders asked for are given to Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import NO_VALUE

#: Folder of a table for files that are not yet part of it. Readers skip names that start like this.
SWAP = "_swap"


def _file_system(spark: SparkSession, path: str):
    """(file system, path as its object)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is a folder, bytes) of what lies in a folder; nothing where there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted((s.getPath().getName(), s.isDirectory(), s.getLen()) for s in files.listStatus(target))


def day_folders(spark: SparkSession, path: str, partition_by: Sequence[str], column: str,
                first: date | None = None, last: date | None = None) -> dict[date, list[str]]:
    """The folders of a table by the day in one of its partition columns, in order of the days.

    One listing for each folder above the last level, none below. Null days are left out.
    """
    found: list[tuple[date | None, str]] = [(None, path.rstrip("/"))]
    for name in partition_by:
        below = []
        for day, folder in found:
            for child, is_folder, _ in children(spark, folder):
                value = child.removeprefix(f"{name}=")
                if not is_folder or value == child or (name == column and value == NO_VALUE):
                    continue
                if name == column:
                    day = date.fromisoformat(value)
                    if (first and day < first) or (last and day > last):
                        continue
                below.append((day, f"{folder}/{child}"))
        found = below
    days: dict[date, list[str]] = {}
    for day, folder in sorted(found):
        days.setdefault(day, []).append(folder)
    return days


def read_folders(spark: SparkSession, path: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    """The rows of some partition folders or files of a table; no other folder is looked at."""
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_days(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], column: str,
              first: date | None = None, last: date | None = None) -> DataFrame:
    """The rows of the days from ``first`` to ``last``, either of which may be open."""
    days = day_folders(spark, path, partition_by, column, first, last)
    return read_folders(spark, path, schema, [folder for folders in days.values() for folder in folders])


def oldest_day(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str],
               column: str) -> date | None:
    """The first day with a row; None for an empty table. Opens the folders of one day, but for empty days."""
    for day, folders in day_folders(spark, path, partition_by, column).items():
        if not read_folders(spark, path, schema, folders).isEmpty():
            return day
    return None


def oldest_day_row(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str],
                   column: str) -> DataFrame:
    """``oldest_day`` as one row, in the form of the operators on DataFrames."""
    return spark.createDataFrame([(oldest_day(spark, path, schema, partition_by, column),)], "oldest_day date")


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files right in a folder."""
    return [(f"{folder}/{name}", size) for name, is_folder, size in children(spark, folder)
            if not is_folder and name[0] not in "._"]


def _files_below(spark: SparkSession, folder: str) -> list[str]:
    found = []
    for name, is_folder, _ in children(spark, folder):
        if is_folder:
            found += _files_below(spark, f"{folder}/{name}")
        elif name[0] not in "._":
            found.append(f"{folder}/{name}")
    return found


def replace_files(df: DataFrame, path: str, partition_by: Sequence[str], old: Sequence[str]) -> None:
    """Put the rows of ``df`` in place of the files ``old`` of a table; ``df`` may read them.

    The new files are written aside, then a note of the old ones is left, and only then files are moved and
    deleted: what breaks off before the note changes nothing, what breaks off after it is carried through by
    ``repair``. No row is missing at any time; while files are moved, a reader may see rows twice. One job at
    a time may replace files of a table; others may add to it.
    """
    spark = df.sparkSession
    aside = f"{path.rstrip('/')}/{SWAP}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{aside}/rows")
    files, note = _file_system(spark, f"{aside}/note.part")
    out = files.create(note, True)
    out.write(bytearray("\n".join(old), "utf-8"))
    out.close()
    files.rename(note, _file_system(spark, f"{aside}/note")[1])
    _carry_through(spark, path.rstrip("/"), aside)


def _carry_through(spark: SparkSession, path: str, aside: str) -> None:
    """Moves the new files in, then deletes the old ones. Done in part, it can be done again."""
    files, note = _file_system(spark, f"{aside}/note")
    rows = f"{aside}/rows"
    for file in _files_below(spark, rows):
        target = _file_system(spark, f"{path}/{file.removeprefix(rows + '/')}")[1]
        files.mkdirs(target.getParent())
        if not files.rename(_file_system(spark, file)[1], target):
            raise OSError(f"could not move {file}")
    old = [row.value for row in spark.read.text(note.toString()).collect()]
    for file in filter(None, old):
        files.delete(_file_system(spark, file)[1], False)
    files.delete(note.getParent(), True)


def repair(spark: SparkSession, path: str) -> int:
    """Ends what a job that died has begun to replace; returns how many jobs that were.

    What has no note never became part of the table and is deleted.
    """
    path, begun = path.rstrip("/"), 0
    for name, _, _ in children(spark, f"{path}/{SWAP}"):
        aside = f"{path}/{SWAP}/{name}"
        if any(child == "note" for child, _, _ in children(spark, aside)):
            _carry_through(spark, path, aside)
            begun += 1
        else:
            files, target = _file_system(spark, aside)
            files.delete(target, True)
    return begun
