"""Messages from files, as a stand-in for a topic, and the CSV interchange format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import CSV_NULL, CSV_TIMESTAMP, MESSAGES


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None,
                  file_format: str = "parquet") -> DataFrame:
    """A folder of files with (value, partition, offset) as a stream."""
    reader = spark.readStream.schema(MESSAGES).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


# Inner quotes are doubled and surrounding blanks kept, as in the common CSV dialect.
_CSV = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": CSV_NULL,
    "timestampNTZFormat": CSV_TIMESTAMP,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Comma CSV without header. Files are kept small, because ``read_csv`` cannot split one."""
    (df.write.mode("overwrite").options(**_CSV)
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             line_breaks: bool = True) -> DataFrame:
    """Typed rows; a value that does not fit its type fails the query.

    With ``line_breaks`` a field may hold one inside quotes, and each file is one task; without, files
    of any size are split.
    """
    return (spark.read.schema(schema).options(**_CSV)
            .option("multiLine", str(line_breaks).lower()).option("mode", "FAILFAST").csv(path))
