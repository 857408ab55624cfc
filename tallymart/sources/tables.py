"""Parquet tables: read, append, replace partitions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Fixed value: Spark's folder name for a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Tables:
    """Paths of the pipeline's tables under one root."""

    root: str

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def outbox(self) -> str:
        """Partitioned by sent_date."""
        return self._path("outbox")

    @property
    def message_rejects(self) -> str:
        """Messages that could not be typed, with the reason."""
        return self._path("message_rejects")

    @property
    def landing(self) -> str:
        """Typed messages as they came, partitioned by landed."""
        return self._path("landing")

    @property
    def ingest_batches(self) -> str:
        """What each batch of the stream held, by topic and partition."""
        return self._path("ingest_batches")

    @property
    def transactions(self) -> str:
        """Partitioned by load_date, event_date."""
        return self._path("transactions")

    @property
    def currencies(self) -> str:
        """Partitioned by load_date, event_date."""
        return self._path("currencies")

    @property
    def staging_rejects(self) -> str:
        """Payloads that broke the row contract; partitioned by object_type, load_date."""
        return self._path("staging_rejects")

    @property
    def global_metrics(self) -> str:
        """Partitioned by date_update."""
        return self._path("global_metrics")

    @property
    def bookmarks(self) -> str:
        """Partitioned by workflow_key, one row each."""
        return self._path("bookmarks")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves, in local mode only: on a cluster the executors
    could not reach it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tallymart-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``; no rows where nothing has been written yet."""
    stored = _stored(spark, path, schema)
    return spark.createDataFrame([], schema) if stored is None else stored


def laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition, in files of even size, sorted inside.

    The rebalance hint leaves the number of tasks to the runtime sizes: a partition with a third of
    all rows is split over many tasks, small partitions are merged. The sort lets row-group
    statistics skip data, and spares the writer its own sort by partition.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    else:
        df = df.hint("rebalance")
    return df.sortWithinPartitions(*partition_by, *sort_by) if partition_by or sort_by else df


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ()) -> None:
    (laid_out(df, partition_by, sort_by)
     .write.mode("append").partitionBy(*partition_by).parquet(path))


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       sort_by: Sequence[str] = ()) -> None:
    """Write ``df``, in place of the partitions it has rows for.

    They are written aside and swapped in when the job ends, so ``df`` may read the table itself, and
    a failed job changes nothing.
    """
    (laid_out(df, partition_by, sort_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def drop_partitions(spark: SparkSession, path: str, partition_by: Sequence[str],
                    partitions: Sequence[tuple]) -> None:
    """Delete the folders of partitions, through the file system alone: no job, and no file stays."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for values in partitions:
        folder = "/".join(f"{name}={NO_VALUE if value is None else value}"
                          for name, value in zip(partition_by, values))
        target = hadoop.Path(f"{path}/{folder}")
        target.getFileSystem(conf).delete(target, True)


def _filled_partitions(spark: SparkSession, path: str, schema: T.StructType,
                       partition_by: Sequence[str], scope: Column) -> dict[tuple, tuple[str, int]]:
    """Partitions in scope that hold rows: one of the file names, and the row count.

    No data column is read: values come from folder names, counts from file footers.
    """
    stored = _stored(spark, path, schema)
    if stored is None:
        return {}
    rows = (stored.where(scope).groupBy(*partition_by)
            .agg(F.min("_metadata.file_name"), F.count(F.lit(1))).collect())
    return {tuple(row)[:-2]: tuple(row)[-2:] for row in rows}


def replace_scope(
    df: DataFrame | None, path: str, schema: T.StructType, partition_by: Sequence[str],
    scope: Column, sort_by: Sequence[str] = (), *, spark: SparkSession | None = None,
) -> int:
    """Make ``df`` the whole content of the partitions that match ``scope``; returns their rows.

    ``replace_partitions`` leaves alone what gets no row; such partitions in scope are deleted
    afterwards. They are told by their file names, which change with every write. The lists are no
    longer than the number of partitions. Without ``df`` (give ``spark`` then) all are deleted.
    """
    spark = spark or df.sparkSession
    where = (spark, path, schema, list(partition_by), scope)
    before = _filled_partitions(*where)
    if df is None:
        after = before
    else:
        replace_partitions(df.select(*schema.names), path, partition_by, sort_by)
        after = _filled_partitions(*where)
    stale = [values for values, found in before.items() if after.get(values) == found]
    drop_partitions(spark, path, partition_by, stale)
    return sum(rows for values, (_, rows) in after.items() if values not in stale)
