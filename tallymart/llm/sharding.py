"""Contiguous shards of near equal bytes, from prefix sums over range partitions.

Built-in functions only. Rows without their text are range partitioned, written once, and each
partition's total becomes the start of the next, so that the running sum of the whole table needs no
task that sees it all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, spread

#: Bytes that a row takes besides its text.
ROW_BYTES = 16


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text, and a row's own; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def running_totals(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Each of ``rows`` as the struct ``row``, with its ``size``, ``before`` (sum of ``size`` of earlier
    rows), ``index`` (their number) and ``total`` (sum of all), in the order of ``order``, nulls first.

    A random number is added to the order, so that a value which very many rows share is dealt over several
    partitions. The partition numbers are stored before they are used, as a range partitioning that
    runs again may set other bounds. A null size counts as 0; input columns may have any name.
    """
    spark = rows.sparkSession
    keys = [f"key_{i}" for i in range(len(order))]
    kept = rows.select(F.struct("*").alias("row"), F.coalesce(rows[size], F.lit(0)).cast("long").alias("size"),
                       *[rows[c].alias(k) for c, k in zip(order, keys)], F.rand(7).alias("tie"))
    dealt = (kept.repartitionByRange(spread(spark), *keys, "tie")
             .withColumn("part", F.spark_partition_id()))
    dealt = cut(dealt, "ranges")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(W.partitionBy(F.lit(0))).alias("total"))
    inside = W.partitionBy("part").orderBy(*keys, "tie").rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(F.broadcast(starts), "part").select(  # as many rows as partitions
        "row", "size", "total",
        (F.col("bytes_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("before"),
        (F.col("rows_before") + F.count("*").over(inside)).alias("index"))


def byte_shards(rows: DataFrame, order: list[str], size: str, n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 in each shard).

    Cuts lie at equal shares of all bytes: a row goes where its middle byte falls, so a shard differs
    from its target by at most half of the row at either end. Rows equal in ``order`` come in any
    order, the same for every use of the result. An empty table gives no rows; a row larger than a
    share leaves shards empty. Input columns called ``shard`` or ``slot`` are replaced, others stay
    whatever their names.
    """
    summed = running_totals(rows, order, size)
    shard = F.expr(f"least({n_shards - 1}L, ((2 * before + size) * {n_shards}) div greatest(1L, 2 * total))")
    placed = summed.withColumn("shard", shard.cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("index").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # n_shards rows
        *[F.col("row").getField(c).alias(c) for c in rows.columns if c not in ("shard", "slot")],
        "shard", (F.col("index") - F.col("first")).alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document, in the order of doc_id.

    A null text has no bytes, as an empty one; a null doc_id comes first; repeated rows are placed each; other
    columns are ignored. No documents give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", byte_size(F.col("text")).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return byte_shards(rows, ["doc_id"], "size", n_shards)
