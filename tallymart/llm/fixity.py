"""Merkle fixity audit of two replicas of an archive.

Records have an offset in a file. A leaf covers a fixed range of offsets; its digest is made of sums of
the words of its records' hashes, so it needs no order, and a crowded range is added up in each task
before the shuffle. A node's digest covers its children's in order. An audit compares roots and goes
down only where digests differ, to the records of the ranges that do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Offsets of a leaf, and children of a node.
SPAN, FANOUT = 256, 64


def record_hashes(records: DataFrame, file: str, offset: str, payload: list[str]) -> DataFrame:
    """file, offset and sha (of offset and payload) of each record.

    A null file or payload hashes unlike an empty one. A record without offset gets one from its hash,
    in a file of its own kind, so that such records do not crowd one range.
    """
    fields = [F.coalesce(F.concat(F.lit("="), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                                  F.col(c).cast("string")), F.lit("-")) for c in [offset, *payload]]
    sha = F.sha2(F.concat(*fields), 256)
    at = F.col(offset).cast("long")
    return records.select(
        F.concat(F.when(at.isNull(), "?").otherwise("="),
                 F.coalesce(F.col(file).cast("string"), F.lit("?"))).alias("file"),
        F.coalesce(at, F.pmod(F.xxhash64(sha), F.lit(1 << 40))).alias("offset"), sha.alias("sha"))


def _leaves(hashed: DataFrame, span: int) -> DataFrame:
    words = [F.sum(F.conv(F.substring("sha", 1 + 8 * i, 8), 16, 10).cast("long")).alias(f"w{i}")
             for i in range(8)]
    summed = hashed.groupBy("file", F.floor(F.col("offset") / span).alias("node")).agg(
        F.count("*").alias("n"), *words)
    digest = F.sha2(F.concat_ws(",", F.col("n").cast("string"),
                                *[F.col(f"w{i}").cast("string") for i in range(8)]), 256)
    return summed.select("file", "node", digest.alias("digest"))


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("node", "digest")))  # at most ``fanout``
    text = F.array_join(F.transform(children, lambda c: F.concat_ws(
        ":", c["node"].cast("string"), c["digest"])), ",")
    return nodes.groupBy("file", F.floor(F.col("node") / fanout).alias("parent")).agg(
        F.sha2(text, 256).alias("digest")).withColumnRenamed("parent", "node")


def merkle_levels(hashed: DataFrame, height: int, span: int = SPAN, fanout: int = FANOUT) -> list[DataFrame]:
    """Leaves first, then ``height`` levels of nodes (file, node, digest) above them."""
    levels = [cut(_leaves(hashed, span), "leaves")]
    for _ in range(height):
        levels.append(_parents(levels[-1], fanout))
    return levels


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    both = one.join(other.withColumnRenamed("digest", "other"), ["file", "node"], "full")
    return both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "node")


def audit(one: DataFrame, other: DataFrame, span: int = SPAN, fanout: int = FANOUT) -> DataFrame:
    """file, offset, sha, other_sha and state of the records in which two replicas differ.

    ``one`` and ``other`` come from ``record_hashes``. State is ``changed`` (the offset has one record
    here and one there), ``missing`` (not in ``other``) or ``extra`` (not in ``one``); of several
    records at an offset, those without an equal one are missing or extra, each kind of hash once with
    its surplus as ``n``. Equal replicas, and two empty ones, give no rows.
    """
    last = reduce(max, [df.agg(F.max("offset")).head()[0] or 0 for df in (one, other)])
    height, top = 0, last // span
    while top > 0:
        top //= fanout
        height += 1
    ours, theirs = (merkle_levels(df, height, span, fanout) for df in (one, other))
    bad = _differing(ours[-1], theirs[-1])
    for level in range(height - 1, -1, -1):
        parents = bad.select("file", F.col("node").alias("parent"))
        under = [side[level].withColumn("parent", F.floor(F.col("node") / fanout)).join(
            parents, ["file", "parent"], "left_semi").drop("parent") for side in (ours, theirs)]
        bad = cut(_differing(*under), f"level{level}")
    ranges = bad.distinct()
    counted = [df.withColumn("node", F.floor(F.col("offset") / span))
               .join(ranges, ["file", "node"], "left_semi")
               .groupBy("file", "offset", "sha").count() for df in (one, other)]
    surplus = counted[0].unionByName(counted[1].withColumn("count", -F.col("count"))).groupBy(
        "file", "offset", "sha").agg(F.sum("count").alias("n")).where("n <> 0")
    sides = surplus.groupBy("file", "offset").agg(
        F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0)).alias("here"),
        F.sum(F.when(F.col("n") < 0, -F.col("n")).otherwise(0)).alias("there"),
        F.max(F.when(F.col("n") > 0, F.col("sha"))).alias("sha_here"),
        F.max(F.when(F.col("n") < 0, F.col("sha"))).alias("sha_there"))
    changed = sides.where("here = 1 AND there = 1").select(
        "file", "offset", F.col("sha_here").alias("sha"), F.col("sha_there").alias("other_sha"),
        F.lit("changed").alias("state"), F.lit(1).cast("long").alias("n"))
    rest = surplus.join(sides.where("here <> 1 OR there <> 1").select("file", "offset"),
                        ["file", "offset"], "left_semi")
    here = F.col("n") > 0
    rest = rest.select(
        "file", "offset", F.when(here, F.col("sha")).alias("sha"),
        F.when(~here, F.col("sha")).alias("other_sha"),
        F.when(here, "missing").otherwise("extra").alias("state"), F.abs("n").alias("n"))
    return changed.unionByName(rest)
