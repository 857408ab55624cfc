"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, verified.

A vector's hash is the axis, with its sign, that the vector lies closest to after a pseudo-random rotation:
three rounds of random signs and a Hadamard transform. A bucket is told by several such hashes, the more
the more vectors there are, so that buckets stay small. Each vector stands in its own bucket of each table
and looks into the next best ones as well (probes). In a bucket all residents are compared with all others
exactly; links are counted there, and never leave it as pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, join_members, lists, schema_with, slices
from .components import components

COSINE = 0.9
TABLES, PROBES = 10, 3
#: The number of hashes of a bucket is the least one that leaves so many vectors to a bucket on average.
BUCKET_VECTORS = 256
#: Rows compared at once; a bucket of more is split. Beyond MOST_SPLIT times as many rows it grows with the
#: input, so that the list of buckets to split has a bound.
BLOCK_ROWS, MOST_SPLIT = 4_096, 200_000
#: Cosines that a task holds at once.
BLOCK_COSINES = 1_000_000

_FOUND = "id long, key long, links long, to_id long, to_key long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the orthonormal Hadamard matrix; the width is a power of two."""
    width, step = x.shape[1], 1
    while step < width:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        step *= 2
    return x.reshape(-1, width) / math.sqrt(width)


def _rotated(x: np.ndarray, table: int, place: int) -> np.ndarray:
    """Rows padded to a power of two and rotated; the rotation is told by table and place alone."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    rng = np.random.default_rng([table, place])
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], width))
    return x


def n_hashes(n_vectors: int, width: int) -> int:
    """Hashes to a bucket for so many vectors of a width."""
    axes = 2 << max(0, width - 1).bit_length()
    return max(1, math.ceil(math.log(max(1, n_vectors / BUCKET_VECTORS)) / math.log(axes)))


def bucket_codes(x: np.ndarray, table: int, hashes: int, probes: int = PROBES) -> np.ndarray:
    """For each row its bucket, and then the ones that it would nearly have been in, the nearest first.

    A bucket that differs in a hash costs what the rotated vector lacks there of its largest entry. A row
    with fewer buckets than ``probes`` (width 1) repeats -1.
    """
    codes, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for place in range(hashes):
        y = _rotated(x, table, place)
        size = np.abs(y)
        best = np.argsort(-size, axis=1, kind="stable")[:, :probes]
        axis = 2 * best + (np.take_along_axis(y, best, 1) < 0)
        lack = size.max(axis=1, keepdims=True) - np.take_along_axis(size, best, 1)
        codes = (codes[:, :, None] * (2 * y.shape[1]) + axis[:, None]).reshape(len(x), -1)
        cost = (cost[:, :, None] + lack[:, None]).reshape(len(x), -1)
        keep = np.argsort(cost, axis=1, kind="stable")[:, :probes]  # no worse part makes a better whole
        codes, cost = np.take_along_axis(codes, keep, 1), np.take_along_axis(cost, keep, 1)
    return np.pad(codes, ((0, 0), (0, probes - codes.shape[1])), constant_values=-1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashed(hashes: dict[int, int]):
    """Adds the buckets of all tables; rows are (id, key, members, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            offsets, values = lists(batch.column("vector"))
            sizes = np.diff(offsets)
            codes = np.full((len(sizes), TABLES * PROBES), -1, np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = _unit(values[offsets[rows][:, None] + np.arange(size)])
                codes[rows] = np.hstack([bucket_codes(x, t, hashes[int(size)]) for t in range(TABLES)])
            listed = pa.ListArray.from_arrays(
                np.arange(0, codes.size + 1, TABLES * PROBES, dtype=np.int32), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "codes"])

    return run


def _met(i: np.ndarray, j: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the pairs (i, j) met in a table with these buckets: one looked into the other's own."""
    return (codes[i] == codes[j, :1]).any(1) | (codes[j] == codes[i, :1]).any(1)


def _links(x, own, resident, order, split, table, hashes, cosine):
    """Pairs (i, j) linked in one block, each pair in one block of one table only.

    ``order`` ranks the vectors. A pair belongs to the first table in which it met, there to the bucket where
    both reside, or else to the resident's of lesser rank.
    """
    home = np.flatnonzero(resident)
    step = max(1, BLOCK_COSINES // len(x))
    for start in range(0, len(home), step):
        rows = home[start:start + step]
        i, j = np.nonzero(x[rows] @ x.T >= cosine)
        i = rows[i]
        take = ~resident[j] | (order[i] < order[j])
        take &= (own[i] != own[j]) if split else (i != j)
        i, j = i[take], j[take]
        if not len(i):
            continue
        # What met before goes table by table: few pairs are left after the first ones.
        i, j = _unseen(i, j, lambda a, b, codes: (
            ~resident[j] & (codes[a] == codes[b, :1]).any(1) & (order[j] < order[i])), x, table, hashes)
        for earlier in range(table):
            i, j = _unseen(i, j, _met, x, earlier, hashes)
        if len(i):
            yield i, j


def _unseen(i, j, met, x, table, hashes):
    """The pairs (i, j) that did not meet by the buckets of a table."""
    if not len(i):
        return i, j
    among, place = np.unique(np.concatenate((i, j)), return_inverse=True)
    left = ~met(place[:len(i)], place[len(i):], bucket_codes(x[among], table, hashes))
    return i[left], j[left]


def _least(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least row that each of n rows reaches by the pairs."""
    label = np.arange(n)
    while True:
        last = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        label = label[label]
        if (label == last).all():
            return label


def _compared(table: int, hashes: dict[int, int], cosine: float):
    """Links within the blocks of a bin: for each vector their number, and the least one it reaches."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("size", "code", "a", "b", "id", "key")])
        columns = {c: rows.column(c).to_numpy() for c in ("size", "code", "a", "b", "own", "home", "id", "key", "members")}
        offsets, values = lists(rows.column("vector"))
        changes = [np.diff(columns[c]) != 0 for c in ("size", "code", "a", "b")]
        starts = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce(changes)))) if len(rows) else []
        out = []
        for start, end in zip(starts, [*starts[1:], len(rows)]):
            if end - start < 2 or not columns["home"][start:end].any():
                continue
            block = {c: v[start:end] for c, v in columns.items()}
            size = int(block["size"][0])
            x = _unit(values[offsets[start]:offsets[end]].reshape(-1, size))
            # Sorted by id and key, a row's place is its rank.
            for i, j in _links(x, block["own"], block["home"], np.arange(len(x)), block["a"][0] != block["b"][0],
                               table, hashes[size], cosine):
                links = np.bincount(i, block["members"][j], len(x)) + np.bincount(j, block["members"][i], len(x))
                least = _least(i, j, len(x))
                some = np.flatnonzero(links)
                to = least[some]
                out.append([block["id"][some], block["key"][some], links[some].astype(np.int64),
                            block["id"][to], block["key"][to]])
        parts = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.Table.from_arrays([pa.array(c) for c in parts], ["id", "key", "links", "to_id", "to_key"])

    return run


def _valid(vector: str):
    """No null, no entry that is null or not finite, and not all zero."""
    entry = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == math.inf)
    col = F.col(vector)
    return F.coalesce(~F.exists(col, entry) & F.exists(col, lambda x: x != 0), F.lit(False))


def _dealt(hashed: DataFrame, large: DataFrame, table: int, bins: int) -> DataFrame:
    """Each vector in its bucket of a table and those it looks into; large buckets as a grid of blocks.

    The rows of a large bucket are spread over slices; a block has the rows of two slices, so that any two
    rows meet in one block.
    """
    own = F.slice("codes", table * PROBES + 1, PROBES)
    rows = hashed.select("id", "key", "members", "vector", F.size("vector").alias("size"),
                         F.posexplode(own).alias("probe", "code")).where("code >= 0")
    here = F.broadcast(large.where(F.col("t") == table).drop("t"))
    n_slices = F.coalesce("slices", F.lit(1))
    rows = rows.join(here, ["size", "code"], "left").withColumn(
        "own", F.pmod(F.xxhash64("id", "key"), n_slices).cast("int"))
    others = F.transform(F.sequence(F.lit(0), n_slices.cast("int") - 1), lambda s: F.struct(
        F.least("own", s).alias("a"), F.greatest("own", s).alias("b")))
    return rows.select("id", "key", "members", "vector", "size", "code", "own",
                       (F.col("probe") == 0).alias("home"), F.inline(others)).withColumn(
        "bin", F.pmod(F.xxhash64("size", "code", "a", "b"), F.lit(bins)))


def near_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                 cosine: float = COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings``.

    ``n_links`` counts the other rows with cosine ``cosine`` or more, in double precision; what the tables
    miss is not counted (about 1 in 1000 pairs at the threshold, fewer above it). ``component_id`` is the
    least id that can be reached by links, ``kept`` tells whether it is the row's own. A vector that is
    null, empty, zero, or has an entry that is null or not finite has no links; vectors of different lengths
    are not linked. Equal vectors are compared once and counted as often as they stand; a repeated row, also
    of the same id, is another row. A null id is less than any other. Other columns do not matter.
    """
    spark = embeddings.sparkSession
    kind = dict(embeddings.dtypes)[vector]
    vectors = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    source = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), vectors.alias("vector"))
    told = [F.when(_valid("vector"), F.xxhash64(F.lit(seed), "vector")).alias(name)
            for seed, name in ((1, "key"), (2, "key2"))]
    rows = cut(source.select("vec_id", *told), "vector_rows")
    # Equal vectors are one, however many there are. Nodes are told by their least id and a hash.
    least_id = F.coalesce(F.min("vec_id"), F.lit(-(1 << 63))).alias("id")
    distinct = cut(
        source.where(_valid("vector")).withColumn("none", F.col("vec_id").isNull())
        .groupBy("vector").agg(least_id, F.count(F.lit(1)).alias("members"), F.bool_or("none").alias("none"))
        .select(F.when(F.col("none"), F.lit(-(1 << 63))).otherwise(F.col("id")).alias("id"),
                F.xxhash64(F.lit(1), "vector").alias("key"), F.xxhash64(F.lit(2), "vector").alias("key2"),
                "members", "vector"),
        "distinct_vectors")
    sizes = {r["size"]: r["n"] for r in distinct.groupBy(F.size("vector").alias("size")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    hashes = {size: n_hashes(n, size) for size, n in sizes.items()}
    n_rows = sum(sizes.values()) * PROBES
    block_rows = max(block_rows, n_rows // MOST_SPLIT)
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // block_rows + 1)

    bare = distinct.select("id", "key", "members", "vector")
    schema = schema_with(bare, ("codes", T.ArrayType(T.LongType())))
    hashed = cut(bare.mapInArrow(_hashed(hashes), schema), "hashed_vectors")
    counted = hashed.select(F.size("vector").alias("size"), F.posexplode("codes").alias("place", "code")).where("code >= 0")
    large = cut(
        counted.groupBy(F.floor(F.col("place") / PROBES).cast("int").alias("t"), "size", "code")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
        .select("t", "size", "code", F.ceil(F.col("n") / block_rows).cast("int").alias("slices")), "large_buckets")
    # Table by table, so that the copies of the vectors of one table only are on the move at a time.
    found = [cut(_dealt(hashed, large, t, bins).groupBy("bin").applyInArrow(_compared(t, hashes, cosine), _FOUND),
                 "vector_links") for t in range(TABLES)]
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)

    node = lambda i, k: F.struct(F.col(i).alias("id"), F.col(k).alias("key"))
    roots = components(links.select(node("id", "key").alias("a"), node("to_id", "to_key").alias("b")))
    counts = links.groupBy("id", "key").agg(F.sum("links").alias("links"))
    roots = roots.select("node.id", "node.key", F.col("root.id").alias("root"))
    known = distinct.select("id", "key", "key2", "members").join(counts, ["id", "key"], "left").join(
        roots, ["id", "key"], "left")
    known = cut(known.select(
        "key", "key2", "members", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.nullif(F.coalesce("root", "id"), F.lit(-(1 << 63))).alias("component_id")), "known_vectors")
    compared = join_members(rows.where("key IS NOT NULL"), known, ["key", "key2"], "members")
    alone = rows.where("key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return compared.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
