"""Exact Jaccard join of shingle sets, pruned by vectors of shingle counts.

A document is the set of its distinct five-word shingles. Each set is also a point: shingles are
hashed into groups and counted. The sum of the lesser coordinates of two points bounds how much their
sets overlap, and boxes of points (leaves of a tree packed by size) bound all pairs below them.

Points in many dimensions alone leave nearly every box in reach of every other, so the boxes are
built inside blocks that lose no link: a set may only reach the threshold with another if both have
one of their first shingles in common, in an order that puts common shingles last. Equal sets are
one node throughout.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import cut, discard, map_batches, schema_with, sent, spread, text_steps
from .components import contracted, least_known

SIZE = 5
PERCENT = 75
#: Coordinates of a point of few shingles. A larger set's point has four times as many, and again, until
#: there is one for every DENSE shingles: in crowded groups all sets look alike.
GROUPS, DENSE = 256, 4
#: One document in so many is looked at to learn which shingles are common, how often a shingle must be
#: among them, and how many of the most common are told apart. The share is the same for any corpus, so the
#: number of documents that may share a rare shingle does not grow with it. These set the order of shingles,
#: never the result.
FIT_ONE_IN, FIT_LEAST, FIT_SHINGLES = 8, 3, 250_000
#: Shingles that a task compares at once, and points of a leaf.
BUCKET_SHINGLES, LEAF = 1_000_000, 512
#: Nodes up to which a list is compared as it is; a longer one is packed into leaves.
SHORT_LIST = 6
#: Members of a longer list that all others are compared with before its leaves are.
CENTRES = 8
#: Lists, the least by name, that a point is known to be in. They spare pairs met before, never the result.
KNOWN_LISTS = 16
#: Rounds in which the links known so far are contracted before the next pairs are chosen; the last of all
#: run to the end. More of them spare pairs, never change the result.
ROUNDS = 2
#: Document ids up to this number are sent to the scan of the texts; more are joined by shuffle.
SENT_IDS = 1_000_000


def shingle_sets(texts: pa.Array, size: int):
    """Sorted distinct shingles of each text, as 64-bit hashes."""
    for _, _, data, offsets in text_steps(texts):
        starts, ends, firsts = words.spans(data, offsets, words.SPACED)
        hashed = words.hashes(data, starts, ends, lower=True)
        for a, b in zip(firsts[:-1], firsts[1:]):
            yield np.unique(words.shingles(hashed[a:b], size))


def node_of(shingles: np.ndarray) -> int | None:
    """A number for a set: equal sets have the same one; the empty set has none."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little",
                          signed=True)


def point(shingles: np.ndarray) -> bytes:
    """Bytes of a count (1 or 4), then the counts by group."""
    groups = GROUPS
    while groups * DENSE < len(shingles):
        groups *= 4
    counts = np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups)
    wide = counts.max() > 255
    return (b"\4" if wide else b"\1") + counts.astype("<u4" if wide else np.uint8).tobytes()


def counts_of(blob: bytes, groups: int | None = None) -> np.ndarray:
    """The counts of a point, added up to ``groups`` coordinates."""
    counts = np.frombuffer(blob, "<u4" if blob[0] == 4 else np.uint8, offset=1)
    if groups and len(counts) > groups:
        counts = counts.reshape(-1, groups).sum(0, dtype=np.uint32)
    return counts


def overlap_bounds(some: list[bytes], others: list[bytes]) -> np.ndarray:
    """For each pair of points the sum of the lesser counts, in the coordinates that both have."""
    if all(len(blob) == GROUPS + 1 for blobs in (some, others) for blob in blobs):
        a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, GROUPS + 1)[:, 1:] for x in (some, others))
        return np.minimum(a, b).sum(1, dtype=np.int64)
    bounds = np.zeros(len(some), np.int64)
    for i, (p, q) in enumerate(zip(some, others)):
        p, q = counts_of(p), counts_of(q)
        groups = min(len(p), len(q))
        p, q = (x.reshape(-1, groups).sum(0, dtype=np.int64) for x in (p, q))
        bounds[i] = np.minimum(p, q).sum()
    return bounds


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of n and m with that Jaccard similarity."""
    return -(-percent * (n + m) // (100 + percent))


def first_shingles(n: int, percent: int) -> int:
    """How many of a set's first shingles any similar set must share one of."""
    return n - -(-percent * n // 100) + 1


def _nodes(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, node and point of every document."""

    def run(batch):
        sets = list(shingle_sets(batch.column(1), size))
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
            pa.array(map(node_of, sets), pa.int64()),
            pa.array(map(point, sets), pa.binary())],
            ["doc_id", "n_shingles", "node", "point"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run,
                       "doc_id long, n_shingles long, node long, point binary")


def _common(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of common shingles, and the place of each by frequency, the rarest first.

    Learnt from one document in FIT_ONE_IN, chosen by a hash of their id.
    """
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(FIT_ONE_IN)) == 0).select("text")

    def run(batch):
        sets = list(shingle_sets(batch.column(0), size))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(sets).view(np.int64))], ["shingle"])

    rows = (map_batches(sample, run, "shingle long").groupBy("shingle").count()
            .where(F.col("count") >= FIT_LEAST)
            .orderBy(F.desc("count"), "shingle").limit(FIT_SHINGLES).collect())
    hashed = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashed)
    return hashed[order], (len(rows) - 1 - order).astype(np.uint64)


def _ordered(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Keys that put a set's shingles in the one order of all: others by hash, then the common ones."""
    keys = words.mix(shingles) >> np.uint64(1)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], shingles), len(common[0]) - 1)
        known = common[0][at] == shingles
        keys[known] = (np.uint64(1) << np.uint64(63)) + common[1][at[known]]
    return keys


def _lists(docs: DataFrame, size: int, percent: int, common, buckets: int) -> DataFrame:
    """(list, node): the nodes that share one of their first shingles, equal lists once.

    First shingles go to buckets by hash, packed per Arrow batch; copies inside a batch once.
    """

    def pack(batch):
        keys, nodes, seen = [], [], set()
        for shingles in shingle_sets(batch.column(0), size):
            node = node_of(shingles)
            if node is None or node in seen:
                continue
            seen.add(node)
            ordered = _ordered(shingles, common)
            first = first_shingles(len(shingles), percent)
            keys.append(np.partition(ordered, first - 1)[:first])
            nodes.append(np.full(first, node, np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        nodes = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        keys = words.mix(keys)
        bucket = (keys % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        keys, nodes, bucket = keys[order], nodes[order], bucket[order]
        found, starts = np.unique(bucket, return_index=True)
        ends = np.append(starts[1:], len(bucket))
        return pa.RecordBatch.from_arrays([
            pa.array(found, pa.int32()),
            pa.array((keys[a:b].tobytes() for a, b in zip(starts, ends)), pa.binary()),
            pa.array((nodes[a:b].tobytes() for a, b in zip(starts, ends)), pa.binary())],
            ["bucket", "keys", "nodes"])

    def group(packed: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(packed.column("keys").to_pylist()), np.uint64)
        nodes = np.frombuffer(b"".join(packed.column("nodes").to_pylist()), np.int64)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[fresh], nodes[fresh]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(starts, len(keys)))
        names = words.mix(np.add.reduceat(words.mix(nodes.view(np.uint64)), starts)
                          + counts.astype(np.uint64))
        _, one_each = np.unique(names, return_index=True)
        taken = np.zeros(len(starts), bool)
        taken[one_each] = True
        taken = np.repeat(taken & (counts > 1), counts)
        return pa.table({"list": np.repeat(names, counts)[taken].view(np.int64),
                         "node": nodes[taken]})

    packed = map_batches(docs.select("text"), pack, "bucket int, keys binary, nodes binary")
    return (packed.groupBy("bucket").applyInArrow(group, "list long, node long")
            .dropDuplicates(["list", "node"]))


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b), each given once, whose points may overlap enough and whose sets do.

    ``nodes`` has a point and a document for each node.
    """

    def bounded(batch):
        n, m = (batch.column(i).to_numpy() for i in (4, 5))
        may = overlap_bounds(batch.column(2).to_pylist(), batch.column(3).to_pylist()) >= needed(n, m, percent)
        return batch.filter(pa.array(may)).select(["a", "b", "a_doc", "b_doc"])

    may = map_batches(
        pairs.join(nodes.select(F.col("node").alias("a"), F.col("point").alias("p"), "n",
                                F.col("doc_id").alias("a_doc")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("point").alias("q"), F.col("n").alias("m"),
                           F.col("doc_id").alias("b_doc")), "b")
        .select("a", "b", "p", "q", "n", "m", "a_doc", "b_doc"), bounded, "a long, b long, a_doc long, b_doc long")
    may = cut(may, "pairs")

    def packed(batch):
        """Sets of the asked nodes; an id on several rows may bring texts of other nodes."""
        kept = {}
        for node, shingles in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), size)):
            if node_of(shingles) == node:
                kept[node] = shingles.tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.int64()), pa.array(kept.values(), pa.binary())],
            ["node", "shingles"])

    asked = may.select(F.col("a").alias("node"), F.col("a_doc").alias("doc_id")).union(
        may.select("b", "b_doc")).distinct()
    asked = cut(asked, "asked")
    n_asked = asked.count()
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = texts.join(F.broadcast(asked) if n_asked <= SENT_IDS else asked, "doc_id")
    sets = cut(map_batches(found.select("node", "text"), packed, "node long, shingles binary"), "sets")

    def checked(batch):
        ok = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        return batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    # The greater node comes first: of a list it is in one pair, the least one in all of them.
    links = cut(map_batches(
        may.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
        .select("a", "b", "x", "y"), checked, "a long, b long"), "links")
    discard(may, asked, sets)
    return links


def _leaves(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members (list, band, node, root) with their points packed into leaves, each with its box.

    A size band spans one step of the threshold, so partners are in the same or the next band; a
    band with more than LEAF points is dealt over several leaves by hash. Points join last, as they
    are wide, and a leaf keeps a byte for a count where that holds all of its counts. A point comes with
    the first of its lists.
    """
    first = F.slice(F.sort_array(F.collect_set("list")), 1, KNOWN_LISTS).alias("first")
    known = nodes.select("node", "point").join(rows.groupBy("node").agg(first), "node")
    ids = rows.groupBy("list", "band").agg(F.ceil(F.count("*") / F.lit(LEAF)).alias("leaves"))
    dealt = rows.join(ids, ["list", "band"]).withColumn(
        "leaf", F.expr("pmod(xxhash64(node), leaves)")).join(known, "node")

    def pack(found: pa.Table) -> pa.Table:
        all_points = np.array([counts_of(p, GROUPS) for p in found.column("point").to_pylist()], "<u4")
        kept = all_points if all_points.max() > 255 else all_points.astype(np.uint8)
        first = np.full((len(found), KNOWN_LISTS), np.iinfo(np.int64).max)
        for i, names in enumerate(found.column("first").to_pylist()):
            first[i, :len(names)] = names
        blob = lambda name: found.column(name).to_numpy().astype(np.int64).tobytes()
        return pa.table({
            "list": found.column("list")[:1], "band": found.column("band")[:1],
            "leaf": found.column("leaf")[:1], "nodes": [blob("node")], "roots": [blob("root")],
            "firsts": [first.tobytes()], "points": [kept.tobytes()], "box": [all_points.max(0).tobytes()],
            "least": [int(all_points.sum(1, dtype=np.int64).min())]})

    return dealt.select("list", "band", "leaf", "node", "root", "point", "first").groupBy(
        "list", "band", "leaf").applyInArrow(
        pack, "list long, band long, leaf long, nodes binary, roots binary, firsts binary, "
              "points binary, box binary, least long")


def _crossing(leaves: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots inside a list whose points may overlap enough.

    Two leaves meet only if their boxes may; then each point of one is compared with the other leaf. Similar
    sets share many lists, but a pair is listed once: by the first list that both points are known to be in,
    where they meet as well.
    """
    left = leaves.select("list", *[F.col(c).alias(f"l_{c}") for c in leaves.columns[1:]])
    right = leaves.select("list", *[F.col(c).alias(f"r_{c}") for c in leaves.columns[1:]])
    met = left.join(right, "list").where(
        "r_band = l_band + 1 OR (r_band = l_band AND r_leaf >= l_leaf)")

    def leaf_points(blob, members):
        kind = np.uint8 if len(blob) == members * GROUPS else "<u4"
        return np.frombuffer(blob, kind).reshape(-1, GROUPS)

    def compare(batch):
        a_all, b_all = [], []
        for row in batch.to_pylist():
            boxes = np.minimum(*(np.frombuffer(row[f"{s}_box"], "<u4") for s in "lr")).sum()
            if boxes < needed(np.int64(row["l_least"]), np.int64(row["r_least"]), percent):
                continue
            (a, b), (x, y) = ([np.frombuffer(row[f"{s}_{name}"], np.int64) for s in "lr"]
                              for name in ("nodes", "roots"))
            p, q = (leaf_points(row[f"{s}_points"], len(ids)) for s, ids in (("l", a), ("r", b)))
            u, v = (np.frombuffer(row[f"{s}_firsts"], np.int64).reshape(-1, KNOWN_LISTS) for s in "lr")
            same_leaf = row["l_band"] == row["r_band"] and row["l_leaf"] == row["r_leaf"]
            p_size, q_size = (z.sum(1, dtype=np.int64) for z in (p, q))
            for i in range(len(p)):
                # Points are compared last, and only those of pairs that are not known or listed elsewhere.
                least = needed(p_size[i], q_size, percent)
                may = np.flatnonzero((y != x[i]) & (np.minimum(p_size[i], q_size) >= least))
                if same_leaf:
                    may = may[b[may] > a[i]]
                earlier = u[i][u[i] < row["list"]]
                if len(may) and len(earlier):
                    may = may[~np.isin(v[may], earlier).any(1)]
                if len(may):
                    may = may[np.minimum(p[i], q[may]).sum(1, dtype=np.int64) >= least[may]]
                a_all.append(np.full(len(may), a[i]))
                b_all.append(b[may])
        a, b = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a_all, b_all))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return map_batches(met, compare, "a long, b long")


def jaccard_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, node and root of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= ``percent`` * union of their shingle sets;
    component_id is the least doc_id that links reach, root a number for its component. In each list of nodes with a common first
    shingle all are compared with the least node first, and joined into components; in longer lists that
    are still apart, with a few more. Only lists whose nodes are still apart go on: all their pairs across components are bounded by their points, and those
    in reach are compared. So no link between components is lost, and members of one need no pairs.

    A text with fewer words than a shingle is one shingle; a null text or one without words has an
    empty set, linked with nothing. A row without id keeps its count, but counts for no link and has
    no component. Rows with the same id and text are one document, the same id with several texts
    several. Other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    rows = cut(_nodes(docs, size), "nodes")
    known = docs.where("doc_id IS NOT NULL")
    nodes = cut(rows.where("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(
        F.first("point").alias("point"), F.first("n_shingles").alias("n"),
        F.min("doc_id").alias("doc_id")), "points")
    wide, rows = rows, cut(rows.drop("point"), "nodes")
    discard(wide)
    shingles = nodes.agg(F.sum("n")).head()[0] or 0
    buckets = max(spread(spark, 16), math.ceil(shingles / 100 * (100 - percent) / BUCKET_SHINGLES))
    lists = _lists(known, size, percent, _common(known, size), buckets)
    lists = cut(lists.join(nodes.select("node", "n"), "node"), "lists")

    near_size = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    least = lists.groupBy("list").agg(F.min_by(F.struct("node", "n"), "node").alias("least"))
    near = lists.join(least.select("list", F.col("least.node").alias("a"), F.col("least.n").alias("m")), "list")
    near = near.where(f"a <> node AND {near_size}").select("a", F.col("node").alias("b")).distinct()
    near = cut(near, "near")
    edges = contracted(_verified(near, known, nodes, size, percent), ROUNDS)

    def apart(of: DataFrame) -> DataFrame:
        """Members of lists in which several components are known, with the least node known of their own."""
        roots = cut(least_known(edges), "roots")
        rooted = of.join(sent(roots), "node", "left").select(
            "list", "node", "n", F.coalesce("root", "node").alias("root"))
        still = rooted.groupBy("list").agg(
            F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("members")
        ).where("x <> y").select("list", "members")
        return cut(rooted.join(still, "list"), "apart")

    def joined(more: DataFrame, rounds: int | None = None) -> DataFrame:
        return contracted(more.unionByName(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), rounds)

    open_ = apart(lists)
    long = open_.where(F.col("members") > SHORT_LIST)
    chance = W.partitionBy("list").orderBy(F.xxhash64("node"), "node")
    centres = long.withColumn("_nth", F.row_number().over(chance)).where(F.col("_nth") <= CENTRES).select(
        "list", F.col("node").alias("c"), F.col("n").alias("m"), F.col("root").alias("r"))
    spokes = long.join(centres, "list").where(f"root <> r AND {near_size}").select(
        F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()
    spokes = cut(spokes, "spokes")
    edges = joined(_verified(spokes, known, nodes, size, percent), ROUNDS)
    open_ = apart(open_.select("list", "node", "n"))
    short = open_.where(F.col("members") <= SHORT_LIST)
    other = short.select("list", F.col("node").alias("b"), F.col("n").alias("m"), F.col("root").alias("r"))
    crossing = short.withColumnRenamed("node", "a").join(other, "list").where(
        f"a < b AND root <> r AND {near_size}").select("a", "b")
    step = math.log(100 / percent)
    long = open_.where(F.col("members") > SHORT_LIST).withColumn(
        "band", F.floor(F.log("n") / F.lit(step) + F.lit(1e-9)))
    crossing = crossing.unionByName(_crossing(_leaves(long, nodes), percent)).distinct()
    crossing = crossing.join(near.union(spokes), ["a", "b"], "left_anti")
    edges = joined(_verified(crossing, known, nodes, size, percent))

    discard(lists, near, spokes, open_, nodes)
    roots = cut(least_known(edges), "roots")
    placed = rows.join(sent(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.where("doc_id IS NOT NULL AND root IS NOT NULL").groupBy("root").agg(
        F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
        "node", "root")


def with_nodes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(row, node): the rows of ``docs`` with the number of their set, null for an empty one."""

    def run(batch):
        rows = batch.column(0)
        texts = rows.field(rows.type.get_field_index("text"))
        return pa.RecordBatch.from_arrays(
            [rows, pa.array(map(node_of, shingle_sets(texts, size)), pa.int64())], ["row", "node"])

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return map_batches(rows, run, schema_with(rows, ("node", T.LongType())))
