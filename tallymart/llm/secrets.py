"""Secret scan: patterns find candidates, corpus-wide ownership tells live ones from examples.

A value that many owners have is an example from some manual; one that few owners have and that looks
random may be live. Values are counted as hashes, by distinct repositories and owners.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches

#: The kinds of candidates, in this order, and their patterns.
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
OPAQUE = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
ASSIGN_LEAST = 12
#: What an assignment's text must have, in lower case, for the pattern to be tried.
NAMES = (b"passw", b"secret", b"token", b"apikey", b"api_key")

#: An opaque string needs so many bits a character to look random.
OPAQUE_BITS = 3.5
#: From so many owners on a value is an example.
EXAMPLE_OWNERS = 3


def _random_looking(value: bytes) -> bool:
    counts = Counter(value).values()
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    return (bits >= OPAQUE_BITS and re.search(rb"[0-9]", value) is not None
            and re.search(rb"[a-z]", value) is not None and re.search(rb"[A-Z]", value) is not None)


def scan(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, kind, end, value) of the candidates of a text, in bytes, by start and kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = [(a, b) for a, _, b, _ in found]
    found += [(m.start(), 3, m.end(), m[0]) for m in OPAQUE.finditer(text)
              if _random_looking(m[0]) and not any(m.start() < b and a < m.end() for a, b in taken)]
    return sorted(found)


def _candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (its other columns) with found: kind, start and end in code points, hash of the value."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("value", pa.int64())]))

    def run(batch):
        out = []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            data = (text or "").encode("utf-8", "surrogatepass")
            spans = scan(data)
            if spans and not data.isascii():
                before = np.zeros(len(data) + 1, np.int64)
                np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, out=before[1:])
                spans = [(int(before[a]), k, int(before[b]), v) for a, k, b, v in spans]
            out.append([{"kind": KINDS[k], "start": a, "end": b, "value": int.from_bytes(
                hashlib.blake2b(v, digest_size=8).digest(), "little", signed=True)}
                for a, k, b, v in spans])
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, kind)],
                                          [*batch.schema.names[:-1], "found"])

    return map_batches(docs, run, "doc_id long, repository string, owner string, "
                       "found array<struct<kind:string,start:long,end:long,value:long>>")


def owner_of(repository: Column) -> Column:
    """What stands before the first slash of a repository's name; the whole name without one."""
    return F.substring_index(repository, "/", 1)


def find_secrets(docs: DataFrame, repository: str = "source", owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """doc_id and found of every row of ``docs`` (doc_id, text and ``repository``).

    ``found`` has kind, start, end (code points, end exclusive), n_repositories and n_owners of its
    value, and live: fewer than ``owners`` owners have the value. Opaque strings that are not live are
    left out; other kinds stay. A null or empty text has none, a very long one is scanned whole; a null
    repository counts as one owner of no name. Repeated rows are found each and are one owner. Other columns
    are ignored, whatever their names. No rows give no rows.
    """
    named = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        "text")
    rows = _candidates(named.select("doc_id", "repository", owner_of(F.col("repository")).alias("owner"), "text"))
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "candidates")
    each = rows.select("_row", "repository", "owner", F.inline("found"))
    owned = (each.groupBy("value", "repository", "owner").agg(F.lit(1).alias("_one"))
             .groupBy("value", "owner").agg(F.count("*").alias("_n"))
             .groupBy("value").agg(F.sum("_n").alias("n_repositories"), F.count("*").alias("n_owners")))
    judged = each.join(owned, "value").withColumn("live", F.col("n_owners") < owners).where(
        (F.col("kind") != "opaque") | F.col("live"))
    order = F.when(F.col("kind") == KINDS[0], 0).when(F.col("kind") == KINDS[1], 1).when(
        F.col("kind") == KINDS[2], 2).otherwise(3)
    spans = judged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
        "start", order.alias("nth"), "kind", "end", "n_repositories", "n_owners", "live"))).alias("found"))
    return rows.select("_row", "doc_id").join(spans, "_row", "left").select(
        "doc_id", F.coalesce("found", F.expr("array()").cast(spans.schema["found"].dataType)).alias("found"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def base(found: Column) -> Column:
    return F.filter(found, lambda x: x["kind"] != "opaque")


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
