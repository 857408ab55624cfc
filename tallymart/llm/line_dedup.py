"""Line deduplication by winnowing: selected line hashes as fingerprints, their places joined and extended.

A window is the shortest stretch of lines from some line on, or up to some line, that has MIN_WORDS words.
Its least line hash is selected, once for all the windows that have it there. A run of that many words that
stands at two places holds equal windows, so the same line of it is selected at both: the places of a
fingerprint are compared, and equal lines followed both ways, as far as the windows it was selected for go.
Beyond those the run is in other windows, with a fingerprint of their own.

A fingerprint of more than FEW_PLACES places is split by its neighbours: each of its windows is a key of its
own, with the content hashed. All windows of a key are equal, so the first place is a partner for all others.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, join_members, map_batches

MIN_WORDS = 50
#: Places of a fingerprint that are compared with each other; with more, its windows are joined by content.
FEW_PLACES = 16
#: Documents with deletions, and runs in them, up to this number are sent to the scan of the texts.
SENT_ROWS = 100_000

_PLACE = ("_k long, _t long, fingerprint long, at int, hashes array<long>, lines array<int>, words array<int>, "
          "before int, after int")
_MATCH = "_k long, _t long, first int, last int"


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _windows(words: np.ndarray, min_words: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """First and last line of the windows from each line on, and of those up to each line."""
    before, n = np.concatenate([[0], np.cumsum(words, dtype=np.int64)]), len(words)
    ends = np.searchsorted(before, before[:-1] + min_words, "left") - 1
    starts = np.searchsorted(before, before[1:] - min_words, "right") - 1
    return ([(a, b) for a, b in enumerate(ends.tolist()) if b < n],
            [(a, b) for b, a in enumerate(starts.tolist()) if a >= 0])


def _minima(hashes: list[int], windows: list[tuple[int, int]]) -> Iterator[int]:
    """Place of the least hash in each window, the last such; neither end of the windows ever goes back."""
    rising, seen = deque(), 0
    for first, last in windows:
        while seen <= last:
            while rising and hashes[rising[-1]] >= hashes[seen]:
                rising.pop()
            rising.append(seen)
            seen += 1
        while rising[0] < first:
            rising.popleft()
        yield rising[0]


def select(hashes: list[int], words: np.ndarray, min_words: int) -> dict[int, tuple[int, int]]:
    """The selected lines, each with the first and the last line of the windows it was selected for."""
    found: dict[int, tuple[int, int]] = {}
    for windows in _windows(words, min_words):
        for (first, last), at in zip(windows, _minima(hashes, windows)):
            a, b = found.get(at, (first, last))
            found[at] = min(a, first), max(b, last)
    return found


def _places(text: str, min_words: int) -> Iterator[tuple]:
    """at, hashes, lines, words, before and after of each selected line.

    Lines without words are told by the numbers of the others, and by how many there are before the first
    and after the last of a stretch.
    """
    texts = text.split("\n")
    counts = [len(line.split()) for line in texts]
    if sum(counts) < min_words:
        return
    lines = [i for i, count in enumerate(counts) if count]
    words = np.array([counts[i] for i in lines])
    hashes = [_hash(texts[i].strip().encode("utf-8", "surrogatepass")) for i in lines]
    edges = [-1, *lines, len(texts)]
    for at, (a, b) in select(hashes, words, min_words).items():
        yield (hashes[at], at - a, hashes[a:b + 1], lines[a:b + 1], words[a:b + 1].tolist(),
               edges[a + 1] - edges[a] - 1, edges[b + 2] - edges[b + 1] - 1)


def _selected(keyed: DataFrame, min_words: int) -> DataFrame:
    """One row for each selected line of each document."""

    def run(batch):
        rows, found = [], []
        for row, text in enumerate(batch.column(2).to_pylist()):
            places = list(_places(text, min_words))
            rows += [row] * len(places)
            found += places
        at = pa.array(rows, pa.int64())
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()),
                 pa.int32(), pa.int32())
        columns = [pa.array([place[i] for place in found], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), *columns],
            ["_k", "_t", "fingerprint", "at", "hashes", "lines", "words", "before", "after"])

    return map_batches(keyed.where("text IS NOT NULL").select("_k", "_t", "text"), run, _PLACE)


def _gap(place: dict, i: int) -> int:
    """Lines without words before the i-th line of a stretch; after the last one for its length."""
    lines = place["lines"]
    if i == 0:
        return place["before"]
    return place["after"] if i == len(lines) else lines[i] - lines[i - 1] - 1


def extend(own: dict, other: dict, min_words: int) -> tuple[int, int] | None:
    """First and last line of the run that two places share, or None if it has too few words."""
    a, b, shift = own["at"], own["at"], other["at"] - own["at"]
    mine, theirs = own["hashes"], other["hashes"]
    while (a > 0 and a + shift > 0 and _gap(own, a) == _gap(other, a + shift)
           and mine[a - 1] == theirs[a + shift - 1]):
        a -= 1
    while (b + 1 < len(mine) and b + 1 + shift < len(theirs) and _gap(own, b + 1) == _gap(other, b + 1 + shift)
           and mine[b + 1] == theirs[b + 1 + shift]):
        b += 1
    if sum(own["words"][a:b + 1]) < min_words:
        return None
    return (own["lines"][a] - min(_gap(own, a), _gap(other, a + shift)),
            own["lines"][b] + min(_gap(own, b + 1), _gap(other, b + 1 + shift)))


def _matches(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["_k", "_t", "first", "last"])


def _compared(selected: DataFrame, groups: DataFrame, min_words: int) -> DataFrame:
    """Runs that places of a fingerprint share with earlier ones, all of them compared."""

    def run(batch):
        found = set()
        for places in batch.column(0).to_pylist():
            places.sort(key=lambda p: (p["_k"], p["_t"], p["lines"][p["at"]]))
            for i, own in enumerate(places):
                for other in places[:i]:
                    same = (own["_k"], own["_t"]) == (other["_k"], other["_t"])
                    if same and own["lines"][own["at"]] == other["lines"][other["at"]]:
                        continue  # a repeated row
                    shared = extend(own, other, min_words)
                    if shared:
                        found.add((own["_k"], own["_t"], *shared))
        return _matches(list(found))

    few = selected.join(groups.where(F.col("n") <= FEW_PLACES).select("fingerprint"), "fingerprint")
    place = F.struct("_k", "_t", "at", "hashes", "lines", "words", "before", "after")
    together = few.groupBy("fingerprint").agg(F.collect_list(place).alias("places"))  # at most FEW_PLACES
    return map_batches(together.select("places"), run, _MATCH)


def _contents(place: dict, min_words: int) -> Iterator[tuple[int, int, int]]:
    """First line, last line and content of the windows that a place was selected for.

    Lines without words at an end of a window count by their number, each number as a window of its own.
    """
    hashes, lines = place["hashes"], place["lines"]
    seen = set()
    for windows in _windows(np.array(place["words"]), min_words):
        for (a, b), at in zip(windows, _minima(hashes, windows)):
            if at != place["at"] or (a, b) in seen:
                continue
            seen.add((a, b))
            inside = np.array([*hashes[a:b + 1], *(x - lines[a] for x in lines[a:b + 1])], np.int64).tobytes()
            yield lines[a], lines[b], _hash(inside)
            for sign, i in ((-1, a), (1, b + 1)):
                for n in range(1, _gap(place, i) + 1):
                    content = _hash(inside + np.array([sign * n], np.int64).tobytes())
                    yield (lines[a] - n, lines[b], content) if sign < 0 else (lines[a], lines[b] + n, content)


def _by_content(selected: DataFrame, groups: DataFrame, min_words: int) -> tuple[DataFrame, ...]:
    """Windows that stand earlier, of fingerprints with many places; and what was stored for it."""

    def run(batch):
        for start in range(0, batch.num_rows, 1000):
            rows = [(p["fingerprint"], content, p["_k"], p["_t"], first, last)
                    for p in batch.slice(start, 1000).to_pylist()
                    for first, last, content in _contents(p, min_words)]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                ["fingerprint", "content", "_k", "_t", "first", "last"])

    def batches(source):
        for batch in source:
            yield from run(batch)

    many = join_members(selected, groups.where(F.col("n") > FEW_PLACES), ["fingerprint"], "n").drop("n")
    windows = cut(many.mapInArrow(
        batches, "fingerprint long, content long, _k long, _t long, first int, last int"), "windows")
    earliest = cut(windows.groupBy("fingerprint", "content").agg(
        F.min(F.struct("_k", "_t", "first")).alias("source"), F.count("*").alias("n")).where("n > 1"), "earliest")
    later = join_members(windows, earliest, ["fingerprint", "content"], "n").where(
        F.struct("_k", "_t", "first") > F.col("source"))
    return later.select("_k", "_t", "first", "last"), windows, earliest


def _joined(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of the lines that are in any of the matches."""
    out = []
    for matches in batch.column(2).to_pylist():
        runs = []
        for match in sorted(matches, key=lambda m: m["first"]):
            if runs and match["first"] <= runs[-1]["last"] + 1:
                runs[-1]["last"] = max(runs[-1]["last"], match["last"])
            else:
                runs.append(match)
        out.append(runs)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)],
                                      ["_k", "_t", "runs"])


def repeated_runs(keyed: DataFrame, min_words: int) -> DataFrame:
    """_k, _t and runs (first and last line) of documents that repeat what stands earlier."""
    selected = cut(_selected(keyed, min_words), "selected")
    groups = cut(selected.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    later, *stored = _by_content(selected, groups, min_words)
    matches = _compared(selected, groups, min_words).unionByName(later).distinct()
    matches = matches.groupBy("_k", "_t").agg(F.collect_list(F.struct("first", "last")).alias("matches"))
    found = cut(map_batches(
        matches, _joined, "_k long, _t long, runs array<struct<first:int,last:int>>"), "runs")
    discard(selected, groups, *stored)
    return found


def deduplicate_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text and others) without later repeated runs; adds n_lines and n_deleted.

    A run is consecutive lines, of ``min_words`` words or more, that also stand in a document of
    lesser doc_id (ties: by a hash of the text) or earlier in the same one. Lines are compared without
    white space at their ends. All places are judged by the texts as given, so a run may overlap its source,
    and an earlier place may itself lose lines to one before it. No line goes from the first place it has in
    the corpus, but a run stands nowhere whole if its lines are parts of several earlier runs. A document
    that loses all its lines gets an empty text. Rows without id come first; rows with the same id and text
    are one document and lose the same lines. A null text stays null and has no lines, an empty one has one;
    very long texts are read whole. Columns called n_lines or n_deleted are replaced, others stay.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_deleted")]
    keyed = docs.select(
        F.struct(*kept).alias("_row"), F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("_k"),
        F.xxhash64("text").alias("_t"))
    runs = repeated_runs(keyed, min_words)
    few = (runs.agg(F.count("*") + F.sum(F.size("runs"))).first()[0] or 0) <= SENT_ROWS
    found = keyed.join(F.broadcast(runs) if few else runs, ["_k", "_t"], "left")
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda _, i: ~F.exists(
        "runs", lambda r: (i >= r["first"]) & (i <= r["last"])))
    touched = F.col("runs").isNotNull()
    n_lines = F.when(F.col("text").isNotNull(), F.size(lines)).otherwise(0).cast("long")
    found = found.withColumn("_left", F.when(touched, left))
    text = F.when(touched, F.array_join("_left", "\n")).otherwise(F.col("text"))
    deleted = F.when(touched, n_lines - F.size("_left")).otherwise(0).cast("long")
    return found.withColumn("_row", F.col("_row").withField("text", text)).select(
        "_row.*", n_lines.alias("n_lines"), deleted.alias("n_deleted"))
