"""Spelling variants: the words of a corpus that are one inserted, deleted or replaced letter apart.

The vocabulary is a minimal acyclic acceptor A. Composed with E, which copies its input but for at most
one edit, and with A again, it accepts the pairs of words one edit apart. A composed state is (p, e, q):
p and q are states of A, e tells whether the edit is spent. While it is unspent both copies read the same
letters, so p = q. The work is split there: a part of the composition is entered at the state that a
word's first letters lead to, so pairs that part later meet in one part; pairs that part within these
letters meet in the composition of the reversed words. A part of too many words is left at its state by
one arc: pairs that spend the edit on this arc must be equal after it and are joined by the rest of the
word, which at most as many words share as there are letters; all others go on in smaller parts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard, slices

LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A near word is a word's form if it is so many times as frequent.
TIMES = 5
#: Words of a part that one automaton is built of; a larger part is split. Beyond MOST_PARTS times as many
#: words it grows with the vocabulary, so that the list of parts to split has a bound.
PART_WORDS, MOST_PARTS = 20_000, 50_000
#: Distinct words a task counts before it passes its counts on, and their bytes.
HELD_WORDS, HELD_BYTES = 200_000, 16_000_000

_PAIRS = "word string, n long, near string, near_n long"


def word_counts(docs: DataFrame, drop_every: int | None = None, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): occurrences of each run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case.

    With ``drop_every`` a run whose crc32 of ``doc_id:run`` that number divides loses the code point at the
    crc modulo the run's length: misspellings of a known rate. Runs of fewer than ``least_length`` code
    points do not count. Null and empty texts have no runs; a null doc_id is an empty one; repeated rows
    and ids count each time. Tasks add up before the shuffle, in bounded memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)
        total, held = Counter(), 0

        def counted():
            return pa.RecordBatch.from_arrays(
                [pa.array(total, pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = Counter(letters.findall(text.encode().lower().decode())) if text else {}
                head = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in runs.items():
                    if drop_every and not (code := zlib.crc32(word.encode(), head)) % drop_every:
                        at = code % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_length:
                            continue
                    if word not in total:
                        held += len(word)
                    total[word] += n
                if len(total) > HELD_WORDS or held > HELD_BYTES:
                    yield counted()
                    total, held = Counter(), 0
        yield counted()

    rows = docs.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body"))
    parts = rows.mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words.

    State 0 is the one without arcs; a state's arcs lead to states of lesser number.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._state({}, True)
        path: list[tuple[dict, bool]] = [({}, False)]  # states along the last word, not yet numbered
        last = ""
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            self._close(path, last, shared)
            path += [({}, False) for _ in word[shared:]]
            path[-1] = (path[-1][0], True)
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        """The number of the state with these arcs; equal ones are one."""
        key = (final, *arcs.items())
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]

    def _close(self, path: list, word: str, depth: int) -> None:
        """Numbers the states beyond ``depth``: no later word goes through them."""
        while len(path) > depth + 1:
            state = self._state(*path.pop())
            path[-1][0][word[len(path) - 1]] = state


class Composition:
    """The acceptor, one edit, and the acceptor again: pairs of its words one edit apart."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final, self.start = acceptor.arcs, acceptor.final, acceptor.start
        self._alive: dict[tuple[int, int], bool] = {}
        self.spent = [self._edits(q) for q in range(len(self.arcs))]
        self.leads: list[bool] = []  # whether an unspent state leads to a pair
        for q, arcs in enumerate(self.arcs):
            self.leads.append(bool(self.spent[q]) or any(self.leads[to] for to in arcs.values()))

    def alive(self, p: int, q: int) -> bool:
        """Whether some word is accepted from p and from q: the edit is spent, both read the same."""
        if p > q:
            p, q = q, p
        stack = [(p, q, iter(self.arcs[p]))]
        found = self._alive.get((p, q))
        while stack and found is None:
            p, q, letters = stack[-1]
            if p == q or self.final[p] and self.final[q]:
                found = True
                break
            for letter in letters:
                if letter in self.arcs[q]:
                    a, b = sorted((self.arcs[p][letter], self.arcs[q][letter]))
                    known = self._alive.get((a, b))
                    if known:
                        found = True
                    elif known is None:
                        stack.append((a, b, iter(self.arcs[a])))
                    if known is not False:
                        break
            else:
                self._alive[p, q] = False
                stack.pop()
                if not stack:
                    return False
        if found:
            for p, q, _ in stack:
                self._alive[p, q] = True
        return bool(found)

    def _edits(self, q: int) -> list[tuple[str, str, int, int]]:
        """What one side and the other read where the edit is spent at ``q``, and where this leads.

        A letter beside an equal one can be inserted before or after it; only the last place counts, so
        that each pair has one path.
        """
        arcs, edits = self.arcs[q], []
        letters = list(arcs)
        for i, a in enumerate(letters):
            for b in letters[i + 1:]:
                if self.alive(arcs[a], arcs[b]):
                    edits.append((a, b, arcs[a], arcs[b]))
        for b, to in arcs.items():
            if self.final[q] and self.final[to]:
                edits.append(("", b, 0, 0))
            for c, p in arcs.items():
                if c != b and c in self.arcs[to] and self.alive(p, self.arcs[to][c]):
                    edits.append((c, b + c, p, self.arcs[to][c]))
        return edits

    def _same(self, p: int, q: int) -> Iterator[str]:
        """The words accepted from both."""
        stack = [(p, q, "")]
        while stack:
            p, q, word = stack.pop()
            if self.final[p] and self.final[q]:
                yield word
            for letter, a in self.arcs[p].items():
                b = self.arcs[q].get(letter)
                if b is not None and self.alive(a, b):
                    stack.append((a, b, word + letter))

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [(self.start, "")]
        while stack:
            q, word = stack.pop()
            for one, other, a, b in self.spent[q]:
                for rest in self._same(a, b):
                    yield word + one + rest, word + other + rest
            stack += [(to, word + letter) for letter, to in self.arcs[q].items() if self.leads[to]]


def _composed(entry: int):
    """Pairs of the parts dealt to one bin; rows are (bin, back, state, word, n), word as it is read."""

    def run(table: pa.Table) -> pa.Table:
        parts = defaultdict(dict)
        for back, state, word, n in zip(*(table.column(c).to_pylist() for c in ("back", "state", "word", "n"))):
            parts[back, state][word] = n
        out: list[tuple] = []
        for (back, state), counts in parts.items():
            if len(counts) < 2:
                continue
            skip = len(state)
            for a, b in Composition(Acceptor(sorted(w[skip:] for w in counts))).pairs():
                a, b = state + a, state + b
                n, m = counts[a], counts[b]
                if back:
                    a, b = a[::-1], b[::-1]
                    if a[:entry] == b[:entry]:
                        continue  # found by the words as they are
                out += [(a, n, b, m), (b, m, a, n)]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                    ["word", "n", "near", "near_n"])

    return run


def _shared(one: Column, other: Column) -> Column:
    """How many code points both start with."""
    places = F.sequence(F.lit(0), F.least(F.length(one), F.length(other)))
    return F.array_max(F.filter(places, lambda i: F.substring(one, F.lit(1), i) == F.substring(other, F.lit(1), i)))


def _spent_here(left: DataFrame, depth: Column, entry: int) -> DataFrame:
    """Pairs of words that agree on ``depth`` letters and spend the edit on the next one.

    ``rest`` is what stands behind the edit; at most one word per letter shares it, and one without the
    letter. Where the letter equals the next, the edit counts as spent later, in a smaller part.
    """
    rest = lambda skip: F.expr(f"substring(word, depth + {1 + skip})")
    rows = left.withColumn("depth", depth)
    longer = rows.where("length(word) > depth").select(
        "back", "state", "word", "n", rest(1).alias("rest"), F.expr("substring(word, depth + 1, 1)").alias("letter"))
    whole = rows.select("back", "state", "word", "n", rest(0).alias("rest"))
    on = ["back", "state", "rest"]
    other = lambda df: df.select(*on, F.col("word").alias("near"), F.col("n").alias("near_n"))
    replaced = longer.join(other(longer), on).where("word <> near")
    lost = longer.where("letter <> substring(rest, 1, 1)").join(other(whole), on)
    added = lost.select(*on, F.col("near").alias("word"), F.col("near_n").alias("n"),
                        F.col("word").alias("near"), F.col("n").alias("near_n"))
    columns = ["back", "word", "n", "near", "near_n"]
    found = replaced.select(*columns).unionByName(lost.select(*columns)).unionByName(added.select(*columns))
    facing = lambda name: F.when(F.col("back") == 1, F.reverse(name)).otherwise(F.col(name))
    found = found.select("back", facing("word").alias("word"), "n", facing("near").alias("near"), "near_n")
    seen = (F.col("back") == 1) & (F.substring("word", 1, entry) == F.substring("near", 1, entry))
    return found.where(~seen).drop("back")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) one edit apart, each from both sides.

    Words are distinct, without nulls, and have ``least_length`` code points or more, at least 2.
    """
    spark, entry = words.sparkSession, least_length // 2
    n_words = words.count()
    part_words = max(part_words, n_words // MOST_PARTS)
    both = words.select(F.lit(0).alias("back"), "word", "n").unionByName(
        words.select(F.lit(1).alias("back"), F.reverse("word").alias("word"), "n"))
    open_parts = both.withColumn("state", F.substring("word", 1, entry))
    spent = None
    while True:
        large = cut(
            open_parts.groupBy("back", "state")
            .agg(F.count(F.lit(1)).alias("size"), F.min("word").alias("one"), F.max("word").alias("other"))
            .where(F.col("size") > part_words)
            # Told by a hash, so that the list stays small: at most 2 * MOST_PARTS entries.
            .select(F.xxhash64("back", "state").alias("part"), _shared(F.col("one"), F.col("other")).alias("depth")),
            "large_parts")
        if large.isEmpty():
            break
        marked = open_parts.withColumn("part", F.xxhash64("back", "state")).join(F.broadcast(large), "part", "left")
        here = marked.where("depth IS NOT NULL")
        pairs = cut(_spent_here(here, F.col("depth"), entry), "spent_edits")
        spent = pairs if spent is None else spent.unionByName(pairs)
        on = here.where("length(word) > depth").withColumn("state", F.expr("substring(word, 1, depth + 1)"))
        open_parts = cut(marked.where("depth IS NULL").unionByName(on).drop("part", "depth"), "open_parts")
    bins = max(1, 2 * n_words // part_words, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = open_parts.withColumn("bin", F.pmod(F.xxhash64("back", "state"), F.lit(bins)))
    found = dealt.groupBy("bin").applyInArrow(_composed(entry), _PAIRS)
    return found if spent is None else found.unionByName(spent)


def variant_groups(counts: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                   times: int = TIMES, part_words: int = PART_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for the words of ``counts`` (word, n) that are frequent enough.

    ``form`` is the near word of largest n, the first in code-point order among equals, if its n is at least
    ``times`` the word's; else null, as ``form_n``. ``root`` is reached by following forms to the last; a word
    without a form is its own root. Counts only grow along forms, by ``times`` each, so the number of rounds
    is the logarithm of a logarithm. No counts give no rows; other columns of the input do not appear.
    """
    words = counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count)).select("word", "n")
    words = cut(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, least_length, part_words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.less") >= times * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    grouped = cut(joined, "forms")
    roots = cut(grouped.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(roots)
        roots = moved
        if roots.where("moved").isEmpty():
            break
    return grouped.join(roots.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
