"""Quality rules: a table of thresholds, compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that ends a word, the symbols that are counted, and stop words of the
#: languages en, de, fr and es.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "on", "are", "by",
    "der", "die", "das", "und", "zu", "den", "von", "nicht", "für", "mit", "ist", "ein", "im",
    "le", "la", "les", "et", "des", "du", "en", "un", "une", "que", "pour", "qui", "dans", "par",
    "el", "los", "las", "y", "una", "por", "con", "del", "se", "no", "es", "su", "al", "de",
)


#: Up to so many repeated windows, a text's windows are looked up among them one by one.
FEW = 64


@dataclass(frozen=True)
class Rule:
    """A measure must lie within [least, most]; None leaves that side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Measures are columns of ``measured`` or SQL over them.
RULES = (
    Rule("word_length", "word_chars / greatest(n_words, 1)", 2.0, 12.0),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", None, 0.1),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", 0.02, None),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.3),
)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_stop_words")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and
    n_stop_words of each whole text; all 0 for a null or empty one.

    Columns of ``docs`` called like a measure are replaced, others stay.

    Windows of three words are compared by 64-bit hash. Sorted hashes show which ones repeat; with few
    of these, windows are looked up among them, with many, windows are sorted together with their
    places. Either way the words that repeats cover are counted once each.
    """
    kept = [c for c in docs.columns if c not in MEASURES]
    docs = docs.select(F.struct(*kept).alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    text = F.col("_text")
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    stop_words = [*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]]
    hashed = F.expr("transform(_words, w -> xxhash64(w))")
    windows = F.expr("CASE WHEN n_words > 3 THEN transform(sequence(0, n_words - 3), "
                     "i -> xxhash64(_hashes[i], _hashes[i + 1], _hashes[i + 2])) END")
    repeated = F.expr("array_distinct(filter(_sorted, (h, k) -> k > 0 AND _sorted[k - 1] = h))")
    looked_up = F.expr("filter(transform(_windows, (h, i) -> if(array_contains(_repeated, h), i, -1)), "
                       "i -> i >= 0)")
    placed = F.expr("array_sort(transform(_windows, (h, i) -> struct(h AS h, i AS i)))")
    neighbours = F.expr("transform(filter(_placed, (x, k) -> (k > 0 AND _placed[k - 1].h = x.h) OR "
                        "get(_placed, k + 1).h <=> x.h), x -> x.i)")
    covered = F.expr("size(array_distinct(flatten(transform(_places, i -> array(i, i + 1, i + 2)))))")
    none, few = F.size("_repeated") <= 0, F.size("_repeated") <= FEW
    return (
        docs.withColumn("_words", words).withColumn("n_words", F.size("_words"))
        .withColumn("_lines", lines)
        .withColumn("_hashes", hashed)
        .withColumn("_windows", windows)
        .withColumn("_sorted", F.sort_array("_windows"))
        .withColumn("_repeated", repeated)
        .withColumn("_placed", F.when(~few, placed))
        .withColumn("_places", F.when(none, None).when(few, looked_up).otherwise(neighbours))
        .select(
            "_row.*",
            F.col("n_words").cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, rf"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.greatest(F.coalesce(covered, F.lit(0)), F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(F.filter("_words", lambda w: w.isin(*stop_words))).cast("long")
            .alias("n_stop_words"),
        )
    )


def _breaks(rule: Rule) -> Column:
    value = F.expr(rule.measure)
    sides = [value < rule.least] if rule.least is not None else []
    sides += [value > rule.most] if rule.most is not None else []
    return reduce(lambda a, b: a | b, sides, F.lit(False))


def judged(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with base_failed, failed_rules (names, comma-joined) and kept.

    A text without words fails. Columns called like a verdict are replaced.
    """
    base = ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    failed = F.concat_ws(",", *[F.when(_breaks(rule), rule.name) for rule in rules])
    return (measures.withColumn("base_failed", base).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))
