import random

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long, runs string, score string, n_words string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns named like results."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    some = [" ".join(word() for _ in range(90)) for _ in range(6)]
    texts = [None, "", "  \n\t ", "One.", "a b c d", long, long + " end", "#$% 123 ...", "é" * 300,
             *some, some[0], some[1] + " x", some[0].replace(" ", "\n"), "x\n" * 200]
    rows = [(i, t, ("en", "fr", "de", None)[i % 4], (None, "s/1", "s/2")[i % 3], 1, "r", "s", "n")
            for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], rows[5], (None, some[2], "en", "s/1", None, None, None, None),
             (None, None, None, None, None, None, None, None), (4, "another text of the same id", "en", "q", 1, "", "", "")]
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ROWS)
