"""Spelling variants, near vectors and whitening against plain Python."""

import itertools
import random

import numpy as np
import pytest

from tallymart.llm import embedding_dedup, spelling, whitening

VECTORS = "vec_id long, embedding array<double>, key string, links int, root int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    found = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(250)}
    found |= {"a" * n for n in range(6, 10)} | {"xyz" + "c" * n for n in (4000, 4001)} | {"xy" + "c" * 4000}
    return {w: rng.choice([5, 5, 6, 30, 200, 1200]) for w in sorted(found)}


@pytest.mark.parametrize("part_words", [20_000, 30, 3])
def test_near_words_are_all_pairs_one_edit_apart(spark, words, part_words):
    """Also where parts of the composition are split, down to parts of three words."""
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(r.word, r.near) for r in spelling.near_words(rows, part_words=part_words).collect()]
    want = {p for p in itertools.permutations(words, 2) if abs(len(p[0]) - len(p[1])) < 2 and one_edit(*p)}
    assert len(got) == len(want) and set(got) == want


def test_acceptor_is_minimal():
    acceptor = spelling.Acceptor(["tap", "taps", "top", "tops"])
    assert len(acceptor.arcs) == 5


def test_forms_and_roots(spark, words):
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {}
    for word, n in words.items():
        near = [w for w in words if abs(len(w) - len(word)) < 2 and w != word and one_edit(w, word)]
        form = min(near, key=lambda w: (-words[w], w), default=None)
        form = form if form and words[form] >= 5 * n else None
        want[word] = (n, len(near), form, words.get(form))
    for word, facts in want.items():
        root = word
        while want[root][2]:
            root = want[root][2]
        want[word] = (*facts[:4], root)
    got = {r.word: tuple(r)[1:] for r in spelling.variant_groups(rows).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == want
    assert any(want[w[4]][2] is None and w[2] not in (None, w[4]) for w in want.values())


def test_words_of_odd_texts(spark, odd, none):
    docs = spark.createDataFrame(
        [(1, "Straße STRASSE Ünïcode, straße-x" + "straße " * 3, "w"), (None, "strasse" * 2, "w"), (2, None, "w"),
         (3, "", "w"), (3, "kurz " * 9, "w")], "doc_id long, text string, word string")
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    # Only A-Z goes to lower case.
    assert got == {"straße": 4, "strasse": 1, "Ünïcode": 1, "xstraße": 1, "strassestrasse": 1}
    assert spelling.variant_groups(spelling.word_counts(none)).collect() == []
    counts = spelling.word_counts(odd, drop_every=7)
    assert spelling.variant_groups(counts, least_count=1).count() > 0


def test_every_so_many_runs_lose_a_letter(spark):
    import zlib

    texts = [(i, " ".join(f"{a}letter{b}" for a in "abcdefgh" for b in "qrstuv")) for i in range(20)]
    got = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(texts, "doc_id long, text string"), 13).collect()}
    want = {}
    for i, text in texts:
        for run in text.split():
            code = zlib.crc32(f"{i}:{run}".encode())
            run = run if code % 13 else run[:code % len(run)] + run[code % len(run) + 1:]
            want[run] = want.get(run, 0) + 1
    assert got == want and min(map(len, want)) == 7


def links_of(ids, x, cosine=0.9):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    return near.sum(1), ids[embedding_dedup._least(*np.nonzero(near), len(x))]


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_near_vectors_against_all_pairs(spark, block_rows, monkeypatch):
    """Families at the threshold and closer, copies, and buckets split into blocks."""
    monkeypatch.setattr(embedding_dedup, "BLOCK_COSINES", 2000)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40))
    close = [x[i % 7] + rng.normal(size=40) * rng.choice([0.05, 0.2, 0.33]) for i in range(250)]
    x = np.vstack([x, close, x[:30], 5 * x[:3], np.repeat(x[:1], 60, 0)])
    ids = rng.permutation(len(x)) * 3
    order = np.argsort(ids)
    n_links, component = links_of(ids[order], x[order])
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(rows, block_rows=block_rows).collect()}
    found = np.array([got[i].n_links for i in ids[order]])
    assert (found <= n_links).all() and found.sum() >= 0.99 * n_links.sum()
    assert np.mean([got[i].component_id == c for i, c in zip(ids[order], component)]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_odd_vectors(spark):
    nan, inf, big = float("nan"), float("inf"), 1e300
    rows = [(5, [1.0, 2.0]), (4, [2.0, 4.0]), (5, [1.0, 2.0]), (3, [0.0, 0.0]), (2, None), (1, []), (0, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 0.0]), (10, [big, 2 * big]), (11, [-1.0, -2.0]),
            (12, [1.0]), (13, [7.0]), (None, [-2.0, -4.0]), (14, [0.0, 1e-300])]
    rows = spark.createDataFrame([(*r, "k", 1, 1) for r in rows], VECTORS)
    got = sorted(map(tuple, embedding_dedup.near_vectors(rows).collect()), key=str)
    want = [(5, 3, 4, False), (4, 3, 4, True), (5, 3, 4, False), (3, 0, 3, True), (2, 0, 2, True), (1, 0, 1, True),
            (0, 0, 0, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 3, 4, False), (11, 1, None, False),
            (12, 1, 12, True), (13, 1, 12, False), (None, 1, None, True), (14, 0, 14, True)]
    assert got == sorted(want, key=str)
    assert embedding_dedup.near_vectors(rows.where("vec_id < 0")).collect() == []


def test_hashes_follow_the_number_of_vectors():
    assert [embedding_dedup.n_hashes(n, 64) for n in (0, 500, 30_000, 3_000_000, 10**9)] == [1, 1, 1, 2, 4]
    x = np.random.default_rng(0).normal(size=(50, 64))
    codes = embedding_dedup.bucket_codes(x, 3, 2, 5)
    assert codes.max() < 128 * 128 and all(len(set(row)) == 5 for row in codes.tolist())
    assert np.allclose(np.linalg.norm(embedding_dedup._rotated(x, 1, 0), axis=1), np.linalg.norm(x, axis=1))


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 20)) * np.linspace(0.3, 3, 20)
    x = np.vstack([x, np.repeat(x[:5], 40, 0)])
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = sorted(map(tuple, whitening.whiten(rows).collect()))
    whole = np.floor(64 * x).astype(np.int64) + 1_000_000
    fit = np.unique(whole, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    want = (n * whole - sums) / n @ vectors[:, order] / np.sqrt(values[order])
    found = np.array([r[4] for r in got]).reshape(len(x), 16)
    signs = np.sign((found * want).sum(0))
    assert np.abs(found * signs - want).max() < 1e-9
    assert [r[3] for r in got[::16]] == ((n * whole - sums) ** 2).sum(1).tolist()
    assert {r[2] for r in got} == {n} and {r[1] for r in got} == set(range(1, 17))
    assert np.allclose([r[5] for r in got[:16]], values[order] / values.sum(), rtol=1e-9)
    assert max(r[6] for r in got) < 1e-9


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (None, [0.5, 1.0])]
    rows = spark.createDataFrame([(*r, "k", 1, 1) for r in rows], VECTORS)
    got = whitening.whiten(rows).collect()
    # One dimension does not vary, so there is one component; the two distinct vectors lie one on each side.
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation, round(abs(r.whitened), 9)) for r in got) == [
        (0, 1, 2, 1024, 1.0), (1, 1, 2, 1024, 1.0), (2, 1, 2, 1024, 1.0), (2, 1, 2, 1024, 1.0)]
    assert whitening.whiten(rows.where("vec_id = 1")).collect() == []
    assert whitening.whiten(rows.where("vec_id < 0")).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert {(r.vec_id, r.deviation) for r in whitening.whiten(huge).collect()} == {(1, None), (2, None), (3, 81920)}
