"""Near-duplicates against brute force over full shingle sets."""

import random
import re

import numpy as np
import pytest

from tilewright.llm import graph, minhash as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size, percent):
    """{row number: (set size, least id of its component)}"""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))]


def near_copies(n, words, edits, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(words)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def check(spark, data, size, percent, **options):
    found = M.near_duplicates(frame(spark, data), shingle=size, percent=percent, **options).collect()
    got = sorted((r["id"] if r["id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in found)
    want = sorted((k if k is not None else -1, n, c if c is not None else -1) for k, n, c in brute(data, size, percent))
    assert got == want
    return found


@pytest.mark.parametrize("few", [16, 2])
def test_copies_chains_and_strangers(spark, few, monkeypatch):
    monkeypatch.setattr(M, "FEW", few)
    monkeypatch.setattr(M, "BLOCK", 7)
    texts = near_copies(60, 80, 9, 1) + near_copies(25, 40, 4, 2) + ["one", "one", "Two words", "two  WORDS\n", "", "  \t", None]
    texts += [f"alone {i} stranger text {i * 7} and more {i * 13}" for i in range(20)]
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)]
    found = check(spark, rows, 3, 85, bands=32, rows=6)
    assert all(r["kept"] for r in found if r["n_shingles"] == 0)


def test_five_words_and_eighty_percent(spark):
    rows = list(enumerate(near_copies(40, 120, 8, 3) + near_copies(10, 5, 1, 4)))
    check(spark, rows, 5, 80, bands=36, rows=5)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, None), (7, None), (None, "only null ids here"), (None, "only null ids here")]
    found = M.near_duplicates(frame(spark, rows), shingle=3, percent=85, bands=8, rows=4).collect()
    assert sorted(str(r["component_id"]) for r in found) == sorted(["5", "5", "5", "None", "7", "None", "None"])
    kept = M.keep_first(frame(spark, rows), shingle=3, percent=85, bands=8, rows=4).collect()
    assert sorted(str(r["text"]) for r in kept) == sorted(["a b c d", "None", "None", "only null ids here"])


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string, id int, node string, bucket int, component int")
    assert M.near_duplicates(none).count() == 0 and M.keep_first(none).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f", 9, "n", 1, 2), (2, "a b c d e f", 8, "m", 1, 2)], none.schema)
    assert [tuple(r) for r in M.keep_first(some).collect()] == [(1, "a b c d e f", 9, "n", 1, 2)]


def test_very_long_text(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long), (2, long + " tail"), (3, "tail")]
    found = {r["id"]: r["component_id"] for r in M.near_duplicates(frame(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_shingle_hashes_count_like_sets():
    r = random.Random(0)
    texts = [" ".join(r.choice("abcde") for _ in range(r.randrange(30))) for _ in range(200)] + ["\x01 \x02 a", "é a b"]
    for size in (1, 3, 5):
        made = M.shingle_hashes([b" ".join(M.words(t)) for t in texts], size)
        assert [len(x) for x in made] == [len(shingles(t, size)) for t in texts]


def test_signature_agreement_estimates_similarity():
    a, b = np.arange(0, 4000, dtype=np.uint64), np.arange(400, 4400, dtype=np.uint64)
    mix = M._mix64
    s = M.signatures([mix(a), mix(b)], 1024)
    assert (s[0] == s[1]).mean() == pytest.approx(3600 / 4400, abs=0.05)


def test_linked_joins_parts_once():
    x = near_copies(6, 30, 0, 5)
    assert len(M.linked(x, list("abcdef"), x, list("abcdef"), 3, 85)) == 5


@pytest.mark.parametrize("n,kind", [(1, "chain"), (40, "chain"), (30, "star")])
def test_components(spark, n, kind):
    edges = [(i, i + 1) if kind == "chain" else (0, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001), (None, 3)]
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
