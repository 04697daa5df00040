"""Token counts, packing and BPE against the tokenizer library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.llm import bpe as B, packing as P, token_counts as C, tokens as T

ODD = ["", None, " ", "a ", " a\n b", "x<|endoftext|> y", "don't  'll", "é́ b", "中文 テキスト 😀😀", "İstanbul", "a\x1cb\x85c", "1234567 ,,, !!", "\n\n\n", "ab" * 3000]


@pytest.fixture(scope="module")
def byte_level():
    return T.load(T.tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def words():
    return B.Words(T.tokenizer_path("word_bpe_49k.json"))


def texts_of(duck):
    return [r[0] for r in duck.sql("select text from documents order by doc_id").fetchall()]


def test_encode_equals_library(byte_level, duck):
    texts = [t or "" for t in ODD] + texts_of(duck)
    path = T.tokenizer_path("byte_bpe_50k.json")
    for text, ids in zip(texts, T.encode(path, texts)):
        assert np.frombuffer(ids, "<u4").tolist() == byte_level.encode(text, add_special_tokens=False).ids


def test_token_report(spark, byte_level):
    rows = [(i, t) for i, t in enumerate(ODD + ["same words"] * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lengths = [len(byte_level.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    for r in C.token_report(df).collect():
        at = r["length"]
        assert r["docs"] == lengths.count(at) and r["docs_from"] == sum(n >= at for n in lengths)
        assert r["tokens_from"] == sum(n for n in lengths if n >= at) and r["total_tokens"] == sum(lengths) and r["total_docs"] == len(lengths)
        assert r["kept_tokens"] == sum(min(n, at) for n in lengths) and r["docs_upto"] == sum(n <= at for n in lengths)
    sums = C.suffix_sums(C.length_histogram(df))
    for r in C.at_limits(sums, [0, 1, 5, 100, 10**6]).collect():
        assert r["kept_tokens"] == sum(min(n, r["context_limit"]) for n in lengths)
        assert r["docs_cut"] == sum(n > r["context_limit"] for n in lengths)
    ordered = sorted(lengths)
    for r in C.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r["length"] == next(n for k, n in enumerate(ordered, 1) if k >= r["share"] * len(ordered) and ordered[k:k + 1] != [n])
    assert C.token_report(df.limit(0)).count() == 0


def test_long_texts_and_clashing_columns(spark, byte_level):
    r = random.Random(8)
    long = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 9))) for _ in range(200_000))
    df = spark.createDataFrame([(1, long), (2, None), (3, "short")], "doc_id long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("length", "docs", "n_tokens", "copy", "piece", "id", "salt", "offset")})
    n = len(byte_level.encode(long, add_special_tokens=False).ids)
    short = len(byte_level.encode("short", add_special_tokens=False).ids)
    assert sorted((x["length"], x["docs"]) for x in C.token_report(df).collect()) == sorted([(n, 1), (short, 1), (0, 1)])
    packed = P.pack(df, limit=1024, end_id=2, keep_ids=False).collect()
    assert sum(x["length"] for x in packed if x["id"] == 1) == n + 1 and max(x["length"] for x in packed) == 1024
    assert {x["id"] for x in packed} == {1, 2, 3}


def brute_fit(lengths, limit):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [(room, i) for i, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(limit - n)
    return sorted(bins)


def test_plan_is_best_fit_decreasing():
    r = random.Random(2)
    for _ in range(300):
        limit = r.choice([5, 16, 17, 100])
        lengths = [r.randint(1, limit) for _ in range(r.randint(0, 120))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        runs, bins = P.best_fit_plan(histogram, limit)
        filled = {}
        for run in runs:
            for k in range(run.pieces):
                filled.setdefault(run.bin + k // run.each, []).append((run.offset + k % run.each * run.length, run.length))
        assert len(filled) == bins and sorted(limit - sum(n for _, n in v) for v in filled.values()) == brute_fit(lengths, limit)
        for v in filled.values():
            at = 0
            for offset, n in sorted(v):
                assert offset == at
                at += n


@pytest.mark.parametrize("keep_ids", [True, False])
def test_pack_keeps_every_token(spark, byte_level, duck, keep_ids):
    texts = ODD + ODD[:3] + texts_of(duck)[:60]
    df = spark.createDataFrame([(i // 2, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece string")
    packed = P.pack(df, limit=64, end_id=2, keep_ids=keep_ids).toPandas()
    want = []
    for i, t in enumerate(texts):
        ids = byte_level.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids), 64), len(ids)]
        want += [(i // 2, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(zip(packed["id"], packed["piece"], packed["start"], packed["length"], packed["ids_crc32"])) == sorted(want)
    ordered = packed.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id")["length"].cumsum()
    assert (ends - ordered["length"] == ordered["offset"]).all() and ends.max() <= 64
    assert ordered["sequence_id"].nunique() == len(brute_fit(packed["length"].tolist(), 64))


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (None, "d")], "doc_id long, text string")
    packed = P.pack(df, limit=16)
    total = sum(len(r["ids"]) for r in P.sequences(packed).collect())
    assert total == packed.agg({"length": "sum"}).first()[0]
    assert P.pack(df.limit(0)).count() == 0


def test_tree_equals_library(words, duck):
    r = random.Random(4)
    tk, real = words.tokenizer, texts_of(duck)
    for n in range(300):
        kind = n % 4
        if kind == 0:
            text = "".join(r.choice("ab") for _ in range(r.randrange(1, 400)))
        elif kind == 1:
            text = "".join(r.choice(["é", "'re", "''s", "İ", "中", "😀", "<|endoftext|>", " ", "x", "e", "\u0301", "1", "."]) for _ in range(r.randrange(1, 150)))
        elif kind == 2:
            text = real[n % len(real)].replace(" ", "")[:600]
        else:
            text = real[n % len(real)][:600]
        want = tk.encode(text, add_special_tokens=False).ids
        leaf, window = r.choice([1, 7, 30, 100]), r.choice([1, 8, 32])
        assert B.encode_tree(tk, text, leaf, window).ids.tolist() == want
        assert joined_runs(words, text, leaf, window) == want


def joined_runs(words, text, leaf, window):
    """The tokens of a text from the leaves and runs that encode_decode deals out, in one process."""
    runs, closed = {}, {}
    for part, run, at, of, of_next in B.cut_leaves(text, leaf):
        first, middle, last = words.leaf(part)
        assert len(runs.setdefault(run, [])) == at < of
        runs[run].append(last if first is None else first)
        if first is not None:
            closed[run] = [int(x) for e in middle for x in e[1].split()]
            runs[run + 1] = [last]
            assert of_next >= 1
    out = []
    for run in sorted(runs):
        level = runs[run]
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = [p[0] if len(p) == 1 else B.concatenate(words.tokenizer, *p, window) for p in pairs]
        out += level[0].ids.tolist() + closed.get(run, [])
    return out


def expected(tk, t):
    ids = tk.encode(t or "", add_special_tokens=False).ids
    decoded = tk.decode(ids, skip_special_tokens=False)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded), ids, decoded


@pytest.mark.parametrize("leaf", [1 << 15, 200])
def test_encode_decode(spark, words, duck, leaf):
    tk = words.tokenizer
    texts = ODD + texts_of(duck)[:80] + ["word " * 20_000, "unsplit" * 900 + " " + "é" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("copy", "run", "at", "part", "n_tokens", "id")})
    found = {r["id"]: r for r in B.encode_decode(df, leaf=leaf, full=True).collect()}
    for i, t in enumerate(texts):
        r = found[i]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"], r["decoded"]) == expected(tk, t)
    assert B.encode_decode(df.limit(0)).count() == 0


def test_encode_decode_of_derived_tables(spark, words, duck):
    """Tables whose rows come in another order each time they are read."""
    texts = texts_of(duck)[:60] + [None, "x" * 700]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    copies = spark.createDataFrame([(k,) for k in range(3)], "k long")
    want = {i: expected(words.tokenizer, t)[:3] for i, t in enumerate(texts)}
    for made, times in ((df.repartition(7), 1), (df.union(df.repartition(3)), 2), (df.crossJoin(copies).repartition(5), 3), (df.join(df.select("doc_id"), "doc_id"), 1)):
        got = B.encode_decode(made, leaf=200, full=False).collect()
        assert sorted(tuple(r) for r in got) == sorted((i, *w) for i, w in want.items() for _ in range(times))


def test_encode_decode_of_a_huge_word(spark, words):
    r = random.Random(5)
    text = "".join(r.choice("abcdefghij") for _ in range(1_500_000))
    rows = [(None, text), (1, "words and " * 100_000), (None, None)]
    got = {(r["id"], r["n_tokens"] > 0): tuple(r)[1:] for r in B.encode_decode(spark.createDataFrame(rows, "doc_id long, text string"), full=False).collect()}
    assert got == {(i, bool(t)): expected(words.tokenizer, t)[:3] for i, t in rows}
