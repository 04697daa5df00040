"""The registered queries of the training-data operators against their SQL and against brute force."""

import collections
import zlib

import numpy as np
import pytest

from tilewright.llm import queries as Q


def rows_of(df):
    names = sorted(df.columns)
    return sorted(tuple(str(r[c]) for c in names) for r in df.select(*names).collect())


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_equals_sql(spark, sf, duck, name):
    found = duck.sql(Q.ORACLE_SQL[name])
    names = sorted(found.columns)
    want = sorted(tuple(str(r[found.columns.index(c)]) for c in names) for r in found.fetchall())
    made = Q.QUERIES[name](spark, sf)
    assert sorted(made.columns) == names
    if name == "op8_block_join":  # SQL adds components up in its own order
        cut = lambda rows: [tuple(round(float(x), 6) for x in r) for r in rows]
        assert sorted(cut(rows_of(made))) == sorted(cut(want))
    else:
        assert rows_of(made) == want


def documents(duck):
    return duck.sql("select doc_id, text from documents").fetchall()


def test_op5(spark, sf, duck):
    found = {r["doc_id"]: r for r in Q.op5_external_shuffle(spark, sf).collect()}
    slots = collections.defaultdict(set)
    for doc_id, text in documents(duck):
        r, data = found.pop(doc_id), (text or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r["shard"]].add(r["slot"])
    assert not found and set(slots) == set(range(16))
    assert all(v == set(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op6(spark, sf, duck):
    found = Q.op6_toxicity(spark, sf).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in documents(duck))
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op7(spark, sf, duck):
    from tilewright.llm.tokens import load, tokenizer_path

    tokenizer, want = load(tokenizer_path("byte_bpe_50k.json")), []
    for doc_id, text in documents(duck):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids), 1024), len(ids)]
        want += [(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    found = Q.op7_best_fit(spark, sf).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want)
    filled = collections.defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_op2_counts_every_token(spark, sf, duck):
    from tilewright.llm.tokens import load, tokenizer_path

    tokenizer = load(tokenizer_path("byte_bpe_50k.json"))
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in documents(duck)]
    found = Q.op2_token_counts(spark, sf).collect()
    assert {r["length"]: r["docs"] for r in found} == dict(collections.Counter(lengths))
    assert {(r["total_docs"], r["total_tokens"]) for r in found} == {(len(lengths), sum(lengths))}
    for r in found:
        assert r["tokens_from"] == sum(n for n in lengths if n >= r["length"]) and r["kept_tokens"] == sum(min(n, r["length"]) for n in lengths)


def test_op9(spark, sf, duck):
    import hashlib

    from tilewright.llm.tokens import load, tokenizer_path

    tokenizer = load(tokenizer_path("word_bpe_49k.json"))
    found = {r["doc_id"]: tuple(r)[1:] for r in Q.op9_bpe(spark, sf).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for doc_id, text in documents(duck):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert found.pop(doc_id) == (len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    assert not found
