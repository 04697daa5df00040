"""Token ids in Arrow stream files: the round trip, random access, and odd tables."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tilewright.llm import arrow_files as A
from tilewright.llm.tokens import encode, load, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def brute(rows, end=(2,)):
    tokenizer, at, out = load(PATH), 0, []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + list(end)
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_brute_force(spark, sf, duck):
    from tilewright.llm.queries import op13_arrow_files

    want = brute(duck.sql("select doc_id, text from documents order by doc_id").fetchall())
    assert sorted(map(tuple, op13_arrow_files(spark, sf).collect())) == want


def test_odd_rows(spark):
    """Null ids and texts, empty and very long texts, repeated rows, many rows of one id, clashing names."""
    rows = [(None, "no id"), (1, None), (2, ""), (3, "word " * 60_000), (5, "x"), *[(7, "the same")] * 300, *[(8, f"text {i}") for i in range(200)]]
    frame = spark.createDataFrame([(*r, "?") for r in rows], "doc_id bigint, text string, file string").repartition(5)
    written = A.write(frame, length=16, files=7)
    made = [tuple(r) for r in A.read(written).collect()]
    made.sort(key=lambda r: r[1])
    assert [r[0] for r in made] == [r[0] for r in rows]
    assert [r[1] for r in made] == [0, *np.cumsum([r[2] for r in made])[:-1]]
    count = lambda x: sorted((str(k), n, c) for k, _, n, c in x)
    assert count(made) == count(brute(rows))
    names = written.manifest.orderBy("file").collect()
    assert len(names) > 3 and max(r["n_docs"] for r in names) < len(rows) / 2  # one id is split over files


def test_empty_table_and_no_end(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert A.read(A.write(empty)).collect() == []
    bare = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted(map(tuple, A.read(A.write(bare, end_id=None)).collect())) == [(1, 0, 0, 0), (2, 0, 0, 0)]


def test_string_ids_and_tokens(spark):
    frame = spark.createDataFrame([("b", "two words"), ("a", "one")], "key string, body string")
    found = A.read(A.write(frame, id_col="key", text_col="body"), "string", keep_ids=True).collect()
    want = {k: [*np.frombuffer(encode(PATH, [t])[0], "<u4").tolist(), 2] for k, t in (("b", "two words"), ("a", "one"))}
    assert {r["doc_id"]: r["ids"] for r in found} == want


@pytest.mark.parametrize("total", [0, 1, 7 * 8, 7 * 8 + 1, 500])
@pytest.mark.parametrize("vocabulary", [50257, 70000])
def test_random_access_is_a_view(tmp_path, total, vocabulary):
    ids = np.arange(total, dtype=np.uint32) * 131 % vocabulary
    with pa.OSFile(str(tmp_path / "f"), "wb") as sink:
        w = A.SequenceWriter(sink, 8, A.id_type(vocabulary), rows=7)
        for part in np.array_split(ids, 9):
            w.add(part)
        w.close()
    with pa.memory_map(str(tmp_path / "f")) as source:
        f = A.SequenceFile(source)
        assert f.batches == -(-total // 56)
        before = pa.total_allocated_bytes()
        for k in np.random.default_rng(0).permutation(7 * f.batches):
            view, mask = f.sequence(int(k))
            want = ids[8 * k : 8 * k + 8]
            assert view[: len(want)].tolist() == want.tolist() and mask.to_pylist() == [i < len(want) for i in range(8)]
        assert pa.total_allocated_bytes() - before < 4096  # nothing is copied
        assert np.concatenate([*f.ids(3, max(0, total - 5)), []]).tolist() == ids[3 : max(3, total - 2)].tolist()
        whole = pa.ipc.open_stream(pa.memory_map(str(tmp_path / "f"))).read_all()  # any reader of streams takes it
        assert whole.num_rows == 7 * f.batches
