"""The pipeline on the smallest tables: each stage keeps whole columns, and its decisions take effect."""

import collections
import itertools
import re

import corpus_pipeline as P
from tilewright.llm import minhash
from tilewright.llm.common import table


def test_pipeline_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    total, before = docs.count(), docs.columns
    kept = {}
    for i, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept[name] = docs.count()
        if i < len(P.STAGES) - 1:
            assert docs.columns == before
        if name == "near duplicates":
            again = minhash.near_duplicates(docs)
            assert again.where("not kept").count() == 0
            survivors = docs
    assert total > kept["toxicity"] >= kept["quality rules"] > kept["near duplicates"] > 0
    assert docs.select("doc_id").distinct().count() == survivors.select("doc_id").distinct().count()
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _stage(name):
    return dict(P.STAGES)[name]


def test_toxicity_stage_follows_the_scores(spark, sf):
    from tilewright.llm import toxicity
    from tilewright.llm.queries import toxicity_model

    docs = table(spark, sf, "documents")
    model = toxicity_model(docs.select("doc_id", "text"), table(spark, sf, "labels"))
    want = {r["doc_id"] for r in toxicity.score(docs.select("doc_id", "text"), model).collect() if r["score"] < 0.5}
    kept = _stage("toxicity")(spark, docs, sf)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want) and kept.exceptAll(docs).count() == 0


def _base_failed(text):
    w = WORDS.findall(text)
    windows = collections.defaultdict(list)
    for i in range(len(w) - 4):
        windows[tuple(w[i : i + 5])].append(i)
    again = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    return len(w) < 10 or 100 * len(again) > 20 * len(w)


def test_quality_stage_equals_brute_force(spark, sf, duck):
    from test_bounded_rules import brute

    rows = duck.sql("select doc_id, source, text from documents").fetchall()
    lost, kept = brute(rows), {}
    for doc_id, _, text in rows:
        n = len(WORDS.findall(text or ""))
        if not _base_failed(text or "") and n - lost[doc_id] >= max(10, 0.3 * n):
            kept[doc_id] = n - lost[doc_id]
    made = _stage("quality rules")(spark, table(spark, sf, "documents"), sf).collect()
    assert {r["doc_id"]: len(WORDS.findall(r["text"])) for r in made} == kept and len(kept) > 50
    assert all(r["n_chars"] == len(r["text"]) for r in made)


def test_near_duplicate_stage_equals_brute_force(spark, sf, duck):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for doc_id, text in duck.sql("select doc_id, text from documents order by doc_id").fetchall():
        w = WORDS.findall((text or "").translate(lower))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    home = {d: d for d in sets}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            home[y] = x
    docs = table(spark, sf, "documents")
    made = _stage("near duplicates")(spark, docs, sf)
    assert sorted(r["doc_id"] for r in made.collect()) == [d for d in sets if home[d] == d] and made.exceptAll(docs).count() == 0


def test_packing_stage_fills_as_best_fit_does(spark, sf, duck):
    from tilewright.llm.tokens import load, tokenizer_path

    tokenizer, pieces = load(tokenizer_path("byte_bpe_50k.json")), []
    for (text,) in duck.sql("select text from documents").fetchall():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
        pieces += [1024] * (n // 1024) + ([n % 1024] if n % 1024 else [])
    room = []
    for n in sorted(pieces, reverse=True):
        tightest = min((r for r in range(len(room)) if room[r] >= n), key=lambda r: room[r], default=None)
        if tightest is None:
            room.append(1024 - n)
        else:
            room[tightest] -= n
    made = _stage("packing")(spark, table(spark, sf, "documents"), sf).collect()
    filled = collections.Counter()
    for r in made:
        filled[r["sequence_id"]] += r["length"]
    assert sorted(r["length"] for r in made) == sorted(pieces) and len(filled) == len(room) and max(filled.values()) <= 1024
