"""URL rules, sharding, chat, toxicity, quality rules and neighbours against brute force."""

import os
import collections
import random
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tilewright.llm import ann, chat, quality, sharding, toxicity, urls
from tilewright.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- URL rules


URLS = [
    None,
    "",
    "no scheme",
    "http://NET/",
    "https://a.Net",
    "https://x.example.net/en/1?x#y",
    "https://example.net/en",
    "https://notexample.net/en/",
    "http://example.com/de/a",
    "http://example.com?/de/",
    "ftp://a.org/fr/é",
    "http://org#/fr/",
    "a://b://c.org/fr/",
    "http://net:80/",
    "http:///fr/",
]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, "allow")
    return host, path, rule, verdict


def test_urls_equal_brute_force(spark):
    rules = urls.DEFAULT_RULES + [(f"h{i}.example.com", f"/p{i % 7}/", "block") for i in range(500)] + [("example.com", "", "block")]
    asked = URLS + [f"https://s.h{i}.example.com/p{i % 5}/q" for i in range(0, 500, 9)]
    asked += ["http://" + "a." * 500_000 + "net/" + "x" * 1_000_000, "http://" + "b" * 3_000_000, "https://" + "." * 20_000 + "org/fr/" + "/" * 20_000]
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(asked + asked)], "page_id long, url string, host int")
    want = [(i, *judged(u, rules)) for i, u in enumerate(asked + asked)]
    assert sorted(tuple(r) for r in urls.url_filter(df, rules).collect()) == sorted(want)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    joined = urls.url_filter_joined(df, table, sorted({len(p) for _, p, _ in rules}))
    assert sorted(tuple(r) for r in joined.collect()) == sorted(want)
    assert urls.url_filter(df.limit(0), rules).count() == 0 and urls.url_filter(df, []).where("verdict = 'allow'").count() == len(want)
    with pytest.raises(ValueError, match="url_filter_joined"):
        urls.url_filter(df, rules, max_bytes=10)


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    rules = [("a.com", "/", "block"), ("b.com", "/", "allow"), ("cc.com", "/x", "block")]
    urls.DigestArray.write(rules, str(tmp_path / "d"))
    assert urls.DigestArray(str(tmp_path / "d")).find([b"a.com/", b"b.com/", b"d.com/", b"cc.com/x"]) == ["block", "allow", None, "block"]


# --- sharding


def test_shards(spark):
    rows = [(i % 50 if i % 9 else None, None if i % 11 == 0 else f"text {i % 30} " * (i % 40)) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("x") for c in ("shard", "bucket", "total", "row", "at", "begin")})
    out = sharding.external_shuffle(df, shards=16, seed=3, bucket_bytes=4000)
    got = out.collect()
    key = lambda t: (str(t[0]), str(t[1]))
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=key) == sorted(rows, key=key)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.external_shuffle(df, shards=16, seed=3, bucket_bytes=4000)
    other = sharding.external_shuffle(df, shards=16, seed=4, bucket_bytes=4000)
    place = lambda d: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in d.collect())
    assert place(out) == place(again) != place(other)
    assert sharding.external_shuffle(df.limit(0)).count() == 0
    assert [r["shard"] for r in sharding.external_shuffle(df.limit(1), shards=4).collect()] == [0]


def hashed(*values):
    """Spark's xxhash64 of numbers and strings; nulls change nothing."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q" if isinstance(v, np.int64) else "<i", v), seed & (2**64 - 1))
    return seed - 2**64 if seed >= 2**63 else seed


def brute_shuffle(rows, shards, seed, buckets):
    long, copies, filled = np.int64, collections.Counter(), collections.defaultdict(list)
    for row in rows:
        h = hashed(long(seed), long(row[0]) if row[0] is not None else None, row[1])
        key = hashed(long(seed), long(h), long(copies[row]))
        filled[key % buckets].append((key, h, copies[row], row))
        copies[row] += 1
    out = []
    for b in range(buckets):
        order = sorted(filled[b], key=lambda x: x[:3])
        for i in range(1, len(order)):
            j = hashed(long(seed), long(b), i) % (i + 1)
            order[i], order[j] = order[j], order[i]
        out += [x[3] for x in order]
    total, placed, slots = len(out), [], collections.Counter()
    for at, row in enumerate(out):
        shard = at * shards // total
        placed.append((*row, shard, slots[shard]))
        slots[shard] += 1
    return placed


def test_shuffle_equals_brute_force_for_any_split(spark):
    r = random.Random(3)
    rows = [(i % 40 if i % 9 else None, None if i % 11 == 0 else f"text {r.randrange(60)}") for i in range(500)]
    rows += [(None, None)] * 5000 + [(7, "same")] * 3  # a hot group of equal rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = lambda t: tuple(map(str, t))
    want = sorted(map(text, brute_shuffle(rows, 16, 5, -(-len(rows) // 100))))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for made, n in ((df, width), (df.repartition(7), "3"), (df.coalesce(1), "9"), (df.orderBy(F.rand(1)), width)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(text(x) for x in sharding.external_shuffle(made, shards=16, seed=5, bucket_rows=100).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_shuffle_of_maps_and_long_texts(spark):
    df = spark.createDataFrame([(1, "a" * 2_000_000, {"k": 1}), (1, "b", None), (1, "b", None), (2, None, {"k": 2})], "doc_id long, text string, bucket map<string,int>")
    got = sharding.external_shuffle(df.withColumn("begin", F.lit(1)), shards=2).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert sorted(len(r["text"] or "") for r in got) == [0, 1, 1, 2_000_000] and got[0]["begin"] == 1


def test_shuffle_mixes(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(4000)], "doc_id long, text string")
    rows = sharding.external_shuffle(df, shards=4, bucket_bytes=2000).collect()
    mean = {s: np.mean([r["doc_id"] for r in rows if r["shard"] == s]) for s in range(4)}
    assert all(abs(m - 2000) < 150 for m in mean.values())


def test_write_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id long, text string")
    sharding.write_shards(sharding.external_shuffle(df, shards=4), str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100


# --- chat


def test_rotation(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", None), (1, 2, None, "x"), (1, 300, "user", "late"), (1, 300, "user", "late"), (2, None, "user", "y"), (None, 0, "bot", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(0))
    got = collections.defaultdict(list)
    for r in chat.rotate(df).collect():
        got[r["conv_id"], r["perspective"]].append(r)
    assert set(got) == {(1, "user"), (1, "bot"), (1, "unknown"), (2, "user"), (None, "bot")}
    for (conv, side), turns in got.items():
        turns.sort(key=lambda r: r["start"])
        whole = "".join(r["segment"] for r in turns)
        at = 0
        for r in turns:
            assert r["start"] == at
            at += len(r["segment"])
            if r["speaker"] == side:
                assert whole[r["mask_start"] : r["mask_end"]].endswith("<|end|>") and r["segment"].startswith("<|assistant|>\n")
            else:
                assert r["mask_start"] is None and r["segment"].startswith(f"<|user name={r['speaker']}|>\n")
    assert len(got[1, "user"]) == 5
    often = spark.createDataFrame([(3, 0, "a", "hi")] * 9000 + [(3, 1, "b", "<|end|>")], "conv_id long, turn long, role string, text string")
    hot = chat.rotate(often).where("perspective = 'b'").agg(F.count("*").alias("n"), F.countDistinct("start").alias("d"), F.max("copy").alias("c")).first()
    assert (hot["n"], hot["d"], hot["c"]) == (9001, 9001, 8999)
    assert chat.rotate(df.limit(0)).count() == 0


# --- toxicity


def test_grammar_scores_clauses():
    lexicon = toxicity.Lexicon({"=idiot": 4.0})
    plain, target, negated, spoken = (lexicon.features(t)[0] for t in ("an idiot here", "you idiot", "not an idiot", 'he said "an idiot here"'))
    assert target > plain > spoken > negated > 0
    assert lexicon.features("Idiot!!! IDIOT###\nnothing")[2] == 2
    assert lexicon.features("nothing. at all") == (0.0, 0.0, 0)


def plain_score(symbols):
    """Scores of the matched clauses of symbols, from the grammar's rules in words, without automata."""
    scores = []
    for paragraph in symbols.split("\n"):
        marks = [i for i, c in enumerate(paragraph) if c == '"']
        if len(marks) % 2:
            paragraph = paragraph[: marks[-1]] + paragraph[marks[-1] + 1 :]
        p = list(paragraph)
        for i in range(len(p) - 1):
            if p[i] == "y" and p[i + 1] == "r":
                p[i] = "o"
        i = used = 0  # a reporting verb introduces once
        while i < len(p):
            if p[i] == ":":
                back = "".join(p[:i])
                begin = back.rfind("r")
                spoken = begin >= used and len(back) - begin - 1 <= 3 and not set(back[begin:]) & set(':.,"')
                if spoken:
                    del p[i]
                    used = i
                    continue
                p[i] = "."
            i += 1
        quoted = False
        for clause in "".join(p).split("."):
            covered = 0
            for i, c in enumerate(clause):
                if c == ",":
                    ahead = clause[i + 1 : i + 5]
                    end = ahead.find("r")
                    if end >= 0 and not set(ahead[:end]) & set(',"12345678ABCDEFGH'):
                        covered = i
                        break
            words, total, verb, hit = [], 0.0, False, False
            for i, c in enumerate(clause):
                spoken = quoted or verb or i < covered
                if c == '"':
                    quoted = not quoted
                if c == ",":
                    continue
                near = lambda kinds, n: any(x in kinds for x in words[max(0, len(words) - n) :])
                insult, threat = c in "12345678", c in "ABCDEFGH"
                factor = 0.5 if spoken else 1.0
                if near("n", 3) and c != "n":
                    factor *= 0.25
                if threat and near("w", 3):
                    factor *= 1.5
                if (insult or threat) and near("y", 4):
                    factor *= 1.25
                elif threat:
                    factor *= 0.5
                strength = "12345678".find(c) + 1 or "ABCDEFGH".find(c) + 1
                total += factor * (strength + (0.5 if c == "y" and near("12345678ABCDEFGH", 4) else 0))
                verb = verb or c == "r"
                hit = hit or insult or threat
                words.append(c)
            if hit:
                scores.append(total)
    return scores


def test_scores_equal_rules_in_words():
    r = random.Random(11)
    for _ in range(4000):
        symbols = "".join(r.choice("oooyynrrw3B,,:.\"\n") for _ in range(r.randrange(1, 25)))
        got = [toxicity.clause_score(c, q) for p in symbols.encode().split(b"\n") for c, q in toxicity.rewrite(p) if toxicity._HIT.search(c)]
        assert got == pytest.approx(plain_score(symbols)), repr(symbols)


def test_reports_and_quotes():
    lexicon = toxicity.Lexicon({"=idiot": 4.0})
    total = lambda t: lexicon.features(t)[1]
    alone = total("you idiot")
    assert total('"Go away. Now" you idiot') == alone and total('5" tall. you idiot') == alone
    assert total("you are an idiot, he said") == total("you are an idiot") / 2 == total("he said you are an idiot")
    assert total('He said: "what a moron. you are an idiot."') == total("what a moron. you are an idiot.") / 2
    assert total('he said "hello\nyou idiot') == alone  # a paragraph ends what it leaves open
    assert total("i will kill you") > total("kill you") > total("kill time")


def test_threats_are_learned(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    rows, labels = [], []
    for i in range(300):
        text = " ".join(word() for _ in range(20))
        if i % 3 == 0:
            text += f" i will zubble{word()} you" if i % 2 else f" you quimp{word()}"
        rows.append((i, text))
        labels.append((i, int(i % 3 == 0)))
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(s.startswith("zubb") for s in model.threats) and not any(s.startswith("quim") for s in model.threats)
    assert {s[:4] for s in model.weights} >= {"zubb", "quim"}


def test_held_out_labels(spark):
    folder = os.environ.get("TEST_LARGE_DIR", "/root/testdata/sf0.1")  # of the smallest tables too few labels are held out
    found = Q.op6_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").select("toxic", "predicted").toPandas()
    right = ((found.toxic == 1) & (found.predicted == 1)).sum()
    assert (found.toxic == 1).sum() >= 50
    assert right / (found.predicted == 1).sum() >= 0.95 and right / (found.toxic == 1).sum() >= 0.85


def test_learned_stems_are_held_out(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    rows, labels = [], []
    for i in range(600):
        text = [word() for _ in range(30)]
        if i % 5 == 0:
            for _ in range(2):
                text.insert(r.randrange(30), "zorgo" + word())
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, marks, train=~Q.held_out(F.col("doc_id")))
    scored = toxicity.score(docs.withColumn("total", F.lit("clash")), model).collect()
    wrong = sum((r["score"] >= 0.5) != (r["doc_id"] % 5 == 0) for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert wrong == 0
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 480


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x " * 50_000), (3, "same"), (3, "same")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == 5 and all(0 <= r["score"] < 0.5 for r in scored)
    assert toxicity.score(docs.limit(0), model).count() == 0


# --- quality rules


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n, covered = collections.Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    r = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b c d e f", "a b c d e a b c d e", "a a a a a a a a", "x\x0by\x0cz\r\n #*$%&|<>", "l\n l\nl\n\nl", "é ü\u00a0ö \x1f q"]
    texts += [" ".join(r.choice("abc") for _ in range(r.randrange(40))) for _ in range(100)] + ["word " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    got = {x["id"]: x for x in quality.line_rules(df).collect()}
    for i, t in enumerate(texts):
        n = measures(t)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == n, repr(t)[:80]
        assert got[i]["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])


def test_line_rules_equal_brute_force(spark):
    r = random.Random(2)
    fresh = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    rows = []
    for i in range(120):
        host = None if i % 10 == 0 else f"h{i % 2}"
        lines = [fresh(12)]
        if i % 3 == 0:
            lines.append("Shared   footer LINE of this host")
        if i % 12 == 0:
            lines = ["shared footer line of this host", "SHARED footer line of this host!" + " two" * 6]
        rows.append((i, host, "\n".join(lines)))
    rows += [(1000 + k, "h1", rows[1][2]) for k in range(200)]  # exact copies condemn nothing
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    norm = lambda x: " ".join(WORD.findall(x.lower()))
    texts, holders = collections.defaultdict(set), collections.defaultdict(set)
    for _, host, text in rows:
        texts[host].add(text)
        for line in text.split("\n"):
            holders[host, norm(line)].add(text)
    over = {k for k, v in holders.items() if len(v) > 5 and len(v) > 0.2 * len(texts[k[0]])}
    got = {x["id"]: x for x in quality.line_rules(df, min_docs=5, host_share=0.2).collect()}
    removed = 0
    for i, host, text in rows:
        lost = sum(len(WORD.findall(x)) for x in text.split("\n") if (host, norm(x)) in over)
        n = measures(text)
        removed += lost
        left = n[0] - lost
        assert got[i]["removed_words"] == lost
        assert got[i]["kept"] == (not (n[0] < 10 or 100 * n[4] > 20 * n[0]) and left >= 10 and left >= 0.3 * n[0])
    assert removed and all(got[1000 + k]["kept"] for k in range(200))
    clean = {x["doc_id"]: x["text"] for x in quality.apply_rules(df, min_docs=5, host_share=0.2).collect()}
    assert set(clean) == {i for i, x in got.items() if x["kept"]}
    assert not any(("footer" in t.lower()) and (("h0", "shared footer line of this host") in over) for i, t in clean.items() if i % 2 == 0 and i % 10)


def test_quality_edges(spark):
    df = spark.createDataFrame([(1, None, None), (1, "s", "a " * 20), (1, "s", "a " * 20), (None, "s", "b c d e f g h i j k l")], "doc_id long, source string, text string")
    df = df.withColumns({"copy": F.lit(1), "lines": F.lit(2), "n_words": F.lit("x")})
    assert quality.line_rules(df).count() == 4 and quality.apply_rules(df).columns == df.columns
    assert [r["doc_id"] for r in quality.apply_rules(df).collect()] == [None]
    assert quality.line_rules(df.limit(0)).count() == 0


# --- neighbours


def test_nearest_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(0)
    v = r.normal(size=(400, 16)).astype(np.float32)
    v[50:90] = v[50]  # many equal vectors: ties go to the smaller id
    rows = [(i, [float(x) for x in v[i]]) for i in range(400)]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] * 16), (None, rows[0][1]), (420, [1.0, 2.0]), (440, [float("inf")] + [0.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = collections.defaultdict(list)
    for x in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, candidates=64, queries=8).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    m = v.astype(float)
    for q in range(0, 400, 20):
        scores = ann.inner(np.broadcast_to(m[q], m.shape), m)
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        assert got.pop(q) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]
    assert not got
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_long_vectors_and_doubles(spark):
    r = np.random.default_rng(1)
    v = r.normal(size=(60, 2500))  # longer than what one single-precision product of int8 holds exactly
    df = spark.createDataFrame([(i, v[i].tolist()) for i in range(60)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for x in ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    for q in (0, 20, 40):
        scores = ann.inner(np.broadcast_to(v[q], v.shape), v)
        assert got[q] == [(i, -s) for s, i in sorted((-s, i) for i, s in enumerate(scores) if i != q)[:5]]


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 1, 0.5)]


def test_nearest_of_large_and_repeated_vectors(spark):
    """Norms beyond doubles, very small vectors, and one row very many times, which no block gathers."""
    rng = np.random.default_rng(11)
    vectors = [(rng.normal(size=5) * 10.0 ** e).tolist() for e in (300, 200, 0, -200, -300, 307, 150, -5)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(50, [1e300] * 5)] * 300 + [(60, [-1e308, 1e308, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    for k in (3, 20, 400):
        found = {}
        for x in ann.nearest(df, F.lit(True), k=k, candidates=3, queries=2).collect():
            found.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
        for q, v in dict(rows).items():
            others = [(i, float(ann.inner(np.array([v]), np.array([w]))[0])) for i, w in rows if i != q]
            want = sorted(others, key=lambda x: (-(x[1] if x[1] == x[1] else -np.inf), x[0]))[:k]
            got = sorted(found[q])
            assert [x[1:] for x in got] == [(i, None if s != s else s) for i, s in want] and [x[0] for x in got] == list(range(1, len(want) + 1))
