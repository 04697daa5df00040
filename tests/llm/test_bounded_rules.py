"""The quality rules on a hot host and on groups of near copies."""

import collections
import hashlib
import random
import re

from pyspark.sql import functions as F

from tilewright.llm import quality


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def _own(i, n=15):
    return " ".join(f"w{i}x{k}" for k in range(n))


def test_limit_does_not_grow_with_the_host(spark):
    shared, short = "this passage is on many pages", "read more"
    rows = [(i, "hot", "\n".join([_own(i)] + ([shared, short] if i < 30 else []))) for i in range(400)]
    options = {"min_docs": 5, "host_share": 0.1}
    lost = lambda **more: {x["id"]: x["removed_words"] for x in quality.line_rules(_frame(spark, rows), **options, **({"max_docs": None, "by_group": False} | more)).collect()}
    assert set(lost().values()) == {0}  # 30 is under a tenth of 400
    bounded = lost(max_docs=20)
    assert all(bounded[i] == (6 if i < 30 else 0) for i in range(400))
    assert set(lost(max_docs=30).values()) == {0}


def test_near_copies_do_not_condemn_their_own_lines(spark):
    body = [_own(f"b{k}") for k in range(12)]
    footer = "footer of all pages here"
    rows = [(i, "h", "\n".join([*body[: i % 12], _own(f"changed{i}"), *body[i % 12 + 1 :]])) for i in range(30)]
    rows += [(100 + i, "h", f"{_own(i)}\n{footer}") for i in range(30)]
    got = {x["id"]: x for x in quality.line_rules(_frame(spark, rows), by_group=False).collect()}
    assert not any(got[i]["kept"] for i in range(30))  # counted each, the whole group is lost
    got = {x["id"]: x for x in quality.line_rules(_frame(spark, rows), **quality.BOUNDED).collect()}
    assert all(got[i]["kept"] and got[i]["removed_words"] == 0 for i in range(30))
    assert all(got[100 + i]["kept"] and got[100 + i]["removed_words"] == 5 for i in range(30))


WORDS = re.compile("[^\\x20\\x09-\\x0D]+")


def brute(rows, min_docs=20, share=0.01, max_docs=200):
    """kept and removed words by the bounded rule, from plain sets."""
    line = lambda x: " ".join(WORDS.findall(x.lower()))
    split = {k: [(line(x), len(WORDS.findall(x))) for x in (t or "").split("\n") if WORDS.search(x)] for k, (_, _, t) in enumerate(rows)}
    host = {k: s or "" for k, (_, s, _) in enumerate(rows)}
    texts = collections.defaultdict(set)
    for k, lines in split.items():
        if lines:
            texts[host[k]].add(rows[k][2])

    def over(held, among):
        size = {}
        for k, lines in split.items():
            for x, n in lines:
                size[host[k], x] = max(size.get((host[k], x), 0), n)
        return {key: size[key] for key, who in held.items() if key in among and len(who) > min_docs and (len(who) > share * len(texts[key[0]]) or len(who) > max_docs and size[key] >= 4)}

    held = collections.defaultdict(set)
    for k, lines in split.items():
        for x, _ in lines:
            held[host[k], x].add(rows[k][2])
    first = over(held, set(held))
    held = collections.defaultdict(set)
    for k, lines in split.items():
        inside = [(x, n) for x, n in lines if (host[k], x) in first]
        words = sum(n for _, n in lines)
        longest = max((first[host[k], x], hashlib.md5(x.encode()).hexdigest()[:15]) for x, _ in inside) if inside else None
        for x, _ in inside:
            held[host[k], x].add(("copies", longest[1]) if words - sum(n for _, n in inside) < 0.3 * words else rows[k][2])
    last = over(held, set(first))
    return {rows[k][0]: sum(n for x, n in lines if (host[k], x) in last) for k, lines in split.items()}


def test_bounded_rule_equals_brute_force(spark):
    rng = random.Random(5)
    common = [f"common line number {i}" for i in range(6)] + ["read more", "next"]
    rows = []
    for i in range(900):
        host = "hot" if i % 3 else rng.choice(["a", "b", None])
        lines = [_own(i, rng.randrange(1, 12))] + [x for j, x in enumerate(common) if rng.random() < 0.05 * (j + 1)]
        rows.append((i, host, "\n".join(lines)))
    rows += [(1000 + i, "hot", "\n".join(common[: i % 8])) for i in range(90)] + [(2000, None, None), (2001, "hot", ""), (2002, "hot", " \n\t\n")]
    options = {"min_docs": 20, "host_share": 0.2, "max_docs": 60}
    got = {x["id"]: x["removed_words"] for x in quality.line_rules(_frame(spark, rows), **options).collect()}
    assert got == brute(rows, 20, 0.2, 60) and sum(got.values()) > 500


def test_odd_tables(spark):
    """Null, empty, repeated and very long rows, clashing names, an empty table."""
    long = "\n".join(_own(9, 40) for _ in range(3)) + " end" * 50_000
    rows = [(None, None, None), (None, None, None), (1, "h", long), (1, "h", long), (2, "h", "")]
    frame = _frame(spark, rows).withColumn("copy", F.lit(1)).withColumn("host", F.lit("x"))
    got = quality.line_rules(frame).collect()
    assert sorted((r["id"] or 0, r["n_words"], r["kept"]) for r in got) == [(0, 0, False), (0, 0, False), (1, 50_120, False), (1, 50_120, False), (2, 0, False)]
    assert quality.line_rules(frame.limit(0)).count() == 0 and quality.apply_rules(frame).count() == 0
