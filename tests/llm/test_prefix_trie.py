"""The trie of prefixes against a walk over all conversations in Python."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from tilewright.llm import prefix_trie as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, family=None):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    made = own
    if family:
        made = {}
        for c in own:
            h = zlib.crc32(str(c).encode()) % 4
            made[c] = own.get(c - int(math.fmod(c, family)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            nodes[tuple(made[c][:d])].append(c)
    children, sums = defaultdict(int), defaultdict(lambda: [0, 0])
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        saved = (len(members) - 1) * len(WORDS.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            sums[path[:d]][0] += saved
            sums[path[:d]][1] += not children[path]
    sha = lambda cs: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
    return sorted(
        (m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), children[p], sums[p][1], sums[p][0], sha([c for c in m if len(made[c]) == len(p)])) for p, m in nodes.items()
    )


def test_query_equals_brute_force(spark, sf, duck):
    from tilewright.llm.queries import op12_prefix_trie

    rows = duck.sql("select conv_id, turn, role, text from conversations").fetchall()
    assert sorted(map(tuple, op12_prefix_trie(spark, sf).collect())) == brute(rows, 20)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, d int").repartition(3)


def test_odd_rows(spark):
    """Nulls in every column, negative ids, repeated rows, ties, turnless conversations, one very common beginning, one long conversation."""
    rng, rows = random.Random(7), []
    for c in range(-30, 90):
        for turn in range(rng.randrange(1, 6)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "", None, "a b  c"])))
    rows += [(200 + c, t, "user", f"same {t}") for c in range(40) for t in range(6)]
    rows += [(300, t, "user", f"turn {t}") for t in range(45)] + [(301, t, "user", f"turn {t}") for t in range(37)]
    rows += [(302, 1, "user", "again")] * 20 + [(None, 1, "user", "lost"), (303, None, None, None), (305, 0, "user", "long " * 50_000)]
    made = T.prefix_trie(*T.with_family_heads(T.numbered_turns(frame(spark, rows))))
    assert sorted(map(tuple, made.collect()), key=lambda r: (r[0], r[1])) == brute(rows, 20)
    assert sorted(map(tuple, T.trie_of(frame(spark, rows)).collect()), key=lambda r: (r[0], r[1])) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")]])
def test_no_conversations(spark, rows):
    assert T.trie_of(frame(spark, rows)).collect() == []
    assert T.prefix_trie(*T.with_family_heads(T.numbered_turns(frame(spark, rows)))).collect() == []


def test_lists_over_chunks(spark):
    rows = [(c, 0, "user", "all alike") for c in range(-5000, 9000, 3)]
    assert sorted(map(tuple, T.trie_of(frame(spark, rows)).collect())) == brute(rows)
