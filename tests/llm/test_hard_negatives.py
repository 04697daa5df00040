"""Hard negatives against brute force: planted ties, repeated rows, odd vectors, one very common vector, numbers beyond doubles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.llm import hard_negatives as H


def brute(rows, anchor, positives=5, negatives=5, percent=80):
    fine = [(i, l, [min(H.MOST, max(H.LEAST, math.floor(256.0 * x) if abs(256.0 * x) < math.inf else math.copysign(H.MOST, x))) for x in v]) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, l, [int(x) for x in v]) for i, l, v in fine]
    cut = lambda s: min(H.MOST, max(H.LEAST, s))
    out = []
    for a in sorted({i for i, _, _ in fine if anchor(i)}):
        v, label = min((v, l) for i, l, v in fine if i == a)
        scored = sorted((-cut(sum(x * y for x, y in zip(v, w))), i, l) for i, l, w in fine if i != a and len(w) == len(v))
        for s, i, l in [r for r in scored if r[2] == label][:positives]:
            fit = [r for r in scored if r[2] != label and percent * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(a, i, k, r[1], -s, -r[0]) for k, r in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, anchor, **options):
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, label int, embedding array<double>, leaf int").repartition(3)
    found = H.mine(H.whole_vectors(frame), anchor, **options)
    return sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_query_equals_brute_force(spark, sf, duck):
    from tilewright.llm.queries import op11_hard_negatives

    rows = duck.sql("select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end, embedding from embeddings").fetchall()
    assert sorted(map(tuple, op11_hard_negatives(spark, sf).collect())) == brute(rows, lambda i: i % 100 == 0)


@pytest.mark.parametrize("seed", range(2))
def test_odd_rows(spark, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, 8))
    rows = [(i, int(rng.integers(0, 4)), (middles[i % 6] + rng.normal(size=8) * 0.2).round(1).tolist()) for i in range(600)]
    rows += [(1000 + i, i % 3, [0.5] * 8) for i in range(300)]  # one very common vector
    rows += [(20, 1, [0.25] * 8)] * 9 + [(2000, 1, [0.5] * 8)] * 9  # repeated rows, an anchor's too
    rows += [(3000 + i, i % 2, [0.0] * 8) for i in range(20)] + [(3100 + i, i % 2, [float(i), 1.0]) for i in range(30)] + [(3200 + i, i % 2, []) for i in range(12)]
    rows += [(None, 1, [1.0] * 8), (4001, None, [1.0] * 8), (4002, 1, None), (4003, 1, [None] + [1.0] * 7), (4020, 1, [math.nan] + [1.0] * 7), (4040, 1, [math.inf] * 8)]
    found = mined(spark, rows, F.col("id") % 20 == 0, block=64)
    assert found == brute(rows, lambda i: i % 20 == 0) and len(found) > 500


def test_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, (rng.normal(size=3) * 10.0 ** rng.choice([0, 6, 12])).tolist()) for i in range(120)] + [(200 + i, i % 2, [1e300, -1e300, 1.0]) for i in range(12)]
    assert mined(spark, rows, F.col("id") % 10 == 0, block=32) == brute(rows, lambda i: i % 10 == 0)


def test_empty(spark):
    assert mined(spark, [], F.col("id") % 10 == 0) == []
    assert mined(spark, [(10, 1, [1.0])], F.col("id") % 10 == 0) == []


def test_the_tree_leaves_out_what_it_can():
    """On vectors of few directions most leaves are never looked at."""
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(40, 4))
    middles /= np.linalg.norm(middles, axis=1)[:, None]
    x = np.floor(256 * (np.repeat(middles, 100, axis=0) + rng.normal(size=(4000, 4)) * 0.01)).astype(np.int64)
    largest, labels = float((x * x).sum(axis=1).max()), np.arange(4000) % 5
    tree = H.VantageTree(x.astype(float), np.sqrt(largest - (x * x).sum(axis=1)), labels, leaf=64)
    search = H.Search(tree.nodes, x[tree.order], labels[tree.order], [[int(i)] for i in tree.order], [[1]] * 4000, largest)
    looked, plain = [], search.scores
    search.scores = lambda n, v, q: looked.append(n) or plain(n, v, q)
    (found,) = search.query(x[7].tolist(), 7, int(labels[7]), False, 5, [(0, H.MOST)])
    want = sorted((-int(x[7] @ x[i]), i) for i in range(4000) if labels[i] != labels[7] and x[7] @ x[i] >= 0)[:5]
    assert [(-s, i) for s, i, _ in found] == want
    assert len(looked) < sum(n.inner < 0 for n in tree.nodes) / 2
