"""Hard negatives by vantage-point trees over norm-augmented vectors.

A vector x of whole numbers gets one more component, sqrt(M - |x|^2) with M the largest |x|^2 of
all, and a query q gets a zero there. Then the squared distance is |q|^2 + M - 2 q.x: the row of
the largest inner product is the nearest one, and a window of scores is an annulus of distances.
A vantage-point tree is walked from the nearest on, leaving out what lies outside the annulus,
until k rows of the wanted labels have come. Distances only decide what needs no look; scores
are exact whole numbers.

The rows are dealt to leaves of a small tree over a bounded sample, every leaf to blocks of
bounded size, and each block is a tree of its own in a written index. A query goes to the blocks
that its annulus can reach, and their best are merged.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

#: Rows of a block and queries of a batch at most, and the bytes of their vectors; points of a leaf of a block's tree.
BLOCK, BATCH, BLOCK_BYTES, LEAF = 8192, 16384, 16 << 20, 256
#: Leaves of the tree over the sample at most, and sampled points for each (the sample's bound: LEAVES * SAMPLED rows, SAMPLE_BYTES).
LEAVES, SAMPLED, SAMPLE_BYTES = 512, 32, 16 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Sums of products below this are exact in double precision.
EXACT = float(1 << 52)


def whole_vectors(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, v): floor(scale * x) of every component; rows with a null id, label or vector, or a null or non-finite component, are left out.

    Components beyond a long take its ends.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("bigint"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), whole.alias("v"))


@dataclass
class Ball:
    """A node: points lo .. hi-1, its vantage point and two children (or -1), how far its points are from its parent's vantage point, and their label if they share one."""

    lo: int
    hi: int
    near: float
    far: float
    label: float
    vantage: int = -1
    inner: int = -1
    outer: int = -1


class VantageTree:
    """A vantage-point tree over points with a last, augmented component; order says where its points were."""

    def __init__(self, x: np.ndarray, extra: np.ndarray, labels: np.ndarray, leaf: int = LEAF):
        points = np.column_stack((x, extra))
        order = np.arange(len(points))
        self.nodes: list[Ball] = []
        where: dict[int, int] = {}

        def ball(lo: int, hi: int, d: np.ndarray) -> int:
            own = labels[order[lo:hi]]
            self.nodes.append(Ball(lo, hi, float(d.min()), float(d.max()), float(own[0]) if (own == own[0]).all() else np.nan))
            return len(self.nodes) - 1

        todo = [ball(0, len(points), np.zeros(1))] if len(points) else []
        while todo:
            n = self.nodes[todo.pop()]
            if n.hi - n.lo <= leaf:
                continue
            here = points[order[n.lo : n.hi]]
            start = np.linalg.norm(here - here[0], axis=1)
            vantage = int(order[n.lo + int(start.argmax())])  # a point on the rim parts the others best
            d = np.linalg.norm(here - points[vantage], axis=1)
            if d.max() == 0:
                continue
            by = np.argsort(d, kind="stable")
            order[n.lo : n.hi], d = order[n.lo : n.hi][by], d[by]
            cut = len(d) // 2
            where[id(n)], n.vantage = vantage, 0
            n.inner, n.outer = ball(n.lo, n.lo + cut, d[:cut]), ball(n.lo + cut, n.hi, d[cut:])
            todo += [n.inner, n.outer]
        place = np.empty(len(points), int)
        place[order] = np.arange(len(points))
        for n in self.nodes:
            if id(n) in where:
                n.vantage = int(place[where[id(n)]])
        self.order = order

    def packed(self) -> bytes:
        return np.array([[n.lo, n.hi, n.near, n.far, n.label, n.vantage, n.inner, n.outer] for n in self.nodes], "<f8").tobytes()


def unpacked(data: bytes) -> list[Ball]:
    rows = np.frombuffer(data, "<f8").reshape(-1, 8).tolist()
    return [Ball(int(a), int(b), c, d, e, int(f), int(g), int(h)) for a, b, c, d, e, f, g, h in rows]


def annulus(q: np.ndarray, largest: float, low: int, high: int) -> tuple[float, float, float, float, float]:
    """|q|^2 + M, the room that round-off takes in scores and in distances, and the window with its ends opened where scores are cut off."""
    square = float(q @ q) + largest
    return square, 1e-9 * square + 1, 1e-6 * np.sqrt(square), -np.inf if low <= LEAST else low, np.inf if high >= MOST else high


class Search:
    """A block's tree with its rows: x (by the tree's order, 64-bit), labels, and each point's ids, ascending, with their copies."""

    def __init__(self, nodes: list[Ball], x: np.ndarray, labels: np.ndarray, ids: list, copies: list, largest: float):
        self.nodes, self.whole, self.x, self.labels, self.ids, self.copies, self.largest = nodes, x, x.astype(np.float64), labels, ids, copies, largest
        self.first = np.array([i[0] for i in ids], np.int64)
        self.inner = [k for k, n in enumerate(nodes) if n.inner >= 0]
        self.vantage = self.x[[nodes[k].vantage for k in self.inner]]

    def scores(self, n: Ball, v: list[int], q: np.ndarray) -> np.ndarray:
        """Exact inner products of a leaf's points; beyond a long its ends, beyond doubles by Python's integers."""
        if self.largest < EXACT:
            return self.x[n.lo : n.hi] @ q
        wide = self.whole[n.lo : n.hi].tolist()
        found = np.empty(len(wide), object)
        found[:] = [min(MOST, max(LEAST, sum(a * b for a, b in zip(w, v)))) for w in wide]
        return found

    def query(self, v: list[int], own: int, label: int, same: bool, k: int, windows: list[tuple[int, int]]) -> list[list[tuple]]:
        """For each window (low, high) the k best (score, id, copies) with low <= score <= high, best first; a leaf is scored once for all windows."""
        q = np.array(v, np.float64)
        square = annulus(q, self.largest, 0, 0)[0]
        away = dict(zip(self.inner, np.sqrt(np.maximum(0.0, square - 2 * (self.vantage @ q))).tolist()))
        known: dict[int, list] = {}
        least, most = min(low for low, _ in windows), max(high for _, high in windows)

        def leaf(n: Ball) -> list[tuple]:
            """The leaf's rows of the wanted label that any window takes, as (-score, first id, point), best first."""
            if n.lo not in known:
                s = self.scores(n, v, q)
                at = np.flatnonzero((s >= least) & (s <= most) & ((self.labels[n.lo : n.hi] == label) == same))
                known[n.lo] = sorted(zip((-s[at]).tolist(), self.first[n.lo + at].tolist(), (n.lo + at).tolist()))
            return known[n.lo]

        def nearest(low: int, high: int):
            """Rows from the nearest on; what the heap holds of a node is the best score that it can have."""
            _, slack, blur, low, high = annulus(q, self.largest, low, high)
            heap: list[tuple] = [(-np.inf, 0, 0, 0.0, 0)] if self.nodes else []
            while heap:
                key, kind, item, bound, copies = heapq.heappop(heap)
                if kind:
                    yield -int(key), item, copies
                    continue
                n = self.nodes[item]
                if n.label == n.label and (n.label == label) != same:
                    continue
                if n.inner < 0:
                    rows = leaf(n)
                    at = bisect_left(rows, (-high,))
                    for s, _, p in rows[at : at + k + 1]:  # one of them may be the query's own
                        if s > -low:
                            break
                        for one, many in zip(self.ids[p], self.copies[p]):
                            if one != own:
                                heapq.heappush(heap, (s, 1, one, 0.0, many))
                    continue
                d = away[item]
                for child in (n.inner, n.outer):
                    c = self.nodes[child]
                    closest = max(bound, d - c.far - blur, c.near - d - blur)
                    best = (square - closest**2) / 2 + slack
                    if best >= low and (square - (d + c.far + blur) ** 2) / 2 - slack <= high:
                        heapq.heappush(heap, (-best, 0, child, closest, 0))

        def window(low: int, high: int) -> list[tuple]:
            found, rows = [], 0
            for s, i, many in nearest(low, high):
                found.append((s, i, many))
                rows += many
                if rows >= k:
                    break
            return found

        return [window(low, high) for low, high in windows]


class Top:
    """The tree over the sample: deals rows to leaves and tells which leaves a query's annulus can reach."""

    def __init__(self, sample: np.ndarray, square: float, leaves: int):
        self.square, self.splits, self.leaves = square, [], 0
        points = self.augmented(sample)

        def split(at: np.ndarray, depth: int):
            if depth == 0 or len(at) < 2:
                self.leaves += 1
                return self.leaves - 1
            here = points[at]
            v = here[int(np.linalg.norm(here - here[0], axis=1).argmax())]
            d = np.linalg.norm(here - v, axis=1)
            radius = float(np.median(d))
            k = len(self.splits)
            self.splits.append(None)
            self.splits[k] = (v, radius, split(at[d <= radius], depth - 1), split(at[d > radius], depth - 1)) if (d > radius).any() else (v, np.inf, split(at, 0), split(at[:0], 0))
            return -k - 1

        self.root = split(np.arange(len(points)), max(0, int(np.ceil(np.log2(max(1, leaves))))))

    def augmented(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((x, np.sqrt(np.maximum(0.0, self.square - np.sum(x * x, axis=1)))))

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each augmented point."""
        out, todo = np.zeros(len(points), np.int32), [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if node >= 0:
                out[at] = node
            elif len(at):
                v, radius, inner, outer = self.splits[-node - 1]
                near = np.linalg.norm(points[at] - v, axis=1) <= radius
                todo += [(inner, at[near]), (outer, at[~near])]
        return out

    def reached(self, q: np.ndarray, low: int, high: int) -> list[int]:
        """Leaves that may hold a row of scores low .. high."""
        square, slack, blur, low, high = annulus(q, self.square, low, high)
        point = np.append(q, 0.0)
        out, todo = [], [(self.root, 0.0, np.inf)]
        while todo:
            node, closest, farthest = todo.pop()
            if (square - closest**2) / 2 + slack < low or (square - farthest**2) / 2 - slack > high:
                continue
            if node >= 0:
                out.append(node)
                continue
            v, radius, inner, outer = self.splits[-node - 1]
            d = float(np.linalg.norm(point - v))
            todo += [(inner, max(closest, d - radius - blur), min(farthest, d + radius + blur)), (outer, max(closest, radius - d - blur), farthest)]
        return out


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dim)


@dataclass
class Index:
    """The written trees (dim, leaf, sub and a block's columns), each leaf's number of blocks, the trees over the sample by dim, and M."""

    blocks: DataFrame
    sizes: DataFrame
    tops: dict
    square: float


def build(rows: DataFrame, k: int, block: int | None = None) -> Index:
    """Index all rows (id, label, v).

    Rows of one vector and label are one point with their smallest k + 1 ids and the copies of
    each: a query wants at most k rows and may leave out its own id, so no other of them can be
    in a result. Only the choice of leaves rests on a sample.
    """
    spark = rows.sparkSession
    equal = rows.groupBy("v", "label", "id").agg(F.count("*").alias("copies"))
    first = Window.partitionBy("v", "label").orderBy("id")
    some = equal.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    kept = F.array_sort(F.collect_list(F.struct("id", F.least("copies", F.lit(k)).alias("copies"))))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    points = materialize(some.groupBy("v", "label").agg(kept.alias("held")).select(F.size("v").alias("dim"), "v", "label", "held", square.alias("square")), "points")
    told = points.agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.max("square").alias("square")).first()
    n, widest, whole = told["n"], max(1, told["dim"] or 1), told["square"] or 0.0
    per = block or max(256, min(BLOCK, BLOCK_BYTES // (8 * widest), n // (4 * spark.sparkContext.defaultParallelism)))
    leaves = max(1, min(LEAVES, -(-n // per)))
    sampled = points.select("dim", "v").orderBy(F.xxhash64("v", "label"), "v").limit(max(1, min(SAMPLED * leaves, SAMPLE_BYTES // (8 * widest)))).collect()
    by_dim: dict[int, list] = {}
    for r in sampled:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    tops = {d: Top(np.array(v, np.float64).reshape(len(v), d), whole, leaves * len(v) // len(sampled)) for d, v in by_dim.items()}

    def deal(batches):
        for batch in batches:
            dims, leaf = batch.column("dim").to_numpy(), np.zeros(len(batch), np.int32)
            for d in np.unique(dims):
                if d in tops:
                    at = np.flatnonzero(dims == d)
                    leaf[at] = tops[d].home(tops[d].augmented(_matrix(batch.column("v").take(pa.array(at)), int(d))))
            yield batch.append_column("leaf", pa.array(leaf))

    dealt = materialize(points.mapInArrow(deal, "dim int, v array<bigint>, label bigint, held array<struct<id: bigint, copies: bigint>>, square double, leaf int"), "dealt")
    sizes = materialize(dealt.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / F.lit(2.0 * per)).cast("int").alias("subs")), "sizes")
    spread = dealt.join(sizes, ["dim", "leaf"]).withColumn("sub", F.pmod(F.xxhash64("v", "label"), F.col("subs")).cast("int"))

    def tree(key, table):
        dim, table = key[0].as_py(), table.combine_chunks()
        x = _matrix(table.column("v").combine_chunks(), dim)
        labels = table.column("label").to_numpy()
        made = VantageTree(x, np.sqrt(np.maximum(0.0, whole - table.column("square").to_numpy())), labels)
        held = [table.column("held")[int(i)].as_py() for i in made.order]
        whole_x = table.column("v").combine_chunks().take(pa.array(made.order)).flatten().to_numpy(zero_copy_only=False)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "leaf": pa.array([key[1].as_py()], pa.int32()),
                "sub": pa.array([key[2].as_py()], pa.int32()),
                "nodes": [made.packed()],
                "x": [whole_x.astype("<i8").tobytes()],
                "labels": pa.array([labels[made.order].tolist()], pa.list_(pa.int64())),
                "ids": pa.array([[[h["id"] for h in p] for p in held]], pa.list_(pa.list_(pa.int64()))),
                "copies": pa.array([[[h["copies"] for h in p] for p in held]], pa.list_(pa.list_(pa.int64()))),
            }
        )

    blocks = spread.select("dim", "leaf", "sub", "v", "label", "held", "square").groupBy("dim", "leaf", "sub")
    blocks = blocks.applyInArrow(tree, "dim int, leaf int, sub int, nodes binary, x binary, labels array<bigint>, ids array<array<bigint>>, copies array<array<bigint>>")
    return Index(materialize(blocks, "trees"), sizes, tops, whole)


def search(index: Index, queries: DataFrame, same: bool, k: int, home: bool | None = None, batches: int = 1) -> DataFrame:
    """(query_id, high, score, id): for each window of each query the k best rows of its own label, or of others.

    queries: query_id, label, v, windows (array of low, high). home: the query's own leaf only
    (True), all others (False) or all (None). Ties go to the smaller id; rows of the query's own
    id are left out; a row's copies count each.
    """
    tops, whole = index.tops, index.square

    def route(parts):
        for batch in parts:
            owner, leaf, dims = [], [], []
            vectors, windows = batch.column("v").to_pylist(), batch.column("windows").to_pylist()
            for i, (v, w) in enumerate(zip(vectors, windows)):
                top = tops.get(len(v))
                if top is None:
                    reached = set() if home is False else {0}
                else:
                    q = np.array(v, np.float64)
                    own = {int(top.home(top.augmented(q[None, :]))[0])} if home is not None else set()
                    reached = own if home else {x for one in w for x in top.reached(q, one["low"], one["high"])} - own
                owner += [i] * len(reached)
                leaf += sorted(reached)
                dims += [len(v)] * len(reached)
            rows = batch.take(pa.array(owner, pa.int64()))
            yield rows.append_column("dim", pa.array(dims, pa.int32())).append_column("leaf", pa.array(leaf, pa.int32()))

    kind = "query_id bigint, label bigint, v array<bigint>, windows array<struct<low: bigint, high: bigint>>"
    asked = queries.select("query_id", "label", "v", "windows").mapInArrow(route, f"{kind}, dim int, leaf int")
    asked = asked.join(index.sizes, ["dim", "leaf"]).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).drop("subs")
    asked = asked.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(batches)).cast("int"))
    given = index.blocks.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    key = ["dim", "leaf", "sub", "batch"]
    names = ["query_id", "high", "score", "id", "copies"]

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            block = right.to_pylist()[0]
            x = np.frombuffer(block["x"], "<i8").reshape(len(block["labels"]), block["dim"])
            tree = Search(unpacked(block["nodes"]), x, np.array(block["labels"]), block["ids"], block["copies"], whole)
            for query_id, label, v, windows in zip(*(left.column(c).to_pylist() for c in ("query_id", "label", "v", "windows"))):
                found = tree.query(v, query_id, label, same, k, [(w["low"], w["high"]) for w in windows])
                out += [(query_id, w["high"], s, i, many) for w, rows in zip(windows, found) for s, i, many in rows]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 5)], names)

    found = asked.groupBy(*key).cogroup(given.groupBy(*key)).applyInArrow(look, ", ".join(f"{c} bigint" for c in names))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).drop("copies", "copy")
    return _best(each, k)


def _best(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id", "high").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80, block: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score) for every anchor and each of its positives.

    rows: id, label, v (see whole_vectors); is_anchor: a Column over them. A score is the inner
    product with the anchor, beyond a long the long's end; higher scores come first, ties by
    smaller id. An anchor's positives are its first rows of the same label, its negatives for a
    positive of score p the first rows of another label with percent * p <= 100 * score <=
    100 * p (none if p is negative and percent under 100). Results are exact whatever the trees
    are. Vectors meet only vectors of their own length. A row that repeats counts each time; an
    anchor's id that repeats is one anchor (the row that sorts first) and no partner of itself.
    Anchors without positives, and positives without negatives, have no rows. An empty table
    gives none.

    Positives are looked for in the anchor's own leaf first, and elsewhere only where a better
    one can be.
    """
    rows = materialize(rows.select("id", "label", "v"), "vectors")
    index = build(rows, max(positives, negatives), block)
    window = lambda low, high: F.struct(low.cast("bigint").alias("low"), high.cast("bigint").alias("high"))
    anchors = rows.where(is_anchor).groupBy(F.col("id").alias("query_id")).agg(F.min(F.struct("v", "label")).alias("a")).select("query_id", "a.label", "a.v")
    anchors = materialize(anchors, "anchors")
    told = anchors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    batches = max(1, -(-told["n"] // max(1, min(BATCH, BLOCK_BYTES // (8 * max(1, told["dim"] or 1))))))
    whole = anchors.withColumn("windows", F.array(window(F.lit(LEAST), F.lit(MOST))))
    near = materialize(search(index, whole, True, positives, True, batches).drop("rank"), "near")
    least = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    least = least.select("query_id", F.when(F.col("n") >= positives, F.col("least")).alias("least"))
    open_ = anchors.join(least, "query_id", "left").withColumn("windows", F.array(window(F.coalesce("least", F.lit(LEAST)), F.lit(MOST))))
    far = search(index, open_, True, positives, False, batches).drop("rank")
    found = materialize(_best(near.unionByName(far).withColumn("high", F.lit(MOST)), positives), "positives")
    low = F.ceil(F.col("score").cast("decimal(20,0)") * percent / 100)
    windows = found.select("query_id", "score").distinct().where(F.col("score").cast("decimal(20,0)") >= low)
    windows = windows.groupBy("query_id").agg(F.collect_list(window(low, F.col("score"))).alias("windows"))
    other = search(index, anchors.join(windows, "query_id"), False, negatives, None, batches)
    other = other.select("query_id", F.col("high").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    chosen = found.select("query_id", "score", F.col("id").alias("positive_id"), F.col("rank").alias("positive_rank"))
    return chosen.join(other, ["query_id", "score"]).select(
        F.col("query_id").alias("anchor_id"), "positive_id", "positive_rank", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )
