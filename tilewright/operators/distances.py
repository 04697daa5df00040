"""Points along lines, distances to the nearest line without a reach, and the comparison of boundaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import kernels as K
from ..storage import materialize
from . import exact

#: Metres between samples, and the distances that the comparison's states rest on (fixed values).
SPACING, LEAST_TOLERANCE, NEAR, MINOR, WIDE = 5_000.0, 25.0, 50_000.0, 1_000.0, 5_000.0
#: Points of a batch.
POINTS = 65_536


def points_along(lines: DataFrame, keys: list[str], step: float) -> DataFrame:
    """(keys, part, number, along, x, y): points on every line of each row, evenly spaced and no more than step apart, both ends included.

    lines: keys and wkb; only line parts count, others have no points. A part has two points
    at least. A point's place is found in the running sum of the edges' lengths.
    """
    if not step > 0:
        raise ValueError("step must be positive")
    parts = exact.parts_of(lines.select(*keys, "wkb"), number="part").where("family = 'line'").select(*keys, "part", "wkb")
    schema = T.StructType([*(parts.schema[k] for k in keys), *T._parse_datatype_string("part int, number bigint, along double, x double, y double")])

    def walk(batches):
        for batch in batches:
            held, size = [], 0
            columns = [*keys, "part"]

            def made():
                owner, *rest = (np.concatenate(c) for c in zip(*held))
                at = pa.array(owner)
                return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in columns), *map(pa.array, rest)], schema.names)  # noqa: B023

            for i, data in enumerate(batch.column("wkb").to_pylist()):
                ((_, line),) = K.primitives(*K.from_wkb(data))
                d = line[1:] - line[:-1]
                edges = np.hypot(d[:, 0], d[:, 1])
                ends = np.concatenate(([0.0], np.cumsum(edges)))
                count = max(2, int(np.ceil(ends[-1] / step)) + 1)
                for lo in range(0, count, POINTS):
                    number = np.arange(lo, min(count, lo + POINTS))
                    along = ends[-1] * number / (count - 1)
                    k = np.clip(np.searchsorted(ends, along, "right") - 1, 0, len(edges) - 1)
                    share = np.where(edges[k] > 0, (along - ends[k]) / np.where(edges[k] > 0, edges[k], 1), 0.0)
                    p = line[k] + np.clip(share, 0, 1)[:, None] * d[k]
                    held.append((np.full(len(number), i), number, along, p[:, 0], p[:, 1]))
                    size += len(number)
                    if size >= POINTS:
                        yield made()
                        held, size = [], 0
            if held:
                yield made()

    return exact.spread(parts).mapInArrow(walk, schema)


def edges_of(shapes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x1, y1, x2, y2): the edges of lines and of polygons' rings, and points as edges without length."""
    parts = exact.parts_of(shapes.select(*keys, "wkb")).select(*keys, "wkb")
    names = ["x1", "y1", "x2", "y2"]
    schema = T.StructType([*(parts.schema[k] for k in keys), *[T.StructField(c, T.DoubleType()) for c in names]])

    def split(batches):
        for batch in batches:
            owner, rows = [], []
            for i, data in enumerate(batch.column("wkb").to_pylist()):
                ((kind, shape),) = K.primitives(*K.from_wkb(data))
                lines = [np.vstack((r, r[:1])) for r in shape] if kind == "Polygon" else [shape]
                for r in lines:
                    found = np.hstack((r[:-1], r[1:])) if len(r) > 1 else np.hstack((r, r))
                    owner.append(np.full(len(found), i))
                    rows.append(found)
            if rows:
                at, flat = pa.array(np.concatenate(owner)), np.vstack(rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), *(pa.array(np.ascontiguousarray(flat[:, j])) for j in range(4))], schema.names)

    return exact.spread(parts).mapInArrow(split, schema)


#: Edges of a block and of a leaf in it; points that one task takes to a block; pairs held at a time.
BLOCK, LEAF, AT_A_BLOCK, HELD = 2048, 16, 200_000, 1 << 20


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The place of whole (x, y) below 2**31 along a curve that keeps neighbours together (their bits by turns)."""

    def apart(v):
        v = v.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = (v | (v << np.uint64(shift))) & np.uint64(mask)
        return v

    return (apart(x) | (apart(y) << np.uint64(1))).astype(np.int64)


def _frames(e: np.ndarray, size: int) -> np.ndarray:
    """(n, 4) bounds of every `size` edges in turn."""
    at = np.arange(0, len(e), size)
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    return np.hstack((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))


def _to_frames(p: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes (points, boxes), 0 within."""
    dx = np.maximum(np.maximum(b[None, :, 0] - p[:, None, 0], p[:, None, 0] - b[None, :, 2]), 0)
    dy = np.maximum(np.maximum(b[None, :, 1] - p[:, None, 1], p[:, None, 1] - b[None, :, 3]), 0)
    return dx * dx + dy * dy


def _to_edges(p: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distance of each point to the edge beside it."""
    d, v = e[..., 2:] - e[..., :2], p - e[..., :2]
    size = (d * d).sum(axis=-1)
    t = np.where(size > 0, np.clip((v * d).sum(axis=-1) / np.where(size > 0, size, 1), 0, 1), 0)
    return np.hypot(e[..., 0] + t * d[..., 0] - p[..., 0], e[..., 1] + t * d[..., 1] - p[..., 1])


def _nearest(p: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distance of each point to the nearest of the edges: that of the nearest leaf first, then leaves whose bounds are nearer."""
    leaves = _frames(e, LEAF)
    padded = np.vstack((e, np.repeat(e[-1:], -len(e) % LEAF, axis=0))).reshape(-1, LEAF, 4)
    out = np.empty(len(p))
    step = max(1, HELD // len(leaves))
    for lo in range(0, len(p), step):
        q = p[lo : lo + step]
        away = _to_frames(q, leaves)
        first = away.argmin(axis=1)
        best = _to_edges(q[:, None], padded[first]).min(axis=1)
        away[np.arange(len(q)), first] = np.inf
        i, k = np.nonzero(away < (best * best)[:, None])
        for at in range(0, len(i), HELD // LEAF):
            some = slice(at, at + HELD // LEAF)
            np.minimum.at(best, i[some], _to_edges(q[i[some], None], padded[k[some]]).min(axis=1))
        out[lo : lo + step] = best
    return out


def _blocks(edges: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """(keys, block, frame, packed): every BLOCK edges of a key that are near each other and of like size.

    Edges are dealt by ranges of key, size and place along a curve, so a task holds a range.
    """
    low = edges.agg(F.min(F.least("x1", "x2")).alias("a"), F.min(F.least("y1", "y2")).alias("b"), F.max(F.greatest("x1", "x2")).alias("c"), F.max(F.greatest("y1", "y2")).alias("d")).first()
    if low["a"] is None:
        low = {c: 0.0 for c in "abcd"}
    step = max(float(tile) / 1024, (low["c"] - low["a"]) / 2**30, (low["d"] - low["b"]) / 2**30)
    west, south = low["a"], low["b"]

    def place(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
        a, b, c, d = (v.to_numpy(zero_copy_only=False) for v in (x1, y1, x2, y2))
        return pa.array(_curve(((a + c) / 2 - west) / step, ((b + d) / 2 - south) / step))

    sized = F.floor(F.log2(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")), F.lit(step))) / 3)
    placed = edges.withColumn("__size", sized).withColumn("__at", F.arrow_udf(place, T.LongType())("x1", "y1", "x2", "y2"))
    by = [*keys, "__size", "__at"]
    schema = T.StructType([*(edges.schema[k] for k in keys), *T._parse_datatype_string("frame array<double>, packed binary")])

    def pack(batches):
        for group in exact._groups(batches, [*keys, "__size"]):
            first = group.select(keys).slice(0, 1).combine_chunks()
            e = np.column_stack([group.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")])
            frames = _frames(e, BLOCK).tolist()
            packed = [e[lo : lo + BLOCK].astype("<f8").tobytes() for lo in range(0, len(e), BLOCK)]
            at = pa.array([0] * len(packed), pa.int64())
            table = pa.table([*(first.column(k).take(at) for k in keys), pa.array(frames, pa.list_(pa.float64())), pa.array(packed, pa.binary())], schema.names)
            yield from table.combine_chunks().to_batches()

    dealt = placed.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialize(dealt.mapInArrow(pack, schema).withColumn("block", F.monotonically_increasing_id()), "blocks")


def _visits(asked: DataFrame, blocks: DataFrame, keys: list[str], again: bool) -> DataFrame:
    """(row, x, y, block): the block of its key whose bounds are nearest each point; again, the others that are nearer than the distance found."""
    schema = T.StructType([*(asked.schema[c] for c in ("__row", "x", "y")), T.StructField("block", T.LongType())])
    own_frames: dict[tuple, list] = {}
    for r in blocks.select(*keys, "block", "frame").toLocalIterator():  # a row for BLOCK edges
        own_frames.setdefault(tuple(r[:-2]), []).append((r["block"], r["frame"]))
    known = {k: (np.array([b for b, _ in v], np.int64), np.array([f for _, f in v])) for k, v in own_frames.items()}

    def visit(batches):
        for batch in batches:
            own = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            of: dict[tuple, list[int]] = {}
            for i, k in enumerate(own):
                of.setdefault(k, []).append(i)
            p = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y")])
            for k, rows in of.items():
                if k not in known:
                    continue
                ids, boxes = known[k]
                rows = np.array(rows)
                step = max(1, HELD // len(ids))
                for lo in range(0, len(rows), step):
                    some = rows[lo : lo + step]
                    away = _to_frames(p[some], boxes)
                    first = away.argmin(axis=1)
                    if again:
                        found = batch.column("distance").to_numpy(zero_copy_only=False)[some]
                        away[np.arange(len(some)), first] = np.inf
                        i, j = np.nonzero(away < (found * found)[:, None])
                    else:
                        i, j = np.arange(len(some)), first
                    at = pa.array(some[i])
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("__row", "x", "y")), pa.array(ids[j])], schema.names)

    return exact.spread(asked).mapInArrow(visit, schema)


def _met(visits: DataFrame, blocks: DataFrame) -> DataFrame:
    """(row, distance) of every visit. A task reads a block's edges and then its points in batches; a block with many points is read by several tasks."""
    visits = materialize(visits, "visits")
    shares = visits.groupBy("block").agg(F.ceil(F.count("*") / F.lit(AT_A_BLOCK)).cast("int").alias("shares"))
    told = blocks.select("block", "packed").join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    edges = told.select("block", "share", F.lit(0).alias("side"), "packed", none("__row", "bigint"), none("x", "double"), none("y", "double"))
    dealt = visits.join(shares, "block").withColumn("share", F.pmod(F.xxhash64("__row"), F.col("shares")).cast("int"))
    points = dealt.select("block", "share", F.lit(1).alias("side"), none("packed", "binary"), "__row", "x", "y")
    schema = T._parse_datatype_string("__row bigint, distance double")

    def meet(batches):
        held = None
        for batch in batches:
            side = batch.column("side").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero(side == 0).tolist()
            for lo, hi in zip([0, *turns], [*turns, batch.num_rows]):
                if lo < hi and side[lo] == 0:
                    held = np.frombuffer(batch.column("packed")[lo].as_py(), "<f8").reshape(-1, 4)
                    lo += 1
                if lo < hi:
                    rows = batch.slice(lo, hi - lo)
                    p = np.column_stack([rows.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y")])
                    yield pa.RecordBatch.from_arrays([rows.column("__row"), pa.array(_nearest(p, held))], schema.names)

    by = ["block", "share"]
    return exact.spread(edges.unionByName(points), *by).sortWithinPartitions(*by, "side").mapInArrow(meet, schema)


def nearest_edge(points: DataFrame, edges: DataFrame, id_col: str, tile: float, keys: list[str] | None = None) -> DataFrame:
    """(id, distance): the distance of every point (id, keys, x, y) to the nearest edge (keys, x1, y1, x2, y2) of its key, at any distance.

    Equal edges are one, and so are points of equal key and place. Edges are packed in blocks of
    neighbours, by squares of a thousandth of a tile along a curve. A point goes to the block
    whose bounds are nearest, and then to the others whose bounds are nearer than the edge
    found, so few edges are compared and none is left out; blocks and points meet by an
    equi-join. Points without an edge of their key, or without a place, get null; repeated ids
    have a row each.
    """
    keys = list(keys or ())
    places = [*keys, "x", "y"]
    rows = materialize(points.select(id_col, *places), "points")
    whole = rows.where(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" if c in ("x", "y") else f"`{c}` is not null" for c in places))
    asked = materialize(whole.select(*places).distinct().withColumn("__row", F.monotonically_increasing_id()), "places")
    ends = ["x1", "y1", "x2", "y2"]
    sound = [f"{c} is not null" for c in ends] + [f"`{k}` is not null" for k in keys]
    given = materialize(edges.select(*keys, *ends).where(" and ".join(sound)).distinct(), "edges")
    blocks = _blocks(given, keys, tile)
    first = materialize(_met(_visits(asked, blocks, keys, False), blocks), "near")
    more = _met(_visits(asked.join(first, "__row"), blocks, keys, True), blocks)
    near = first.unionByName(more).groupBy("__row").agg(F.min("distance").alias("distance"))
    found = asked.join(near, "__row").select(*places, "distance")
    return rows.join(found, places, "left").select(id_col, "distance")


def reconcile(sections: DataFrame, comparisons: DataFrame, tile: float, spacing: float = SPACING) -> DataFrame:
    """One row for each section and comparison source: how far the section's samples lie from it, and the state that follows.

    sections: section_id, wkb (lines), precision (metres or null); comparisons: source_id, wkb,
    accuracy (metres or null), any number of rows for each source, which are few and declared;
    both in metres of one plane. A sample is taken every `spacing` metres or less. A source's
    accuracy is the median of its rows', and the tolerance is the larger precision, 25 at
    least. The states, in this order: no distances; none within 50 km; 90 % within the tolerance;
    the 95th percentile within 1 km or five tolerances; 90 % within 5 km; else unresolved.
    """
    sections = materialize(exact.spread(sections.select("section_id", "wkb", "precision")), "sections")
    samples = points_along(sections.select("section_id", "wkb"), ["section_id"], spacing).select("section_id", "x", "y")
    sources = comparisons.groupBy("source_id").agg(F.coalesce(F.median("accuracy"), F.lit(0.0)).alias("accuracy"))
    sources = materialize(sources, "sources")
    asked = samples.crossJoin(F.broadcast(sources.select("source_id")))  # the declared sources
    asked = materialize(asked.withColumn("sample", F.monotonically_increasing_id()), "samples")
    away = nearest_edge(asked, edges_of(comparisons, ["source_id"]), "sample", tile, ["source_id"])
    precision = sections.groupBy("section_id").agg(F.coalesce(F.max("precision"), F.lit(0.0)).alias("precision"))
    pairs = precision.crossJoin(F.broadcast(sources)).withColumn("tolerance", F.greatest(F.lit(LEAST_TOLERANCE), "precision", "accuracy"))
    told = asked.join(away, "sample").join(pairs.select("section_id", "source_id", "tolerance"), ["section_id", "source_id"])
    share = lambda most: F.avg(F.when(F.col("distance").isNotNull(), (F.col("distance") <= most).cast("double")))
    stats = told.groupBy("section_id", "source_id").agg(
        F.count("*").alias("samples"),
        F.min("distance").alias("min_distance"),
        F.median("distance").alias("median_distance"),
        F.percentile("distance", 0.95).alias("p95_distance"),
        F.max("distance").alias("max_distance"),
        share(F.col("tolerance")).alias("share_within_precision"),
        share(WIDE).alias("share_within_5km"),
    )
    out = pairs.join(stats, ["section_id", "source_id"], "left").withColumn("samples", F.coalesce("samples", F.lit(0)))
    c = F.col
    status = (
        F.when(c("min_distance").isNull(), "comparison_geometry_unavailable")
        .when(c("min_distance") > NEAR, "no_comparable_geometry_near_section")
        .when(c("share_within_precision") >= 0.9, "aligned_within_reported_precision")
        .when(c("p95_distance") <= F.greatest(F.lit(MINOR), c("tolerance") * 5), "minor_divergence_within_1km")
        .when(c("share_within_5km") >= 0.9, "divergence_within_5km_review_required")
        .otherwise("unresolved_divergence")
    )
    return out.drop("precision", "accuracy").withColumn("status", status)


#: States that leave a comparison open (fixed values).
OPEN = ("divergence_within_5km_review_required", "unresolved_divergence", "comparison_geometry_unavailable")


def reconciliation_status(compared: DataFrame, primary: list[str]) -> DataFrame:
    """(section_id, reconciliation_status, qc_status, summary): a section is unresolved if its comparison with a primary source is open."""
    bad = F.bool_or(F.col("source_id").isin(*primary) & F.col("status").isin(*OPEN))
    listed = F.array_join(F.array_sort(F.collect_list(F.concat("source_id", F.lit("="), "status"))), "; ")
    per = compared.groupBy("section_id").agg(bad.alias("bad"), listed.alias("summary"))  # a row for each declared source
    said = lambda a, b: F.when(F.col("bad"), a).otherwise(b)
    return per.select("section_id", said("unresolved_source_divergence", "source_compared").alias("reconciliation_status"), said("review_required", "pass_with_limitations").alias("qc_status"), "summary")


def marine_class(name: str | Column) -> Column:
    """The class of a boundary's section by its name (fixed words)."""
    text = F.lower(F.col(name) if isinstance(name, str) else name)
    return F.when(text.contains("strait") | text.contains("canal"), "marine").when(text.contains("southeast alaska"), "mixed_land_marine").otherwise("terrestrial")
