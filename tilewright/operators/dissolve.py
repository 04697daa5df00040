"""Unions of polygons as geometry, by tile and then over the seams of tiles; buffers and boundaries.

A task unites the pieces of one key in one tile. Faces of neighbouring tiles that share a stretch of
their seam are linked, links are followed to connected components in rounds of joins, and a
component's faces are united once more, which takes the seams out. What one task holds is the
pieces of a tile, and then one polygon of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import kernels as K, noding as N, planar as P
from ..storage import materialize
from . import exact
from .exact import BOX

#: Points of a quarter of a round corner.
QUARTER = 8


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links (a, b) connect each node with.

    In every round a node takes the smallest component of its neighbours and then that of its
    component, so paths get shorter by half; rounds end when nothing changes. Nothing but
    counts comes to the driver.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    found = materialize(nodes.select("id", F.col("id").alias("component")), "components")
    while True:
        beside = both.join(found.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("other"))
        closer = found.join(beside, "id", "left").select("id", F.col("component").alias("old"), F.least("component", "other").alias("component"))
        closer = materialize(closer, "components")
        jump = closer.select(F.col("id").alias("component"), F.col("component").alias("root"))
        moved = materialize(closer.join(jump, "component").select("id", "old", F.least("component", "root").alias("component")), "components")
        found = moved.select("id", "component")
        if not moved.where("old <> component").head(1):
            return found


def _wkb(rings: list[np.ndarray]) -> bytes:
    return K.to_wkb("Polygon", [np.vstack((r, r[:1])).tolist() for r in rings])


def _valid(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    return [rings] if P.is_simple(rings) else N.make_valid(rings)


_SEAMS = "array<struct<axis: int, line: bigint, across: bigint, side: int, low: double, high: double>>"


def _seams(polygon: list[np.ndarray], bx: int, by: int, tile: float) -> list[dict]:
    """The stretches of a polygon's edges on the borders of its tile: the border's axis and number, the tile's number along it, and on which side of it the polygon lies."""
    near, out = 1e-9 * tile, []
    a, b = np.vstack(polygon), np.vstack([np.roll(r, -1, axis=0) for r in polygon])
    for axis, number, across in ((0, bx, by), (1, by, bx)):
        for side in (0, 1):
            at = (number + side) * tile
            on = (np.abs(a[:, axis] - at) <= near) & (np.abs(b[:, axis] - at) <= near)
            for low, high in np.sort(np.column_stack((a[on, 1 - axis], b[on, 1 - axis])), axis=1).tolist():
                out.append({"axis": axis, "line": number + side, "across": across, "side": side, "low": low, "high": high})
    return out


def dissolve(parts: DataFrame, keys: list[str], tile: float) -> DataFrame:
    """(keys, component, wkb, area): the polygons that the polygon parts of each key cover together, without inner edges.

    parts: keys, family, wkb and bounds (see exact.parts_of), in a plane; other families have no
    area and are left out. Parts whose rings cross or touch count by the even-odd rule each. The
    polygons are valid; two that meet at a point only, or along less than 1e-9 of a tile, are
    apart. component tells the polygons of a key apart. Null keys are keys too; a key without
    area has no rows. A polygon of the result must fit a task, as it is one row.
    """
    own = parts.where("family = 'polygon'").select(*keys, "family", "wkb", *BOX)
    cut = exact.pieces(own, exact.tiles_under(own, tile), tile, earth=False).select(*keys, "family", "cell_id", "piece")
    cut = cut.dropDuplicates([*keys, "cell_id", "piece"])
    by = [*keys, "cell_id"]
    made = T._parse_datatype_string(f"bx bigint, by bigint, wkb binary, seams {_SEAMS}")
    schema = T.StructType([*(cut.schema[k] for k in keys), *made])

    def united(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in made.fields]
        for group in exact._groups(batches, by):
            bx, by_ = map(int, group.column("cell_id")[0].as_py().split("_"))
            polygons = [v for p in group.column("piece").to_pylist() for v in _valid(exact._unpacked(p))]
            faces = N.union(polygons)
            at = pa.array([0] * len(faces), pa.int64())
            rows = [(bx, by_, _wkb(f), _seams(f, bx, by_, tile)) for f in faces]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, kinds)]
            first = group.select(keys).slice(0, 1).combine_chunks()
            yield from pa.table([*(first.column(k).take(at) for k in keys), *columns], [*keys, *made.names]).combine_chunks().to_batches()

    faces = exact.spread(cut, *by).sortWithinPartitions(*by).mapInArrow(united, schema)
    faces = materialize(faces.withColumn("id", F.monotonically_increasing_id()), "faces")
    seams = faces.select(*keys, "id", F.explode("seams").alias("s")).select(*keys, "id", "s.*")
    left, right = seams.where("side = 1").alias("l"), seams.where("side = 0").alias("r")
    where = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, "axis", "line", "across")]
    room = 1e-9 * tile
    touching = (F.col("l.low") < F.col("r.high") - room) & (F.col("r.low") < F.col("l.high") - room)
    links = left.join(right, [*where, touching]).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    whole = faces.select(*keys, "id", "wkb").join(components(faces.select("id"), links), "id").drop("id")
    done = T.StructType([*(cut.schema[k] for k in keys), *T._parse_datatype_string("component bigint, wkb binary, area double")])

    def joined(batches):
        for group in exact._groups(batches, ["component"]):
            shapes = [K.primitives(*K.from_wkb(d))[0][1] for d in group.column("wkb").to_pylist()]
            found = shapes if len(shapes) == 1 else N.union(shapes)
            first = group.select([*keys, "component"]).slice(0, 1).combine_chunks()
            at = pa.array([0] * len(found), pa.int64())
            areas = [sum(P.ring_area(r) for r in P.oriented(f)) for f in found]
            table = pa.table([*(first.column(k).take(at) for k in (*keys, "component")), pa.array([_wkb(f) for f in found], pa.binary()), pa.array(areas, pa.float64())], done.names)
            yield from table.combine_chunks().to_batches()

    return exact.spread(whole, "component").sortWithinPartitions("component").mapInArrow(joined, done)


def _round(a: np.ndarray, b: np.ndarray, distance: float, quarter: int) -> np.ndarray:
    """The points within a distance of a segment, with round ends, counter-clockwise."""
    way = float(np.arctan2(*(b - a)[::-1])) if (a != b).any() else 0.0
    turn = np.linspace(-np.pi / 2, np.pi / 2, 2 * quarter + 1)
    ends = [p + distance * np.column_stack((np.cos(way + t), np.sin(way + t))) for p, t in ((b, turn), (a, turn + np.pi))]
    return np.vstack(ends)


def buffer(features: DataFrame, keys: list[str], distance: float, tile: float, quarter: int = QUARTER) -> DataFrame:
    """(keys, component, wkb, area): what lies within a distance of each key's points, lines and polygons, as dissolved polygons.

    features: keys and wkb, in a plane. Every edge becomes the shape of the points near it, so
    corners are round (in `quarter` steps a quarter, on the circle, so a little is cut off);
    the shapes and the polygons themselves are dissolved by tile. A distance that is not
    positive is an error.
    """
    if not distance > 0:
        raise ValueError("a buffer's distance must be positive")
    parts = exact.parts_of(features.select(*keys, "wkb")).select(*keys, "family", "wkb")
    schema = T.StructType([*(parts.schema[k] for k in keys), T.StructField("wkb", T.BinaryType())])

    def around(batches):
        for batch in batches:
            for i, data in enumerate(batch.column("wkb").to_pylist()):
                ((kind, shape),) = K.primitives(*K.from_wkb(data))
                lines = [np.vstack((r, r[:1])) for r in shape] if kind == "Polygon" else [shape]
                ends = [(p, q) for r in lines for p, q in (zip(r[:-1], r[1:]) if len(r) > 1 else [(r[0], r[0])])]
                made = [data] * (kind == "Polygon") + [_wkb([_round(p, q, distance, quarter)]) for p, q in ends]
                at = pa.array([i] * len(made), pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), pa.array(made, pa.binary())], [*keys, "wkb"])

    near = parts.select(*keys, "wkb").mapInArrow(around, schema)
    return dissolve(exact.parts_of(near), keys, tile)


def boundary(data):
    """WKB of a WKB column's boundary: the rings of polygons and the ends of open lines; null where there is none."""

    def run(a: pa.Array) -> pa.Array:
        out = []
        for d in a.to_pylist():
            lines, points = [], []
            for kind, shape in K.primitives(*K.from_wkb(d)) if d is not None else []:
                if kind == "Polygon":
                    lines += [np.vstack((r, r[:1])).tolist() for r in shape]
                elif kind == "LineString" and (shape[0] != shape[-1]).any():
                    points += [shape[0].tolist(), shape[-1].tolist()]
            parts = ([("MultiLineString", lines)] if lines else []) + ([("MultiPoint", points)] if points else [])
            out.append(None if not parts else K.to_wkb(*parts[0]) if len(parts) == 1 else K.collection(parts))
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, T.BinaryType())(data)
