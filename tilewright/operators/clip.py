"""Clipping to an area of interest with the share that is retained."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.geometry import box_area, box_parts, clip_to
from .relational import number_parts
from .spatial import BOX


def retained(kept: Column, whole: Column) -> Column:
    """Share in [0, 1]; round-off is cut off, more is an error; null without a whole."""
    share = kept / whole
    bad = (share < -1e-10) | (share > 1 + 1e-8)
    return F.when(whole > 0, F.when(bad, F.raise_error(F.lit("retained fraction exceeds the source"))).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))))


def clip_boxes(df: DataFrame, box: tuple) -> DataFrame:
    """The boxes that share an area with box, clipped to it; adds retained_fraction, clipped and source_ bounds.

    A dateline-crossing box gives a part on each side; retained_fraction is of all parts together.
    """
    out = None
    whole = box_area()
    for part in box_parts(*box):
        w, s, e, n = part
        hit = df.where((F.col("max_x") > w) & (F.col("min_x") < e) & (F.col("max_y") > s) & (F.col("min_y") < n))
        hit = hit.withColumns({"source_" + c: F.col(c) for c in BOX} | {"__whole": whole}).withColumns(clip_to(part))
        hit = hit.withColumn("__kept", box_area())
        out = hit if out is None else out.unionByName(hit)
    if len(box_parts(*box)) > 1:
        out = out.withColumn("__kept", F.sum("__kept").over(Window.partitionBy(*["source_" + c for c in BOX], *[c for c in df.columns if c not in BOX])))
    share = retained(F.col("__kept").cast("double"), F.col("__whole").cast("double"))
    return out.withColumn("retained_fraction", share).withColumn("clipped", F.col("retained_fraction") < 1 - 1e-12).drop("__whole", "__kept")


def clip_polygons(df: DataFrame, box: tuple, record: str, rings: str = "rings") -> DataFrame:
    """Polygon rows (rings: array of array of x, y; shell first) clipped to box, with the retained share of equal-area metres.

    Longitudes are unwrapped first and tried at -360, 0 and +360 degrees, so features across
    the dateline are found. What the box parts becomes rows of its own, each with its holes.
    Parts are numbered per record by the digest of their coordinates.
    """
    from ..functions import geometry as G, planar as P
    from ..functions.kernels import RING

    ring_type = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def arrays(shapes: pa.Array) -> list[list[np.ndarray]]:
        """Rings of each row, without a repeated last point."""
        lines = shapes.flatten()
        points = lines.flatten()
        xy = np.column_stack([points.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
        ends = np.cumsum(lines.value_lengths().to_numpy(zero_copy_only=False))
        each = [xy[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        each = [r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r for r in each]
        ends = np.cumsum(shapes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return [each[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def cut(batches):
        for batch in batches:
            owner, parts = [], []
            for i, shape in enumerate(arrays(batch.column("__rings"))):
                if not shape or len(shape[0]) < 3:
                    continue
                low, high = shape[0][:, 0].min(), shape[0][:, 0].max()
                for shift in (-360.0, 0.0, 360.0):
                    for part in box_parts(*box):
                        if low + shift < part[2] and high + shift > part[0]:
                            for polygon in P.split_polygon([r + (shift, 0.0) for r in shape], part):
                                owner.append(i)
                                parts.append([[{"x": x, "y": y} for x, y in np.vstack((r, r[:1])).tolist()] for r in polygon])
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), pa.array(parts, ring_type)], [*batch.schema.names, "__part"])

    own = [c for c in df.columns if c != rings]
    unwrapped = df.withColumn("__rings", F.transform(rings, lambda r: G.unwrap(r))).select(*own, "__rings")
    schema = T.StructType([*unwrapped.schema.fields, T.StructField("__part", T.ArrayType(RING))])
    metres = lambda c: G.polygon_area(F.transform(c, lambda r: G.project(r)))
    parts = unwrapped.mapInArrow(cut, schema).withColumn("__kept", metres("__part")).where("__kept > 0")
    total = parts.groupBy(record).agg(F.sum("__kept").alias("__sum"))
    share = retained(F.col("__sum"), metres("__rings"))
    out = parts.join(total, record).withColumn("retained_fraction", share).withColumn("clipped", F.col("retained_fraction") < 1 - 1e-12)
    out = out.withColumn("__digest", F.sha2(F.to_json("__part"), 256))
    return number_parts(out, record, ["__digest"], "part_id").select(*own, F.col("__part").alias(rings), "part_id", "part_number", "retained_fraction", "clipped")


#: States of a repair (fixed values).
REPAIR = ("not_required", "repaired_preserving_dimension", "repaired_lower_dimension_remnants_reported")
GLOBE = (-180.0, -90.0, 180.0, 90.0)


def canonical_parts(features: DataFrame, box: tuple = GLOBE) -> DataFrame:
    """Canonical features as the parts of which they consist in box: unwrapped, repaired, cut at the dateline, numbered.

    What clip_features adds, with the feature's own bounds as source_min_x and so on and each
    part's geometry_type; no `kind`. Records are told apart by their source too.
    """
    kept = [c for c in features.columns if c not in (*BOX, "kind")]
    own = features.select(*kept, *[F.col(c).alias("source_" + c) for c in BOX if c in features.columns])
    parts = clip_features(own.withColumn("__record", F.concat_ws(":", "source_id", "record_id")), box, "__record")
    kinds = {"point": "Point", "line": "LineString", "polygon": "Polygon"}
    kind = F.coalesce(*[F.when(F.col("family") == f, F.lit(k)) for f, k in kinds.items()])
    return parts.withColumn("geometry_type", kind).drop("__record", "family")


def clip_diagnostics(features: DataFrame, parts: DataFrame) -> DataFrame:
    """One row: source rows, those with parts and without, parts, clipped and repaired records, records with remnants, and the change of measure by repairs."""
    record = F.struct("source_id", "record_id")
    seen = parts.agg(
        F.countDistinct(record).alias("intersecting_rows"),
        F.count("*").alias("output_parts"),
        F.countDistinct(F.when(F.col("clipped"), record)).alias("clipped_source_rows"),
        F.countDistinct(F.when(F.col("repaired"), record)).alias("repaired_rows"),
        F.countDistinct(F.when(F.col("repair_status") == REPAIR[2], record)).alias("repair_dimension_remnant_rows"),
    )
    each = parts.where("repaired").groupBy("source_id", "record_id").agg(F.max("repair_delta").alias("delta")).agg(F.coalesce(F.sum("delta"), F.lit(0.0)).alias("repair_measure_delta"))
    rows = features.agg(F.count("*").alias("source_rows"))
    return rows.join(seen).join(each).withColumn("excluded_rows", F.col("source_rows") - F.col("intersecting_rows"))


def clip_features(features: DataFrame, box: tuple, record: str = "record_id") -> DataFrame:
    """Features of any family (record, wkb) cut to box, a row for each primitive part that is left.

    Adds family, wkb and bounds of the part, part_number and part_id (by the digest of the part),
    retained_fraction (of the record's area, length or points, all parts together), clipped, and
    repaired, true for polygons whose rings cross, touch or run over each other and were taken
    apart by the even-odd rule first; repair_status then says whether lines that bound nothing
    were left out, and repair_delta by how many square metres the area is larger than that of
    the shell less the holes. A polygon without area is an error.
    Areas are equal-area and lengths geodesic. The box includes its border: a point on it stays,
    what touches it without an area or length of its own does not. A box with west > east and
    features over the dateline are unwrapped and met on every turn. Records with nothing left
    have no rows; they are what an anti join finds. Null geometries have no parts.
    """
    from ..functions import kernels as K, noding as N, planar as P
    from .exact import parts_of

    parts = parts_of(features)
    own = [c for c in parts.columns if c not in (*BOX, "wkb", "family")]
    made = T._parse_datatype_string("family string, wkb binary, min_x double, min_y double, max_x double, max_y double, repaired boolean, repair_status string, repair_delta double, __kept double, __whole double")
    schema = T.StructType([*(parts.schema[c] for c in own), *made])
    boxes, turns = box_parts(*box), (0.0, -360.0, 360.0)

    def parts_in(rings, turn, box):
        """The polygons within a box of a polygon moved by a turn."""
        (w, s), (e, n) = rings[0].min(axis=0), rings[0].max(axis=0)
        if w + turn >= box[2] or e + turn <= box[0] or s >= box[3] or n <= box[1]:
            return []
        if w + turn >= box[0] and e + turn <= box[2] and s >= box[1] and n <= box[3]:
            return [P.oriented([r + (turn, 0.0) for r in rings])]
        return P.split_polygon([r + (turn, 0.0) for r in rings], box)

    def polygon(rings):
        rings = K.unwrapped_rings(rings)
        metres = lambda shape: [np.column_stack(K.equal_area(r[:, 0], r[:, 1])) for r in shape]
        area = lambda shape: P.polygon_area(metres(shape), True)
        sound = P.is_simple(rings)
        valid, told = ([rings], None) if sound else N.repaired(rings)
        whole = sum(map(area, valid))
        if not whole:
            raise ValueError("a polygon without area loses its dimension")
        repair = (False, REPAIR[0], None)
        if not sound:
            sizes = [abs(P.ring_area(r)) for r in metres(rings)]
            repair = (True, REPAIR[2 if told["remnant_length"] else 1], whole - (sizes[0] - sum(sizes[1:])))
        found = [x for v in valid for t in turns for b in boxes for x in parts_in(v, t, b)]
        return whole, repair, [(K.to_wkb("Polygon", [np.vstack((r, r[:1])).tolist() for r in x]), x[0], a) for x in found if (a := area(x)) > 0]

    def line(points):
        points = K.unwrapped(points)
        length = lambda p: float(K.line_length(p))
        cut = [P.clip_line(points + (t, 0.0), b) for t in turns for b in boxes]
        return length(points), (False, REPAIR[0], None), [(K.to_wkb("LineString", c.tolist()), c, length(c)) for s in cut if len(s) for c in K.chains(s)]

    def point(points):
        x, y = points[0]
        for t in turns:
            if any(w <= x + t <= e and s <= y <= n for w, s, e, n in boxes):
                return 1.0, (False, REPAIR[0], None), [(K.to_wkb("Point", (x + t, y)), points + (t, 0.0), 1.0)]
        return 1.0, (False, REPAIR[0], None), []

    def cut(batches):
        for batch in batches:
            owner, rows = [], []
            for i, data in enumerate(batch.column("wkb").to_pylist()):
                ((kind, shape),) = K.primitives(*K.from_wkb(data))
                whole, repaired, found = {"Polygon": polygon, "LineString": line, "Point": point}[kind](shape)
                for k, (wkb, p, kept) in enumerate(found or [(None, None, 0.0)]):
                    low, high = (p.min(axis=0).tolist(), p.max(axis=0).tolist()) if p is not None else ([None] * 2, [None] * 2)
                    owner.append(i)
                    rows.append((K.FAMILY[kind], wkb, *low, *high, *repaired, kept, whole if k == 0 else 0.0))
            columns = list(zip(*rows)) if rows else [()] * len(made.fields)
            types = [pa.string(), pa.binary(), *[pa.float64()] * 4, pa.bool_(), pa.string(), *[pa.float64()] * 3]
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in own), *(pa.array(c, t) for c, t in zip(columns, types))], [*own, *made.names])

    every = Window.partitionBy(record)
    share = retained(F.sum("__kept").over(every), F.sum("__whole").over(every))
    left = parts.select(*own, "wkb").mapInArrow(cut, schema).withColumn("retained_fraction", share).where("wkb is not null")
    left = left.withColumn("clipped", F.col("retained_fraction") < 1 - 1e-9).drop("__kept", "__whole").withColumn("__digest", F.sha2("wkb", 256))
    return number_parts(left, record, ["__digest"], "part_id").drop("__digest")


def outside(df: DataFrame, box: tuple, tolerance: float = 0.0) -> DataFrame:
    """Rows whose box is not within box, widened by tolerance; must be empty after clipping."""
    w, s, e, n = box
    inside = (F.col("min_x") >= w - tolerance) & (F.col("min_y") >= s - tolerance) & (F.col("max_x") <= e + tolerance) & (F.col("max_y") <= n + tolerance)
    return df.where(~inside)
