"""Repair of polygons by noding, with a report on what it changed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import kernels as K, noding as N, planar as P
from ..storage import materialize
from . import exact

REPORT = "wkb binary, repaired boolean, pieces int, area_before double, area_after double, remnant_length double"


def repair(features: DataFrame, wkb: str = "wkb") -> DataFrame:
    """features with their polygons made valid, and how that changed them.

    Adds repaired (whether any ring crossed, touched or ran over itself or another), pieces (of
    polygons), area_before (of shells less holes), area_after and remnant_length (of edges that
    bound no area any more). Points and lines stay as they are. A feature keeps its dimension:
    one whose polygons have no area left is an error. Null stays null. Equal geometries are
    repaired once, so features are written first and joined with what became of theirs.
    """
    fields = T._parse_datatype_string(f"struct<{', '.join(f.replace(' ', ': ', 1) for f in REPORT.split(', '))}>")

    def one(data: bytes) -> dict:
        parts, changed, before, after, lost, polygons = [], False, 0.0, 0.0, 0.0, 0
        for kind, shape in K.primitives(*K.from_wkb(data)):
            if kind != "Polygon":
                parts.append((kind, shape[0].tolist() if kind == "Point" else shape.tolist()))
                continue
            if P.is_simple(shape):
                found, told = [shape], None
            else:
                found, told = N.repaired(shape)
                changed = True
            if not found:
                raise ValueError("a polygon without area loses its dimension")
            sizes = [abs(P.ring_area(r)) for r in shape]
            before += sizes[0] - sum(sizes[1:])
            after += told["area_after"] if told else sizes[0] - sum(sizes[1:])
            lost += told["remnant_length"] if told else 0.0
            polygons += len(found)
            parts += [("Polygon", [np.vstack((r, r[:1])).tolist() for r in f]) for f in found]
        kinds = {k for k, _ in parts}
        if not changed:
            made = data
        elif len(parts) == 1:
            made = K.to_wkb(*parts[0])
        else:
            made = K.to_wkb("Multi" + kinds.pop(), [c for _, c in parts]) if len(kinds) == 1 else K.collection(parts)
        return {"wkb": made, "repaired": changed, "pieces": polygons, "area_before": before, "area_after": after, "remnant_length": lost}

    def run(a: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array([None if d is None else one(d) for d in a.to_pylist()], to_arrow_type(fields))

    own = [c for c in features.columns if c not in (wkb, *fields.names)]
    given = materialize(features.select(*own, F.col(wkb).alias("__wkb")), "features")
    distinct = exact.spread(given.where("__wkb is not null").select(F.col("__wkb").alias("__key")).distinct())
    told = materialize(distinct.select("__key", F.arrow_udf(run, fields)("__key").alias("__told")), "repaired")
    joined = given.join(told, F.col("__wkb") == F.col("__key"), "left")
    return joined.select(*own, *[F.col(f"__told.{n}").alias(wkb if n == "wkb" else n) for n in fields.names])


def areas(wkb):
    """Square metres of the equal-area cylinder that the polygons of a WKB column cover, by the even-odd rule each; 0 for others, null for null."""

    def run(a: pa.Array) -> pa.Array:
        out = []
        for d in a.to_pylist():
            shapes = [K.unwrapped_rings(s) for k, s in K.primitives(*K.from_wkb(d)) if k == "Polygon"] if d is not None else []
            metres = [[np.column_stack(K.equal_area(r[:, 0], r[:, 1])) for r in s] for s in shapes]
            out.append(None if d is None else float(sum(P.polygon_area(s, P.is_simple(s)) for s in metres)))
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, T.DoubleType())(wkb)
