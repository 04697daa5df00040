"""Geometry as Column expressions: boxes, rings, equal-area projection and longitudes.

A ring or line is array<struct<x: double, y: double>>; a box is four columns. Nothing here
leaves generated code or array functions, so these stay in the scan's stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .scalar import col

#: WGS84 (fixed values).
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
ECC2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(ECC2)
#: Standard parallel of the equal-area cylinder (fixed value).
STANDARD_PARALLEL = math.radians(30)
K0 = math.cos(STANDARD_PARALLEL) / math.sqrt(1 - ECC2 * math.sin(STANDARD_PARALLEL) ** 2)


def family(kind) -> Column:
    """point, line, polygon or collection of a geometry type name."""
    k = col(kind)
    return (
        F.when(k.isin("Point", "MultiPoint"), "point")
        .when(k.isin("LineString", "MultiLineString", "LinearRing"), "line")
        .when(k.isin("Polygon", "MultiPolygon"), "polygon")
        .otherwise("collection")
    )


def project_x(lon) -> Column:
    """Easting of the equal-area cylinder in metres."""
    return F.radians(col(lon)) * (SEMI_MAJOR * K0)


def project_y(lat) -> Column:
    """Northing of the equal-area cylinder in metres."""
    s = F.sin(F.radians(col(lat)))
    q = (1 - ECC2) * (s / (1 - ECC2 * s * s) - F.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
    return q * (SEMI_MAJOR / (2 * K0))


def project(ring) -> Column:
    """A ring of degrees as a ring of metres."""
    return F.transform(col(ring), lambda p: F.struct(project_x(p["x"]).alias("x"), project_y(p["y"]).alias("y")))


def signed_area(ring) -> Column:
    """Shoelace area, positive if counter-clockwise; the ring may be closed or not; 0 for fewer than three points."""
    r = col(ring)
    rest = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))
    terms = F.zip_with(r, rest, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.when(F.size(r) < 3, F.lit(0.0)).otherwise(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2)


def polygon_area(rings) -> Column:
    """Area of a polygon given as its shell and then its holes."""
    sizes = F.transform(col(rings), lambda r: F.abs(signed_area(r)))
    return 2 * sizes[0] - F.aggregate(sizes, F.lit(0.0), lambda s, a: s + a)


def unwrap(ring) -> Column:
    """The ring with 360 added or taken so that no step exceeds 180 degrees of longitude."""
    point = "struct<x: double, y: double>"
    start = F.array().cast(f"array<{point}>")

    def step(done, p):
        before = F.element_at(done, -1)["x"]
        turns = F.when(F.size(done) == 0, F.lit(0.0)).otherwise(F.ceil((F.abs(p["x"] - before) - 180) / 360) * -F.signum(p["x"] - before))
        turns = F.when((F.size(done) > 0) & (F.abs(p["x"] - before) <= 180), F.lit(0.0)).otherwise(turns)
        return F.concat(done, F.array(F.struct((p["x"] + turns * 360).cast("double").alias("x"), p["y"].cast("double").alias("y"))))

    return F.aggregate(col(ring), start, step)


def bounds(ring) -> dict[str, Column]:
    r = col(ring)
    xs, ys = F.transform(r, lambda p: p["x"]), F.transform(r, lambda p: p["y"])
    return {"min_x": F.array_min(xs), "min_y": F.array_min(ys), "max_x": F.array_max(xs), "max_y": F.array_max(ys)}


def check_box(west: float, south: float, east: float, north: float) -> None:
    """Raise unless the box is finite, within the globe and not empty; west > east crosses the dateline."""
    if not all(math.isfinite(v) for v in (west, south, east, north)):
        raise ValueError("bounding box must be finite")
    if not (-180 <= west <= 180 and -180 <= east <= 180 and -90 <= south < north <= 90) or west == east:
        raise ValueError("bounding box must be ordered and within the globe")


def box_parts(west: float, south: float, east: float, north: float) -> list[tuple[float, float, float, float]]:
    """One box, or two if it crosses the dateline."""
    if west < east:
        return [(west, south, east, north)]
    return [(west, south, 180.0, north), (-180.0, south, east, north)]


def in_box(box: tuple, min_x="min_x", min_y="min_y", max_x="max_x", max_y="max_y") -> Column:
    """Bounds that meet the box, its edges included; plain comparisons, so they reach a Parquet scan."""
    parts = [(col(max_x) >= w) & (col(min_x) <= e) & (col(max_y) >= s) & (col(min_y) <= n) for w, s, e, n in box_parts(*box)]
    return parts[0] if len(parts) == 1 else parts[0] | parts[1]


def clip_to(box: tuple, min_x="min_x", min_y="min_y", max_x="max_x", max_y="max_y") -> dict[str, Column]:
    """Bounds of a box clipped to one that doesn't cross the dateline."""
    w, s, e, n = box
    return {
        "min_x": F.greatest(col(min_x), F.lit(w)),
        "min_y": F.greatest(col(min_y), F.lit(s)),
        "max_x": F.least(col(max_x), F.lit(e)),
        "max_y": F.least(col(max_y), F.lit(n)),
    }


def box_area(min_x="min_x", min_y="min_y", max_x="max_x", max_y="max_y") -> Column:
    zero = F.lit(0)
    return F.greatest(col(max_x) - col(min_x), zero) * F.greatest(col(max_y) - col(min_y), zero)


def haversine(lon1, lat1, lon2, lat2, radius: float = 6371008.8) -> Column:
    """Great-circle metres on the mean sphere."""
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
