"""Small numeric kernels for what Column expressions can't say, and pandas UDFs over them.

Each works on one geometry or one batch at a time; Spark partitions and shuffles the rows.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from . import planar
from .geometry import ECC, ECC2, FLATTENING, K0, SEMI_MAJOR

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
SEMI_MINOR = SEMI_MAJOR * (1 - FLATTENING)


def geodesic(lon1, lat1, lon2, lat2):
    """Metres between points on the WGS84 ellipsoid (Vincenty's inverse formula); arrays or numbers.

    Not for nearly antipodal points, where the iteration doesn't settle (null then).
    """
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2 = np.arctan((1 - FLATTENING) * np.tan(lat1)), np.arctan((1 - FLATTENING) * np.tan(lat2))
    diff = lon2 - lon1
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam = diff.copy() if isinstance(diff, np.ndarray) else diff
    settled = np.zeros(np.shape(diff), bool)
    with np.errstate(invalid="ignore", divide="ignore"):
        for _ in range(100):
            sl, cl = np.sin(lam), np.cos(lam)
            sin_sigma = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
            cos_sigma = s1 * s2 + c1 * c2 * cl
            sigma = np.arctan2(sin_sigma, cos_sigma)
            sin_alpha = np.where(sin_sigma == 0, 0.0, c1 * c2 * sl / sin_sigma)
            cos2 = 1 - sin_alpha**2
            mid = np.where(cos2 < 1e-15, 0.0, cos_sigma - 2 * s1 * s2 / cos2)
            c = FLATTENING / 16 * cos2 * (4 + FLATTENING * (4 - 3 * cos2))
            after = diff + (1 - c) * FLATTENING * sin_alpha * (sigma + c * sin_sigma * (mid + c * cos_sigma * (2 * mid**2 - 1)))
            settled = np.abs(after - lam) < 1e-13
            lam = after
            if np.all(settled):
                break
        u = cos2 * (SEMI_MAJOR**2 - SEMI_MINOR**2) / SEMI_MINOR**2
        a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        d = b * sin_sigma * (mid + b / 4 * (cos_sigma * (2 * mid**2 - 1) - b / 6 * mid * (4 * sin_sigma**2 - 3) * (4 * mid**2 - 3)))
        return np.where(settled, SEMI_MINOR * a * (sigma - d), np.nan)


def line_length(points: np.ndarray) -> float:
    """Geodesic metres along (n, 2) degrees."""
    if len(points) < 2:
        return 0.0
    return float(geodesic(points[:-1, 0], points[:-1, 1], points[1:, 0], points[1:, 1]).sum())


def utm(lon, lat, zone: int):
    """Easting and northing in metres of a northern UTM zone (Krüger's series to the sixth order)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    )
    phi, lam = np.radians(np.asarray(lat, float)), np.radians(np.asarray(lon, float) - (6 * zone - 183))
    e = math.sqrt(ECC2)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.hypot(1.0, t))
    x = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(alpha, 1))
    y = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(alpha, 1))
    return 500000 + 0.9996 * radius * x, 0.9996 * radius * y


def equal_area(lon, lat) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing in metres of the equal-area cylinder."""
    s = np.sin(np.radians(np.asarray(lat, float)))
    q = (1 - ECC2) * (s / (1 - ECC2 * s * s) - np.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
    return np.radians(np.asarray(lon, float)) * (SEMI_MAJOR * K0), q * (SEMI_MAJOR / (2 * K0))


# --- well-known binary -----------------------------------------------------------------------

_CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}
_NAMES = {v: k for k, v in _CODES.items()}


def to_wkb(kind: str, coordinates) -> bytes:
    """Little-endian WKB of a GeoJSON type and its coordinates (two dimensions)."""
    head = struct.pack("<BI", 1, _CODES[kind])
    line = lambda c: struct.pack("<I", len(c)) + b"".join(struct.pack("<2d", *p[:2]) for p in c)
    if kind == "Point":
        return head + struct.pack("<2d", *coordinates[:2])
    if kind == "LineString":
        return head + line(coordinates)
    if kind == "Polygon":
        return head + struct.pack("<I", len(coordinates)) + b"".join(map(line, coordinates))
    one = kind.removeprefix("Multi")
    return head + struct.pack("<I", len(coordinates)) + b"".join(to_wkb(one, c) for c in coordinates)


def collection(parts: list[tuple[str, object]]) -> bytes:
    """WKB of a collection of geometries (type, coordinates)."""
    return struct.pack("<BII", 1, _CODES["GeometryCollection"], len(parts)) + b"".join(to_wkb(k, c) for k, c in parts)


def from_wkb(data: bytes) -> tuple[str, object]:
    """GeoJSON type and coordinates in two dimensions of WKB of either byte order; raises on other codes.

    Heights and measures, by ISO codes (1001, 2001, 3001, ...) or by the flags of extended WKB,
    are left out, and so is the identity of a coordinate system that extended WKB may carry.
    """
    return _read(data, 0)[0]


#: Flags of extended WKB: heights, measures, a coordinate system's identity follows (fixed values).
_HEIGHT, _MEASURE, _SYSTEM = 0x80000000, 0x40000000, 0x20000000


def _read(data: bytes, at: int):
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5 + 4 * bool(code & _SYSTEM)
    iso, plain = divmod(code & 0x0FFFFFFF, 1000)
    if plain not in _NAMES or iso > 3:
        raise ValueError(f"unsupported geometry code {code}")
    kind, size = _NAMES[plain], 2 + max(bool(code & _HEIGHT) + bool(code & _MEASURE), (0, 1, 1, 2)[iso])

    def points(at, n):
        flat = struct.unpack_from(f"{order}{size * n}d", data, at)
        return list(zip(flat[::size], flat[1::size])), at + 8 * size * n

    def line(at):
        (n,) = struct.unpack_from(order + "I", data, at)
        return points(at + 4, n)

    if kind == "Point":
        (point,), at = points(at, 1)
        return (kind, point), at
    if kind == "LineString":
        found, at = line(at)
        return (kind, found), at
    (n,) = struct.unpack_from(order + "I", data, at)
    at, out = at + 4, []
    for _ in range(n):
        if kind == "Polygon":
            item, at = line(at)
        else:
            (item_kind, item), at = _read(data, at)
            item = (item_kind, item) if kind == "GeometryCollection" else item
        out.append(item)
    return (kind, out), at


# --- Columns by pandas UDFs ------------------------------------------------------------------


def summed_lengths(segments: np.ndarray, counts: np.ndarray, earth: bool = True) -> np.ndarray:
    """Length of each run of counts[i] segments (x1, y1, x2, y2): geodesic metres, or plain."""
    if earth:
        each = geodesic(*segments.T) if len(segments) else np.zeros(0)
    else:
        each = np.hypot(segments[:, 2] - segments[:, 0], segments[:, 3] - segments[:, 1])
    out = np.zeros(len(counts))
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(each, (np.cumsum(counts) - counts)[some])
    return out


def geodesic_length(lines):
    """Geodesic metres of an array<struct<x, y>> column; null for null. One call for all steps of a batch."""

    def run(a: pa.Array) -> pa.Array:
        sizes = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = a.flatten()
        x, y = (flat.field(k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 1))
        last = np.zeros(len(x), bool)
        last[np.cumsum(sizes)[sizes > 0] - 1] = True
        steps = np.flatnonzero(~last)
        segments = np.column_stack((x[steps], y[steps], x[steps + 1], y[steps + 1])) if len(steps) else np.zeros((0, 4))
        lengths = summed_lengths(segments, np.maximum(sizes - 1, 0))
        return pa.array(lengths, pa.float64(), mask=a.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(run, T.DoubleType())(lines)


def geodesic_distance(lon1, lat1, lon2, lat2):
    """Geodesic metres between two points given as columns."""

    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(geodesic(a.to_numpy(float), b.to_numpy(float), c.to_numpy(float), d.to_numpy(float)))

    return F.pandas_udf(run, T.DoubleType())(lon1, lat1, lon2, lat2)


def wkb_parts(data):
    """The primitive parts of a WKB column as array<struct<kind, wkb>>, collections taken apart; empty for null."""

    def parts(kind, c):
        if kind == "GeometryCollection":
            return [x for k, v in c for x in parts(k, v)]
        if kind.startswith("Multi"):
            return [(kind[5:], to_wkb(kind[5:], v)) for v in c]
        return [(kind, to_wkb(kind, c))]

    kind = pa.list_(pa.struct([("kind", pa.string()), ("wkb", pa.binary())]))

    def run(a: pa.Array) -> pa.Array:
        return pa.array([[] if d is None else [{"kind": k, "wkb": w} for k, w in parts(*from_wkb(d))] for d in a.to_pylist()], kind)

    part = T.StructType([T.StructField("kind", T.StringType()), T.StructField("wkb", T.BinaryType())])
    return F.arrow_udf(run, T.ArrayType(part))(data)


FAMILY = {"Point": "point", "LineString": "line", "Polygon": "polygon"}


def primitives(kind: str, coordinates) -> list[tuple[str, object]]:
    """The points, lines and polygons of a geometry, collections taken apart; rings lose a repeated last point."""
    if kind == "GeometryCollection":
        return [x for k, c in coordinates for x in primitives(k, c)]
    if kind.startswith("Multi"):
        return [x for c in coordinates for x in primitives(kind[5:], c)]
    array = lambda c: np.array(c, float).reshape(-1, 2)
    if kind == "Polygon":
        rings = [array(r) for r in coordinates]
        return [(kind, [r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r for r in rings])]
    return [(kind, array(coordinates))]


def unwrapped(p: np.ndarray) -> np.ndarray:
    """Points with longitudes moved by whole turns so that no step exceeds 180 degrees."""
    step = np.diff(p[:, 0])
    turns = np.concatenate(([0.0], np.cumsum(np.where(step > 180, -360.0, np.where(step < -180, 360.0, 0.0)))))
    return np.column_stack((p[:, 0] + turns, p[:, 1]))


def unwrapped_rings(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Rings (without a repeated last point) unwrapped each, and the holes moved to the shell's turn."""
    rings = [unwrapped(np.vstack((r, r[:1])))[:-1] for r in rings]
    return [r + (360.0 * np.round((rings[0][0, 0] - r[0, 0]) / 360), 0.0) for r in rings]


def chains(segments: np.ndarray) -> list[np.ndarray]:
    """Lines of the segments that follow each other end to start."""
    breaks = np.flatnonzero((segments[1:, :2] != segments[:-1, 2:]).any(axis=1)) + 1
    return [np.vstack((part[:1, :2], part[:, 2:])) for part in np.split(segments, breaks)] if len(segments) else []


def on_the_globe(kind: str, coordinates) -> list[tuple[str, object]]:
    """A line or polygon as parts within longitudes -180 to 180: one that steps over the dateline is cut there."""
    points = np.array(coordinates[0] if kind == "Polygon" else coordinates, float).reshape(-1, 2)
    if len(points) < 2 or (np.abs(np.diff(points[:, 0])).max() <= 180 and np.abs(points[:, 0]).max() <= 180):
        return [(kind, coordinates)]
    turns, out = (0.0, -360.0, 360.0), []
    if kind == "LineString":
        line = unwrapped(points)
        return [(kind, c.tolist()) for t in turns for c in chains(planar.clip_line(line + (t, 0.0), (-180.0, -90.0, 180.0, 90.0)))]
    rings = unwrapped_rings(primitives(kind, coordinates)[0][1])
    if not planar.is_simple(rings):
        from .noding import make_valid

        each = make_valid(rings)
    else:
        each = [rings]
    for polygon in each:
        for t in turns:
            for part in planar.split_polygon([r + (t, 0.0) for r in polygon], (-180.0, -90.0, 180.0, 90.0)):
                out.append((kind, [np.vstack((r, r[:1])).tolist() for r in part]))
    return out


def shapes(data, earth: bool = False):
    """The primitive parts of a WKB column as array<struct<family, wkb, bounds>>; empty for null.

    On the earth what steps over the dateline becomes a part on each side of it.
    """
    fields = T._parse_datatype_string("array<struct<family: string, wkb: binary, min_x: double, min_y: double, max_x: double, max_y: double>>")

    def parts(kind, c):
        if kind == "GeometryCollection":
            return [x for k, v in c for x in parts(k, v)]
        if kind.startswith("Multi"):
            return [x for v in c for x in parts(kind[5:], v)]
        p = np.array([c] if kind == "Point" else c if kind == "LineString" else [x for r in c for x in r], float).reshape(-1, 2)
        if not len(p) or np.isnan(p).any():
            return []
        if earth and kind != "Point":
            each = on_the_globe(kind, c)
            if len(each) != 1 or each[0][1] is not c:
                return [x for k, v in each for x in flat(k, v)]
        return flat(kind, c, p)

    def flat(kind, c, p=None):
        p = p if p is not None else np.array(c if kind == "LineString" else [x for r in c for x in r], float)
        low, high = p.min(axis=0), p.max(axis=0)
        return [{"family": FAMILY[kind], "wkb": to_wkb(kind, c), "min_x": low[0], "min_y": low[1], "max_x": high[0], "max_y": high[1]}]

    def run(a: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        return pa.array([[] if d is None else parts(*from_wkb(d)) for d in a.to_pylist()], to_arrow_type(fields))

    return F.arrow_udf(run, fields)(data)


def meets_box(kind: str, coordinates, box: tuple) -> bool:
    """Whether a geometry and a box, its border included, have a point in common."""
    w, s, e, n = box
    for family, shape in primitives(kind, coordinates):
        points = shape if family != "Polygon" else np.vstack(shape)
        if ((points[:, 0] >= w) & (points[:, 0] <= e) & (points[:, 1] >= s) & (points[:, 1] <= n)).any():
            return True
        if family == "Point":
            continue
        for line in [shape] if family == "LineString" else [np.vstack((r, r[:1])) for r in shape]:
            if len(planar.clip_line(line, box)):
                return True
        if family == "Polygon" and sum(planar.holds(r, (w, s)) for r in shape) % 2:
            return True
    return False


def meets(data, boxes: list[tuple]):
    """Whether the geometry of a WKB column meets any of the boxes; null for null."""

    def run(a: pa.Array) -> pa.Array:
        return pa.array([None if d is None else any(meets_box(*from_wkb(d), b) for b in boxes) for d in a.to_pylist()], pa.bool_())

    return F.arrow_udf(run, T.BooleanType())(data)


def box_wkb(min_x, min_y, max_x, max_y):
    """WKB of boxes given by their bounds, of a point where they have no extent; null for null bounds."""

    def run(*bounds: pa.Array) -> pa.Array:
        out = []
        for w, s, e, n in zip(*(b.to_pylist() for b in bounds)):
            if None in (w, s, e, n):
                out.append(None)
            elif w == e and s == n:
                out.append(to_wkb("Point", (w, s)))
            else:
                out.append(to_wkb("Polygon", [[(w, s), (e, s), (e, n), (w, n), (w, s)]]))
        return pa.array(out, pa.binary())

    double = lambda c: (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.arrow_udf(run, T.BinaryType())(*map(double, (min_x, min_y, max_x, max_y)))


def shape_wkb(kind, rings):
    """WKB of rings, array<array<struct<x, y>>>, as the type named in kind: polygons take all, lines and points the first; null for null."""

    def run(kinds: pa.Array, lists: pa.Array) -> pa.Array:
        lines = lists.flatten()
        points = lines.flatten()
        xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False).astype("<f8") for c in ("x", "y")])
        many = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        sizes = lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        last, out = np.cumsum(many), []
        for name, k, n in zip(kinds.to_pylist(), last.tolist(), many.tolist()):
            if name is None or not n or not sizes[k - n : k].any():
                out.append(None)
                continue
            rings = [xy[ends[j] - sizes[j] : ends[j]] for j in range(k - n, k)]
            head = struct.pack("<BI", 1, _CODES[name])
            if name == "Polygon":
                out.append(head + struct.pack("<I", n) + b"".join(struct.pack("<I", len(r)) + r.tobytes() for r in rings))
            elif name == "Point":
                out.append(head + rings[0][0].tobytes())
            elif name == "LineString":
                out.append(head + struct.pack("<I", len(rings[0])) + rings[0].tobytes())
            else:
                out.append(to_wkb(name, rings[0].tolist()))
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, T.BinaryType())(kind, rings)


def collection_wkb(shapes):
    """WKB of all primitive parts of an array of WKB as one multi-geometry, a collection where families mix; null for none."""
    codes = {"point": 4, "line": 5, "polygon": 6}

    def joined(data: list) -> bytes | None:
        parts = []

        def take(kind, c):
            if kind == "GeometryCollection":
                for k, v in c:
                    take(k, v)
            elif kind.startswith("Multi"):
                parts.extend((FAMILY[kind[5:]], to_wkb(kind[5:], v)) for v in c)
            else:
                parts.append((FAMILY[kind], to_wkb(kind, c)))

        for d in data or []:
            if d is not None:
                take(*from_wkb(d))
        if not parts:
            return None
        families = {f for f, _ in parts}
        code = codes[families.pop()] if len(families) == 1 else 7
        return struct.pack("<BII", 1, code, len(parts)) + b"".join(w for _, w in parts)

    def run(a: pa.Array) -> pa.Array:
        return pa.array([joined(x) for x in a.to_pylist()], pa.binary())

    return F.arrow_udf(run, T.BinaryType())(shapes)


def simplify(data, tolerance: float):
    """WKB of a WKB column's parts with lines and rings simplified to within tolerance; a ring keeps four points at least, null stays null."""

    def run(a: pa.Array) -> pa.Array:
        out = []
        for d in a.to_pylist():
            parts = []
            for kind, shape in primitives(*from_wkb(d)) if d is not None else []:
                if kind == "Point":
                    parts.append(to_wkb(kind, shape[0]))
                elif kind == "LineString":
                    parts.append(to_wkb(kind, planar.simplified(shape, tolerance).tolist()))
                else:
                    closed = [np.vstack((r, r[:1])) for r in shape]
                    less = [planar.simplified(r, tolerance) for r in closed]
                    parts.append(to_wkb(kind, [(x if len(x) > 3 else r).tolist() for x, r in zip(less, closed)]))
            out.append(None if not parts else parts[0] if len(parts) == 1 else struct.pack("<BII", 1, 7, len(parts)) + b"".join(parts))
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, T.BinaryType())(data)
