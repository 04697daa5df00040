"""Exact intersections of polygons, lines and points with cells, and their unions per cell and group.

Parts meet cells by an equi-join on tiles whose size follows the part's extent, so neither a
long part nor a fine grid multiplies rows. A part is cut to its cells inside a task, and the
pieces go on as bytes: rings, segments or a point. On the earth, areas are of the equal-area
cylinder and lengths are geodesic; on a plane both are of the coordinates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import kernels as K, planar as P
from ..storage import materialize

BOX = ("min_x", "min_y", "max_x", "max_y")
#: Tile sizes are tile * 2**level; a part takes the level at which it is about WIDE tiles wide.
LEVELS, WIDE = 7, 4
#: Distinct pieces of one cell and group beyond which the cell is divided.
MANY = 2000


def parts_of(features: DataFrame, wkb: str = "wkb", number: str | None = None, earth: bool = False) -> DataFrame:
    """One row per point, line and polygon of each feature: its columns, family, wkb and bounds; collections are taken apart.

    number names a column for the part's place in its feature, from 0 on. On the earth, what
    steps over the dateline is a part on each side. Null and empty geometries have no parts.
    """
    own = [c for c in features.columns if c not in (*BOX, wkb, "family", number)]
    parts = spread(features.select(*own, wkb)).select(*own, F.posexplode(K.shapes(F.col(wkb), earth)).alias("__number", "__part"))
    return parts.select(*own, *([F.col("__number").alias(number)] if number else []), "__part.*")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df over as many tasks as shuffles have, by keys if any.

    Work in Python is heavy for its bytes: a small file would be one task, and adaptive
    execution would join small partitions again if it were free to choose their number.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _blocks(df: DataFrame, size, box=BOX) -> DataFrame:
    """df with a row for each tile (__bx, __by) of the column size that its box meets, borders included."""
    span = lambda low, high: F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))
    return df.withColumn("__bx", F.explode(span(box[0], box[2]))).withColumn("__by", F.explode(span(box[1], box[3])))


def _pairs(parts: DataFrame, cells: DataFrame, tile: float) -> DataFrame:
    """Every part with the cells that its bounds meet, as (own columns, __cells: array of id and box); a pair is in one row only."""
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")) / (WIDE * tile)
    level = F.when(extent <= 1, 0).otherwise(F.least(F.ceil(F.log2(extent)), F.lit(LEVELS - 1))).cast("int")
    size = F.lit(float(tile)) * F.pow(F.lit(2.0), F.col("__level"))
    dealt = _blocks(parts.withColumn("__level", level), size)
    ring = [F.col("wkb").alias("ring")] if "wkb" in cells.columns else []
    cell = F.struct(F.col("cell_id").alias("id"), *[F.col(c).cast("double").alias(c) for c in BOX], *ring)
    given = _blocks(cells.withColumn("__level", F.explode(F.array(*map(F.lit, range(LEVELS))))), size)
    given = given.groupBy("__level", "__bx", "__by").agg(F.collect_list(cell).alias("__cells"))
    here = f"""c.min_x <= max_x and c.max_x >= min_x and c.min_y <= max_y and c.max_y >= min_y
      and floor(greatest(min_x, c.min_x) / __size) = __bx and floor(greatest(min_y, c.min_y) / __size) = __by"""
    joined = dealt.join(given, ["__level", "__bx", "__by"]).withColumn("__size", size)
    joined = joined.withColumn("__cells", F.expr(f"filter(__cells, c -> {here})")).where("size(__cells) > 0")
    return joined.drop("__level", "__bx", "__by", "__size", *BOX)


def _packed(rings: list[np.ndarray]) -> bytes:
    """Rings as doubles: their number, their sizes, then all points."""
    return np.concatenate(([len(rings)], [len(r) for r in rings], *[r.reshape(-1) for r in rings])).astype("<f8").tobytes()


def _unpacked(piece: bytes) -> list[np.ndarray]:
    v = np.frombuffer(piece, "<f8")
    n = int(v[0])
    ends = np.cumsum(v[1 : 1 + n].astype(int))
    points = v[1 + n :].reshape(-1, 2)
    return [points[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _metres(rings: list[np.ndarray]) -> list[np.ndarray]:
    return [np.column_stack(K.equal_area(r[:, 0], r[:, 1])) for r in rings]


def _metre_boxes(boxes: np.ndarray) -> np.ndarray:
    return np.column_stack((*K.equal_area(boxes[:, 0], boxes[:, 1]), *K.equal_area(boxes[:, 2], boxes[:, 3])))


def _kept(area: float, rings: list[np.ndarray], box) -> tuple[float, list[np.ndarray]] | None:
    """Area and rings of what lies in a box; None without an area, the box itself if it is full."""
    whole = (box[2] - box[0]) * (box[3] - box[1])
    if area <= 1e-12 * whole:
        return None
    if area >= whole * (1 - 1e-12):
        return whole, [np.array([[box[0], box[1]], [box[2], box[1]], [box[2], box[3]], [box[0], box[3]]])]
    return area, rings


def _kept_in(area: float, rings: list[np.ndarray], cell: np.ndarray) -> tuple[float, list[np.ndarray]] | None:
    """_kept for a convex cell."""
    whole = P.ring_area(cell)
    if area <= 1e-12 * whole:
        return None
    return (whole, [cell]) if area >= whole * (1 - 1e-12) else (area, rings)


def _polygon_pieces(rings: list[np.ndarray], boxes: np.ndarray, simple: bool):
    """(index of box, area, packed piece) of the boxes in which a polygon has an area; a row of boxes shares one cut."""
    strips: dict[tuple, list[np.ndarray]] = {}
    for i, box in enumerate(boxes.tolist()):
        rows = (box[1], box[3])
        if rows not in strips:
            strips[rows] = P.clip_band(rings, 1, *rows)
        kept = P.clip_band(strips[rows], 0, box[0], box[2]) if strips[rows] else []
        found = _kept(P.polygon_area(kept, simple), kept, box) if kept else None
        if found:
            yield i, found[0], _packed(found[1])


#: Points times boxes of a polygon up to which it is cut together with others, and of all that are cut together.
SMALL, TOGETHER = 1 << 14, 1 << 18


def _many_polygon_pieces(shapes: list[list[np.ndarray]], boxes: np.ndarray, begins: np.ndarray, ends: np.ndarray, earth: bool, cells: list[np.ndarray] | None = None):
    """(polygon, index in boxes, area, packed piece) of all polygons in their boxes, begins to ends of boxes; cells: convex rings instead of the boxes.

    Small polygons are cut to all their boxes in one pass over flat arrays, large ones each by
    strips.
    """
    rings = [r for s in shapes for r in s]
    sizes, per = np.array([len(r) for r in rings]), np.array([len(s) for s in shapes])
    points, home = np.vstack(rings), np.repeat(np.arange(len(rings)), sizes)
    if earth:
        points, boxes = np.column_stack(K.equal_area(points[:, 0], points[:, 1])), _metre_boxes(boxes)
    if cells is not None:
        known = {id(c): c for c in cells}  # a cell is one ring in a batch
        known = {k: (i, c) for i, (k, c) in enumerate(zip(known, _metres(list(known.values())) if earth else known.values()))}
        which_cell = np.array([known[id(c)][0] for c in cells], np.int64)
        cells = [known[id(c)][1] for c in cells]
        sides = np.zeros((len(known), max(len(c) for _, c in known.values()), 4))
        for i, c in known.values():
            sides[i, : len(c)] = np.hstack((c, np.roll(c, -1, axis=0) - c))
    starts = np.cumsum(sizes) - sizes
    first = np.cumsum(per) - per
    round_ = P.run_round(points, home, len(rings))
    load = np.add.reduceat(sizes, first) * (ends - begins)
    own = lambda k: [points[starts[j] : starts[j] + sizes[j]] for j in range(first[k], first[k] + per[k])]
    simple = [per[k] == 1 and bool(round_[first[k]]) or P.is_simple(own(k)) for k in range(len(shapes))]
    small = np.flatnonzero((load <= SMALL) & (load > 0))
    for k in np.flatnonzero(load > SMALL).tolist():
        mine = slice(begins[k], ends[k])
        for i, area, packed in _polygon_pieces(own(k), boxes[mine], simple[k]) if cells is None else _polygon_in_rings(own(k), cells[mine], False):
            yield k, begins[k] + i, area, packed
    groups = np.cumsum(load[small]) // TOGETHER
    for g in np.unique(groups):
        chosen = small[groups == g]
        owner = np.repeat(chosen, ends[chosen] - begins[chosen])  # a polygon for each pair with a box
        count = ends[chosen] - begins[chosen]
        box = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begins[chosen], count)
        pair = np.repeat(np.arange(len(owner)), per[owner])  # a pair for each ring in it
        which = np.arange(len(pair)) - np.repeat(np.cumsum(per[owner]) - per[owner], per[owner])
        ring = first[owner[pair]] + which
        n = sizes[ring]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[ring], n)
        of = np.repeat(np.arange(len(ring)), n)
        cut, of = P.clip_many(points[at], of, boxes[box[pair]]) if cells is None else P.clip_many_convex(points[at], of, sides[which_cell[box[pair]]])
        left = np.bincount(of, minlength=len(ring))
        begin = np.cumsum(left) - left
        sound = left >= 3
        area = np.where(sound, np.abs(P.ring_areas(cut, of, len(ring))), 0.0) * np.where(which == 0, 1, -1)
        total = np.bincount(pair, area, len(owner))
        shell = np.cumsum(per[owner]) - per[owner]
        for j in np.flatnonzero(sound[shell]).tolist():
            rings_ = [cut[begin[r] : begin[r] + left[r]] for r in range(shell[j], shell[j] + per[owner[j]]) if sound[r]]
            k = int(owner[j])
            size = max(0.0, total[j]) if simple[k] else P.polygon_area(rings_)
            found = _kept(size, rings_, boxes[box[j]]) if cells is None else _kept_in(size, rings_, cells[box[j]])
            if found:
                yield k, int(box[j]), float(found[0]), _packed(found[1])


def _cell_rings(data: list[bytes]) -> list[np.ndarray]:
    """The convex rings of cells, counter-clockwise."""
    rings = []
    for d in data:
        ((kind, shape),) = K.primitives(*K.from_wkb(d))
        if kind != "Polygon" or len(shape) != 1:
            raise ValueError("a cell must be a convex polygon")
        rings.append(P.convex(shape[0]))
    return rings


def _polygon_in_rings(rings: list[np.ndarray], cells: list[np.ndarray], earth: bool):
    """(index of cell, area, packed piece) of the convex cells in which a polygon has an area."""
    if earth:
        rings, cells = _metres(rings), _metres(cells)
    simple = P.is_simple(rings)
    for i, cell in enumerate(cells):
        kept = P.clip_convex(rings, cell)
        if not kept:
            continue
        found = _kept_in(P.polygon_area(kept, simple), kept, cell)
        if found:
            yield i, found[0], _packed(found[1])


def with_bounds(cells: DataFrame) -> DataFrame:
    """(cell_id, wkb) of polygon cells with their bounds."""

    def run(a: pa.Array) -> pa.Array:
        found = [(r.min(axis=0), r.max(axis=0)) for r in _cell_rings(a.to_pylist())]
        return pa.array([dict(zip(BOX, (*low.tolist(), *high.tolist()))) for low, high in found], pa.struct([(c, pa.float64()) for c in BOX]))

    bounds = T.StructType([T.StructField(c, T.DoubleType()) for c in BOX])
    return cells.withColumn("__box", F.arrow_udf(run, bounds)("wkb")).select("cell_id", "wkb", "__box.*")


def pieces(parts: DataFrame, cells: DataFrame, tile: float, earth: bool = True) -> DataFrame:
    """One row per cell and part that have an area, a length or a point in common, by the part's family.

    parts: own columns, family, wkb, bounds (see parts_of); cells: cell_id and box, and wkb where
    cells are convex polygons (hexagons, say) and not boxes, whose box is then their bounds;
    tile: about a cell's width. Adds cell_id, measure (area, length or 1) and piece, the common
    part as bytes. Cells include their borders: a point or line on a border belongs to both
    sides, and a polygon that only touches a cell has no area there. On the earth a cell's edges
    are straight in the equal-area plane for areas and in degrees for lines and points. Rows
    with null bounds meet nothing; repeated rows have their pieces each; a cell that is no
    convex polygon is an error.
    """
    shaped = "wkb" in cells.columns
    own = [c for c in parts.columns if c not in (*BOX, "wkb")]
    pairs = _pairs(parts.where(" and ".join(f"{c} is not null" for c in BOX)), cells.select("cell_id", *BOX, *["wkb"] * shaped), tile)
    pairs = pairs.select(*own, "wkb", "__cells")
    made = [T.StructField("cell_id", cells.schema["cell_id"].dataType), T.StructField("measure", T.DoubleType()), T.StructField("piece", T.BinaryType())]
    schema = T.StructType([*(pairs.schema[c] for c in own), *made])

    def cut(batches):
        for batch in batches:
            owner, which, measure, piece, lines, polygons = [], [], [], [], [], []
            lists = batch.column("__cells")
            flat = lists.flatten()
            boxes = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False) for c in BOX])
            known: dict[bytes, np.ndarray] = {}
            rings = flat.field("ring").to_pylist() if shaped else []
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            for row, (data, begin, end) in enumerate(zip(batch.column("wkb").to_pylist(), [0, *ends[:-1]], ends)):
                ((kind, shape),) = K.primitives(*K.from_wkb(data))
                mine = boxes[begin:end]
                if shaped:
                    for d in rings[begin:end]:
                        if d not in known:
                            known[d] = _cell_rings([d])[0]
                    own_rings = [known[d] for d in rings[begin:end]]
                if kind == "Polygon":
                    polygons.append((row, shape, begin, end))
                elif kind == "LineString":
                    for i, box in enumerate(mine.tolist()):
                        segments = P.clip_line_convex(shape, own_rings[i]) if shaped else P.clip_line(shape, box)
                        if len(segments):
                            lines.append((len(owner), segments))
                            owner.append(row)
                            which.append(begin + i)
                            measure.append(0.0)
                            piece.append(segments.astype("<f8").tobytes())
                else:
                    x, y = shape[0]
                    for i in np.flatnonzero((mine[:, 0] <= x) & (mine[:, 2] >= x) & (mine[:, 1] <= y) & (mine[:, 3] >= y)):
                        if shaped and not P.in_convex(shape, own_rings[i])[0]:
                            continue
                        owner.append(row)
                        which.append(begin + int(i))
                        measure.append(1.0)
                        piece.append(np.array([x, y], "<f8").tobytes())
            if polygons:
                rows_, shapes, begins, stops = zip(*polygons)
                for k, i, area, packed in _many_polygon_pieces(list(shapes), boxes, np.array(begins), np.array(stops), earth, [known[d] for d in rings] if shaped else None):
                    owner.append(rows_[k])
                    which.append(i)
                    measure.append(area)
                    piece.append(packed)
            values = np.array(measure, float)
            if lines:
                at = np.array([i for i, _ in lines])
                values[at] = K.summed_lengths(np.vstack([s for _, s in lines]), np.array([len(s) for _, s in lines]), earth)
            rows, chosen = pa.array(owner, pa.int64()), flat.field("id").take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in own), chosen, pa.array(values), pa.array(piece, pa.binary())], [*own, "cell_id", "measure", "piece"])

    return pairs.mapInArrow(cut, schema).where("measure > 0")


def memberships(found: DataFrame) -> DataFrame:
    """pieces with intersection_area, intersection_length and point_count, one of them set by family, instead of measure and piece."""
    only = lambda family, c: F.when(F.col("family") == family, c)
    own = [c for c in found.columns if c not in ("measure", "piece")]
    return found.select(
        *own,
        only("polygon", F.col("measure")).alias("intersection_area"),
        only("line", F.col("measure")).alias("intersection_length"),
        only("point", F.lit(1).cast("bigint")).alias("point_count"),
    )


def _read(family: str, piece: bytes):
    if family == "polygon":
        return _unpacked(piece)
    return np.frombuffer(piece, "<f8").reshape(-1, 4 if family == "line" else 2)


def _cut(family: str, shape, box: tuple, last: tuple[bool, bool]):
    """The part of a shape in a box of a lattice; what lies on a border belongs to the box right of it or above."""
    if family == "polygon":
        return P.clip_polygon(shape, box)
    if family == "line":
        shape = np.vstack([P.clip_line(s.reshape(2, 2), box) for s in shape])
    x, y = (shape[:, 0] + shape[:, -2]) / 2, (shape[:, 1] + shape[:, -1]) / 2
    return shape[(x >= box[0]) & (y >= box[1]) & ((x < box[2]) | last[0] & (x <= box[2])) & ((y < box[3]) | last[1] & (y <= box[3]))]


_UNIONS = ["union_area", "union_length", "distinct_points"]
_TYPES = [pa.float64(), pa.float64(), pa.int64()]


def _measures(groups: list[list[tuple]], earth: bool) -> list[list]:
    """For each group of pieces (family, shape, measure): union area, union length and distinct points; null for families that it lacks.

    A single polygon or line has the measure that it came with; all other areas are swept at once.
    """
    out, swept = [], []
    for pieces in groups:
        polygons, lines, points = ([p for p in pieces if p[0] == f] for f in ("polygon", "line", "point"))
        area = length = None
        if polygons:
            single = len(polygons) == 1 and polygons[0][2] is not None
            area = polygons[0][2] if single else 0.0
            if not single:
                swept.append((len(out), [p[1] for p in polygons]))
        if lines:
            if len(lines) == 1 and len(lines[0][1]) == 1 and lines[0][2] is not None:
                length = lines[0][2]
            else:
                merged = P.merged_segments(np.vstack([p[1] for p in lines]))
                length = float(K.summed_lengths(merged, np.array([len(merged)]), earth)[0])
        out.append([area, length, len(P.distinct_points(np.vstack([p[1] for p in points]))) if points else None])
    for (i, _), area in zip(swept, P.covered_areas([s for _, s in swept]) if swept else ()):
        out[i][0] = float(area)
    return out


def _groups(batches, keys: list[str]):
    """Tables of equal keys from batches in which equal keys follow each other; a group may go over batches."""
    kept: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if kept is None else pa.concat_tables([kept, rows]).combine_chunks()
        lists = [rows.column(k).to_pylist() for k in keys]
        own = list(zip(*lists))
        starts = [i for i in range(len(own)) if i == 0 or own[i] != own[i - 1]]
        for a, b in zip(starts, starts[1:]):
            yield rows.slice(a, b - a)
        kept = rows.slice(starts[-1]) if starts else None
    if kept is not None and len(kept):
        yield kept


def unions(found: DataFrame, keys: list[str], earth: bool = True, many: int = MANY, written: bool = False) -> DataFrame:
    """(keys, union_area, union_length, distinct_points): what the pieces of each key cover together, null for families that it lacks.

    Equal pieces are one. A key with more than `many` pieces is set apart by a count first: its
    equal pieces become one before they are shuffled, and it is divided into a lattice of boxes
    over the pieces' bounds, which tasks take one by one; what the boxes cover adds up. Tasks go
    through the other keys in order and hold some at a time. The pieces are read two or three
    times and so written first, unless found is a written table.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    some = found.select(*keys, "family", "piece", "measure")
    some = some if written else materialize(some, "pieces")
    other = {k: "__" + k for k in keys}
    same = [F.col(k).eqNullSafe(F.col("__" + k)) for k in keys]
    full = materialize(some.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > many).select(*keys), "full")
    any_full = bool(full.head(1))
    full = full.withColumnsRenamed(other)
    distinct = some.join(full, same, "left_semi").dropDuplicates([*keys, "family", "piece"])
    sides = distinct.groupBy(*keys).agg(F.least(F.ceil(F.sqrt(F.count("*") / F.lit(float(many)))), F.lit(64)).cast("int").alias("__n"))
    sized = distinct.join(sides.withColumnsRenamed(other), same).drop(*other.values())
    schema = T.StructType([*(some.schema[k] for k in keys), *T._parse_datatype_string("union_area double, union_length double, distinct_points bigint")])

    kinds = [to_arrow_type(some.schema[k].dataType) for k in keys]
    by = [*keys, "family", "__i", "__j"]

    def results(first: list[tuple], groups: list[list[tuple]]):
        """A batch of keys and what their pieces cover."""
        columns = [pa.array(c, t) for c, t in zip(zip(*_measures(groups, earth)), _TYPES)]
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*first), kinds)), *columns], [*keys, *_UNIONS])

    def whole(batches):
        """What the pieces of each key cover; keys of some thousand pieces together are measured at once."""
        first, groups, held, at, now = [], [], 0, None, {}
        for batch in batches:
            for key, f, p, m in zip(zip(*(batch.column(k).to_pylist() for k in keys)), *(batch.column(c).to_pylist() for c in ("family", "piece", "measure"))):
                if key != at:
                    if at is not None:
                        first.append(at)
                        groups.append([(f_, _read(f_, p_), m_) for (f_, p_), m_ in now.items()])
                        held += len(now)
                        if held > 2 * MANY or len(first) == 1000:
                            yield results(first, groups)
                            first, groups, held = [], [], 0
                    at, now = key, {}
                now[f, p] = m  # equal pieces are one
        if at is not None:
            first.append(at)
            groups.append([(f_, _read(f_, p_), m_) for (f_, p_), m_ in now.items()])
            yield results(first, groups)

    def lattices(batches):
        for group in _groups(batches, by):
            yield results([tuple(group.column(k)[0].as_py() for k in keys)], [boxed(group)])

    def boxed(group: pa.Table) -> list[tuple]:
        n, i, j, a, b, c, d = (group.column(x)[0].as_py() for x in ("__n", "__i", "__j", "__a", "__b", "__c", "__d"))
        xs, ys = np.linspace(a, c, n + 1), np.linspace(b, d, n + 1)
        cut = [(f, _cut(f, _read(f, p), (xs[i], ys[j], xs[i + 1], ys[j + 1]), (i == n - 1, j == n - 1)), None) for f, p in zip(group.column("family").to_pylist(), group.column("piece").to_pylist())]
        return [x for x in cut if len(x[1])]

    bounds = T._parse_datatype_string("struct<a: double, b: double, c: double, d: double>")

    def extent(families: pa.Array, data: pa.Array) -> pa.Array:
        rows = []
        for family, piece in zip(families.to_pylist(), data.to_pylist()):
            shape = _read(family, piece)
            p = np.vstack(shape) if family == "polygon" else shape.reshape(-1, 2)
            rows.append(dict(zip("abcd", (*p.min(axis=0).tolist(), *p.max(axis=0).tolist()))))
        return pa.array(rows, pa.struct([(k, pa.float64()) for k in "abcd"]))

    framed = sized.withColumn("__e", F.arrow_udf(extent, bounds)("family", "piece"))
    # lines and points are in degrees where areas are in metres, so each family has its own lattice
    frames = framed.groupBy(*keys, "family").agg(F.min("__e.a").alias("__a"), F.min("__e.b").alias("__b"), F.max("__e.c").alias("__c"), F.max("__e.d").alias("__d"))
    framed = framed.join(frames.withColumnsRenamed(other | {"family": "__family"}), [*same, F.col("family") == F.col("__family")]).drop("__family", *other.values())

    def place(c: str, low: str, high: str):
        step = F.greatest(F.col(high) - F.col(low), F.lit(1e-300)) / F.col("__n")
        return F.greatest(F.lit(0), F.least(F.col("__n") - 1, F.floor((F.col(c) - F.col(low)) / step).cast("int")))

    # a box more on both sides, for round-off at the borders
    around = lambda a, b: F.sequence(F.greatest(F.lit(0), a - 1), F.least(F.col("__n") - 1, b + 1))
    lattice = framed.withColumn("__i", F.explode(around(place("__e.a", "__a", "__c"), place("__e.c", "__a", "__c"))))
    lattice = lattice.withColumn("__j", F.explode(around(place("__e.b", "__b", "__d"), place("__e.d", "__b", "__d")))).drop("__e")
    ordered = lambda df, by: spread(df, *by).sortWithinPartitions(*by)
    calm = some.join(full, same, "left_anti") if any_full else some
    calm = ordered(calm, keys).mapInArrow(whole, schema)
    if not any_full:
        return calm
    crowded = ordered(lattice, by).mapInArrow(lattices, schema)
    return calm.unionByName(crowded.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _UNIONS]))


def cell_areas(cells: DataFrame, earth: bool = True) -> DataFrame:
    """(cell_id, cell_area) in the units of the pieces' areas: of the cell's polygon, or of its box."""
    from ..functions.geometry import project_x, project_y

    if "wkb" in cells.columns:

        def run(a: pa.Array) -> pa.Array:
            rings = _cell_rings(a.to_pylist())
            return pa.array([P.ring_area(r) for r in (_metres(rings) if earth else rings)], pa.float64())

        return cells.select("cell_id", F.arrow_udf(run, T.DoubleType())("wkb").alias("cell_area"))
    x, y = (project_x, project_y) if earth else (lambda c: F.col(c).cast("double"),) * 2
    return cells.select("cell_id", ((x("max_x") - x("min_x")) * (y("max_y") - y("min_y"))).alias("cell_area"))


def tiles_under(parts: DataFrame, tile: float) -> DataFrame:
    """Square cells (cell_id, box) of a lattice that the parts' bounds meet, each once."""
    met = _blocks(parts.where(" and ".join(f"{c} is not null" for c in BOX)).select(*BOX), F.lit(float(tile))).select("__bx", "__by").distinct()
    side = lambda c, more: ((F.col(c) + more) * float(tile))
    return met.select(F.format_string("%d_%d", "__bx", "__by").alias("cell_id"), side("__bx", 0).alias("min_x"), side("__by", 0).alias("min_y"), side("__bx", 1).alias("max_x"), side("__by", 1).alias("max_y"))


def crosswalk(parts: DataFrame, cells: DataFrame, record: list[str], tile: float, earth: bool = True) -> DataFrame:
    """(record, cell_id, intersection_area, native_area, cell_area, fraction_of_native, fraction_of_cell) of polygon parts.

    parts as for pieces, with the record's columns. A record's parts are a union in the cell and
    as a whole, so what they share counts once; its own area is added up from a lattice of tiles,
    so no record meets in one task. Only positive areas appear; lines and points have none.
    """
    polygons = parts.where("family = 'polygon'").select(*record, "family", "wkb", *BOX)
    inside = unions(pieces(polygons, cells, tile, earth), [*record, "cell_id"], earth).select(*record, "cell_id", F.col("union_area").alias("intersection_area"))
    own = unions(pieces(polygons, tiles_under(polygons, tile), tile, earth), [*record, "cell_id"], earth)
    native = own.groupBy(*record).agg(F.sum("union_area").alias("native_area"))
    other = {k: "__" + k for k in record}
    same = [F.col(k).eqNullSafe(F.col("__" + k)) for k in record]
    out = inside.join(native.withColumnsRenamed(other), same).drop(*other.values()).join(cell_areas(cells, earth), "cell_id")
    share = lambda c: (F.col("intersection_area") / F.col(c))
    return out.where("intersection_area > 0").select(
        *record, "cell_id", "intersection_area", "native_area", "cell_area", share("native_area").alias("fraction_of_native"), share("cell_area").alias("fraction_of_cell")
    )


def supported(cells: DataFrame, mask: DataFrame, tile: float) -> DataFrame:
    """The cells that share an area with the polygons of a mask (parts as for pieces)."""
    hit = pieces(mask.where("family = 'polygon'").select("family", "wkb", *BOX), cells, tile).select("cell_id").distinct()
    return cells.join(hit, "cell_id", "left_semi")
