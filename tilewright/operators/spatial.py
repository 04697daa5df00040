"""Spatial joins and unions of boxes: tile equi-join, memberships, union areas and lengths, nearest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import planar

BOX = ("min_x", "min_y", "max_x", "max_y")


def tiles_of(df: DataFrame, size: float, closed: bool = False, prefix: str = "") -> DataFrame:
    """df with one row per square tile (tx, ty) that its box meets, and the box's first tile (fx, fy).

    Boxes that only touch a tile's edge meet it if closed (points and lines), else not (areas).
    """
    x1, y1, x2, y2 = (F.col(prefix + c) for c in BOX)
    low = lambda c: F.floor(c / size).cast("bigint")
    high = low if closed else lambda c: (F.ceil(c / size) - 1).cast("bigint")
    out = df.withColumn("fx", low(x1)).withColumn("fy", low(y1))
    out = out.withColumn("tx", F.explode(F.sequence(F.col("fx"), F.greatest(high(x2), F.col("fx")))))
    return out.withColumn("ty", F.explode(F.sequence(F.col("fy"), F.greatest(high(y2), F.col("fy")))))


def tile_join(left: DataFrame, right: DataFrame, size: float, closed: bool = False) -> DataFrame:
    """Pairs of rows whose boxes overlap, each once; both sides need min_x, min_y, max_x, max_y.

    Both sides are dealt to square tiles and joined on the tile, so the join is an equi-join
    that Spark shuffles, broadcasts or splits like any other. A pair that meets in several
    tiles is kept in the one that holds the lower left corner of the overlap, which needs no
    second shuffle. With closed, touching counts (points, lines); without, the overlap must
    have an area. Right columns get the prefix r_; null boxes join nothing.
    """
    a = tiles_of(left.where(" and ".join(f"{c} is not null" for c in BOX)), size, closed)
    b = right.where(" and ".join(f"{c} is not null" for c in BOX))
    b = tiles_of(b.select(*[F.col(c).alias("r_" + c) for c in right.columns]), size, closed, "r_")
    b = b.withColumnsRenamed({"fx": "r_fx", "fy": "r_fy"})
    owner = (F.greatest("fx", "r_fx") == F.col("tx")) & (F.greatest("fy", "r_fy") == F.col("ty"))
    less = (lambda x, y: F.col(x) <= F.col(y)) if closed else (lambda x, y: F.col(x) < F.col(y))
    meets = less("min_x", "r_max_x") & less("r_min_x", "max_x") & less("min_y", "r_max_y") & less("r_min_y", "max_y")
    return a.join(b, ["tx", "ty"]).where(owner & meets).drop("tx", "ty", "fx", "fy", "r_fx", "r_fy")


def overlap() -> dict[str, Column]:
    """The overlap box of a joined pair."""
    return {
        "o_min_x": F.greatest("min_x", "r_min_x"),
        "o_min_y": F.greatest("min_y", "r_min_y"),
        "o_max_x": F.least("max_x", "r_max_x"),
        "o_max_y": F.least("max_y", "r_max_y"),
    }


def memberships(cells: DataFrame, parts: DataFrame, size: float) -> DataFrame:
    """One row per cell and box part with a positive overlap: both rows' columns, the overlap box and its area."""
    joined = tile_join(parts, cells, size).withColumns(overlap())
    return joined.withColumn("area", (F.col("o_max_x") - F.col("o_min_x")) * (F.col("o_max_y") - F.col("o_min_y")))


def union_area(boxes: DataFrame, keys: list[str], box=("o_min_x", "o_min_y", "o_max_x", "o_max_y"), tile: float | None = None) -> DataFrame:
    """(keys, union_area): the area that the boxes of each key cover together; a whole number if all bounds are.

    Equal boxes count once before anything is grouped. With tile, boxes are first cut to square
    tiles, which tasks take one by one and whose areas add up: that bounds what meets in one
    task for keys of any extent. Within a tile the boxes are swept, in n log n for boxes that
    overlap few others. Null boxes cover nothing.
    """
    whole = all(isinstance(boxes.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) for c in box)
    number, kind = ("bigint", np.int64) if whole else ("double", np.float64)
    b = boxes.select(*keys, *[F.col(c).cast(number).alias(n) for c, n in zip(box, BOX)]).where(" and ".join(f"{c} is not null" for c in BOX))
    by = list(keys)
    if tile is not None:
        side = F.lit(tile).cast(number)
        edge = lambda c, i: F.col(c).cast("bigint") * side if i == 0 else (F.col(c).cast("bigint") + 1) * side
        b = tiles_of(b, tile).drop("fx", "fy")
        cut = [F.greatest("min_x", edge("tx", 0)), F.greatest("min_y", edge("ty", 0)), F.least("max_x", edge("tx", 1)), F.least("max_y", edge("ty", 1))]
        b = b.select(*keys, "tx", "ty", *[c.cast(number).alias(n) for c, n in zip(cut, BOX)])
        by += ["tx", "ty"]
    schema = T.StructType([*(b.schema[k] for k in keys), T.StructField("union_area", T.LongType() if whole else T.DoubleType())])

    def sweep(group: pa.Table) -> pa.Table:
        found = planar.boxes_area(np.column_stack([group.column(c).to_numpy() for c in BOX]).astype(kind))
        return pa.table([*(group.column(k).slice(0, 1) for k in keys), pa.array([found])], [*keys, "union_area"])

    found = b.distinct().groupBy(*by).applyInArrow(sweep, schema)
    return found if tile is None else found.groupBy(*keys).agg(F.sum("union_area").alias("union_area"))


def union_length(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, union_length): the length that the intervals of each key cover together; empty ones add nothing."""
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(F.max(end).over(before), F.col(start))))
    return intervals.select(*keys, start, end).distinct().withColumn("new", new).groupBy(*keys).agg(F.sum("new").alias("union_length"))


def nearest_distance(points: DataFrame, targets: DataFrame, id_col: str, reach: float, metric) -> DataFrame:
    """(id, distance): the least metric(point, target) of each point, over targets that are at most reach away.

    Points and targets have x and y; metric is a function of two row prefixes that returns a
    Column. Targets are dealt to the tiles within reach, so this is an equi-join whatever the
    sizes; points with nothing in reach get null.
    """
    here = points.withColumn("tx", F.floor(F.col("x") / reach)).withColumn("ty", F.floor(F.col("y") / reach))
    around = F.sequence(F.lit(-1), F.lit(1))
    there = targets.select(*[F.col(c).alias("r_" + c) for c in targets.columns])
    there = there.withColumn("tx", F.explode(F.transform(around, lambda d: F.floor(F.col("r_x") / reach) + d)))
    there = there.withColumn("ty", F.explode(F.transform(around, lambda d: F.floor(F.col("r_y") / reach) + d)))
    near = here.join(there, ["tx", "ty"]).select(id_col, metric("", "r_").alias("d")).where(F.col("d") <= reach)
    best = near.groupBy(id_col).agg(F.min("d").alias("distance"))
    return points.select(id_col).join(best, id_col, "left")


def samples_along(lines: DataFrame, id_col: str, step: float, length: str) -> DataFrame:
    """(id, sample, share): points along each line no more than step apart, both ends included."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col(length) / step)).cast("int")
    out = lines.withColumn("pieces", pieces).withColumn("sample", F.explode(F.sequence(F.lit(0), F.col("pieces"))))
    return out.select(id_col, "sample", (F.col("sample") / F.col("pieces")).alias("share"))


def crosswalk(parts: DataFrame, cells: DataFrame, record: list[str], cell: str, size: float) -> DataFrame:
    """(record, cell, intersection_area, native_area, cell_area, fraction_of_native, fraction_of_cell).

    The parts of a record are a union, in the cell and as a whole, so overlaps of one record's
    parts count once; a record's own area is added up from tiles. Only positive areas appear.
    """
    cells = cells.withColumn("cell_area", (F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y")))
    hits = memberships(cells.select(cell, *BOX, "cell_area"), parts.select(*record, *BOX), size)
    inside = union_area(hits, [*record, "r_" + cell]).withColumnRenamed("union_area", "intersection_area")
    native = union_area(parts, record, BOX, size).withColumnRenamed("union_area", "native_area")
    out = inside.withColumnRenamed("r_" + cell, cell).join(native, record).join(cells.select(cell, "cell_area"), cell)
    return out.where("intersection_area > 0").select(
        *record,
        cell,
        "intersection_area",
        "native_area",
        "cell_area",
        (F.col("intersection_area") / F.col("native_area")).alias("fraction_of_native"),
        (F.col("intersection_area") / F.col("cell_area")).alias("fraction_of_cell"),
    )


def check_crosswalk(walk: DataFrame, record: list[str], cell: str) -> DataFrame:
    """One row of counts that must be 0 (but rows): repeated keys, bad measures, wrong fractions, records above 1."""
    keys = walk.groupBy(*record, cell).count().where("count > 1").agg(F.count("*").alias("repeated"))
    over = walk.groupBy(*record).agg(F.sum("fraction_of_native").alias("s")).where("s > 1 + 1e-8").agg(F.count("*").alias("above_one"))
    bad = walk.agg(
        F.count("*").alias("rows"),
        F.count_if(F.expr("not (intersection_area > 0 and native_area > 0 and cell_area > 0)")).alias("bad_measures"),
        F.count_if(
            F.expr("abs(fraction_of_native - intersection_area / native_area) > 1e-9 or abs(fraction_of_cell - intersection_area / cell_area) > 1e-9 or fraction_of_cell > 1 + 1e-8")
        ).alias("bad_fractions"),
    )
    return bad.join(keys).join(over)


def supported(cells: DataFrame, mask: DataFrame, size: float) -> DataFrame:
    """The cells that share an area with the mask (left semi join over tiles)."""
    own = tiles_of(mask.select(*[F.col(c).alias("r_" + c) for c in BOX]), size, prefix="r_").drop("fx", "fy")
    hit = (F.col("min_x") < F.col("r_max_x")) & (F.col("r_min_x") < F.col("max_x")) & (F.col("min_y") < F.col("r_max_y")) & (F.col("r_min_y") < F.col("max_y"))
    dealt = tiles_of(cells, size)
    same = (dealt["tx"] == own["tx"]) & (dealt["ty"] == own["ty"]) & hit
    return dealt.join(own, same, "left_semi").select(*cells.columns).distinct()


def grid_of(spark, columns: int, rows: int, size: float, max_cells: int = 100_000) -> DataFrame:
    """Square cells (cell_id, cx, cy, box) of columns * rows; raises before any work beyond max_cells."""
    if max_cells <= 0 or columns * rows > max_cells:
        raise ValueError("grid exceeds the cell budget")
    cells = spark.range(columns * rows).select((F.col("id") % columns).alias("cx"), F.expr(f"id div {columns}").alias("cy"))
    return cells.select(
        F.format_string("%d_%d", "cx", "cy").alias("cell_id"),
        "cx",
        "cy",
        (F.col("cx") * size).alias("min_x"),
        (F.col("cy") * size).alias("min_y"),
        ((F.col("cx") + 1) * size).alias("max_x"),
        ((F.col("cy") + 1) * size).alias("max_y"),
    )


def grid_over(boxes: DataFrame, size: float, max_cells: int = 10_000_000) -> DataFrame:
    """The square cells (cell_id, cx, cy, box) of a lattice over the bounds of all boxes; more than max_cells are an error, no boxes give none.

    Only the bounds are gathered, in one aggregate; a task makes the cells of some columns.
    """
    low, high = (lambda c: F.floor(F.min(c) / size)), (lambda c: F.ceil(F.max(c) / size) - 1)
    bounds = boxes.agg(low("min_x").alias("x0"), high("max_x").alias("x1"), low("min_y").alias("y0"), high("max_y").alias("y1")).where("x0 is not null and y0 is not null")
    many = (F.col("x1") - F.col("x0") + 1).cast("double") * (F.col("y1") - F.col("y0") + 1)
    last = F.when(many > max_cells, F.raise_error(F.lit("grid exceeds the cell budget")).cast("bigint")).otherwise(F.col("x1"))
    cells = bounds.select(F.explode(F.sequence("x0", F.greatest("x0", last))).alias("cx"), "y0", "y1").select("cx", F.explode(F.sequence("y0", F.greatest("y0", "y1"))).alias("cy"))
    side = lambda c, more: (F.col(c) + more) * size
    return cells.select(F.format_string("%d_%d", "cx", "cy").alias("cell_id"), "cx", "cy", side("cx", 0).alias("min_x"), side("cy", 0).alias("min_y"), side("cx", 1).alias("max_x"), side("cy", 1).alias("max_y"))


def lonlat_grid(spark, bbox: tuple, degrees: float, max_cells: int = 100_000) -> DataFrame:
    """Cells of so many degrees that share an area with bbox (west > east crosses the dateline)."""
    import math

    from ..functions.geometry import box_parts, check_box

    check_box(*bbox)
    spans = []
    for w, s, e, n in box_parts(*bbox):
        spans.append((math.floor(w / degrees), math.ceil(e / degrees) - 1, math.floor(s / degrees), math.ceil(n / degrees) - 1))
    if max_cells <= 0 or sum((b - a + 1) * (d - c + 1) for a, b, c, d in spans) > max_cells:
        raise ValueError("grid exceeds the cell budget; use a smaller bounding box or larger cells")
    span = spark.createDataFrame(spans, "x0 bigint, x1 bigint, y0 bigint, y1 bigint")
    cells = span.select(F.explode(F.sequence("x0", "x1")).alias("cx"), "y0", "y1").select("cx", F.explode(F.sequence("y0", "y1")).alias("cy")).distinct()
    return cells.select(
        F.format_string("%d_%d", "cx", "cy").alias("cell_id"),
        *[F.lit(1.0 * degrees).alias("resolution")],
        (F.col("cx") * degrees).alias("min_x"),
        (F.col("cy") * degrees).alias("min_y"),
        ((F.col("cx") + 1) * degrees).alias("max_x"),
        ((F.col("cy") + 1) * degrees).alias("max_y"),
    )
