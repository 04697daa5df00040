"""Queries of the exact overlay on triangles, L-shapes, slanted lines and points, whose measures have closed forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import exact
from .base import CELL, WITH_C, cells, query, table

#: p: a part as a shape. Its kind by id: 0 a right triangle, 1 an L of two boxes, 2 a line at 45 degrees, 3 two points, one on a border of cells.
_P = (
    WITH_C
    + """, p as (select id, id % 4 as kind, grp, brand, x1 as x, y1 as y, x2 - x1 as w, y2 - y1 as h,
  greatest(1, (x2 - x1) // 2) as w1, greatest(1, (y2 - y1) // 2) as h1 from f),
  corner as (select id, brand, x, y from p where kind = 3 union all select id, brand, x - x % 100, y from p where kind = 3)"""
)


def _shapes(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey as id", "p_partkey % 4 as kind", "p_type as grp", "p_brand as brand", "(p_partkey * 37) % 1000 as x", "(p_partkey * 91) % 1000 as y", "cast(1 + p_size as bigint) as w", "1 + p_partkey % 40 as h"
    ).withColumns({"w1": F.expr("greatest(1, w div 2)"), "h1": F.expr("greatest(1, h div 2)")})
    at = lambda a, b: F.expr(f"struct(cast({a} as double) as x, cast({b} as double) as y)")
    triangle = F.array(at("x", "y"), at("x + w", "y"), at("x", "y + h"), at("x", "y"))
    ell = F.array(at("x", "y"), at("x + w", "y"), at("x + w", "y + h1"), at("x + w1", "y + h1"), at("x + w1", "y + h"), at("x", "y + h"), at("x", "y"))
    line = F.array(at("x", "y"), at("x + w", "y + w"))
    points = F.array(at("x", "y"), at("x - x % 100", "y"))
    kind = F.expr("element_at(array('Polygon', 'Polygon', 'LineString', 'MultiPoint'), cast(kind as int) + 1)")
    shape = F.when(F.col("kind") == 0, triangle).when(F.col("kind") == 1, ell).when(F.col("kind") == 2, line).otherwise(points)
    return p.select("id", "kind", "grp", "brand", kernels.shape_wkb(kind, F.array(shape)).alias("wkb"))


def _pieces(spark, sf_dir, kind=None):
    shapes = _shapes(spark, sf_dir)
    parts = exact.parts_of(shapes if kind is None else shapes.where(f"kind = {kind}"))
    return exact.pieces(parts, cells(spark, sf_dir).select("cell_id", *exact.BOX), CELL, earth=False)


@query(
    _P
    + """, q as (select cell_id, p.*, greatest(cx * 100, x) as a1, cx * 100 + 100 as a2, greatest(cy * 100, y) as b1, cy * 100 + 100 as b2, cx * 100 as l, cy * 100 as b from p cross join c),
  t as (select cell_id, id, 'polygon' as family, w * h / 2.0 * (pow(greatest(0, 1 - (a1 - x) / w - (b1 - y) / h), 2) - pow(greatest(0, 1 - (a2 - x) / w - (b1 - y) / h), 2)
    - pow(greatest(0, 1 - (a1 - x) / w - (b2 - y) / h), 2) + pow(greatest(0, 1 - (a2 - x) / w - (b2 - y) / h), 2)) as m from q where kind = 0 and a2 > x and b2 > y),
  e as (select cell_id, id, 'polygon' as family, greatest(0, least(x + w, l + 100) - a1) * greatest(0, least(y + h1, b + 100) - b1)
    + greatest(0, least(x + w1, l + 100) - a1) * greatest(0, least(y + h, b + 100) - greatest(b1, y + h1)) as m from q where kind = 1),
  s as (select cell_id, id, 'line' as family, least(x + w, l + 100, x + b + 100 - y) - greatest(x, l, x + b - y) as m from q where kind = 2),
  r as (select cell_id, id, 'point' as family, count(distinct {'x': corner.x, 'y': corner.y}) as m
    from corner join c on x >= cx * 100 and x <= cx * 100 + 100 and y >= cy * 100 and y <= cy * 100 + 100 group by 1, 2)
  select cell_id, id, family, cast(floor(m * 1000000 + 0.4) as bigint) as millionths from
    (select * from t union all select * from e union all select * from s union all select * from r) where m > 1e-8"""
)
def shape_memberships(spark, sf_dir):
    """Area, length over the root of 2, or distinct points of every shape in every cell; in millionths, rounded where no such fraction lies."""
    found = exact.memberships(_pieces(spark, sf_dir).select("id", "family", "cell_id", "measure", "piece").distinct())
    measure = F.coalesce("intersection_area", F.col("intersection_length") / F.sqrt(F.lit(2.0)), F.col("point_count").cast("double"))
    per = found.select("cell_id", "id", "family", measure.alias("m")).groupBy("cell_id", "id", "family").agg(F.sum("m").alias("m"))
    return per.select("cell_id", "id", "family", F.floor(F.col("m") * 1000000 + 0.4).alias("millionths"))


@query(
    _P
    + """, o as (select id, grp, x as x1, y as y1, x + w as x2, y + h1 as y2 from p where kind = 1 union all select id, grp, x, y, x + w1, y + h from p where kind = 1),
  m as (select cell_id, grp, greatest(x1, cx * 100) as a1, least(x2, cx * 100 + 100) as a2, greatest(y1, cy * 100) as b1, least(y2, cy * 100 + 100) as b2
    from o join c on x1 < cx * 100 + 100 and x2 > cx * 100 and y1 < cy * 100 + 100 and y2 > cy * 100),
  xs as (select cell_id, grp, a1 as x from m union select cell_id, grp, a2 from m),
  sl as (select cell_id, grp, x as s1, lead(x) over (partition by cell_id, grp order by x) as s2 from xs),
  cov as (select s.cell_id, s.grp, s1, s2, b1, b2, max(b2) over (partition by s.cell_id, s.grp, s1 order by b1, b2 rows between unbounded preceding and 1 preceding) as pm
    from sl s join (select distinct * from m) q on s.cell_id = q.cell_id and s.grp = q.grp and a1 <= s1 and a2 >= s2 where s2 is not null)
  select cell_id, grp, cast(sum((s2 - s1) * greatest(0, b2 - greatest(b1, coalesce(pm, b1)))) as bigint) as union_area from cov group by 1, 2"""
)
def shape_coverage(spark, sf_dir):
    """The area that the L-shapes of each group cover together in each cell."""
    return exact.unions(_pieces(spark, sf_dir, 1), ["cell_id", "grp"], earth=False).select("cell_id", "grp", F.round("union_area").cast("bigint").alias("union_area"))


@query(
    _P
    + """, s as (select cell_id, brand, y - x as line, greatest(x, cx * 100, x + cy * 100 - y) as a, least(x + w, cx * 100 + 100, x + cy * 100 + 100 - y) as e from p cross join c where kind = 2),
  r as (select *, max(e) over (partition by cell_id, brand, line order by a, e rows between unbounded preceding and 1 preceding) as pm from s where e > a)
  select cell_id, brand, cast(sum(greatest(0, e - greatest(a, coalesce(pm, a)))) as bigint) as steps from r group by 1, 2"""
)
def shape_line_length(spark, sf_dir):
    """The length, over the root of 2, that the slanted lines of each brand cover together in each cell."""
    found = exact.unions(_pieces(spark, sf_dir, 2), ["cell_id", "brand"], earth=False)
    return found.select("cell_id", "brand", F.round(F.col("union_length") / F.sqrt(F.lit(2.0))).cast("bigint").alias("steps"))


@query(
    _P
    + """ select cell_id, brand, count(distinct {'x': x, 'y': y}) as points, count(distinct id) as features
  from corner join c on x >= cx * 100 and x <= cx * 100 + 100 and y >= cy * 100 and y <= cy * 100 + 100 group by 1, 2"""
)
def shape_point_count(spark, sf_dir):
    """Distinct points of each brand in each cell, borders included, and the shapes that they belong to."""
    found = _pieces(spark, sf_dir, 3)
    counted = found.groupBy("cell_id", "brand").agg(F.countDistinct("id").alias("features"))
    points = exact.unions(found, ["cell_id", "brand"], earth=False).select("cell_id", "brand", F.col("distinct_points").alias("points"))
    return points.join(counted, ["cell_id", "brand"])


@query(
    _P
    + """ select id, 'polygon' as family, x as min_x, y as min_y, x + w as max_x, y + h as max_y from p where kind < 2
  union all select id, 'line', x, y, x + w, y + w from p where kind = 2
  union all select id, 'point', x, y, x, y from corner"""
)
def shape_parts(spark, sf_dir):
    """Every part of every shape with its family and bounds."""
    parts = exact.parts_of(_shapes(spark, sf_dir))
    return parts.select("id", "family", *[F.col(c).cast("bigint").alias(c) for c in exact.BOX])
