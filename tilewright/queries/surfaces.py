"""Queries of polygon cells, repair, the dateline, dissolved polygons and distances to lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import dissolve, distances, exact, repair
from ..plans import overlay as plans, verify
from .base import WITH_F, parts, query, table
from .shapes import _P, _shapes

#: h: hexagons 100 wide and high whose rows are 75 apart, each other row moved by half a width.
_HEX = WITH_F + """, h as (select c || '_' || r as cell_id, c * 100 + 50 * (r % 2) as x, r * 75 as y from (select unnest(range(0, 12)) as c) cross join (select unnest(range(0, 15)) as r))"""


def _cut_by_hexagon(boxes: str, keys: str) -> str:
    """(cell_id, keys, quarters): four times the area of disjoint boxes (x1, y1, x2, y2) in hexagons, by the hexagon's half-planes: its width at each height, between all heights where the width bends."""
    return f"""j as (select cell_id, b.*, x, y, greatest(y1, y - 50) as lo, least(y2, y + 50) as hi from {boxes} b join h on x2 > x - 50 and x1 < x + 50 and y2 > y - 50 and y1 < y + 50),
  k as (select row_number() over () as n, *, list_sort(list_distinct(list_transform([lo, hi, y - 25, y + 25, y - 50 + abs(x1 - x) / 2.0, y + 50 - abs(x1 - x) / 2.0, y - 50 + abs(x2 - x) / 2.0, y + 50 - abs(x2 - x) / 2.0],
    lambda v: least(greatest(v, lo), hi)))) as ys from j),
  s as (select n, cell_id, {keys}, v, greatest(0, least(x2, x + least(50, 100 - 2 * abs(v - y))) - greatest(x1, x - least(50, 100 - 2 * abs(v - y)))) as wide
    from (select *, unnest(ys) as v from k)),
  t as (select cell_id, {keys}, (v - lag(v) over w) * (wide + lag(wide) over w) * 2 as q from s window w as (partition by n order by v))
  select cell_id, {keys}, cast(sum(q) as bigint) as quarters from t group by cell_id, {keys} having sum(q) > 0"""


def _hexagons(spark):
    c, r = F.col("id") % 12, F.expr("id div 12")
    x, y = (c * 100 + 50 * (r % 2)).cast("double"), (r * 75).cast("double")
    corners = [(50, -25), (50, 25), (0, 50), (-50, 25), (-50, -25), (0, -50), (50, -25)]
    ring = F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in corners])
    return exact.with_bounds(spark.range(180).select(F.format_string("%d_%d", c, r).alias("cell_id"), kernels.shape_wkb(F.lit("Polygon"), F.array(ring)).alias("wkb")))


def _in_hexagons(spark, sf_dir):
    boxes = parts(spark, sf_dir).withColumn("wkb", kernels.box_wkb(*exact.BOX)).select("id", "brand", "wkb")
    return exact.pieces(exact.parts_of(boxes), _hexagons(spark), 100.0, earth=False)


@query(_HEX + ", " + _cut_by_hexagon("f", "id"))
def hex_memberships(spark, sf_dir):
    """Four times the area that every box has in every hexagon (a whole number)."""
    return _in_hexagons(spark, sf_dir).select("cell_id", "id", F.round(F.col("measure") * 4).cast("bigint").alias("quarters"))


@query(
    _HEX
    + """, xs as (select brand, x1 as x from f union select brand, x2 from f),
  sl as (select brand, x as s1, lead(x) over (partition by brand order by x) as s2 from xs),
  cov as (select s.brand, s1, s2, f.y1, f.y2, max(f.y2) over (partition by s.brand, s1 order by f.y1, f.y2 rows between unbounded preceding and 1 preceding) as pm
    from sl s join (select distinct brand, x1, x2, y1, y2 from f) f on s.brand = f.brand and f.x1 <= s1 and f.x2 >= s2 where s2 is not null),
  d as (select brand, s1 as x1, s2 as x2, greatest(y1, coalesce(pm, y1)) as y1, y2 from cov where y2 > greatest(y1, coalesce(pm, y1))), """
    + _cut_by_hexagon("d", "brand")
)
def hex_coverage(spark, sf_dir):
    """Four times the area that the boxes of each brand cover together in each hexagon."""
    found = exact.unions(_in_hexagons(spark, sf_dir), ["cell_id", "brand"], earth=False)
    return found.select("cell_id", "brand", F.round(F.col("union_area") * 4).cast("bigint").alias("quarters"))


#: Rings by kind, in units of 1 + p_size: a bow tie with a corner at its crossing, a square with two holes that overlap, a ring that crosses itself on upright edges, a square with a spike.
_RINGS = {
    0: [[(0, 0), (1, 1), (2, 2), (2, 0), (1, 1), (0, 2)]],
    1: [[(0, 0), (10, 0), (10, 10), (0, 10)], [(1, 1), (5, 1), (5, 5), (1, 5)], [(3, 3), (7, 3), (7, 7), (3, 7)]],
    2: [[(0, 0), (6, 0), (6, 4), (3, 4), (3, -2), (1, -2), (1, 2), (0, 2)]],
    3: [[(0, 0), (4, 0), (4, 4), (2, 4), (2, 9), (2, 4), (0, 4)]],
}


def _broken(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("p_partkey as id", "p_partkey % 4 as kind", "cast(1 + p_size as double) as u", "cast(p_partkey % 1000 as double) as x", "cast(p_partkey * 7 % 1000 as double) as y")
    at = lambda a, b: F.struct((F.col("x") + a * F.col("u")).alias("x"), (F.col("y") + b * F.col("u")).alias("y"))
    shape = lambda k: F.array(*[F.array(*[at(a, b) for a, b in (*r, r[0])]) for r in _RINGS[k]])
    rings = F.when(F.col("kind") == 0, shape(0)).when(F.col("kind") == 1, shape(1)).when(F.col("kind") == 2, shape(2)).otherwise(shape(3))
    return p.select("id", "u", kernels.shape_wkb(F.lit("Polygon"), rings).alias("wkb"))


@query(
    """with p as (select p_partkey as id, p_partkey % 4 as kind, 1 + p_size as u from part)
  select id, cast(case kind when 0 then 2 when 1 then 76 when 2 then 18 else 16 end * u * u as bigint) as area, cast(case kind when 0 then 2 when 1 then 2 when 2 then 3 else 1 end as integer) as pieces,
    cast(case when kind = 3 then 5 * u else 0 end as bigint) as remnant from p"""
)
def shape_repair(spark, sf_dir):
    """Area by the even-odd rule, pieces and what is left over of rings that cross, touch or run over themselves."""
    found = repair.repair(_broken(spark, sf_dir))
    whole = lambda c: F.round(c).cast("bigint")
    return found.select("id", whole("area_after").alias("area"), "pieces", whole("remnant_length").alias("remnant"))


#: s: strips of one degree of latitude from x1 to x2 in tenths of a degree east of 178, over the dateline too.
_STRIPS = "with s as (select p_brand as brand, (p_partkey * 37) % 31 as x1, (p_partkey * 37) % 31 + 1 + p_partkey % 9 as x2 from part)"


@query(
    _STRIPS
    + """, t as (select distinct brand, x1, x2 from s), c as (select unnest(range(0, 4)) as k),
  u as (select brand, k, greatest(x1, 10 * k) as a, least(x2, 10 * k + 10) as e from t cross join c where least(x2, 10 * k + 10) > greatest(x1, 10 * k)),
  m as (select *, max(e) over (partition by brand, k order by a, e rows between unbounded preceding and 1 preceding) as pm from u)
  select brand, case k when 0 then 178 when 1 then 179 when 2 then -180 else -179 end as west, cast(sum(greatest(0, e - greatest(a, coalesce(pm, a)))) as bigint) as tenths from m group by 1, 2"""
)
def dateline_coverage(spark, sf_dir):
    """The share, in tenths, of cells on both sides of the dateline that strips over it cover on the earth."""
    p = table(spark, sf_dir, "part").selectExpr("p_brand as brand", "p_partkey as id", "(p_partkey * 37) % 31 as x1", "(p_partkey * 37) % 31 + 1 + p_partkey % 9 as x2")
    lon = lambda c: F.when(F.col(c) > 20, F.lit(-182.0) + F.col(c) / 10).otherwise(F.lit(178.0) + F.col(c) / 10)
    at = lambda x, y: F.struct(lon(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(at("x1", 0.0), at("x2", 0.0), at("x2", 1.0), at("x1", 1.0), at("x1", 0.0))
    shapes = p.select(F.col("brand").alias("group"), F.col("id").cast("string").alias("feature_id"), F.col("id").cast("string").alias("record_id"), kernels.shape_wkb(F.lit("Polygon"), F.array(ring)).alias("wkb"))
    west = F.element_at(F.array(*map(F.lit, (178, 179, -180, -179))), (F.col("id") + 1).cast("int"))
    cells = spark.range(4).select(west.cast("string").alias("cell_id"), west.cast("double").alias("min_x"), F.lit(0.0).alias("min_y"), (west + 1).cast("double").alias("max_x"), F.lit(1.0).alias("max_y"))
    brands = [f"Brand#{k}" for k in range(1, 26)]
    long = plans.overlay(cells, shapes, brands, 1.0, completeness={}).long
    return long.where("polygon_coverage_fraction > 0").select(F.col("group").alias("brand"), F.col("cell_id").cast("int").alias("west"), F.round(F.col("polygon_coverage_fraction") * 10).cast("bigint").alias("tenths"))


@query(
    _P
    + """, o as (select grp, x as x1, y as y1, x + w as x2, y + h1 as y2 from p where kind = 1 union select grp, x, y, x + w1, y + h from p where kind = 1),
  xs as (select grp, x1 as x from o union select grp, x2 from o),
  sl as (select grp, x as s1, lead(x) over (partition by grp order by x) as s2 from xs),
  cov as (select s.grp, s1, s2, y1, y2, max(y2) over (partition by s.grp, s1 order by y1, y2 rows between unbounded preceding and 1 preceding) as pm
    from sl s join o on s.grp = o.grp and x1 <= s1 and x2 >= s2 where s2 is not null)
  select grp, cast(sum((s2 - s1) * greatest(0, y2 - greatest(y1, coalesce(pm, y1)))) as bigint) as area from cov group by 1"""
)
def dissolve_area(spark, sf_dir):
    """The area of the dissolved polygons of each group's L-shapes."""
    made = dissolve.dissolve(exact.parts_of(_shapes(spark, sf_dir).where("kind = 1").select("grp", "wkb")), ["grp"], 100.0)
    return made.groupBy("grp").agg(F.round(F.sum("area")).cast("bigint").alias("area"))


@query(
    _P
    + """, s as (select s_suppkey as id, (s_suppkey * 7919) % 3000 - 1000 as px, (s_suppkey * 104729) % 3000 - 1000 as py from supplier),
  t as (select s.id, px, py, x, y, greatest(0.0, least(1.0, ((px - x) + (py - y)) / (2.0 * w))) * w as a from s cross join p where kind = 2)
  select id, round(min(sqrt(pow(x + a - px, 2) + pow(y + a - py, 2))), 6) as distance from t group by 1"""
)
def nearest_line(spark, sf_dir):
    """The distance of every supplier's place to the nearest slanted line, however far it is."""
    points = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "cast((s_suppkey * 7919) % 3000 - 1000 as double) as x", "cast((s_suppkey * 104729) % 3000 - 1000 as double) as y")
    lines = distances.edges_of(_shapes(spark, sf_dir).where("kind = 2"), [])
    return distances.nearest_edge(points, lines, "id", 20.0).select("id", F.round("distance", 6).alias("distance"))


@query(
    _P
    + """, n as (select id, x, y, w, greatest(2, cast(ceil(w * sqrt(2.0) / 5) as bigint) + 1) as n from p where kind = 2)
  select id, i as number, round(x + w * i / (n - 1.0), 6) as x, round(y + w * i / (n - 1.0), 6) as y from (select *, unnest(range(0, n)) as i from n)"""
)
def line_points(spark, sf_dir):
    """Points along every slanted line, evenly spaced and at most 5 apart."""
    found = distances.points_along(_shapes(spark, sf_dir).where("kind = 2").select("id", "wkb"), ["id"], 5.0)
    return found.select("id", "number", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    """with s as (select c_custkey as section_id, (c_custkey * 797) % 100000 as y, c_custkey % 7 * 40 as p from customer),
  l as (select 'source ' || s_suppkey % 3 as source_id, (s_suppkey * 7919) % 100000 as ly, s_suppkey % 11 * 10 as acc from supplier),
  a as (select source_id, median(acc) as acc from l group by 1),
  d as (select section_id, source_id, max(p) as p, min(abs(y - ly)) as d from s cross join l group by 1, 2),
  t as (select section_id, source_id, d, greatest(25, p, acc) as tol from d join a using (source_id))
  select section_id, source_id, round(cast(d as double), 6) as distance, case when d > 50000 then 'no_comparable_geometry_near_section' when d <= tol then 'aligned_within_reported_precision'
    when d <= greatest(1000, 5 * tol) then 'minor_divergence_within_1km' when d <= 5000 then 'divergence_within_5km_review_required' else 'unresolved_divergence' end as status from t"""
)
def boundary_reconcile(spark, sf_dir):
    """Level lines of customers as sections against the level lines of three sources of suppliers."""
    level = lambda y, a, b: kernels.shape_wkb(F.lit("LineString"), F.array(F.array(*[F.struct(F.lit(float(x)).alias("x"), y.cast("double").alias("y")) for x in (a, b)])))
    sections = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("section_id"), level(F.col("c_custkey") * 797 % 100000, 0, 12000).alias("wkb"), (F.col("c_custkey") % 7 * 40).cast("double").alias("precision")
    )
    sources = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("source "), (F.col("s_suppkey") % 3).cast("string")).alias("source_id"),
        level(F.col("s_suppkey") * 7919 % 100000, -5000, 20000).alias("wkb"),
        (F.col("s_suppkey") % 11 * 10).cast("double").alias("accuracy"),
    )
    made = distances.reconcile(sections, sources, 2000.0)
    return made.select("section_id", "source_id", F.round("median_distance", 6).alias("distance"), "status")


@query(
    WITH_F
    + """, g as (select brand, cx || '_' || cy as cell_id, case when exists (select 1 from f where f.brand = b.brand and x1 < cx * 100 + 100 and x2 > cx * 100 and y1 < cy * 100 + 100 and y2 > cy * 100) then 1 else 0 end as hit
    from (select distinct brand from f) b cross join (select unnest(range(0, 12)) as cx) cross join (select unnest(range(0, 12)) as cy)),
  k as (select *, row_number() over (partition by brand, hit order by cell_id) as a, row_number() over (partition by brand, hit order by cell_id desc) as b from g)
  select brand, cell_id, hit, true as agrees from k where a <= 2 or b <= 2"""
)
def coverage_recomputed(spark, sf_dir):
    """The first and last two cells with and without a value of each brand, and whether another method finds the same coverage."""
    from .base import cells

    grid = cells(spark, sf_dir).select("cell_id", *[F.col(c).cast("double").alias(c) for c in exact.BOX])
    shapes = parts(spark, sf_dir).select(F.col("brand").alias("group"), F.col("id").cast("string").alias("feature_id"), F.col("id").cast("string").alias("record_id"), kernels.box_wkb(*exact.BOX).alias("wkb"))
    brands = [r["group"] for r in shapes.select("group").distinct().collect()]  # 25 brands
    made = plans.overlay(grid, shapes, sorted(brands), 100.0, completeness={}, earth=False)
    found = verify.recompute(made.long, grid, shapes, 100.0, earth=False)
    return found.select(F.col("group").alias("brand"), "cell_id", (F.coalesce("stored", F.lit(0.0)) > 0).cast("int").alias("hit"), "agrees")
