"""Spatial queries on integer boxes, whose areas and lengths are exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import metrics, relational, spatial, validate
from .base import CELL, ORACLE_SQL, QUERIES, WITH_C, WITH_F, WITH_M, cells, hits, parts, query, table, with_union


@query(WITH_M + " select cx, cy, id, (a2-a1)*(b2-b1) as area from m")
def spatial_join_box(spark, sf_dir):
    return hits(spark, sf_dir).select(F.col("r_cx").alias("cx"), F.col("r_cy").alias("cy"), "id", "area")


@query(WITH_M + " select cell_id, grp, id, brand, 'polygon' as family, (a2-a1)*(b2-b1) as intersection_area from m")
def memberships(spark, sf_dir):
    found = hits(spark, sf_dir).select(
        F.col("r_cell_id").alias("cell_id"), "grp", "id", "brand", F.lit("polygon").alias("family"), F.col("area").alias("intersection_area")
    )
    return found


@query(WITH_M + " select cell_id, grp, count(distinct id) as feature_count, count(distinct brand) as source_record_count, count(*) as part_count from m group by 1, 2")
def metric_counts(spark, sf_dir):
    return metrics.counts(hits(spark, sf_dir).withColumnRenamed("r_cell_id", "cell_id"), ["cell_id", "grp"], "id", "brand", "id")


@query(
    with_union("cx, cy, grp")
    + """ select c.cell_id, u.grp, u.union_area, case when u.union_area is not null then round(least(1.0, u.union_area/10000.0), 6) end as fraction
  from c left join u on u.cx = c.cx and u.cy = c.cy"""
)
def coverage_fraction(spark, sf_dir):
    found = hits(spark, sf_dir).withColumnRenamed("r_cell_id", "cell_id")
    covered = metrics.cell_coverage(found, "cell_id", "grp", CELL * CELL).withColumn("fraction", F.round("fraction", 6))
    return metrics.for_every_cell(cells(spark, sf_dir).select("cell_id"), covered, "cell_id").select("cell_id", "grp", "union_area", "fraction")


@query(with_union("cell_id") + " select cell_id, union_area from u")
def union_area(spark, sf_dir):
    return spatial.union_area(hits(spark, sf_dir).withColumnRenamed("r_cell_id", "cell_id"), ["cell_id"])


@query(WITH_M + " select c.cell_id, cast(n as bigint) as feature_count from c left join (select cell_id, count(distinct id) n from m group by 1) k on k.cell_id = c.cell_id")
def left_cells(spark, sf_dir):
    n = hits(spark, sf_dir).groupBy(F.col("r_cell_id").alias("cell_id")).agg(F.countDistinct("id").alias("feature_count"))
    return metrics.for_every_cell(cells(spark, sf_dir).select("cell_id"), n, "cell_id")


#: The declared groups of the wide table: all brands.
_BRANDS = [f"Brand#{k}" for k in range(1, 26)]


@query(
    WITH_M
    + " , k as (select cell_id, brand, count(distinct id) as n, count(*) as p from m group by 1, 2) select c.cell_id, "
    + ", ".join(f"max(n) filter (brand='{b}') as \"{b}__feature_count\", max(p) filter (brand='{b}') as \"{b}__part_count\"" for b in _BRANDS)
    + " from c left join k on k.cell_id = c.cell_id group by 1"
)
def metric_pivot(spark, sf_dir):
    found = metrics.counts(hits(spark, sf_dir).withColumnRenamed("r_cell_id", "cell_id"), ["cell_id", "brand"], "id", "brand", "id")
    table_ = metrics.wide(found, "cell_id", "brand", _BRANDS, ["feature_count", "part_count"])
    return metrics.for_every_cell(cells(spark, sf_dir).select("cell_id"), table_, "cell_id")


@query(WITH_M + " select cell_id, array_to_string(list_sort(list(distinct brand)), '|') as brands, count(distinct brand) as n from m group by 1")
def attr_sets(spark, sf_dir):
    found = hits(spark, sf_dir).groupBy(F.col("r_cell_id").alias("cell_id")).agg(metrics.attribute_set("brand").alias("set"))
    return found.select("cell_id", F.array_join("set", "|").alias("brands"), F.size("set").cast("bigint").alias("n"))


_COMPLETENESS = "case when cx % 3 = 0 then 'complete' when cx % 3 = 1 then 'partial' else 'unknown' end"


#: z: every cell with every declared brand, the inventory's completeness there, and the features that were found.
_EVERY = (
    WITH_M
    + f""", k as (select cell_id, brand, count(distinct id) n from m group by 1, 2),
  z as (select c.cell_id, b.brand, {_COMPLETENESS} as completeness, n from c cross join (select unnest({_BRANDS}) as brand) b left join k on k.cell_id = c.cell_id and k.brand = b.brand)"""
)


def _every(spark, sf_dir):
    n = hits(spark, sf_dir).groupBy(F.col("r_cell_id").alias("cell_id"), "brand").agg(F.countDistinct("id").alias("n"))
    brands = spark.createDataFrame([(b,) for b in _BRANDS], "brand string")
    full = cells(spark, sf_dir).select("cell_id", F.expr(_COMPLETENESS).alias("completeness")).crossJoin(F.broadcast(brands))  # the declared brands
    return full.join(n, ["cell_id", "brand"], "left")


@query(_EVERY + " select cell_id, brand, completeness, case when completeness = 'complete' then coalesce(n, 0) else n end as feature_count from z")
def zero_fill(spark, sf_dir):
    return _every(spark, sf_dir).select("cell_id", "brand", "completeness", metrics.zero_fill("n", "completeness").alias("feature_count"))


@query(
    _EVERY
    + """, s as (select cell_id, brand, case when completeness = 'complete' then 'observed' else completeness end as state, case when completeness = 'unknown' then null else n end as v, n from z)
  select cell_id, brand, state, v as feature_count, case when v is null and state = 'observed' then 'unknown' else state end as status,
    case when n is not null then 'partial' when cell_id like '1%' then 'unknown' else 'unavailable' end as query_state from s"""
)
def status_derive(spark, sf_dir):
    z = _every(spark, sf_dir)
    s = z.select("cell_id", "brand", metrics.support_state("completeness").alias("state"), "n").withColumn("feature_count", F.when(F.col("state") != "unknown", F.col("n")))
    reached = F.when(F.col("cell_id").startswith("1"), "available").otherwise("failed")
    return s.select(
        "cell_id",
        "brand",
        "state",
        "feature_count",
        metrics.delivery_status("feature_count", "state").alias("status"),
        metrics.query_status(F.col("n").isNotNull(), reached).alias("query_state"),
    )


@query(
    """with p as (select event_id, user_id, event_type, (user_id*7)%1000 as x, (event_id*13)%1000 as y from events)
  select (x // 100) as cx, (y // 100) as cy, count(distinct {'x': x, 'y': y}) as coordinates, count(distinct user_id) as features from p group by 1, 2"""
)
def point_count(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("user_id", F.expr("(user_id * 7) % 1000").alias("x"), F.expr("(event_id * 13) % 1000").alias("y"))
    return p.groupBy(F.expr("x div 100").alias("cx"), F.expr("y div 100").alias("cy")).agg(
        F.countDistinct(F.struct("x", "y")).alias("coordinates"), F.countDistinct("user_id").alias("features")
    )


@query(
    """with i as (select distinct o_custkey as k, date_diff('day', timestamp '1990-01-01', o_orderdate) as s, date_diff('day', timestamp '1990-01-01', o_orderdate) + o_orderkey % 30 as e from orders),
  r as (select k, s, e, max(e) over (partition by k order by s, e rows between unbounded preceding and 1 preceding) as pm from i)
  select k as o_custkey, cast(sum(greatest(0, e - greatest(s, coalesce(pm, s)))) as bigint) as union_length from r group by 1"""
)
def union_length(spark, sf_dir):
    day = F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")).cast("bigint")
    i = table(spark, sf_dir, "orders").select("o_custkey", day.alias("s"), (day + F.col("o_orderkey") % 30).alias("e"))
    return spatial.union_length(i, ["o_custkey"], "s", "e")


_WALK = with_union("brand, cell_id") + """, b as (select brand, x1 as a1, x2 as a2, y1 as b1, y2 as b2 from f),
  nx as (select brand, a1 as x from b union select brand, a2 from b),
  ns as (select brand, x as s1, lead(x) over (partition by brand order by x) as s2 from nx),
  nc as (select n.brand, s1, s2, b1, b2, max(b2) over (partition by n.brand, s1 order by b1, b2 rows between unbounded preceding and 1 preceding) as pm
    from ns n join (select distinct * from b) q on q.brand = n.brand and a1 <= s1 and a2 >= s2 where s2 is not null),
  nu as (select brand, cast(sum((s2-s1)*greatest(0, b2-greatest(b1, coalesce(pm, b1)))) as bigint) as native_area from nc group by 1)"""


@query(
    _WALK
    + """ select u.brand, u.cell_id, u.union_area as intersection_area, native_area,
  round(u.union_area/native_area, 9) as fraction_of_native, round(u.union_area/10000.0, 9) as fraction_of_cell from u join nu on nu.brand = u.brand where u.union_area > 0"""
)
def crosswalk(spark, sf_dir):
    walk = spatial.crosswalk(parts(spark, sf_dir), cells(spark, sf_dir), ["brand"], "cell_id", CELL)
    rounded = {c: F.round(c, 9) for c in ("fraction_of_native", "fraction_of_cell")}
    return walk.withColumns(rounded).select("brand", "cell_id", "intersection_area", "native_area", *rounded)


@query(
    _WALK
    + """, k as (select u.brand, u.cell_id, u.union_area, native_area from u join nu on nu.brand = u.brand)
  select count(*) as "rows", cast(0 as bigint) as bad_measures, count(*) filter (brand = 'Brand#11') as bad_fractions,
    (select count(distinct cell_id) from k where brand = 'Brand#12') as repeated, cast(0 as bigint) + (select case when 2 * sum(union_area) > max(native_area) then 1 else 0 end from k where brand = 'Brand#12') as above_one
  from (select brand, cell_id from k union all select brand, cell_id from k where brand = 'Brand#12')"""
)
def crosswalk_check(spark, sf_dir):
    """The faults of a crosswalk in which one record has wrong areas and another has all its rows twice."""
    walk = spatial.crosswalk(parts(spark, sf_dir), cells(spark, sf_dir), ["brand"], "cell_id", CELL)
    wrong = walk.withColumn("intersection_area", F.when(F.col("brand") == "Brand#11", F.col("intersection_area") * 2).otherwise(F.col("intersection_area")))
    return spatial.check_crosswalk(wrong.unionByName(wrong.where("brand = 'Brand#12'")), ["brand"], "cell_id")


@query(WITH_M + " select distinct cell_id from m where brand = 'Brand#13'")
def mask_support(spark, sf_dir):
    mask = parts(spark, sf_dir).where("brand = 'Brand#13'")
    return spatial.supported(cells(spark, sf_dir).drop("cx", "cy"), mask, CELL).select("cell_id")


@query(
    WITH_F
    + """ select brand, round(sum(greatest(0, least(x2, 500)-x1)*(y2-y1)) / sum((x2-x1)*(y2-y1)), 6) as share,
  case when sum(greatest(0, least(x2, 500)-x1)*(y2-y1)) / sum((x2-x1)*(y2-y1)) >= 0.995 then 'consistent' when sum(greatest(0, least(x2, 500)-x1)*(y2-y1)) > 0 then 'review_required' else 'disjoint' end as status from f group by 1"""
)
def allocation_match(spark, sf_dir):
    inside = G.clip_to((0, 0, 500, 100000))
    p = parts(spark, sf_dir).select("brand", G.box_area().alias("whole"), G.box_area(*inside.values()).alias("inside"))
    share = p.groupBy("brand").agg((F.sum("inside") / F.sum("whole")).alias("share"))
    return share.select("brand", F.round("share", 6).alias("share"), metrics.distance_status("share").alias("status"))


@query(
    WITH_F
    + """, a as (select brand, sum((x2-x1)*(y2-y1)) as area, count(*) * 500 as reference from f group by 1)
  select brand, cast(area as bigint) as area, round(100.0*(area-reference)/reference, 4) as percent, case when abs(100.0*(area-reference)/reference) <= 5 then 'passed' else 'review_required' end as qc from a"""
)
def area_qc(spark, sf_dir):
    a = parts(spark, sf_dir).groupBy("brand").agg(F.sum(G.box_area()).alias("area"), (F.count("*") * 500).alias("reference"))
    return a.select(
        "brand", "area", F.round(100.0 * (F.col("area") - F.col("reference")) / F.col("reference"), 4).alias("percent"), metrics.area_qc("area", "reference", 5.0).alias("qc")
    )


@query(
    WITH_F
    + """, b as (select min(x1) // 100 as x1, (max(x2) + 99) // 100 - 1 as x2, min(y1) // 100 as y1, (max(y2) + 99) // 100 - 1 as y2 from f),
  g as (select cx, unnest(range(y1, y2 + 1)) as cy from (select *, unnest(range(x1, x2 + 1)) as cx from b))
  select cx || '_' || cy as cell_id, cx, cy, cx * 100 as min_x, cy * 100 as min_y, cx * 100 + 100 as max_x, cy * 100 + 100 as max_y from g"""
)
def grid_generate(spark, sf_dir):
    """The cells over the bounds of all parts."""
    made = spatial.grid_over(parts(spark, sf_dir), CELL)
    return made.select("cell_id", "cx", "cy", *[F.col(c).cast("bigint").alias(c) for c in spatial.BOX])


@query(
    WITH_F
    + """, g as (select case when id % 7 = 0 then ' ' else name end as cell_id, x1 as min_x, case when id % 11 = 0 then null else x1 + y2 % 5 end as max_x, y1 as min_y, y2 as max_y from f)
  select count(*) as "rows", count(*) filter (coalesce(trim(cell_id), '') = '') as id, count(*) filter (not coalesce(min_x < max_x and min_y < max_y, false)) as box, cast(0 as bigint) as finite from g"""
)
def grid_validate(spark, sf_dir):
    """The faults of a grid with blank ids and boxes that are empty or lack a side."""
    p = parts(spark, sf_dir).withColumn("cell_id", F.when(F.col("id") % 7 == 0, " ").otherwise(F.col("name")))
    p = p.withColumn("max_x", F.when(F.col("id") % 11 != 0, F.col("min_x") + F.col("max_y") % 5))
    return validate.count_violations(p, validate.grid_rules())


@query(WITH_F + " select id, grp from f where (x2 >= 900 and x1 <= 1000 and y2 >= 100 and y1 <= 300) or (x2 >= 0 and x1 <= 50 and y2 >= 100 and y1 <= 300)")
def bbox_filter(spark, sf_dir):
    # a window that wraps: east of 900 or west of 50
    p = parts(spark, sf_dir)
    wrapped = [(900, 100, 1000, 300), (0, 100, 50, 300)]
    return p.where(F.lit(False) | G.in_box(wrapped[0]) | G.in_box(wrapped[1])).select("id", "grp")


@query("select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000)")
def semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    c = table(spark, sf_dir, "customer")
    return c.join(big, c["c_custkey"] == big["o_custkey"], "left_semi").select("c_custkey", "c_name")


@query(
    WITH_F
    + """ select min(x1) as min_x, min(y1) as min_y, max(x2) as max_x, max(y2) as max_y,
  min(x1) filter (x1 >= 500) as east_min, max(x2) filter (x2 < 500) as west_max from f"""
)
def total_bounds(spark, sf_dir):
    return parts(spark, sf_dir).agg(
        F.min("min_x").alias("min_x"),
        F.min("min_y").alias("min_y"),
        F.max("max_x").alias("max_x"),
        F.max("max_y").alias("max_y"),
        F.min(F.when(F.col("min_x") >= 500, F.col("min_x"))).alias("east_min"),
        F.max(F.when(F.col("max_x") < 500, F.col("max_x"))).alias("west_max"),
    )


@query(
    WITH_F
    + """, k as (select id, greatest(x1, 200) as min_x, greatest(y1, 200) as min_y, least(x2, 700) as max_x, least(y2, 700) as max_y, (x2-x1)*(y2-y1) as whole from f where x1 < 700 and x2 > 200 and y1 < 700 and y2 > 200)
  select id, min_x, min_y, max_x, max_y, round((max_x-min_x)*(max_y-min_y)/whole, 9) as retained, (max_x-min_x)*(max_y-min_y) < whole as clipped from k"""
)
def clip_box(spark, sf_dir):
    from ..operators.clip import clip_boxes

    kept = clip_boxes(parts(spark, sf_dir), (200, 200, 700, 700))
    return kept.select("id", *spatial.BOX, F.round("retained_fraction", 9).alias("retained"), "clipped")


@query(WITH_F + " select grp, case when grp like 'ECONOMY%' then 'point' when grp like 'LARGE%' then 'line' when grp like 'SMALL%' then 'collection' else 'polygon' end as family, count(*) as n from f group by 1, 2")
def geom_family(spark, sf_dir):
    kind = F.expr("case when grp like 'ECONOMY%' then 'MultiPoint' when grp like 'LARGE%' then 'LineString' when grp like 'SMALL%' then 'GeometryCollection' else 'Polygon' end")
    return parts(spark, sf_dir).groupBy("grp", G.family(kind).alias("family")).agg(F.count("*").alias("n"))


def _exploded(lines):
    per = lines.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("parts"))
    part = per.select(F.col("l_orderkey").alias("source"), F.explode("parts").alias("p"))
    return part.select("source", F.col("p.l_linenumber").alias("part_key"), F.col("p.l_quantity").cast("bigint").alias("quantity"))


@query("select l_orderkey as source, l_linenumber as part_key, cast(l_quantity as bigint) as quantity from lineitem")
def explode_parts(spark, sf_dir):
    """Every part of every order."""
    return _exploded(table(spark, sf_dir, "lineitem"))


QUERIES["explode_parts_all"], ORACLE_SQL["explode_parts_all"] = explode_parts, ORACLE_SQL["explode_parts"]


@query(WITH_M + " select id, cell_id, (a2 - a1) * (b2 - b1) as area from m where (select count(*) from m) <= 10000000")
def budget_guard(spark, sf_dir):
    """All memberships, or an error if there were more than the budget."""
    return relational.within_budget(hits(spark, sf_dir).select("id", F.col("r_cell_id").alias("cell_id"), F.col("area").cast("bigint").alias("area")), 10_000_000, "memberships")
