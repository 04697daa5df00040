"""Queries on longitudes and latitudes derived from keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G, kernels, scalar as S
from ..operators import metrics, spatial
from .base import ORACLE_SQL, QUERIES, query, table

_LL = "cast((c_custkey*7)%360-180 as double) as lon, cast(c_nationkey*5-60 as double) as lat"
_RAD = "(pi()/180)"
_E2 = repr(G.ECC2)
_E = repr(G.ECC)
_X = f"(lon*{_RAD}*{G.SEMI_MAJOR * G.K0!r})"
_S = f"sin(lat*{_RAD})"
_Y = f"((1-{_E2})*({_S}/(1-{_E2}*{_S}*{_S}) - ln((1-{_E}*{_S})/(1+{_E}*{_S}))/(2*{_E}))*{G.SEMI_MAJOR / (2 * G.K0)!r})"


def _points(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey", *_LL.split(", "))


@query(f"with p as (select c_custkey, {_LL} from customer) select c_custkey, round({_X}, 3) as x, round({_Y}, 3) as y from p")
def project_6933(spark, sf_dir):
    return _points(spark, sf_dir).select("c_custkey", F.round(G.project_x("lon"), 3).alias("x"), F.round(G.project_y("lat"), 3).alias("y"))


@query(
    """with r as (select p_partkey, (p_partkey*37)%1000 as x, (p_partkey*91)%1000 as y, p_size as w, 1+p_partkey%40 as h from part)
  select p_partkey, round(cast(w*h as double)/2 + cast(w*h as double), 3) as area from r"""
)
def shoelace_area(spark, sf_dir):
    # a box with a right triangle on top of it, both w wide and h high
    p = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "cast((p_partkey*37)%1000 as double) as x", "cast((p_partkey*91)%1000 as double) as y", "cast(p_size as double) as w", "cast(1+p_partkey%40 as double) as h"
    )
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    zero, w, h = F.lit(0.0), F.col("w"), F.col("h")
    ring = F.array(at(zero, zero), at(w, zero), at(w, h), at(zero, 2 * h))
    return p.select("p_partkey", F.round(F.abs(G.signed_area(ring)), 3).alias("area"))


def _distances(p):
    return p.select("c_custkey", F.round(G.haversine("lon", "lat", F.lit(0.0), F.col("lat") + 1), 0).alias("metres"))


@query(
    f"""with p as (select c_custkey, {_LL} from customer),
  q as (select c_custkey, lon, lat, 0.0 as lon2, lat+1 as lat2 from p)
  select c_custkey, round(2*6371008.8*asin(sqrt(least(1.0, pow(sin((lat2-lat)*{_RAD}/2),2)+cos(lat*{_RAD})*cos(lat2*{_RAD})*pow(sin((lon2-lon)*{_RAD}/2),2)))), 0) as metres from q"""
)
def sphere_distance(spark, sf_dir):
    """Every customer's distance."""
    return _distances(_points(spark, sf_dir))


QUERIES["sphere_distance_all"], ORACLE_SQL["sphere_distance_all"] = sphere_distance, ORACLE_SQL["sphere_distance"]


@query()
def geodesic_len(spark, sf_dir):
    """Ellipsoidal length of a two-step line from each customer's point; no SQL, tested against closed forms."""
    p = _points(spark, sf_dir)
    at = lambda dx, dy: F.struct((F.col("lon") + dx).alias("x"), (F.col("lat") + dy).alias("y"))
    return p.select("c_custkey", F.round(kernels.geodesic_length(F.array(at(0, 0), at(1, 0), at(1, 1))), 3).alias("metres"))


@query(
    """with p as (select c_custkey, cast((c_custkey*7)%360-180 as double) as a, cast((c_custkey*13)%360-180 as double) as b from customer)
  select c_custkey, a as first_x, case when b-a > 180 then b-360 when b-a < -180 then b+360 else b end as second_x from p"""
)
def unwrap_lon(spark, sf_dir):
    p = table(spark, sf_dir, "customer").selectExpr("c_custkey", "cast((c_custkey*7)%360-180 as double) as a", "cast((c_custkey*13)%360-180 as double) as b")
    ring = G.unwrap(F.array(F.struct(F.col("a").alias("x"), F.lit(0.0).alias("y")), F.struct(F.col("b").alias("x"), F.lit(0.0).alias("y"))))
    return p.select("c_custkey", ring[0]["x"].alias("first_x"), ring[1]["x"].alias("second_x"))


@query(
    """select s_suppkey, round(0.0 + (case when s_suppkey % 2 = 0 then -1 else 1 end) * (cast(s_suppkey % 90 as double) + cast(s_suppkey % 61 as double)/60 + cast(s_suppkey % 60 as double)/3600), 9) as lat from supplier"""
)
def dms_parse(spark, sf_dir):
    text = F.format_string("%d°%d'%d\"%s", F.expr("s_suppkey % 90"), F.expr("s_suppkey % 61"), F.expr("s_suppkey % 60"), F.expr("case when s_suppkey % 2 = 0 then 'S' else 'N' end"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(S.dms(text), 9).alias("lat"))


_SUPPLIERS = "select s_suppkey, cast((s_suppkey*37)%1000 as double) as x, cast((s_suppkey*91)%1000 as double) as y from supplier"
_NATIONS = "select n_nationkey, cast((n_nationkey*41)%1000 as double) as x, cast((n_nationkey*83)%1000 as double) as y from nation"


@query(
    f"""with s as ({_SUPPLIERS}), n as ({_NATIONS}), d as (select s_suppkey, sqrt(pow(s.x-n.x,2)+pow(s.y-n.y,2)) as d from s cross join n)
  select s.s_suppkey, round(min(d) filter (d <= 400), 6) as distance from s left join d on d.s_suppkey = s.s_suppkey group by 1"""
)
def nearest_distance(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "cast((s_suppkey*37)%1000 as double) as x", "cast((s_suppkey*91)%1000 as double) as y")
    n = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "cast((n_nationkey*41)%1000 as double) as x", "cast((n_nationkey*83)%1000 as double) as y")
    metric = lambda a, b: F.sqrt(F.pow(F.col(a + "x") - F.col(b + "x"), 2) + F.pow(F.col(a + "y") - F.col(b + "y"), 2))
    return spatial.nearest_distance(s, n, "s_suppkey", 400.0, metric).withColumn("distance", F.round("distance", 6))


@query(
    """with l as (select p_partkey, cast(p_size as double) as len, greatest(1, cast(ceil(p_size/5.0) as integer)) as n from part)
  select p_partkey, cast(i as integer) as sample, round(i/n, 9) as share from (select p_partkey, n, unnest(range(0, n+1)) as i from l)"""
)
def line_sample(spark, sf_dir):
    lines = table(spark, sf_dir, "part").selectExpr("p_partkey", "cast(p_size as double) as len")
    return spatial.samples_along(lines, "p_partkey", 5.0, "len").withColumn("share", F.round("share", 9))


@query(
    f"""with s as ({_SUPPLIERS}), n as ({_NATIONS}), d as (select n_nationkey, sqrt(pow(s.x-n.x,2)+pow(s.y-n.y,2)) as d from s cross join n)
  select n_nationkey, count(d) as samples, round(min(d),4) as least, round(median(d),4) as median, round(quantile_cont(d,0.95),4) as p95, round(max(d),4) as greatest, round(avg(case when d <= 300 then 1.0 else 0.0 end),6) as share_within from d group by 1"""
)
def distance_stats(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").selectExpr("cast((s_suppkey*37)%1000 as double) as x", "cast((s_suppkey*91)%1000 as double) as y")
    n = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "cast((n_nationkey*41)%1000 as double) as nx", "cast((n_nationkey*83)%1000 as double) as ny")
    # samples against each of a fixed, small set of targets: the nation table is a dimension of 25 rows
    d = s.crossJoin(F.broadcast(n)).withColumn("d", F.sqrt(F.pow(F.col("x") - F.col("nx"), 2) + F.pow(F.col("y") - F.col("ny"), 2)))
    out = metrics.distance_stats(d, ["n_nationkey"], "d", 300.0)
    return out.withColumns({c: F.round(c, 4) for c in ("least", "median", "p95", "greatest")} | {"share_within": F.round("share_within", 6)})
