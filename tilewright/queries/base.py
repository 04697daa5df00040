"""Registry of queries and the feature and cell tables that the driver's tables stand in for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import spatial

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CELL = 100


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark, sf_dir: str) -> DataFrame:
    """Parts as features: an id, a group, a brand and an integer box in 0..1050."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_type").alias("grp"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        F.expr("(p_partkey * 37) % 1000").alias("min_x"),
        F.expr("(p_partkey * 91) % 1000").alias("min_y"),
        F.expr("cast((p_partkey * 37) % 1000 + 1 + p_size as bigint)").alias("max_x"),
        F.expr("(p_partkey * 91) % 1000 + 1 + p_partkey % 40").alias("max_y"),
    )


def cells(spark, sf_dir: str) -> DataFrame:
    return spatial.grid_of(spark, 12, 12, CELL).select("cx", "cy", "cell_id", *[F.col(c).cast("bigint").alias(c) for c in spatial.BOX])


def hits(spark, sf_dir: str) -> DataFrame:
    """Memberships of the boxes in the cells; right columns carry the prefix r_."""
    return spatial.memberships(cells(spark, sf_dir), parts(spark, sf_dir), CELL)


#: The same tables in DuckDB: f (features), c (cells), m (memberships by a theta join), u (union areas).
WITH_F = """with f as (select p_partkey as id, p_type as grp, p_brand as brand, p_name as name,
  (p_partkey*37)%1000 as x1, (p_partkey*91)%1000 as y1,
  cast((p_partkey*37)%1000+1+p_size as bigint) as x2, (p_partkey*91)%1000+1+p_partkey%40 as y2 from part)"""
WITH_C = WITH_F + """, c as (select cx, cy, cx || '_' || cy as cell_id from (select unnest(range(0,12)) as cx) cross join (select unnest(range(0,12)) as cy))"""
WITH_M = WITH_C + """, m as (select c.cx, c.cy, c.cell_id, f.*, greatest(x1, cx*100) as a1, least(x2, cx*100+100) as a2,
  greatest(y1, cy*100) as b1, least(y2, cy*100+100) as b2
  from f join c on x1 < cx*100+100 and x2 > cx*100 and y1 < cy*100+100 and y2 > cy*100)"""


def with_union(keys: str) -> str:
    """WITH_M and u (keys, union_area) by slabs."""
    on = " and ".join(f"s.{k} = b.{k}" for k in keys.split(", "))
    ks = ", ".join(f"s.{k}" for k in keys.split(", "))
    return (
        WITH_M
        + f""", bx as (select distinct {keys}, a1, a2, b1, b2 from m),
  xs as (select {keys}, a1 as x from bx union select {keys}, a2 from bx),
  sl as (select {keys}, x as s1, lead(x) over (partition by {keys} order by x) as s2 from xs),
  cov as (select {ks}, s1, s2, b1, b2, max(b2) over (partition by {ks}, s1 order by b1, b2 rows between unbounded preceding and 1 preceding) as pm
    from sl s join bx b on {on} and a1 <= s1 and a2 >= s2 where s2 is not null),
  u as (select {keys}, cast(sum((s2-s1)*greatest(0, b2-greatest(b1, coalesce(pm, b1)))) as bigint) as union_area from cov group by {keys})"""
    )
