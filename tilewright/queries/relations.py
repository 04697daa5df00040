"""Relational queries: keys, sets, counts, numbering, receipts and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S, temporal as T
from ..operators import metrics, relational as R, validate as V
from .base import query, table


@query("select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '1998-01-01' and l_quantity > 30")
def scan_parquet(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem")
    return t.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 30)).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """select count(*) as "rows", count(*) filter (c_custkey is null) as key, count(*) filter (c_name is null or trim(c_name) = '') as name,
  count(*) filter (c_acctbal is null or c_acctbal < 0) as balance from customer"""
)
def schema_gate(spark, sf_dir):
    t = table(spark, sf_dir, "customer")
    R.require(t, ["C_CUSTKEY", "c_name", "c_acctbal"])
    rules = {"key": S.strict_int("c_custkey").isNotNull(), "name": V.text("c_name"), "balance": F.col("c_acctbal") >= 0}
    return V.count_violations(t, rules)


@query("select p_partkey, p_brand, p_size from part where p_brand in ('Brand#11', 'Brand#23') and p_size between 10 and 20 and p_type is not null")
def filter_basic(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_brand").isin("Brand#11", "Brand#23") & F.col("p_size").between(10, 20) & F.col("p_type").isNotNull()).select("p_partkey", "p_brand", "p_size")


@query("select p_partkey, p_name, p_type from part where lower(p_name) like '%ring%' and upper(p_type) like 'E%'")
def filter_text(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(F.lower("p_name").contains("ring") & F.upper("p_type").startswith("E")).select("p_partkey", "p_name", "p_type")


@query("select o_orderkey, o_orderpriority from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
def view_filter(spark, sf_dir):
    return R.view(table(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}).select("o_orderkey", "o_orderpriority")


@query(
    """select cast(c_custkey as varchar) as feature, c_mktsegment as status from customer where c_mktsegment is distinct from 'MACHINERY'
  union all select 'proposed', 'not_applicable'"""
)
def proposal_filter(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("feature"), F.col("c_mktsegment").alias("status"))
    return c.where(~F.col("status").eqNullSafe("MACHINERY")).unionByName(spark.createDataFrame([("proposed", "not_applicable")], "feature string, status string"))


@query("select s_suppkey, s_name as name, cast(null as varchar) as absent from supplier")
def column_alias(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", R.resolve(s, "title", "S_NAME").alias("name"), R.resolve(s, "title").alias("absent"))


@query(
    """select 'tpch:' || s_suppkey as feature_id, 'supplier' as source_id, cast(s_suppkey as varchar) as record_id, nullif(trim(s_name), '') as feature_name,
  coalesce(n_name, 'provider') as authority, 'reference_geometry' as legal_status, 'observed' as measurement_status, false as model_eligible, 'review_required' as qc_status
  from supplier left join nation on n_nationkey = s_nationkey and n_nationkey < 20"""
)
def base_record(spark, sf_dir):
    from ..plans.normalize import Source, base_record as build

    s = table(spark, sf_dir, "supplier")
    n = F.broadcast(table(spark, sf_dir, "nation").where("n_nationkey < 20"))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left")
    source = Source("supplier", provider="provider")
    made = build(joined, source, record_id=F.col("s_suppkey"), feature_id=F.concat(F.lit("tpch:"), "s_suppkey"), feature_name=F.col("s_name"), feature_type=F.lit("supplier"), authority=F.col("n_name"))
    return made.select("feature_id", "source_id", "record_id", "feature_name", "authority", "legal_status", "measurement_status", "model_eligible", "qc_status")


@query("select cast(s_suppkey as varchar) as \"P_S_SUPPKEY\", nullif(trim(s_name), '') as \"P_S_NAME\", cast(s_nationkey as varchar) as \"P_S_NATIONKEY\" from supplier")
def prefix_passthrough(spark, sf_dir):
    from ..plans.normalize import passthrough

    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return s.select(*passthrough(s, "P_"))


@query(
    """select c_custkey, case when c_acctbal is null then 'not_compared' when c_acctbal >= 0.995 then 'consistent' when c_acctbal > 0 then 'review_required' else 'disjoint' end as status from customer"""
)
def case_status(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", metrics.distance_status("c_acctbal").alias("status"))


@query("select o_orderkey, o_orderstatus, case o_orderstatus when 'F' then 'final' when 'O' then 'open' else 'pending' end as role from orders")
def class_lookup(spark, sf_dir):
    roles = spark.createDataFrame([("F", "final"), ("O", "open"), ("P", "pending")], "o_orderstatus string, role string")
    return R.classify(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.broadcast(roles), ["o_orderstatus"])


@query("select d.doc_id, coalesce(l.quality, -1) as receipt, coalesce(cast(l.quality as varchar), d.source) as learned from documents d left join labels l on l.doc_id = d.doc_id")
def receipt_join(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(l, "doc_id", "left").withColumn("q", F.col("quality").cast("string"))
    return j.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("receipt"), T.learned_at("q", "source").alias("learned"))


@query("select c_custkey, n_name, r_name from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey")
def lookup_join(spark, sf_dir):
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return c.join(F.broadcast(places), c["c_nationkey"] == places["n_nationkey"]).select("c_custkey", "n_name", "r_name")


@query("select r_name, n_name, count(c_custkey) as customers, case when count(c_custkey) > 0 then 'available' else 'unavailable' end as status from region cross join nation left join customer on c_nationkey = n_nationkey and n_regionkey = r_regionkey group by 1, 2")
def availability_matrix(spark, sf_dir):
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    per = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("c"))
    matrix = r.crossJoin(F.broadcast(n))  # two dimension tables of fixed size
    found = matrix.join(per, matrix["n_nationkey"] == per["c_nationkey"], "left")
    n_ = F.when(F.col("n_regionkey") == F.col("r_regionkey"), F.coalesce("c", F.lit(0))).otherwise(0).cast("bigint")
    return found.select("r_name", "n_name", n_.alias("customers"), F.when(n_ > 0, "available").otherwise("unavailable").alias("status"))


@query(
    """select n_regionkey as grp, count(*) filter (n_nationkey % 3 <> 0) as available, count(*) as configured, round(count(*) filter (n_nationkey % 3 <> 0) / count(*), 6) as fraction,
  array_to_string(list_sort(list(distinct n_name) filter (n_nationkey % 3 = 0)), '|') as gaps from nation group by 1"""
)
def receipt_fraction(spark, sf_dir):
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "grp")
    out = metrics.receipts(n, "grp", F.col("n_nationkey") % 3 != 0, "n_name")
    gaps = F.when(F.size("gaps") > 0, F.array_join("gaps", "|"))
    return out.select("grp", "available", "configured", F.round("fraction", 6).alias("fraction"), gaps.alias("gaps"))


_STATUS = "case n_nationkey % 7 when 0 then 'partial' when 1 then 'not_applicable' else 'complete' end"


@query(f"with s as (select n_regionkey, {_STATUS} as status from nation) select n_regionkey, bool_and(status in ('complete','not_applicable')) as complete, bool_or(status in ('partial','unknown','unavailable')) as partial from s group by 1")
def completeness_gate(spark, sf_dir):
    return metrics.completeness(table(spark, sf_dir, "nation").select("n_regionkey", F.expr(_STATUS).alias("status")), "n_regionkey", "status")


@query(
    f"""with n as (select n_name, n_regionkey, {_STATUS} as status from nation)
  select o.r_name as collection, n.n_name as source, r.r_name as region, case when r.r_regionkey = n.n_regionkey then n.status else 'unknown' end as status
  from n join region o on o.r_regionkey = n.n_regionkey cross join region r"""
)
def coverage_matrix(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    sources = n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])  # two dimension tables of fixed size
    sources = sources.select(F.col("r_name").alias("collection"), F.col("n_name").alias("source"), F.create_map("r_name", F.expr(_STATUS)).alias("coverage"))
    return R.coverage_matrix(sources, r.select(F.col("r_name").alias("region")))


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_join(spark, sf_dir):
    """Customers without an order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey")


@query(
    """select doc_id, 'missing' as side from (select doc_id from documents except select doc_id from labels)
  union all select doc_id, 'extra' from (select doc_id from labels except select doc_id from documents)"""
)
def roster_reconcile(spark, sf_dir):
    return R.roster_gaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("select c_custkey as k from customer except select o_custkey from orders where o_orderpriority = '2-HIGH'")
def set_except(spark, sf_dir):
    """Customers without an order of high priority."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return a.subtract(table(spark, sf_dir, "orders").where("o_orderpriority = '2-HIGH'").select(F.col("o_custkey").alias("k")))


@query("select c_custkey as k from customer intersect select o_custkey from orders")
def set_intersect(spark, sf_dir):
    """Customers with an order."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return a.intersect(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")))


@query(
    """select s_suppkey, cast(s_acctbal as double) as s_acctbal, 'left' as side from supplier where s_acctbal < 0
  union all select s_suppkey, cast(0 as double), 'right' from supplier where s_acctbal < 0"""
)
def readback_equal(spark, sf_dir):
    """What differs between a table and a copy of it that lost negative balances."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return R.differences(s, s.withColumn("s_acctbal", F.greatest("s_acctbal", F.lit(0.0))))


@query("select l_partkey, l_suppkey, count(*) as \"rows\" from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return R.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey) as r from lineitem) where r = 1")
def dedup_first(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return R.first_per(t, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"]).drop("l_shipdate")


@query(
    """select l_orderkey, l_linenumber, cast(row_number() over (partition by l_orderkey order by l_partkey, l_linenumber) as integer) as part_number,
  printf('%s:part-%03d', cast(l_orderkey as varchar), row_number() over (partition by l_orderkey order by l_partkey, l_linenumber)) as part_id from lineitem"""
)
def part_number(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return R.number_parts(t, "l_orderkey", ["l_partkey", "l_linenumber"], "part_id").select("l_orderkey", "l_linenumber", "part_number", "part_id")


@query(
    """select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by c_custkey) as u, row_number() over (partition by c_nationkey order by c_custkey desc) as d from customer) where u <= 2 or d <= 2"""
)
def stratified_sample(spark, sf_dir):
    return R.ends_per(table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), ["c_nationkey"], ["c_custkey"], 2)


@query("select s_nationkey, s_suppkey, s_name from supplier order by s_nationkey, s_suppkey")
def sort_parts(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name").orderBy("s_nationkey", "s_suppkey")


@query("select l_orderkey, bool_and(p is null or l_partkey > p) as monotone from (select l_orderkey, l_partkey, lag(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey) as p from lineitem) group by 1")
def monotone_check(spark, sf_dir):
    return V.monotone(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey"], "l_partkey")


@query("select o_orderpriority, count(*) as n from orders group by 1")
def value_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    """select o_orderstatus, string_agg(o_orderpriority || '=' || n, '|' order by o_orderpriority) as counts from (select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2) group by 1"""
)
def nested_counts(spark, sf_dir):
    out = metrics.nested_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")
    pairs = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("o_orderstatus", F.array_join(F.array_sort(pairs), "|").alias("counts"))


@query(
    """select o_custkey, bool_or(o_orderstatus = 'P') as unresolved, string_agg(distinct o_orderstatus, '; ' order by o_orderstatus) as summary from orders group by 1"""
)
def any_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(
        F.bool_or(F.col("o_orderstatus") == "P").alias("unresolved"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "; ").alias("summary")
    )


@query(
    """select c_nationkey, count(distinct c_mktsegment) as n_c_mktsegment, count(distinct c_nationkey) as n_same, greatest(count(distinct c_mktsegment), count(distinct c_nationkey)) > 1 as conflict from customer group by 1"""
)
def group_conflict(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("same", F.col("c_nationkey"))
    return R.conflicts(c, ["c_nationkey"], ["c_mktsegment", "same"])


@query("select l_returnflag, count(distinct {'a': nullif(l_linenumber, 3), 'b': l_linestatus}) filter (l_linestatus is not null) as n from lineitem group by 1")
def distinct_struct(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").withColumn("a", F.nullif("l_linenumber", F.lit(3)))
    return t.groupBy("l_returnflag").agg(metrics.distinct_tuples(["a", "l_linestatus"], "l_linestatus").alias("n"))


@query("select strftime(min(o_orderdate), '%Y-%m-%d') as first_day, strftime(max(o_orderdate), '%Y-%m-%d') as last_day from orders")
def temporal_extent(spark, sf_dir):
    day = S.try_iso_date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


_INTERVAL = """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as a, case when o_orderkey % 2 = 0 then strftime(m, '%Y-%m-%d') end as b from orders join (select l_orderkey, max(l_shipdate) as m from lineitem group by 1) on l_orderkey = o_orderkey"""


def _intervals(spark, sf_dir):
    last = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("m"))
    o = table(spark, sf_dir, "orders")
    return o.join(last, o["o_orderkey"] == last["l_orderkey"]).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("a"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("m", "yyyy-MM-dd")).alias("b")
    )


@query(f"select o_orderkey, a, b from ({_INTERVAL}) where a <= '1996-01-01' and (b is null or b >= '1996-01-01')")
def as_of_slice(spark, sf_dir):
    return _intervals(spark, sf_dir).where(T.as_of("1996-01-01", "a", "b"))


@query(f"select count(*) as \"rows\", count(*) filter (b is not null and a > b) as broken from ({_INTERVAL})")
def interval_valid(spark, sf_dir):
    return V.count_violations(_intervals(spark, sf_dir), {"broken": T.interval_valid("a", "b")})


@query("select count(*) as \"rows\", cast(0 as bigint) as null_dates, (select count(*) from (select 1 from orders group by o_custkey, o_orderdate having count(*) > 1)) as repeated_keys from orders")
def dynamic_grain(spark, sf_dir):
    return V.grain(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate").select("rows", "null_dates", "repeated_keys")


@query("select c_custkey as id, c_name as name, c_acctbal as balance from customer union all select s_suppkey, s_name, null from supplier")
def union_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return R.stack([c, s])


@query("select n_regionkey as resolution, n_nationkey as cell, n_name as name from nation where n_regionkey in (1, 3)")
def delivery_split(spark, sf_dir):
    from ..plans.products import per_resolution

    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("resolution"), F.col("n_nationkey").alias("cell"), F.col("n_name").alias("name"))
    split = per_resolution(n, "resolution", [1, 3])
    return R.stack(list(split.values()))


@query(
    """select count(*) as "rows", count(*) filter (s_name is null or trim(s_name) = '') as text_feature_id, cast(0 as bigint) as legal_status, count(*) filter (s_suppkey % 10 = 0) as model_eligible,
  count(*) filter (s_suppkey % 7 = 0) as date_effective_start, count(*) filter (s_suppkey % 11 = 0) as retained_fraction from supplier"""
)
def validate_native(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("feature_id"),
        *[F.lit("x").alias(c) for c in ("source_id", "record_id", "part_id", "feature_type", "measurement_status")],
        F.lit("partial_roster").alias("coverage_status"),
        F.lit("reference_geometry").alias("legal_status"),
        F.lit(None).cast("string").alias("qc_status"),
        (F.col("s_suppkey") % 10 == 0).alias("model_eligible"),
        F.lit(False).alias("clipped"),
        F.lit("Polygon").alias("geometry_type"),
        F.when(F.col("s_suppkey") % 11 == 0, 1.5).otherwise(0.5).alias("retained_fraction"),
        F.when(F.col("s_suppkey") % 7 == 0, "2020-13-01").alias("effective_start"),
        F.lit(None).cast("string").alias("effective_end"),
        F.lit("2024-01-01T00:00:00Z").alias("learned_at"),
        *[F.lit(0.0).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")],
    )
    found = V.count_violations(s, V.canonical_rules(s))
    return found.select("rows", "text_feature_id", "legal_status", "model_eligible", "date_effective_start", "retained_fraction")


@query(
    """with m as (select c_custkey, case when c_custkey % 4 = 0 then null else c_acctbal end as v, case c_custkey % 5 when 0 then 'unknown' when 1 then 'partial' when 2 then 'strange' else 'observed' end as s from customer)
  select count(*) as "rows", count(*) filter (s = 'strange') as v_state, count(*) filter (s = 'observed' and v is null) as v_observed, count(*) filter (s = 'unknown' and v is not null) as v_missing, count(*) filter (v < 0) as v_range from m"""
)
def metric_validate(spark, sf_dir):
    m = table(spark, sf_dir, "customer").selectExpr(
        "case when c_custkey % 4 = 0 then null else c_acctbal end as v",
        "case c_custkey % 5 when 0 then 'unknown' when 1 then 'partial' when 2 then 'strange' else 'observed' end as s",
    )
    return V.count_violations(m, V.metric_rules("v", "s", "m"))


@query()
def semantic_hash(spark, sf_dir):
    """Digest of a table whatever its order; no SQL (digests of JSON text), tested for order and change."""
    return R.semantic_hash(table(spark, sf_dir, "customer"))
