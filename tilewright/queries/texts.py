"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..sources import readers
from .base import query, table


@query(
    """select doc_id, nullif(trim(source), '') as cleaned, case when lower(trim(lang)) not in ('', 'unknown', 'unavailable', 'en') then trim(lang) end as language, upper(lang) as upper_lang, replace(source, 'src', 'Source ') as label from documents"""
)
def clean_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        S.clean("source").alias("cleaned"),
        S.placeholder_null("lang", ("", "unknown", "unavailable", "en")).alias("language"),
        F.upper("lang").alias("upper_lang"),
        F.replace("source", F.lit("src"), F.lit("Source ")).alias("label"),
    )


@query("select p_partkey, trim(regexp_replace(lower(p_type || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') as slug from part")
def slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.slug(F.concat_ws(" ", "p_type", "p_brand")).alias("slug"))


@query(
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, strftime(o_orderdate, '%Y-%m-%d') as epoch, case when o_orderkey % 3 = 2 then null else strftime(o_orderdate, '%Y-%m-%d') end as effective from orders"""
)
def date_parse(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.expr("case o_orderkey % 3 when 0 then date_format(o_orderdate, 'MM/dd/yyyy') when 1 then date_format(o_orderdate, 'yyyyMMdd') else date_format(o_orderdate, 'dd.MM.yyyy') end")
    return o.select(
        "o_orderkey",
        S.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("iso"),
        S.epoch_ms_date(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("epoch"),
        S.effective_date(text).alias("effective"),
    )


@query("select p_partkey, try_cast(case when p_partkey % 2 = 0 then cast(p_size as varchar) || '.5' else p_name end as double) as number from part")
def try_number(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.number(F.expr("case when p_partkey % 2 = 0 then p_size || '.5' else p_name end")).alias("number"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then cast(year(o_orderdate) as integer) end as established from orders")
def year_extract(spark, sf_dir):
    text = F.expr("case when o_orderkey % 2 = 0 then concat('since ', year(o_orderdate), ' or 17', o_orderkey) else '21000' end")
    return table(spark, sf_dir, "orders").select("o_orderkey", S.year(text).alias("established"))


@query("select p_partkey, case when p_partkey % 3 <> 0 then cast(p_partkey * 1000 as bigint) end as scale from part")
def scale_parse(spark, sf_dir):
    text = F.expr("case when p_partkey % 3 <> 0 then concat('1:', p_partkey, ',000') else 'no scale' end")
    return table(spark, sf_dir, "part").select("p_partkey", S.scale_denominator(text).alias("scale"))


@query("select c_custkey, case when c_custkey % 2 = 0 then c_custkey end as whole from customer")
def strict_int(spark, sf_dir):
    text = F.expr("case when c_custkey % 2 = 0 then cast(c_custkey as string) else concat(c_custkey, '.5') end")
    return table(spark, sf_dir, "customer").select("c_custkey", S.strict_int(text).alias("whole"))


@query(
    """select doc_id, true as digest, regexp_matches(lpad(cast(doc_id % 200000 as varchar), 5, '0'), '^[0-9]{5}$') as geoid, false as revision, regexp_matches(source, '^[0-9a-f]{64}$') as source_digest from documents"""
)
def regex_valid(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        S.is_digest(S.sha256("text")).alias("digest"),
        S.is_geoid(F.lpad((F.col("doc_id") % 200000).cast("string"), 5, "0")).alias("geoid"),
        S.is_revision("source").alias("revision"),
        S.is_digest("source").alias("source_digest"),
    )


@query("select n_nationkey, '{\"a\":\"' || n_name || '\",\"b\":\"' || n_nationkey || '\"}' as attribute from nation")
def json_attr(spark, sf_dir):
    m = F.create_map(F.lit("b"), F.col("n_nationkey").cast("string"), F.lit("a"), F.col("n_name"))
    return table(spark, sf_dir, "nation").select("n_nationkey", S.json_attribute(m).alias("attribute"))


@query("""select event_id, key, json_extract_string(props, '$.' || key) as value from (select event_id, props, unnest(json_keys(props)) as key from events)""")
def json_explode(spark, sf_dir):
    """Every entry of every object as a row."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))


@query("select n_nationkey, 'name=' || n_name || '|region=' || n_regionkey as kept from nation")
def map_ops(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    m = F.map_concat(F.create_map(F.lit("name"), F.col("n_name")), F.create_map(F.lit("region"), F.col("n_regionkey").cast("string"), F.lit("drop"), F.lit("x")))
    kept = F.map_filter(m, lambda k, v: k != "drop")
    return n.select("n_nationkey", F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("kept"))


@query("select doc_id, sha256(text) as digest from documents")
def sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.sha256("text").alias("digest"))


@query("select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, cast(len(regexp_extract_all(html, '<a [^>]*href')) as bigint) as links from pages")
def html_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<a [^>]*href")).cast("bigint").alias("links"))


@query(
    """select 'region-' || r_regionkey as file, 'r' || r_regionkey as section, r_name as title, cast(row_number() over (partition by r_regionkey order by n_nationkey) - 1 as integer) as "row",
  cast(n_nationkey as varchar) || '|' || n_name as cells from nation join region on r_regionkey = n_regionkey"""
)
def html_table_extract(spark, sf_dir):
    """The rows of tables in HTML made from the nations, a document for each region."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    per = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("rows"))  # 25 rows at every scale
    row = lambda x: F.concat(F.lit("<tr><td> "), x["n_nationkey"].cast("string"), F.lit("</td><th>"), x["n_name"], F.lit("</th></tr>"))
    html = F.concat(F.lit("<h2 id='r"), F.col("r_regionkey").cast("string"), F.lit("'>"), "r_name", F.lit("</h2><table>"), F.array_join(F.transform("rows", row), "\n"), F.lit("</table>"))
    files = per.join(r, F.col("r_regionkey") == F.col("n_regionkey")).select(F.concat(F.lit("region-"), F.col("r_regionkey").cast("string")).alias("path"), html.cast("binary").alias("content"))
    return readers.tables_of(files).withColumn("cells", F.array_join("cells", "|"))
