"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, arrow_files, bpe, chat, hard_negatives, minhash, packing, prefix_trie, quality, sharding, token_counts, toxicity, urls
from .common import table
from .tokens import tokenizer_path


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85, bands=32, rows=6)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.url_filter(table(spark, sf_dir, "pages"), urls.DEFAULT_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16, seed=0)
    return placed.select(
        "doc_id",
        sharding.record_size("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.learn(docs, labels, train=~held_out(F.col("doc_id")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024, end_id=2, keep_ids=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), full=False)
    return coded.withColumnRenamed("id", "doc_id")


def op10_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_rules(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings"), scale=256.0)
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    found = hard_negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=5, percent=80)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.with_family_heads(numbered, family=20, heads=4))


def op13_arrow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_files.read(arrow_files.write(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), length=1024, end_id=2))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_token_counts": op2_token_counts,
    "op3_url_filter": op3_url_filter,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_external_shuffle": op5_external_shuffle,
    "op6_toxicity": op6_toxicity,
    "op7_best_fit": op7_best_fit,
    "op8_block_join": op8_block_join,
    "op9_bpe": op9_bpe,
    "op10_line_rules": op10_line_rules,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_arrow_files": op13_arrow_files,
}

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE_SQL: dict[str, str] = {
    "op1_minhash": rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORDS}) as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) end) as s from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
sym as (select a, b from l union select b, a from l),
reach as (select doc_id as a, doc_id as b from documents union select reach.a, sym.b from reach join sym on sym.a = reach.b),
c as (select a as doc_id, min(b) as component_id from reach group by 1)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join c on c.doc_id = d.doc_id left join n on n.doc_id = d.doc_id""",
    "op3_url_filter": r"""
with r as (select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) as v(h, p, verdict)),
u as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
q as (select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from u),
h as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from q),
f as (select page_id, h || p as rule, verdict, row_number() over (partition by page_id order by length(h) + length(p) desc, length(h) desc) as k
  from h join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select h.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from h left join f on f.page_id = h.page_id and k = 1""",
    "op4_chat_rotation": r"""
with t as (select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as text,
  row_number() over (partition by conv_id, turn, role, text) - 1 as copy from conversations),
s as (select distinct conv_id as c, speaker as perspective from t),
g as (select conv_id, perspective, turn, copy, speaker, speaker = perspective as own,
  case when speaker = perspective then '<|assistant|>' || chr(10) else '<|user name=' || speaker || '|>' || chr(10) end as head, text from t join s on c is not distinct from conv_id),
x as (select *, head || text || '<|end|>' || chr(10) as segment from g),
y as (select *, cast(coalesce(sum(length(segment)) over (partition by conv_id, perspective order by turn nulls first, speaker, segment, copy rows between unbounded preceding and 1 preceding), 0) as bigint) as start from x)
select conv_id, perspective, turn, copy, speaker, segment, start, case when own then start + length(head) end as mask_start,
  case when own then start + length(segment) - 1 end as mask_end from y""",
    "op8_block_join": r"""
with v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings where embedding is not null),
g as (select * from v where len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda a, b: a + b) as score
  from g q join g c on c.vec_id <> q.vec_id and len(c.v) = len(q.v) where q.vec_id % 20 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20""",
    "op10_line_rules": rf"""
with d as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents),
w as (select doc_id, host, t, regexp_extract_all(t, {_WORDS}) as w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORDS})) as l from d),
g as (select doc_id, i, array_to_string(w[i:i+4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w)),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as k from g) where k > 1),
cover as (select doc_id, count(*) as n_repeat_words from (select distinct doc_id, unnest(range(i, i + 5)) from again) group by 1),
ln as (select doc_id, host, t, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g')) as line, len(regexp_extract_all(x, {_WORDS})) as n
  from (select doc_id, host, t, unnest(l) as x from w)),
hosts as (select host, count(distinct t) as docs from ln group by 1),
first_ as (select host, line, lw from (select host, line, count(distinct t) as k, max(n) as lw from ln group by 1, 2) join hosts using (host)
  where k > 20 and (k > 0.01 * docs or k > 200 and lw >= 4)),
inside as (select doc_id, host, line, lw, sum(n) as n from ln join first_ using (host, line) group by 1, 2, 3, 4),
gone as (select doc_id, sum(n) as gone, max({{'w': lw, 'h': substr(md5(line), 1, 15)}})['h'] as longest from inside group by 1),
holder as (select w.doc_id, case when len(w) - gone < 0.3 * len(w) then 'copies ' || longest else 'text ' || t end as holder from gone join w on w.doc_id = gone.doc_id),
over_ as (select host, line from (select host, line, lw, count(distinct holder) as k from inside join holder using (doc_id) group by 1, 2, 3) join hosts using (host)
  where k > 20 and (k > 0.01 * docs or k > 200 and lw >= 4)),
lost as (select doc_id, cast(sum(n) as bigint) as removed_words from inside join over_ using (host, line) group by 1),
m as (select w.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
  len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(removed_words, 0) as removed_words
  from w left join cover on cover.doc_id = w.doc_id left join lost on lost.doc_id = w.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - removed_words >= 10 and n_words - removed_words >= 0.3 * n_words as kept, removed_words from m""",
    "op11_hard_negatives": r"""
with g as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as x from embeddings where vec_id is not null and label is not null and embedding is not null),
v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(x, lambda y: floor(256 * y)) as v from g
  where len(list_filter(x, lambda y: y is null or isnan(y) or isinf(y))) = 0),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as s
  from v a join v b on b.vec_id <> a.vec_id and len(a.v) = len(b.v) where a.vec_id % 100 = 0),
p as (select a, b, s from s where same qualify row_number() over (partition by a order by s desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id, cast(row_number() over (partition by p.a, p.b order by n.s desc, n.b) as integer) as rank, n.b as negative_id,
  p.s as positive_score, n.s as negative_score
from p join s n on n.a = p.a and not n.same and 80 * p.s <= 100 * n.s and n.s <= p.s qualify rank <= 5""",
    "op12_prefix_trie": rf"""
with t as (select conv_id as c, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
o as (select c, list({{'r': r, 'x': x}} order by turn nulls first, r, sha256(concat(length(r), ':', r, x))) as l from t group by 1),
crc as (select c, (4294967295 - list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda s: ascii(s)::bigint)), lambda a, b:
  list_reduce(list_prepend(xor(a, b), range(8)), lambda y, i: case when y % 2 = 1 then xor(y // 2, 3988292384) else y // 2 end))) % 4 as h from o),
v as (select o.c, list_concat(coalesce(b.l, [])[1:h], o.l[h + 1:]) as l from o join crc on crc.c = o.c left join o b on b.c = o.c - o.c % 20),
p as (select c, l, unnest(range(0, len(l) + 1)) as d from v),
n as (select d, l[1:d] as path, min(c) as rep, count(*) as n, string_agg(c::varchar, ',' order by c) filter (where len(l) = d) as ends from p group by 1, 2),
m as (select *, (n - 1) * case when d = 0 then 0 else len(regexp_extract_all(path[d]['x'], {_WORDS})) end as saved,
  not exists (select 1 from n k where k.d = n.d + 1 and k.path[1:n.d] = n.path) as leaf from n),
up as (select d, path, saved, leaf, unnest(range(0, d + 1)) as e from m),
sums as (select e, path[1:e] as path, sum(saved) as saved, count(*) filter (where leaf) as leaves, count(*) filter (where d = e + 1) as children from up group by 1, 2)
select m.rep as conv_id, m.d as depth, q.rep as parent_conv_id, m.n as n_convs, s.children as n_children, s.leaves as n_leaves, s.saved::bigint as saved_tokens,
  sha256(coalesce(m.ends, '')) as ends_sha256
from m join sums s on s.e = m.d and s.path = m.path left join n q on q.d = m.d - 1 and q.path = m.path[1:m.d - 1]""",
}
