"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, embedding_dedup, language, licenses, media, mixing, near_dedup, packing, substring_dedup, url_filter
from .tables import load


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(load(spark, sf_dir, "documents"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.describe_media(media.store_texts(load(spark, sf_dir, "documents")))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(load(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge_pages(load(spark, sf_dir, "pages"), rules)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", F.col("source"), "before")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(load(spark, sf_dir, "documents"))


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_media_columns, op3_minhash_near_dedup, op4_url_filter, op5_mixing, op6_embedding_near_dedup, op7_packing, op8_license_scan, op9_suffix_array_dedup, op10_attention_lm)}

_URL = r"""
with u as (
  select page_id, url,
    case when contains(url, '://') then translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when contains(url, '://') then regexp_extract(url, '://[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
r(h, p, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
j as (
  select u.*, h || p as rule, v, row_number() over (partition by page_id, url order by length(h || p) desc) as k
  from u left join r on (u.host = r.h or u.host like '%.' || r.h) and starts_with(u.path, r.p))
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule, coalesce(v, 'allow') as verdict from j where k = 1
"""

_MIX = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '')) as k
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select source, source_size, ([3, 1, 2])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as w,
    row_number() over (order by source nulls last) as place, sum(source_size) over () as all_sizes from s),
l as (
  select *, source_size * 2 / w as ratio from w),
m as (
  select *, (all_sizes * 1.5::double - coalesce(sum(source_size) over (order by ratio, place rows between unbounded preceding and 1 preceding), 0) * 2)
    / sum(w) over (order by ratio, place rows between current row and unbounded following) as level from l),
f as (select *, ratio <= level as stops from m),
t as (
  select source, source_size, case when stops then (source_size * 2)::double
    else (select arg_min(level, (ratio, place)) from f where not stops) * w end as target from f),
p as (
  select d.doc_id, d.size, t.source_size, t.target, d.source, k,
    coalesce(sum(size) over (partition by d.source order by k, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join t on d.source is not distinct from t.source),
x as (
  select p.*, g.epoch, h.start, least(256, p.size - h.start) as words
  from p, (select unnest([0, 1]) as epoch) g, lateral (select unnest(range(0, p.size, 256)) as start) h),
o as (
  select *, (epoch * source_size + before + start + words) / target as finish from x),
c as (
  select *, sum(words) over (order by finish, k, doc_id, size, epoch, start rows unbounded preceding) - words as ahead from o),
b as (select floor(sum(target) + 0.25) as budget from t),
s1 as (
  select source, before, sum(greatest(0, least(words, budget - ahead)))::bigint as taken from c, b group by source, before)
select doc_id, size, source_size, target, case when size = 0 then 0 else taken end as taken, p.source, p.before
from p left join s1 on size > 0 and p.before = s1.before and p.source is not distinct from s1.source
"""

_NEAR = r"""
with recursive w as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) as ws from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then []::varchar[] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as i from s a join s b using (g) where a.doc_id <> b.doc_id group by all),
l as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * i >= 85 * (a.n + b.n - i)),
r(a, b) as (select doc_id, doc_id from documents union select r.a, l.y from r join l on r.b = l.x),
c as (select a, min(b) as component_id from r group by a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join c on c.a = d.doc_id left join n on n.doc_id = d.doc_id
"""

_VECTORS = r"""
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings),
g as (
  select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from v
  where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
u as (select vec_id, list_transform(e, lambda x: x / norm) as e from g where norm > 0),
l as (select a.vec_id as x, b.vec_id as y from u a join u b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) >= 0.95),
r(a, b) as (select vec_id, vec_id from v union select r.a, l.y from r join l on r.b = l.x),
c as (select a, min(b) as component_id from r group by a),
k as (select x, count(*) as n from l group by x)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from v join c on a = vec_id left join k on x = vec_id
"""

_REPEATS = r"""
with d as (select doc_id, encode(coalesce(text, '')) as b from documents),
w as (select doc_id, b, octet_length(b) as n, unnest(range(1, octet_length(b) - 98)) as s from d where octet_length(b) >= 100),
h as (select doc_id, s, row_number() over (partition by b[s:s + 99] order by doc_id, s) as k from w),
late as (select doc_id, s, s - row_number() over (partition by doc_id order by s) as one_run from h where k > 1),
runs as (select doc_id, min(s) as s, max(s) + 100 as e from late group by doc_id, one_run),
j as (select *, case when s <= max(e) over (partition by doc_id order by s rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from runs),
k as (select *, sum(fresh) over (partition by doc_id order by s) as span from j),
m as (select doc_id, span, min(s) as s, max(e) as e from k group by doc_id, span),
g as (select doc_id, count(*) as n_spans, sum(e - s)::bigint as n_removed, list(s order by s) as ss, list(e order by s) as es from m group by doc_id)
select d.doc_id, octet_length(b)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  case when ss is null then sha256(b) else sha256(unhex(array_to_string(list_transform(range(1, len(ss) + 2),
    lambda i: hex(b[(case when i = 1 then 1 else es[i - 1] end):(case when i > len(ss) then octet_length(b) else ss[i] - 1 end)])), ''))) end as kept_sha256
from d left join g on g.doc_id = d.doc_id
"""

SQL = {"op3_minhash_near_dedup": _NEAR, "op6_embedding_near_dedup": _VECTORS, "op4_url_filter": _URL, "op5_mixing": _MIX, "op9_suffix_array_dedup": _REPEATS}
