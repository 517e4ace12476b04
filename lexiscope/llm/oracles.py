"""DuckDB SQL of the registered queries that SQL can express."""

#: The posterior's mass below the limit is summed by a power series here.
OP13 = r"""
with u as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
r as (
  select *,
    case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
         when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
         when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
         when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from u),
o as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 when quality is not null or toxic is not null then 0 end) as bad
  from labels where doc_id is not null group by doc_id),
h as (
  select host, count(*) as pages, count(bad) as n, coalesce(sum(bad), 0) as bad,
         string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '(:\d*)?\.?$', ''), '.') as l
  from u left join o on page_id = doc_id group by host),
g as (
  select host, pages, n, bad, l[-1] as suffix, array_to_string(l[-2:], '.') as domain from h),
d as (select domain, min(suffix) as suffix, sum(n) as n, sum(bad) as bad from g group by domain),
s as (select suffix, sum(n) as n, sum(bad) as bad from d group by suffix),
s1 as (select *, (select (sum(bad) + 1) / (sum(n) + 2) from s) as mu from s),
ms as (select case when sum(n) > count(*) and sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) > count(*)
         then least(1000.0, greatest(1.0, (sum(n) - count(*)) / (sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) - count(*)) - 1))
         else 1000.0 end as m from s1 where n > 0),
d1 as (select d.*, (m * mu + s1.bad) / (m + s1.n) as mu from d join s1 using (suffix), ms),
md as (select case when sum(n) > count(*) and sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) > count(*)
         then least(1000.0, greatest(1.0, (sum(n) - count(*)) / (sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) - count(*)) - 1))
         else 1000.0 end as m from d1 where n > 0),
h1 as (select g.*, (m * mu + d1.bad) / (m + d1.n) as mu from g join d1 using (domain), md),
mh as (select case when sum(n) > count(*) and sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) > count(*)
         then least(1000.0, greatest(1.0, (sum(n) - count(*)) / (sum(n * pow(bad / n - mu, 2) / (mu * (1 - mu))) - count(*)) - 1))
         else 1000.0 end as m from h1 where n > 0),
post as (select host, n, m * mu + bad as a, m * (1 - mu) + n - bad as b from h1, mh),
tail as (
  select host, any_value(n) as n,
         sum(exp(a * ln(0.5) + b * ln(0.5) - ln(a) + lgamma(a + b + k) - lgamma(a) - lgamma(b)
                 - lgamma(a + 1 + k) + lgamma(a + 1) + k * ln(0.5))) as below
  from post, generate_series(0, 5000) t(k) group by host)
select r.page_id, r.host, r.path, r.rule,
       case when r.rule in ('example.net/en/', 'org/fr/') then 'allow' when r.rule is not null then 'block'
            when 1 - below >= 0.95 then 'block' else 'allow' end as verdict,
       tail.n as n_labelled
from r join tail using (host)
"""

OP11 = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select a.vec_id as anchor_id, a.label = e.label as same, e.vec_id, list_dot_product(a.q, e.q)::bigint as score
  from e as a join e on a.vec_id % 100 = 0 and a.vec_id <> e.vec_id),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::integer as rank
  from p join s using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
