"""The operators over the given tables, and the SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martkit.llm import (
    decontaminate, hyperminhash, jaccard, line_dedup, mixture, periodic_runs, pivot_search, prefix_trie, quality_rules, suffix_dedup, surrogates,
    token_shards, toxicity)
from martkit.llm.base import table

# Words as the operators see them: A-Z lower-cased, runs of letters, digits and anything beyond ASCII.
_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Words without white space.
_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _crc32(value: str) -> str:
    """crc32 of a short text: bit by bit, eight steps a byte."""
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({value}, ''), "
            "lambda c: [cast(ascii(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))), "
            "lambda a, x: xor(xor(a, x) // 2, 3988292384 * (xor(a, x) % 2))))")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@query("op9_quality_rules")
def op9(spark, sf_dir):
    return quality_rules.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_entropy_mixture")
def op4(spark, sf_dir):
    return mixture.mixture(table(spark, sf_dir, "documents"))


@query("op7_suffix_automaton", f"""with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
bw as (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as k from b
  where len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as win from bw),
dw as (select doc_id, w, n, unnest(range(1, cast(len(w) - n + 2 as bigint))) as k
  from d, (select distinct n from windows) where len(w) >= n),
hits as (select doc_id, dw.n, k, item_id from dw join windows on dw.n = windows.n and
  array_to_string(w[k:k + dw.n - 1], ' ') = win),
places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + n)) as p from hits) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, cast(item_id as varchar) as i from hits) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)""")
def op7(spark, sf_dir):
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query("op1_token_shards")
def op1(spark, sf_dir):
    return token_shards.write_and_digest(table(spark, sf_dir, "documents"))


@query("op3_chosen_path_join", f"""with recursive d as (select doc_id, {_WORDS} as w from documents),
p as (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as k from d where len(w) > 0),
s as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') as g from p),
z as (select doc_id, count(*) as n from s group by 1),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from shared join z zx on zx.doc_id = x join z zy on zy.doc_id = y where c >= 0.8 * (zx.n + zy.n - c)),
reach as (select doc_id as x, doc_id as y from d union select r.x, l.y from reach r join links l on r.y = l.x),
deg as (select x, count(*) as n_links from links group by 1)
select r.x as doc_id, min(r.y) as class_id, coalesce(any_value(n_links), 0) as n_links
from reach r left join deg on deg.x = r.x group by r.x""")
def op3(spark, sf_dir):
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


@query("op10_pivot_top5", """with usable as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score,
    row_number() over (partition by q.vec_id order by list_inner_product(q.v, c.v) desc, c.vec_id) as rank
  from usable q join usable c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0) where rank <= 5""")
def op10(spark, sf_dir):
    return pivot_search.nearest(table(spark, sf_dir, "embeddings"))


@query("op8_noisy_or_toxicity")
def op8(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_pii_surrogates")
def op5(spark, sf_dir):
    return surrogates.surrogate_report(table(spark, sf_dir, "documents"))


@query("op6_line_edit_join")
def op6(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"), short=True)


@query("op2_induced_suffix_dedup")
def op2(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), whole=False)


@query("op11_prefix_trie", f"""with own as (select conv_id, {_crc32("cast(conv_id as varchar)")} % 9 as h, turns from (
  select conv_id, list({{'role': role, 'text': text}} order by turn nulls first, sha256(strlen(role) || ':' || role || text)) as turns
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
  group by 1)),
rebuilt as (select o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) as turns
  from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 5),
prefixes as (select conv_id, len(turns) as n, d, turns[1:d] as pre
  from (select *, unnest(range(0, len(turns) + 1)) as d from rebuilt)),
node as (select d, pre, min(conv_id) as conv_id, count(*) as n_convs,
  sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where n = d), '')) as ends_sha256
  from prefixes group by d, pre),
kids as (select d - 1 as d, pre[1:d - 1] as pre, count(*) as n_children from node where d > 0 group by all),
told as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (d, pre)),
sums as (select a as d, pre[1:a] as pre, cast(sum(case when n_children = 0 then 1 else 0 end) as bigint) as n_leaves,
  cast(sum(case when d > 0 then (n_convs - 1) * strlen(pre[d].text) else 0 end) as bigint) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from told) group by all)
select t.conv_id, t.d as depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
from told t join sums using (d, pre) left join node p on p.d = t.d - 1 and p.pre = t.pre[1:t.d - 1]""")
def op11(spark, sf_dir):
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"))


@query("op12_periodic_runs", f"""with d as (select doc_id, {_PLAIN} as w, {_crc32("cast(doc_id as varchar)")} as h from documents),
s as (select *, len(w) as n, h // 10 % greatest(len(w), 1) as a, h // 10 % 8 as k from d),
e as (select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n),
  lambda i: w[1 + case when i >= a then a + (i - a) % (1 + (n - a) // (3 + k)) else i end]) else w end as w from s),
pos as (select doc_id, n, unnest(w) as word, unnest(range(n)) as i from e),
pair as (select x.doc_id, x.i, y.i - x.i as q from pos x join pos y on x.doc_id = y.doc_id and x.word = y.word
  and y.i > x.i and 4 * (y.i - x.i) <= x.n),
stretch as (select doc_id, q, min(i) as s, max(i) + q + 1 as e from (
  select *, i - row_number() over (partition by doc_id, q order by i) as g from pair)
  group by doc_id, q, g having count(*) + q >= greatest(6, 4 * q)),
run as (select doc_id, s, e - s as len, min(q) as q from stretch group by all),
best as (select doc_id, count(*) as n_runs, arg_min({{'s': s, 'len': len, 'q': q}}, {{'l': -len, 's': s, 'q': q}}) as b,
  sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q)) as runs_sha256 from run group by 1),
gone as (select distinct doc_id, unnest(range(s + q, s + len)) as i from run),
kept as (select doc_id, string_agg(word, ' ' order by i) as text from pos anti join gone using (doc_id, i) group by 1)
select e.doc_id, coalesce(n_runs, 0) as n_runs, b.s as start, b.len as length, b.q as period, 1000 * b.len // b.q as exponent_milli,
  coalesce(runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256, n as n_words
from e left join best using (doc_id) left join kept using (doc_id)""")
def op12(spark, sf_dir):
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


@query("op13_hyperminhash", f"""with recursive d as (select doc_id, {_PLAIN.replace("coalesce(text, '')",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
p as (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as k from d where len(w) > 0),
s as (select distinct doc_id, array_to_string(w[k:k + 2], ' ') as g from p),
z as (select doc_id, count(*) as n from s group by 1),
shared as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from shared join z zx on zx.doc_id = x join z zy on zy.doc_id = y where 100 * c >= 85 * (zx.n + zy.n - c)),
reach as (select doc_id as x, doc_id as y from d union select r.x, l.y from reach r join links l on r.y = l.x)
select r.x as doc_id, coalesce(any_value(z.n), 0) as n_shingles, min(r.y) as component_id, r.x = min(r.y) as kept
from reach r left join z on z.doc_id = r.x group by r.x""")
def op13(spark, sf_dir):
    return hyperminhash.near_copies(table(spark, sf_dir, "documents"))
