"""The registered queries of this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridstone.llm.common import read
from gridstone.llm.decontaminate import find_items
from gridstone.llm.hard_negatives import mine
from gridstone.llm.language import held_out, identify, learn
from gridstone.llm.lm_scoring import fit, score, sliced
from gridstone.llm.minhash_dedup import near_duplicates
from gridstone.llm.mixing import mix_sources
from gridstone.llm.neighbours import nearest
from gridstone.llm.pseudonyms import replace_personal
from gridstone.llm.quality_rules import cascade
from gridstone.llm.spelling import variants
from gridstone.llm.suffix_dedup import remove_earlier
from gridstone.llm.url_filter import Rule, judge
from gridstone.llm.window_dedup import remove_repeated

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target, all others the background."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg((F.max("quality") == 1).alias("__good"))
    with sliced(docs.join(labels, "doc_id", "left").select("doc_id", "text", "__good")) as docs:
        return score(docs, fit(docs, F.col("__good"), once=False), fitted=F.col("__good"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier(read(spark, sf_dir, "documents"), keep=False)


HOST_RULES = (
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"), Rule("block", "com/de/"),
)
PATTERN_RULES = (
    Rule("block", "*//spam-farm.*"), Rule("block", "*.spam-farm.*"), Rule("block", "*//cheap-pills.*"), Rule("block", "*.cheap-pills.*"),
    Rule("block", "*/casino/*"), Rule("block", "*/login?*"), Rule("block", "*&affiliate=*"), Rule("allow", "*//blog.*/en/*"),
)


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"), HOST_RULES + PATTERN_RULES)


SQL["op3_url_filter"] = r"""
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages
), parts as (
  select page_id, rest,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(rest, '(?s)^[^/?#]*(.*)$', 1), '') as tail
  from cut
), ruled as (
  select *, '//' || host || tail as subject, '.' || host as dotted,
    case when ends_with('.' || host, '.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
         when ends_with('.' || host, '.example.org') and starts_with(path, '/es/') then 'example.org/es/'
         when ends_with('.' || host, '.com') and starts_with(path, '/fr/') then 'com/fr/'
         when ends_with('.' || host, '.com') and starts_with(path, '/de/') then 'com/de/'
         when ends_with('.' || host, '.org') and starts_with(path, '/') then 'org/' end as rule
  from parts
), patterned as (
  select *, case when rest is null then null
      when contains(subject, '//cheap-pills.') then '*//cheap-pills.*'
      when contains(subject, '//spam-farm.') then '*//spam-farm.*'
      when contains(subject, '.cheap-pills.') then '*.cheap-pills.*'
      when contains(subject, '.spam-farm.') then '*.spam-farm.*'
      when regexp_matches(subject, '(?s)//blog\..*/en/') then '*//blog.*/en/*'
      when contains(subject, '&affiliate=') then '*&affiliate=*'
      when contains(subject, '/casino/') then '*/casino/*'
      when contains(subject, '/login?') then '*/login?*' end as pattern
  from ruled
)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
       when pattern is null or pattern = '*//blog.*/en/*' then 'allow' else 'block' end as verdict,
  case when rule is null then pattern end as matched
from patterned"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).drop("turn")


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(read(spark, sf_dir, "documents"), keep=False)


KEY = "a key that the owner of the data chooses and keeps"


@query
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal(read(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


@query
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


SHINGLED = r"""
with recursive tokens as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
)"""

SQL["op8_minhash_dedup"] = SHINGLED + r"""
, sets as (
  select doc_id, list_distinct(case when len(w) between 1 and 2 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
  from tokens
), sized as (select doc_id, len(s) as n, s from sets),
items as (select doc_id, n, unnest(s) as x from sized),
links as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.x = b.x and a.doc_id < b.doc_id
    and least(a.n, b.n) * 100 >= 85 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges as (select a, b from links union all select b, a from links),
reach as (select doc_id as node, doc_id as root from sized union select e.b, r.root from reach r join edges e on e.a = r.node)
select s.doc_id, s.n as n_shingles, min(r.root) as component_id, min(r.root) = s.doc_id as kept,
  (select min(c.doc_id) from sized c where c.n = s.n and (c.doc_id = s.doc_id or s.n > 0 and list_sort(c.s) = list_sort(s.s))) as class_id
from sized s join reach r on r.node = s.doc_id group by s.doc_id, s.n, s.s"""


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", F.explode("items").alias("i")).select(
        "doc_id", F.col("i.item").alias("item_id"), F.col("i.size").alias("n_shingles"), F.col("i.shared").alias("n_shared"))


SQL["op9_decontamination"] = SHINGLED + r"""
, items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from benchmark
), pieces as (
  select distinct doc_id, unnest(case when len(w) between 1 and 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as x from tokens
), wanted as (
  select distinct item_id, unnest(case when len(w) between 1 and 4 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as x from items
), sizes as (select item_id, count(*) as n from wanted group by item_id)
select doc_id, item_id, n as n_shingles, count(*) as n_shared
from pieces join wanted using (x) join sizes using (item_id) group by doc_id, item_id, n having 100 * count(*) >= 80 * n"""


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    said = identify(docs, learn(docs), ["doc_id"])
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label in seven is made wrong, as the contract has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


SQL["op11_hard_negatives"] = r"""
with items as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where label is not null and embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), parts as (select r, vec_id, label, unnest(v) as x, unnest(range(len(v))) as i from items
), scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id as id, b.label as label, cast(sum(a.x * b.x) as bigint) as score
  from parts a join parts b on a.i = b.i and a.vec_id <> b.vec_id where a.vec_id % 100 = 0 group by a.r, a.vec_id, a.label, b.r, b.vec_id, b.label
), positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as integer) as rank,
  id as negative_id, positive_score, score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
where 80 * positive_score <= 100 * score and score <= positive_score
qualify row_number() over (partition by p.anchor_id, positive_id order by score desc, id) <= 5"""


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(read(spark, sf_dir, "documents"))


SQL["op12_quality_rules"] = r"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), split as (
  select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from texts
), spots as (
  select r, unnest(range(1, len(w) - 3)) as i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as x from split
), again as (
  select r, count(distinct j) as n from (
    select r, unnest(range(i, i + 5)) as j from (select r, i, count(*) over (partition by r, x) as times from spots) where times > 1) group by r
), words as (
  select r, max(n) as top from (select r, x, count(*) as n from (select r, unnest(w) as x from split) group by r, x) group by r
), pairs as (
  select r, max(n) as top from (
    select r, x, count(*) as n from (select r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as x from split) group by r, x) group by r
), counted as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(again.n, 0) as n_repeat_words,
    len(l) as n_lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) as n_letter_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper, length(regexp_replace(text, '[^a-z]', '', 'g')) as n_lower,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as n_stutters, coalesce(words.top, 0) as top_word, coalesce(pairs.top, 0) as top_pair
  from split left join again using (r) left join words using (r) left join pairs using (r)
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and word_chars between 2 * n_words and 15 * n_words and 10 * n_symbols <= n_words and 100 * n_dup_lines <= 50 * n_lines
    and 100 * n_letter_words >= 70 * n_words and 100 * n_stutters <= 30 * n_words and 100 * n_upper <= 50 * (n_upper + n_lower) and 100 * top_word <= 30 * n_words and 100 * top_pair <= 20 * n_words as kept
from judged"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run in 199 loses a letter first, as the contract has it."""
    return variants(read(spark, sf_dir, "documents"), slip=199)


SQL["op13_spelling_variants"] = r"""
with recursive steps as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), runs as (
  select coalesce(cast(doc_id as varchar), '') as key, x, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as x from documents)
  where length(x) >= 6 group by doc_id, x
), bytes as (
  select x, n, [4294967295] || flatten(list_transform(string_split(key || ':' || x, ''),
    lambda c: case when unicode(c) < 128 then [unicode(c)] else [195, unicode(c) - 64] end)) as b from runs
), summed as (
  select x, n, xor(list_reduce(list_transform(b, lambda y: cast(y as bigint)), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) as h from bytes, steps
), slipped as (
  select case when h % 199 = 0 then substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) else x end as word, n from summed
), words as (
  select word, cast(sum(n) as bigint) as n from slipped where length(word) >= 6 group by word having sum(n) >= 5
), places as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word, b.word as other, b.n as other_n from places a join places b on a.i = b.i and a.rest = b.rest and a.word <> b.word and length(a.word) = length(b.word)
  union select p.word, w.word, w.n from places p join words w on w.word = p.rest
  union select w.word, p.word, p.n from places p join words w on w.word = p.rest
), best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from near group by word
), judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 5 * w.n then other end as form, case when other_n >= 5 * w.n then other_n end as form_n
  from words w left join best using (word)
), chain as (
  select word, coalesce(form, word) as root from judged
  union select c.word, j.form from chain c join judged j on j.word = c.root where j.form is not null
)
select word, form, (select c.root from chain c join judged k on k.word = c.root where c.word = j.word and k.form is null) as root, n, n_near, form_n from judged j"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
