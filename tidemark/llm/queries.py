"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    binary,
    chat,
    decontam,
    jaccard,
    lm,
    packing,
    quality,
    rtree,
    rules,
    secret_scan,
    substrings,
    toxicity,
    trie,
)
from tidemark.llm.frames import table
from tidemark.session import scratch_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("copy")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents")).drop("redacted")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    binary.write_ids(table(spark, sf_dir, "documents"), path)
    return binary.read_ids(spark, path, keep_ids=False).drop("ids")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")), rules.CURRENT)
    base = rules.Policy("base", rules.BASE).mask
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
        "kept",
        "failed",
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumn("n_clauses", F.size("clauses")).drop("clauses")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_classifier,
        op3_secret_scans,
        op4_ngram_jaccard_join,
        op5_benchmark_decontamination,
        op6_token_binary,
        op7_quality_rules,
        op8_lm_scoring,
        op9_substring_dedup,
        op10_chat_formatting,
        op11_prefix_trie,
        op12_toxicity,
        op13_hard_negatives,
    )
}

SQL: dict[str, str] = {
    "op7_quality_rules": r"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
worded as (
  select doc_id, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) as bigint) as n_upper,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from texts),
placed as (
  select doc_id, unnest(range(1, len(w) - 3)) as i,
    unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) as g
  from worded),
grams as (select doc_id, i, count(*) over (partition by doc_id, g) as k from placed),
covered as (
  select doc_id, count(distinct p) as n from (
    select doc_id, unnest(range(i, i + 5)) as p from grams where k > 1) group by doc_id),
counted as (
  select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    n_symbols, n_upper, len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from worded left join covered using (doc_id)),
judged as (
  select *, (n_words < 10)::bigint * 1 + (100 * n_repeat_words > 20 * n_words)::bigint * 2
    + (10 * n_symbols > n_words)::bigint * 4
    + (n_dup_lines > 1 and 10 * n_dup_lines > 3 * n_lines)::bigint * 8 + (word_chars < 2 * n_words)::bigint * 16
    + (word_chars > 15 * n_words)::bigint * 32 + (n_upper > 0.5 * word_chars)::bigint * 64
    + (n_words > 100000)::bigint * 128 as failed
  from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 as base_failed, failed & 127 = 0 as kept, failed
from judged""",
    "op10_chat_formatting": """
with turns as (
  select conv_id, turn, coalesce(nullif(role, ''), 'unknown') as speaker, coalesce(text, '') as t from conversations),
people as (select distinct conv_id, speaker as perspective from turns where speaker <> 'system'),
rotated as (
  select turns.*, perspective, case when speaker = 'system' then 'system' when speaker = perspective then 'assistant'
    else 'user' end as role
  from turns left join people on turns.conv_id is not distinct from people.conv_id),
named as (select *, case when role = 'user' then replace(speaker, '<|', '< |') end as name from rotated),
headed as (select *, '<|' || role || coalesce(' name=' || name, '') || '|>' || chr(10) as header from named),
rendered as (
  select *, header || replace(t, '<|', '< |') || chr(10) || '<|end|>' || chr(10) as content from headed),
placed as (
  select *, cast(sum(length(content)) over (partition by conv_id, perspective order by turn nulls first, speaker, t
    rows between unbounded preceding and current row) as bigint) as stop
  from rendered)
select conv_id, perspective, turn, role, name, content, stop - length(content) as start, stop,
  case when role = 'assistant' then stop - length(content) + length(header) else stop end as learn_start,
  stop as learn_stop
from placed""",
    "op11_prefix_trie": """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as t from conversations
  where conv_id is not null),
digested as (select *, md5(length(role) || ':' || role || t) as digest, length(t) as chars from turns),
numbered as (
  select conv_id, digest, chars,
    row_number() over (partition by conv_id order by turn nulls first, role, digest) as i from digested),
convs as (
  select conv_id as c, conv_id - conv_id % 100 as family,
    4294967295 - list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda a, b: list_reduce(
        list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
        lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))) as crc
  from (select distinct conv_id from turns)),
shares as (select c, family, crc % 6 as h from convs),
heads as (select c, h, i, digest, chars from shares join numbered on numbered.conv_id = family and i <= h),
rebuilt as (
  select c, i as d, digest, chars from heads
  union all
  select shares.c, i - h + coalesce(k, 0), digest, chars
  from shares join numbered on numbered.conv_id = shares.c and i > h
    left join (select c, count(*) as k from heads group by c) as n on n.c = shares.c),
prefixes as (
  select c, d, chars, string_agg(digest, '') over (partition by c order by d) as path from rebuilt
  union all select c, 0, 0, '' from shares),
nodes as (
  select path, any_value(d) as d, any_value(chars) as chars, min(c) as conv_id, count(*) as n from prefixes group by path),
placed as (select *, case when d > 0 then left(path, length(path) - 32) end as above from nodes),
children as (select above as path, count(*) as k from placed where above is not null group by above),
finals as (select c, arg_max(path, d) as path from prefixes group by c),
ended as (select path, string_agg(c::varchar, ',' order by c) as ids from finals group by path),
own as (
  select placed.*, coalesce(k, 0) as k, (k is null)::bigint as leaf,
    case when d > 0 then (n - 1) * chars else 0 end as saved
  from placed left join children using (path)),
subtrees as (
  select p.path, sum(leaf) as leaves, sum(saved) as saved
  from own join prefixes as p on p.c = own.conv_id and p.d <= own.d group by p.path)
select own.conv_id, own.d::bigint as depth, up.conv_id as parent_conv_id, own.n as n_convs, own.k as n_children,
  subtrees.leaves::bigint as n_leaves, subtrees.saved::bigint as saved_tokens,
  sha256(coalesce(ids, '')) as ends_sha256
from own join subtrees using (path) left join nodes as up on up.path = own.above
  left join ended on ended.path = own.path""",
    "op13_hard_negatives": """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
items as (select vec_id, min(row(label, v)) as r from usable group by vec_id),
plain as (select vec_id, r[1] as label, r[2] as v from items),
scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
    coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::bigint as score
  from plain as a join plain as b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
  row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where label <> anchor_label and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5""",
}
