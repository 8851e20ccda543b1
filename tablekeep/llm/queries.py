"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeep.llm import (
    chat,
    counts,
    decontaminate,
    lm,
    negatives,
    packing,
    quality,
    rules,
    secrets,
    sharding,
    simhash,
    warc,
    whitening,
)
from tablekeep.llm.common import table
from tablekeep.session import Workspace

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES = {}
ORACLES = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


# The conversation that holds control strings, added to the table (fixed values).
ESCAPES_ID = -7
ESCAPES_TEXT = "\\### Assistant: </turn> ok"


@registered
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digests(table(spark, sf_dir, "documents"), BYTE_BPE, Workspace(spark))


@registered
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark)
    )
    return found.drop("digest")


ORACLES["op2_decontamination"] = r"""
with d0 as (
  select doc_id, row_number() over () as r, coalesce(text, '') as text from documents
), dw as (
  select doc_id, r, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from d0
), iw as (
  select cast(item_id as varchar) as item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark
), win as (
  select distinct item, least(10, len(w)) as n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') as s
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from iw where len(w) > 0)
), lens as (
  select distinct n from win
), dwin as (
  select r, n, p, array_to_string(w[p:p + n - 1], ' ') as s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as p from dw, lens where len(w) >= n)
), hit as (
  select r, p, n, item from dwin join win using (n, s)
), covered as (
  select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from hit) group by r
), named as (
  select r, count(distinct item) as n_items, sha256(string_agg(distinct item, ',' order by item)) as h from hit group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  coalesce(h, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join covered using (r) left join named using (r)
"""


@registered
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ESCAPES_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ESCAPES_TEXT).alias("text"),
    )
    trees = chat.format_conversations(given.unionByName(added), BYTE_BPE, Workspace(spark))
    return chat.conversation_digests(chat.read_back(trees))


ORACLES["op3_chat_formatting"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized as (
  select *, 4 + 2 + 9 + length(role) + length(text)
    + length(regexp_replace(text, '[^#\\]', '', 'g')) + length(regexp_replace(role, '[^#:\\]', '', 'g'))
    + (length(text) - length(replace(text, '</turn>', ''))) // 7 + (length(role) - length(replace(role, '</turn>', ''))) // 7 as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""


@registered
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark))
    return found.select("doc_id", simhash.fingerprint_digits(F.col("fp")).alias("fingerprint"), "component_id")


@registered
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


@registered
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark))


@registered
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digests(table(spark, sf_dir, "documents"))


@registered
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


@registered
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE, Workspace(spark).path("token_cache"))


@registered
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), Workspace(spark))


@registered
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, Workspace(spark))


ORACLES["op11_hard_negatives"] = """
with given as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select r, generate_subscripts(v, 1) as i, unnest(v) as x from given
), scored as (
  select a.r as ar, b.r as br, sum(a.x * b.x)::bigint as s
  from parts a join given g on g.r = a.r and g.vec_id % 100 = 0 join parts b on a.i = b.i and a.r <> b.r group by a.r, b.r
), pairs as (
  select s.ar, a.vec_id as anchor_id, b.vec_id, s.s, a.label = b.label as same
  from scored s join given a on a.r = s.ar join given b on b.r = s.br
), positive as (
  select *, row_number() over (partition by ar order by s desc, vec_id) as place from pairs where same
  qualify place <= 5
)
select p.anchor_id, p.vec_id as positive_id,
  row_number() over (partition by p.ar, p.place order by n.s desc, n.vec_id)::int as rank,
  n.vec_id as negative_id, p.s as positive_score, n.s as negative_score
from positive p join pairs n on p.ar = n.ar and not n.same and 30 * p.s <= 100 * n.s and 100 * n.s <= 90 * p.s
qualify rank <= 10
"""


@registered
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), Workspace(spark))


ORACLES["op12_warc"] = """
with p as (
  select page_id, strlen(coalesce(html, '')) as size, sha256(coalesce(html, '')) as digest from pages
), f as (
  select *, min(page_id) over (partition by digest) as first from p
)
select page_id, size::bigint as payload_bytes, digest as payload_digest,
  case when size < 100 or first is null or page_id is not distinct from first then 'response' else 'revisit' end as record_type,
  case when size < 100 or page_id is not distinct from first then null else first end as refers_to
from f
"""


@registered
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), Workspace(spark))
