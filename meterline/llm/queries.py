"""The registered query of each operator: production parameters over the whole table, digests of its outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import configure

from .bpe import encode_decode
from .common import table
from .conversation_trie import prefix_trie
from .exact_dedup import exact_duplicates
from .hard_negatives import hard_negatives
from .language import identify
from .near_text import near_duplicates
from .near_vectors import near_vectors
from .packing import pack
from .pii import BASE, pii_spans
from .quality import score_quality
from .rules import quality_rules
from .sharding import shard_by_bytes
from .toxicity import score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), str(sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op10_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


@query("op6_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_decode(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op9_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op7_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(BASE))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of_kind(kind):
        return lambda x: x["kind"] == kind

    counts = [
        F.size(F.filter("spans", of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in BASE
    ]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


@query("op5_rules")
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op2_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query("op3_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


NEAR_TEXT_SQL = r"""
with words as materialized (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
sets as materialized (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else
         list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words),
sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
pairs as materialized (
  select a.doc_id as a, b.doc_id as b, count(*) as common from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id
  group by 1, 2),
links as materialized (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 75 * (x.n + y.n - common)),
reach as (
  select doc_id as a, doc_id as b from words union select r.a, l.b from reach r join links l on l.a = r.b)
select w.doc_id, coalesce(n, 0) as n_shingles, m.c as component_id, m.c = w.doc_id as kept
from words w left join sizes s on s.doc_id = w.doc_id join (select a, min(b) as c from reach group by a) m on m.a = w.doc_id
""".replace("with words", "with recursive words")


@query("op1_near_text", NEAR_TEXT_SQL)
def near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_near_vectors")
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


EXACT_SQL = """
with rows as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
              from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       coalesce(doc_id = max(doc_id) over same, false) as kept, sha256(norm) as text_sha256
from rows window same as (partition by norm)
"""


@query("op12_exact_dedup", EXACT_SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


NEGATIVES_SQL = """
with v as materialized (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (
  select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_inner_product(a.q, v.q)::bigint as score
  from v a join v on a.vec_id <> v.vec_id and len(a.q) = len(v.q) where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, row_number() over best as rank, vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window best as (partition by anchor_id, positive_id order by score desc, vec_id)
qualify row_number() over best <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


TRIE_SQL = """
with t as materialized (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''),
      sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos
  from conversations where conv_id is not null),
c as materialized (
  select conv_id, conv_id - conv_id % 5 as base, xor(4294967295, list_reduce(
    [4294967295::bigint] || flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ord(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end)) % 9 as h
  from (select distinct conv_id from t)),
r as materialized (
  select c.conv_id, t.role, t.text, 0 as part, t.pos from c join t on t.conv_id = c.base where t.pos < c.h
  union all select c.conv_id, t.role, t.text, 1, t.pos from c join t on t.conv_id = c.conv_id where t.pos >= c.h),
p as materialized (
  select conv_id, text, list((role, text)) over (partition by conv_id order by part, pos) as path,
         count(*) over (partition by conv_id) as size from r
  union all select conv_id, '', [], count(part) from c left join r using (conv_id) group by conv_id),
n as materialized (
  select path, len(path) as depth, min(conv_id) as conv_id, count(*) as n_convs, min(strlen(text)) as bytes,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = len(path)), '')) as ends_sha256
  from p group by path),
k as materialized (select path[:-2] as path, count(*) as n_children from n where depth > 0 group by 1),
m as materialized (
  select n.*, coalesce(n_children, 0) as n_children from n left join k using (path)),
s as (
  select path[1:d] as path, sum((n_children = 0)::bigint)::bigint as n_leaves, sum((n_convs - 1) * bytes)::bigint as saved_tokens
  from (select *, unnest(range(0, depth + 1)) as d from m) group by 1)
select m.conv_id, m.depth, u.conv_id as parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens, m.ends_sha256
from m join s using (path) left join n u on m.depth > 0 and u.path = m.path[:-2]
"""


@query("op11_conversation_trie", TRIE_SQL)
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
