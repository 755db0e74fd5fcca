"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from laptrace.llm import (
    balance, bilinear, bpe, covertree, interactions, language, licences, merkle, near, pigeonhole, quality, repeats,
    wavelet,
)
from laptrace.llm.registry import QUERIES, SQL, query
from laptrace.llm.tables import table
from laptrace.session import fresh_path

__all__ = ["QUERIES", "SQL"]

#: The tokenizer of the queries; the operators take any path.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query("op2_exact_top_k", sql="""
with points as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as point from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.point, c.point) as bigint) as score
    from points q join points c on q.vec_id <> c.vec_id and len(q.point) = len(c.point)
    where q.vec_id % 20 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
    from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
""")
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op4_mix_sources")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = balance.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


@query("op6_bpe_encode_decode")
def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE,
                      outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op10_wavelet_shards")
def op10_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "wavelet")
    wavelet.write(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=2)
    return wavelet.documents(spark, path)


@query("op9_setsketch_near_dedup", sql="""
with recursive words as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') as w
    from documents where text is not null
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) = 1 then [w]
                                 else list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) end) as s
    from words
), shingles as (
    select doc_id, len(s) as n, md5(unnest(s)::varchar) as h from sets
), classes as (
    select doc_id, n, min(doc_id) over (partition by n, digest) as rep
    from (select doc_id, n, md5(string_agg(h, '' order by h)) as digest from shingles group by doc_id, n)
), reps as (
    select s.doc_id, s.n, s.h from shingles s join classes c on s.doc_id = c.doc_id and c.doc_id = c.rep
), common as (
    select x.doc_id as a, y.doc_id as b, x.n as na, y.n as nb, count(*) as shared
    from reps x join reps y on x.h = y.h and x.doc_id < y.doc_id
      and 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
    group by all
), links as (
    select a, b from common where 100 * shared >= 80 * (na + nb - shared)
    union all select doc_id, rep from classes where doc_id <> rep
), sides as (
    select a, b from links union all select b, a from links
), reach(node, seen) as (
    select a, b from sides
    union select r.node, s.b from reach r join sides s on r.seen = s.a
)
select d.doc_id, coalesce(len(s.s), 0)::bigint as n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(r.low, d.doc_id)) as kept
from documents d left join sets s on d.doc_id = s.doc_id
left join (select node, min(seen) as low from reach group by node) r on d.doc_id = r.node
""")
def op9_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


@query("op7_substring_dedup", sql="""
with words as (
    select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w from documents
), windows as (
    select doc_id, unnest(range(1, len(w) - 18)) as i, w from words where len(w) >= 20
), hashed as (
    select doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) as h from windows
), later as (
    select doc_id, i from (select *, row_number() over (partition by h order by doc_id, i) as n from hashed) where n > 1
), gone as (
    select distinct doc_id, unnest(range(i, i + 20)) as i from later
), places as (
    select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from words
), kept as (
    select p.doc_id, count(g.i) as n_removed,
           coalesce(string_agg(case when g.i is null then p.word end, ' ' order by p.i), '') as text
    from places p left join gone g on p.doc_id = g.doc_id and p.i = g.i group by p.doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from words d left join kept k on d.doc_id = k.doc_id
""")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeats(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op1_divergence_rules")
def op1_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(table(spark, sf_dir, "documents"))


@query("op5_bilinear_scores")
def op5_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return bilinear.score(table(spark, sf_dir, "documents"), held_out)


@query("op3_licence_sentences", sql=licences.scan_sql())
def op3_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op8_language_fusion")
def op8_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query("op11_filter_orders", sql=interactions.audit_sql())
def op11_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_merkle_versions", sql=merkle.manifest_sql())
def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    manifest = merkle.Manifest(table(spark, sf_dir, "documents"), tampered, merkle.lower_cased(F.col("text")))
    return manifest.rows().select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("op13_pigeonhole_near_dedup", sql="""
with recursive points as (
    select vec_id, label, embedding::double[] as v from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), sides as (
    select x.vec_id as a, y.vec_id as b from points x join points y
    on x.label = y.label and x.vec_id <> y.vec_id and len(x.v) = len(y.v) and list_cosine_similarity(x.v, y.v) >= 0.98
), reach(node, seen) as (
    select a, b from sides
    union select r.node, s.b from reach r join sides s on r.seen = s.a
), low as (
    select node, min(seen) as low from reach group by node
), links as (
    select a, count(*) as n from sides group by a
)
select e.vec_id, coalesce(l.n, 0)::bigint as n_links, least(e.vec_id, coalesce(r.low, e.vec_id)) as component_id,
       e.vec_id = least(e.vec_id, coalesce(r.low, e.vec_id)) as kept
from embeddings e left join links l on e.vec_id = l.a left join low r on e.vec_id = r.node
""")
def op13_pigeonhole_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.near_copies(table(spark, sf_dir, "embeddings"), threshold=0.98)
