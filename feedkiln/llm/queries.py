"""The registered queries of the training-data operators: each applies its
operator to its whole table and derives the digest columns from the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkiln import session
from feedkiln.llm import (
    byte_bpe, decontaminate, embedding_dedup, kd_shard, language_gru, line_dedup, pii_crf, simhash_bk, sparse_suffix, token_align, toxicity_gbt,
    turn_repair, warc,
)
from feedkiln.llm.common import crc, read

RANKS = "byte_bpe_50k.tiktoken"


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links at cosine 0.9 or more among all embeddings, and their components."""
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_kd_tree_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    placed = kd_shard.shard(read(spark, sf_dir, "documents"), ["doc_id", "n_chars", "source", "lang"], 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Windows of 10 item words found in the documents by suffix arrays."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


def op4_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    return byte_bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three of four folds."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(crc("doc_id"), F.lit(4)) == 2, F.lit(False))
    net = language_gru.fit(docs.filter(~held_out))
    return language_gru.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "share")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Documents after deleting later copies of repeated runs of lines."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    clean = line_dedup.dedup_lines(docs, min_lines=2, min_chars=100, removed="n_removed")
    left = F.coalesce(F.col("text"), F.lit(""))
    return clean.select("doc_id", F.octet_length(left).cast("long").alias("n_bytes"), "n_removed", F.sha2(left, 256).alias("text_sha256"))


def op7_simhash_bk_tree(spark, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 3-word shingles, at most 3 bits apart."""
    return simhash_bk.groups(read(spark, sf_dir, "documents"), shingle=3, radius=3)


def op8_sparse_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Documents that share a passage of 50 words or more, with its places."""
    return sparse_suffix.report(read(spark, sf_dir, "documents"), min_words=50)


def op9_pii_crf(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents: pattern spans and those of the field."""
    return pii_crf.find(read(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents, learned from four of five folds."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity_gbt.fit(docs, read(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity_gbt.score(docs, model).select(
        "doc_id", F.coalesce(F.pmod(crc("doc_id"), F.lit(5)) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Token groups of a byte-level BPE and a piece model over all documents,
    with how often their token pairs end together in the whole corpus."""
    return token_align.report(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back by byte ranges."""
    pages = read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType.simpleString()
    path = session.scratch_path(spark, "warc")
    warc.write_archive(pages, path, min_bytes=100)
    return warc.read_archive(spark, path, payloads=False).select(
        warc.id_of(F.col("record_id"), kind).alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        warc.id_of(F.col("refers_to"), kind).alias("refers_to"))


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations after known damage."""
    return turn_repair.report(turn_repair.damage(read(spark, sf_dir, "conversations")), copies="copies")


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_kd_tree_sharding, op3_benchmark_decontamination, op4_byte_bpe, op5_language_id, op6_line_dedup,
    op7_simhash_bk_tree, op8_sparse_suffix_dedup, op9_pii_crf, op10_toxicity, op11_token_alignment, op12_warc, op13_conversation_repair)}

ORACLE: dict[str, str] = {}

ORACLE["op6_line_dedup"] = r"""
with raw as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as p
             from documents),
line as (select doc_id, p, line, row_number() over (partition by doc_id order by p) as i from raw
         where regexp_matches(line, '[^\x09-\x0D\x20]')),
pair as (select doc_id, i, line, lead(line) over (partition by doc_id order by i) as next from line),
run as (select doc_id, i from (select doc_id, i, row_number() over (partition by line, next order by doc_id, i) as k
                               from pair where next is not null) where k > 1),
single as (select doc_id, i from (select doc_id, i, row_number() over (partition by line order by doc_id, i) as k
                                  from line where length(line) >= 100) where k > 1),
gone as (select doc_id, i from run union select doc_id, i + 1 from run union select doc_id, i from single),
gone_raw as (select doc_id, p from line join gone using (doc_id, i)),
kept as (select raw.doc_id, string_agg(raw.line, chr(10) order by raw.p) as text
         from raw left join gone_raw using (doc_id, p) where gone_raw.p is null group by raw.doc_id),
n as (select doc_id, count(*) as n_removed from gone_raw group by doc_id)
select d.doc_id, strlen(coalesce(kept.text, '')) as n_bytes, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as text_sha256
from documents d left join kept using (doc_id) left join n using (doc_id)
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

ORACLE["op1_embedding_near_dedup"] = """
with recursive good as (
  select vec_id, embedding::double[] as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (select a.vec_id as u, b.vec_id as v from good a join good b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
         where list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (select vec_id as u, vec_id as v from good union select r.u, l.v from reach r join link l on l.u = r.v),
comp as (select u, min(v) as c from reach group by u),
n as (select u, count(*) as n from link group by u)
select e.vec_id, coalesce(n.n, 0) as n_links, coalesce(comp.c, e.vec_id) as component_id, coalesce(comp.c, e.vec_id) = e.vec_id as kept
from embeddings e left join n on n.u = e.vec_id left join comp on comp.u = e.vec_id
"""

ORACLE["op3_benchmark_decontamination"] = f"""
with d as (select doc_id, {_WORDS} as words from documents),
item as (select cast(item_id as varchar) as item_id, {_WORDS} as words from benchmark where item_id is not null),
iw as (select item_id, ip, k, array_to_string(list_slice(words, ip, ip + k - 1), ' ') as win
       from (select item_id, words, least(len(words), 10) as k, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as ip
             from item where len(words) > 0)),
dw as (select doc_id, p, k, array_to_string(list_slice(words, p, p + k - 1), ' ') as win
       from (select doc_id, words, k, unnest(range(1, len(words) - k + 2)) as p
             from d, (select distinct k from iw) where len(words) >= k)),
hit as (select distinct doc_id, p, item_id, ip, k from dw join iw using (k, win)),
word as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(p, p + k)) as p from hit) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
          from (select distinct doc_id, item_id from hit) group by doc_id),
run as (select doc_id, max(ip) - min(ip) + min(k) as size from
          (select *, ip - row_number() over (partition by doc_id, item_id, p - ip order by ip) as island from hit)
        group by doc_id, item_id, p - ip, island),
long as (select doc_id, max(size) as size from run group by doc_id)
select d.doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(long.size, 0) as longest_match
from d left join word using (doc_id) left join found using (doc_id) left join long using (doc_id)
"""

ORACLE["op8_sparse_suffix_dedup"] = f"""
with d as (select doc_id, {_WORDS} as words from documents where doc_id is not null),
win as (select doc_id, p, md5(array_to_string(list_slice(words, p, p + 49), ' ')) as h
        from (select doc_id, words, unnest(range(1, len(words) - 48)) as p from d where len(words) >= 50)),
flag as (select doc_id, p, row_number() over (partition by h order by doc_id, p) > 1 as later, count(*) over (partition by h) > 1 as rep from win),
kind as (select doc_id, p, false as later from flag where rep union all select doc_id, p, true from flag where later),
step as (select *, p - lag(p) over (partition by doc_id, later order by p) as gap from kind),
isle as (select *, sum(case when gap is null or gap > 50 then 1 else 0 end) over (partition by doc_id, later order by p) as g from step),
span as (select doc_id, later, min(p) - 1 as s, max(p) + 49 as e from isle group by doc_id, later, g)
select doc_id, cast(sum(case when not later then e - s else 0 end) as bigint) as n_repeated,
       cast(sum(case when later then e - s else 0 end) as bigint) as n_removed,
       coalesce(string_agg(s || ':' || e, ',' order by s) filter (not later), '') as repeated,
       coalesce(string_agg(s || ':' || e, ',' order by s) filter (later), '') as removed
from span group by doc_id
"""

ORACLE["op12_warc"] = """
with p as (select page_id, coalesce(html, '') as h from pages),
grp as (select sha256(h) as d, min(page_id) as first, count(*) as n from p where strlen(h) >= 100 group by 1)
select page_id, cast(strlen(h) as bigint) as payload_bytes, sha256(h) as payload_digest,
       case when n > 1 and page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
       case when n > 1 and page_id is distinct from first then first end as refers_to
from p left join grp on d = sha256(h) and strlen(h) >= 100
"""

#: The grammar's four states as structs (cost, edits, repaired rows), advanced row by row.
ORACLE["op13_conversation_repair"] = r"""
with recursive keyed as (
  select dense_rank() over (order by conv_id nulls first) as g, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
dealt as (select *, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(key, ''), lambda x: cast(ord(x) as bigint))),
                                    lambda c, b: list_reduce(list_prepend(xor(c, b), cast([1, 1, 1, 1, 1, 1, 1, 1] as bigint[])),
                                                             lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 as k from keyed),
damaged as (select g, turn, case when k = 4 then 'user' else role end as role,
                   case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                   unnest(range(case when k = 0 then 0 when k = 3 then 2 else 1 end)) as copy from dealt),
placed as (select *, row_number() over (partition by g order by turn nulls first, role, text, copy) as i from damaged),
told as (select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, row_number() over (partition by g, role, text order by i) > 1 as again,
                not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') as open_end, lag(role) over (partition by g order by i) as before from placed),
faults as (select g, cast(max(turn) - min(turn) + 1 - count(distinct turn) as bigint) as gaps, count(*) filter (blank) as blank,
                  count(*) filter (again and not blank) as duplicate, count(*) filter (open_end and not again and not blank) as truncated,
                  count(*) filter (i > 1 and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) as illegal from told group by g),
step as (
  select distinct g, cast(0 as bigint) as i, {'c': cast(0 as bigint), 'a': '', 'r': cast([] as varchar[])} as s0,
         cast(null as struct(c bigint, a varchar, r varchar[])) as s1, cast(null as struct(c bigint, a varchar, r varchar[])) as s2,
         cast(null as struct(c bigint, a varchar, r varchar[])) as s3 from keyed
  union all
  select g, i, list_min([case when s0.c is not null then {'c': s0.c + 2, 'a': s0.a || 'D', 'r': s0.r} end]),
         list_min([case when s1.c is not null then {'c': s1.c + 2, 'a': s1.a || 'D', 'r': s1.r} end,
                   case when s0.c is not null and not gone and left(role, 1) = 's' then {'c': s0.c + x, 'a': s0.a || 'K', 'r': list_append(s0.r, role || ':' || text)} end]),
         list_min([case when u.c is not null then {'c': u.c + 2, 'a': u.a || 'D', 'r': u.r} end,
                   case when s0.c is not null and not gone and left(role, 1) = 'u' then {'c': s0.c + x, 'a': s0.a || 'K', 'r': list_append(s0.r, role || ':' || text)} end,
                   case when s1.c is not null and not gone and left(role, 1) = 'u' then {'c': s1.c + x, 'a': s1.a || 'K', 'r': list_append(s1.r, role || ':' || text)} end,
                   case when v.c is not null and not gone and left(role, 1) = 'u' then {'c': v.c + x, 'a': v.a || 'K', 'r': list_append(v.r, role || ':' || text)} end,
                   case when s0.c is not null and not gone then {'c': s0.c + x + 1, 'a': s0.a || 'R', 'r': list_append(s0.r, 'user:' || text)} end,
                   case when s1.c is not null and not gone then {'c': s1.c + x + 1, 'a': s1.a || 'R', 'r': list_append(s1.r, 'user:' || text)} end,
                   case when v.c is not null and not gone then {'c': v.c + x + 1, 'a': v.a || 'R', 'r': list_append(v.r, 'user:' || text)} end]),
         list_min([case when v.c is not null then {'c': v.c + 2, 'a': v.a || 'D', 'r': v.r} end,
                   case when u.c is not null and not gone and left(role, 1) = 'a' then {'c': u.c + x, 'a': u.a || 'K', 'r': list_append(u.r, role || ':' || text)} end,
                   case when u.c is not null and not gone then {'c': u.c + x + 1, 'a': u.a || 'R', 'r': list_append(u.r, 'assistant:' || text)} end])
  from (select *, list_min([s3, case when u.c is not null then {'c': u.c + 5, 'a': u.a || 'I', 'r': list_append(u.r, 'assistant:')} end]) as v
        from (select t.g, t.i, t.role, t.text, t.blank or t.again as gone, case when t.open_end then 5 else 0 end as x, s0, s1, s3,
                     list_min([s2, case when s0.c is not null then {'c': s0.c + 5, 'a': s0.a || 'I', 'r': list_append(s0.r, 'user:')} end,
                               case when s1.c is not null then {'c': s1.c + 5, 'a': s1.a || 'I', 'r': list_append(s1.r, 'user:')} end,
                               case when s3.c is not null then {'c': s3.c + 5, 'a': s3.a || 'I', 'r': list_append(s3.r, 'user:')} end]) as u
              from step join told t on t.g = step.g and t.i = step.i + 1))),
ended as (select g, list_min([s0, s3, case when u.c is not null then {'c': u.c + 5, 'a': u.a || 'I', 'r': list_append(u.r, 'assistant:')} end]) as w
          from (select *, list_min([s2, case when s0.c is not null then {'c': s0.c + 5, 'a': s0.a || 'I', 'r': list_append(s0.r, 'user:')} end,
                                    case when s1.c is not null then {'c': s1.c + 5, 'a': s1.a || 'I', 'r': list_append(s1.r, 'user:')} end,
                                    case when s3.c is not null then {'c': s3.c + 5, 'a': s3.a || 'I', 'r': list_append(s3.r, 'user:')} end]) as u
                from (select step.* from step left join (select g, max(i) as n from told group by g) m using (g) where step.i = coalesce(n, 0))))
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, w.c as cost, w.a as audit, sha256(array_to_string(w.r, chr(10))) as repaired_sha256
from (select distinct g, conv_id from keyed) join ended using (g) left join faults using (g)
"""
