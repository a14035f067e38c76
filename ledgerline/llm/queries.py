"""Registered queries of the training-data operators: each applies one
operator with its production parameters to its whole table and derives the
digest columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchor_pii, bpe_fst, decontaminate, histogram_shards, interpolated_lm, merkle_rollup, middle_fill, piece_agenda, quality_llr, simhash_ring, substring_graph, token_files, warc_derive
from .common import table, work_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE_PATTERN = public_tokenizers.PATTERN
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), WORD_BPE, folder)
    return token_files.read(spark, folder).drop("ids")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_graph.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histogram_shards.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")))
    return placed.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_pii.detect(table(spark, sf_dir, "documents"), ["doc_id"])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = quality_llr.fit(docs, table(spark, sf_dir, "labels"))
    return quality_llr.judge(docs, ratio, ["doc_id"])


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ring.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warc_derive.derivatives(warc_derive.responses(table(spark, sf_dir, "pages")))
    return built.select(*(c for c in built.columns if c != "record"), F.sha2("record", 256).alias("record_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_fst.encode_documents(docs, BYTE_BPE, BYTE_BPE_PATTERN, ["doc_id"], with_ids=False)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_fill.fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"], with_output=False)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rollup.manifest(table(spark, sf_dir, "documents"))


def op13_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_agenda.encode_documents(docs, PIECE_BPE, ["doc_id"], with_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_files, op2_lm_scores, op3_substring_dedup, op4_histogram_shards, op5_personal_data, op6_decontamination,
                                    op7_quality_rules, op8_simhash_near_dedup, op9_warc_derivatives, op10_byte_bpe, op11_fill_in_middle,
                                    op12_merkle_manifest, op13_piece_agenda)}


#: Words by position; windows of 50 words by the digest of their words; a word
#: goes when a window over it also starts in a document of smaller id.
SUBSTRING_SQL = r"""
with split as (
  select row_number() over () as doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), windows as (
  select doc, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as digest
  from (select doc, doc_id, ws, unnest(range(1, len(ws) - 48)) as i from split)
), firsts as (
  select digest, min(doc_id) as first_id from windows group by digest
), gone as (
  select distinct doc, unnest(range(i, i + 50)) as i from windows join firsts using (digest) where first_id < doc_id
), word as (
  select doc, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from split
), kept as (
  select word.doc, string_agg(w, ' ' order by word.i) as kept_text
  from word left join gone on gone.doc = word.doc and gone.i = word.i where gone.i is null group by word.doc
), lost as (
  select doc, count(*) as n from gone group by doc
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(lost.n, 0) as bigint) as n_removed,
       sha256(coalesce(kept_text, '')) as kept_sha256
from split left join kept using (doc) left join lost using (doc)
"""


#: Tokens by one expression; a part is the tokens up to its cut, joined. The
#: text is rebuilt by cutting the output at the marks.
MIDDLE_SQL = r"""
with draw as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as ws from documents
), cut as (
  select doc_id, t, ws, len(ws) as n, cast('0x' || h[1:8] as bigint) % (len(ws) + 1) as c1, cast('0x' || h[9:16] as bigint) % (len(ws) + 1) as c2,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || h[17:24] as bigint) % 100 >= 50 then 'plain'
              when cast('0x' || h[25:32] as bigint) % 100 < 80 then 'spm' else 'psm' end as form from draw
), part as (
  select *, array_to_string(ws[1:least(c1, c2)], '') as p, array_to_string(ws[least(c1, c2) + 1:greatest(c1, c2)], '') as m,
         array_to_string(ws[greatest(c1, c2) + 1:], '') as s from cut
), made as (
  select *, case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else '<P>' || p || '<S>' || s || '<M>' || m end as output from part
), back as (
  select *, string_split(replace(replace(output, '<P>', '<M>'), '<S>', '<M>'), '<M>') as bits from made
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
       sha256(output) as output_sha256,
       sha256(case form when 'plain' then output when 'spm' then bits[3] || bits[4] || bits[2] else bits[2] || bits[4] || bits[3] end) as restored_sha256
from back
"""

#: Levels of all trees by recursion; a proof walks from level to level.
MERKLE_SQL = r"""
with recursive leaf as (
  select row_number() over () as k, doc_id, lang, d || s || l || n || t as plain, d || s || l || case when n = '-' then n else n1 end || t as forged,
         -- crc32 of the id's digits, bit by bit
         xor(4294967295, list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(coalesce(cast(doc_id as varchar), ''), ''), lambda c: cast(ascii(c) as bigint))),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [cast(0 as bigint), 0, 0, 0, 0, 0, 0, 0]),
                                           lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) % 7 = 0 as chosen
  from (select doc_id, lang, case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end as d,
               case when source is null then '-' else strlen(source) || ':' || source end as s,
               case when lang is null then '-' else strlen(lang) || ':' || lang end as l,
               case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end as n,
               case when n_chars is null then '-' else strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1) end as n1,
               case when text is null then '-' else strlen(text) || ':' || text end as t from documents)
), placed as (
  select k, doc_id, lang, sha256(plain) as h, case when chosen then sha256(forged) else sha256(plain) end as forged_h,
         row_number() over (partition by lang order by doc_id nulls first, sha256(plain), k) - 1 as i, count(*) over (partition by lang) as size from leaf
), level as (
  select lang, 0 as lv, i, h, size from placed
  union all
  select lang, lv + 1, i // 2, sha256(string_agg(h, '' order by i)), (size + 1) // 2 from level where size > 1 group by lang, lv, i // 2, size
), sub as (
  select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as size from level where size = 1
), upper_level as (
  select 0 as lv, i, subroot as h, size from sub
  union all
  select lv + 1, i // 2, sha256(string_agg(h, '' order by i)), (size + 1) // 2 from upper_level where size > 1 group by lv, i // 2, size
), walk as (
  select k, lang, 0 as lv, i, size, '' as proof, forged_h as own from placed
  union all
  select w.k, w.lang, w.lv + 1, w.i // 2, (w.size + 1) // 2, w.proof || coalesce(b.h, ''),
         sha256(case when w.i % 2 = 1 then b.h || w.own else w.own || coalesce(b.h, '') end)
  from walk w left join level b on b.lang is not distinct from w.lang and b.lv = w.lv and b.i = xor(w.i, 1) where w.size > 1
), upper_walk as (
  select w.k, 0 as lv, s.i, s.size, w.proof, w.own, s.subroot from walk w join sub s on s.lang is not distinct from w.lang where w.size = 1
  union all
  select w.k, w.lv + 1, w.i // 2, (w.size + 1) // 2, w.proof || coalesce(b.h, ''),
         sha256(case when w.i % 2 = 1 then b.h || w.own else w.own || coalesce(b.h, '') end), w.subroot
  from upper_walk w left join upper_level b on b.lv = w.lv and b.i = xor(w.i, 1) where w.size > 1
)
select p.doc_id, p.h as leaf, w.subroot, r.h as root, sha256(w.proof) as proof_sha256, w.own as folded_root, w.own = r.h as verified
from placed p join (select * from upper_walk where size = 1) w using (k) cross join (select h from upper_level where size = 1) r
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_substring_dedup": SUBSTRING_SQL, "op11_fill_in_middle": MIDDLE_SQL, "op12_merkle_manifest": MERKLE_SQL}
