"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, crf, decontam, hard, langid, near, packing, phrases, quality, suffix, toxic, urls, warc
from .common import table

QUALITY_SQL = r"""
with w as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
g as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') as gram from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) >= 8)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as k from g) where k > 1),
c as (select doc_id, sum(least(8, coalesce(i - before, 8))) as n_repeat_words from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from r) group by doc_id),
l as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from w),
f as (
  select w.doc_id, t, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(ls) as n_lines,
    len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    length(t) - length(regexp_replace(t, '!', '', 'g')) as bangs, length(t) - length(regexp_replace(t, '[{}]', '', 'g')) as braces,
    length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) as capitals, length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) as letters
  from w join l using (doc_id) left join c using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from f)
select doc_id, n_words::bigint as n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 100 * n_symbols > 10 * n_words or 100 * bangs > 20 * n_words or 100 * capitals > 50 * letters or 2 * letters < word_chars
    or (n_lines >= 4 and 2 * n_dup_lines > n_lines) or word_chars > 25 * n_words or 2 * word_chars < 3 * n_words or 100 * braces > 10 * n_words) as kept
from b
"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", langid.held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text", "lang")
    model = langid.train(d.where("not held_out"))
    return langid.identify(d.select("doc_id", "held_out", "text"), model)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_spans(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("rejected_by")  # its order depends on timings


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    field = crf.train(d, labels.where(~langid.held_out(F.col("doc_id"), 4, 2)))
    scored = crf.score(d, field)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(chat.format_windows(turns))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard.hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")), F.col("id") % 50 == 0)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", langid.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxic.train(d, labels.where(~langid.held_out(F.col("doc_id"), 5, 0)))
    return toxic.score(d, model).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_url_filters": op10_url_filters,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_collocations": op13_collocations,
}
DECONTAM_SQL = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
iw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
g as (select item_id, least(10, len(ws)) as n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as gram
      from (select item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i from iw where len(ws) > 0)),
x as (select distinct * from g), ns as (select distinct n from x),
dg as (select doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as gram from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from dw, ns where len(ws) >= n)),
m as (select doc_id, item_id, i, x.n from dg join x using (n, gram)),
hw as (select doc_id, count(distinct w) as n_hit from (select doc_id, unnest(range(i, i + n)) as w from m) group by doc_id),
hi as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct doc_id, item_id from m) group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hw using (doc_id) left join hi using (doc_id)
"""

SQL = {"op4_decontamination": DECONTAM_SQL, "op1_warc": warc.SQL, "op5_quality_rules": QUALITY_SQL, "op10_url_filters": urls.SQL, "op11_hard_negatives": hard.SQL, "op13_collocations": phrases.SQL}
