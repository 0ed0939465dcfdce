"""The numbered queries over the given tables, each with its SQL counterpart where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm import common as c
from offerlens.llm import (bpe, jaccard_join, lm_scoring, mixing, nn_descent, quality_classifier, quality_rules, spelling, substring_dedup,
                           token_files, toxicity, warc, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: Folder of the public vocabulary files.
VOCABULARIES = os.environ.get("VOCABULARY_DIR", "/opt/tokenizers")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_toxicity")
def op1(spark, sf):
    return toxicity.judge(c.table(spark, sf, "documents"), c.table(spark, sf, "labels"))


@query("op2_lm_scoring")
def op2(spark, sf):
    return lm_scoring.score_documents(c.table(spark, sf, "documents"))


@query("op3_quality_classifier")
def op3(spark, sf):
    return quality_classifier.judge(c.table(spark, sf, "documents"), c.table(spark, sf, "labels"))


@query("op4_token_files")
def op4(spark, sf):
    path = c.shared_folder(spark)
    token_files.write_tokens(c.table(spark, sf, "documents"), f"{VOCABULARIES}/word_bpe_49k.json", path)
    return token_files.token_digests(spark, path)


@query("op5_nn_descent")
def op5(spark, sf):
    return nn_descent.near_duplicates(c.table(spark, sf, "embeddings"))


@query("op6_jaccard_join")
def op6(spark, sf):
    return jaccard_join.join_documents(c.table(spark, sf, "documents")).drop("node")


@query("op7_quality_rules")
def op7(spark, sf):
    return quality_rules.judge_spans(c.table(spark, sf, "documents")).drop("host", "text_hash")


@query("op8_mix_sources", f"""
WITH RECURSIVE {mixing.mix_sql("documents")}
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, shuffle_key FROM mixed""")
def op8(spark, sf):
    return mixing.mix_sources(c.table(spark, sf, "documents"))


@query("op9_bpe")
def op9(spark, sf):
    return bpe.round_trip(c.table(spark, sf, "documents"), f"{VOCABULARIES}/byte_bpe_50k.json")


@query("op10_warc", """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS best FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND best <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND best <> page_id THEN best END AS refers_to FROM m""")
def op10(spark, sf):
    path = c.shared_folder(spark)
    warc.write_archives(c.table(spark, sf, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path))


@query("op11_spelling_variants")
def op11(spark, sf):
    return spelling.group_variants(c.table(spark, sf, "documents"))


@query("op12_whitening")
def op12(spark, sf):
    return whitening.whiten(c.table(spark, sf, "embeddings"))


@query("op13_substring_dedup")
def op13(spark, sf):
    kept = substring_dedup.remove_repeats(c.table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
