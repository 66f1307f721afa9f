"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstar.llm import (alignment, bpe, fingerprints, html_extract, jaccard_join, lang_id, lm_scoring, mixing, quality, sharding, token_counts,
                         url_filter, whitening)
from ordstar.llm.common import documents, id_crc, text_or_empty

#: Rules of the url query: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
MIX_WEIGHTS = (5, 2, 1)
SHARDS = 24
TOKEN_LIMIT = 1024


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.filter_urls(pages, url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir), MIX_WEIGHTS)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", id_crc() % 7 == 2)
    scored = lm_scoring.score(docs, docs.filter(~F.col("held_out")))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text").cast("binary")
    slim = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.number_slots(sharding.assign_shards(slim, "doc_id", SHARDS, SHARDS + 1), "shard")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        spec = f.read()
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    counted = token_counts.token_counts(docs, spec, budgets=[TOKEN_LIMIT])
    return counted.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), F.col(f"fit_{TOKEN_LIMIT}").alias("fit_chars"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    judged = quality.quality_filter(docs, documents(spark, sf_dir, "labels"), keep_text=False)
    return judged.select("doc_id", *quality.BASE, "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"))


def language_training(docs: DataFrame) -> DataFrame:
    """Rows a language model may learn from: three of four ids by their crc32."""
    rows = docs.filter(id_crc() % 4 != 2)
    return rows.select(F.col("doc_id").alias("key"), "lang", "text")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = lang_id.learn(language_training(docs))
    judged = lang_id.predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", (id_crc() % 4 == 2).alias("held_out"), "lang_pred", "score", "accepted")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_join.jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    rows = fingerprints.with_next(fingerprints.fingerprint(docs), "doc_id", "text", ["text", "fingerprint"])
    edited = F.concat(F.expr("left(text, cast(n_chars - n_chars div 2 AS int))"), F.expr("left(next_text, cast(n_chars div 2 AS int))"))
    rows = rows.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("edited", edited)
    rows = fingerprints.fingerprint(rows, "edited", "edited_fingerprint")
    near = fingerprints.likeness_column
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                       near(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       near(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text"))
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    coded = bpe.decode(coded, ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        spec = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return alignment.align_corpus(docs, spec, model, keep_text=False)


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(documents(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    # Null where the exact number is beyond a long.
    return white.select("vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_mix_sources": op2_mix_sources,
    "op3_lm_scores": op3_lm_scores,
    "op4_shards": op4_shards,
    "op5_token_counts": op5_token_counts,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_fingerprints": op9_fingerprints,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_alignment": op11_alignment,
    "op12_html_extract": op12_html_extract,
    "op13_whitening": op13_whitening,
}
