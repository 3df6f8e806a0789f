"""The registered queries of this subpackage and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    decontamination,
    language_id,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    simhash,
    spelling,
    sql,
    substring_dedup,
    url_rules,
)
from ledgerlark.llm.common import table

#: A parameter: any tokenizer file of this kind will do.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: The host and path rules that go before the mined ones.
URL_RULES = (
    url_rules.HostRule("allow", "com", "/"),
    url_rules.HostRule("block", "example.com", "/en/"),
    url_rules.HostRule("allow", "www.example.com", "/en/"),
    url_rules.HostRule("block", "net", "/es/"),
    url_rules.HostRule("block", "net", "/fr/"),
)


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mined from the labels of the documents that the pages show: the number in a page's path is its doc_id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    labels = table(spark, sf_dir, "labels").select("doc_id", bad.alias("verdict"))
    shown = F.regexp_extract(url_rules.path(F.col("url")), "/([0-9]{1,18})[^0-9/]*/?$", 1)
    numbered = pages.where(shown != "").select("url", shown.cast("long").alias("doc_id"))
    rules = url_rules.mine(numbered.join(labels, "doc_id").select("url", "verdict"))
    judged = url_rules.judge(pages, rules, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule", "confidence")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per contaminated document and item; clean documents have none."""
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(_remainder(3) != 1))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(_remainder(4) != 2)
    out = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    return out.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    kinds = F.transform("plain", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("plain").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents, by a hash of their ids, are tampered with: their text is lower-cased."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = merkle.manifest(table(spark, sf_dir, "documents"), _remainder(5) == 0, lowered)
    return found.drop("copied")


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_rules,
        op2_benchmark_decontamination,
        op3_quality_rules,
        op4_language_id,
        op5_line_dedup,
        op6_quality_classifier,
        op7_minhash_near_dedup,
        op8_pii,
        op9_best_fit_packing,
        op10_substring_dedup,
        op11_simhash_near_dedup,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}
SQL: dict[str, str] = {
    "op3_quality_rules": sql.quality_rules(),
    "op5_line_dedup": sql.line_dedup(),
    "op7_minhash_near_dedup": sql.near_dedup(),
    "op10_substring_dedup": sql.substring_dedup(),
    "op12_spelling_variants": sql.spelling_variants(),
    "op13_merkle_manifest": sql.merkle_manifest(),
}
