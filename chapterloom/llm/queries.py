"""The queries of this subpackage: one for each operator, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chapterloom.llm import bpe, chat_format, decontamination, filter_audit, language_id, lexical_search, licenses, ppm, quality_rules, rule_ensemble, signature_join, url_rules, warc
from chapterloom.llm.common import id_hash, new_path, store


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(modulus: int, remainder: int):
    return id_hash() % modulus == remainder


def tokenizer() -> tuple[str, str]:
    """Path and pattern of the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(docs.where(~held_out(3, 1)))
    cases = docs.select("doc_id", held_out(3, 1).alias("held_out"), "text")
    return language_id.predict(cases, profiles).select("doc_id", "held_out", "lang_pred", "score", "fit")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest_match",
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.components(read(spark, sf_dir, "documents"), words=5, percent=75)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.formatted(read(spark, sf_dir, "conversations"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", held_out(5, 1).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    return ppm.scored(docs, train).select("doc_id", "held_out", *ppm.OUTPUTS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read(spark, path))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license", "dice", "unit", "n_units", F.array_join("licenses", ",").alias("licenses"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer()
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", held_out(4, 2).alias("held_out"), "text")
    statistics = store(rule_ensemble.with_statistics(docs).drop("text"), "statistics")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    ensemble = rule_ensemble.fit(statistics.where(~F.col("held_out")).join(labels, "doc_id"))
    return rule_ensemble.score(statistics, ensemble).select("doc_id", "held_out", "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"), url_rules.rules_table(spark))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_decontamination, op3_ngram_jaccard_join, op4_chat_formatting, op5_lm_scoring, op6_warc, op7_license_scan, op8_byte_bpe, op9_quality_rules, op10_quality_classifier, op11_filter_audit, op12_url_filters, op13_ranked_search)}

SQL: dict[str, str] = {
    "op4_chat_formatting": chat_format.SQL,
    "op7_license_scan": licenses.sql(),
    "op11_filter_audit": filter_audit.SQL,
    "op12_url_filters": url_rules.sql(),
    "op13_ranked_search": lexical_search.SQL,
    "op6_warc": """
WITH d AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages
), b AS (
  SELECT page_id, payload_bytes, x, list_transform(range(0, 8), lambda k: CAST('0x' || substr(x, CAST(1 + 5 * k AS INT), 5) AS INT)) AS c FROM d
), t AS (
  SELECT page_id, payload_bytes,
    array_to_string(list_transform(c, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 15), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 10) & 31), 1)
      || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 5) & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v & 31), 1)), '') AS payload_digest,
    min(page_id) OVER (PARTITION BY x, payload_bytes) AS first
  FROM b
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM t
""",
}
