"""Registered queries of the corpus operators: name -> (run, SQL or None)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import (
    classifier,
    divergence,
    exact_dedup,
    fill_middle,
    jaccard,
    line_dedup,
    lm_scoring,
    mixing,
    pieces,
    quality_rules,
    repeats,
    secrets,
    url_filter,
)
from marketloom.llm import sql as oracle
from marketloom.llm.common import read, stored


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judged(quality_rules.ledger(read(spark, sf_dir, "documents")))
    return rows.selectExpr(
        "_row.doc_id as doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_upper", "fail_bits",
    )


def op1_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every policy's rules over the whole table, from the bits of one stored ledger."""
    bits = stored(quality_rules.ledger(read(spark, sf_dir, "documents")).select("fail_bits"), "ledger")
    rows = []
    for policy in quality_rules.POLICIES:
        n_kept = bits.agg(F.count(F.when(~quality_rules.failed("base") & ~quality_rules.failed(policy), 1)).alias("n_kept"))
        rows.append(quality_rules.ablations(bits, policy).crossJoin(n_kept).withColumn("policy", F.lit(policy)))
    return reduce(DataFrame.unionByName, rows).select("policy", "rule", "bit", "n_docs", "n_failed", "n_only", "n_kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.copies(read(spark, sf_dir, "documents"))
    return rows.selectExpr("_row.doc_id as doc_id", "size", "source_size", "target", "size * copies as taken")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.remove(read(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(read(spark, sf_dir, "documents"), labels=read(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents"), size=3, percent=90)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pieces.encode(read(spark, sf_dir, "documents"), decoded=True)
    return rows.select(
        "doc_id", "sample", F.size("ids").cast("bigint").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        "log_prob", "perturbed", "log_inclusion", F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(read(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_shared_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.selectExpr("_row.doc_id as doc_id", "n_lines", "n_dropped", "sha2(kept, 256) as kept_sha256")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.restore(fill_middle.transform(read(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": (op1_quality_rules, oracle.QUALITY_RULES),
    "op1_rule_ablations": (op1_rule_ablations, oracle.RULE_ABLATIONS),
    "op2_mix_sources": (op2_mix_sources, oracle.MIX_SOURCES),
    "op3_lm_score": (op3_lm_score, None),
    "op4_suffix_dedup": (op4_suffix_dedup, None),
    "op5_quality_classifier": (op5_quality_classifier, None),
    "op6_url_filter": (op6_url_filter, oracle.url_filter()),
    "op7_jaccard_join": (op7_jaccard_join, None),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_exact_dedup": (op9_exact_dedup, oracle.EXACT_DEDUP),
    "op10_secret_scan": (op10_secret_scan, None),
    "op11_line_dedup": (op11_line_dedup, oracle.LINE_DEDUP),
    "op12_fill_middle": (op12_fill_middle, oracle.FILL_MIDDLE),
    "op13_source_divergence": (op13_source_divergence, oracle.SOURCE_DIVERGENCE),
}
