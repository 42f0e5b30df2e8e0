"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cindermill.llm import clustering, decontamination, jaccard_join, line_dedup, lm_scoring, manifest, packing, pii, quality, secret_scan, token_counts, toxicity, url_filter
from cindermill.llm.common import table


def op1_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    return decontamination.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


def op7_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lm_scoring(spark, sf_dir):
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    return url_filter.judged(table(spark, sf_dir, "pages"), url_filter.block_list(spark))


def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.joined(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    return manifest.digest(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark, sf_dir):
    return clustering.digest(table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark, sf_dir):
    return secret_scan.digest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_quality_rules, op3_best_fit_packing, op4_decontamination, op5_pii, op6_line_dedup, op7_toxicity, op8_lm_scoring, op9_url_filter, op10_jaccard_join, op11_merkle_manifest, op12_centroid_clustering, op13_secret_scan)}
ORACLE_SQL = {"op4_decontamination": decontamination.ORACLE, "op6_line_dedup": line_dedup.ORACLE, "op9_url_filter": url_filter.ORACLE, "op10_jaccard_join": jaccard_join.ORACLE, "op11_merkle_manifest": manifest.ORACLE, "op12_centroid_clustering": clustering.ORACLE}
