"""The registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, filter_audit, jaccard, lm_scoring, merkle, mixing, pii, secrets, sharding, token_counts
from tidemark.llm import quality_classifier as quality
from tidemark.llm import quality_rules as rules
from tidemark.llm import toxicity
from tidemark.llm.common import id_remainder, table


def op1_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.scored_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return scored.select(
        "doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op3_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what labels call good and not toxic; below 0 is nearer to it than the average."""
    target = table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0")
    return lm_scoring.cross_entropy_difference(table(spark, sf_dir, "documents"), target)


def op4_randomness_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half as many tokens again as there are, the weights half-way in entropy to those of equal sources."""
    target = mixing.Target(entropy=0.5, relative=True, repeats=4.0, passes=1.5)
    draws = mixing.mixture(table(spark, sf_dir, "documents"), target)
    return draws.withColumn("weight", F.round("weight", 12))


def op6_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.personal_spans(table(spark, sf_dir, "documents")))


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scored_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return scored.select(
        "doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_spans(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return decontaminate.report(found).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_rank_synchronous_tokens(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    merges = token_counts.merge_table(public_tokenizers.path(model))
    return token_counts.token_report(table(spark, sf_dir, "documents"), merges, limit=4096)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, **merkle.lower_cased_thirds(docs))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_lexicon_toxicity": op1_lexicon_toxicity,
    "op2_adaptive_rules": op2_adaptive_rules,
    "op3_cross_entropy": op3_cross_entropy,
    "op4_randomness_secrets": op4_randomness_secrets,
    "op5_temperature_mix": op5_temperature_mix,
    "op6_prefix_sum_shards": op6_prefix_sum_shards,
    "op7_boosted_pii": op7_boosted_pii,
    "op8_pairwise_quality": op8_pairwise_quality,
    "op9_fm_index_decontamination": op9_fm_index_decontamination,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_rank_synchronous_tokens": op11_rank_synchronous_tokens,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit,
}
