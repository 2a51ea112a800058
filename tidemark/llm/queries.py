"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import digest, find_personal_data

    return digest(find_personal_data(table(spark, sf_dir, "documents")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeated_strings

    out = remove_repeated_strings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .matroska import features, stored

    return features(stored(table(spark, sf_dir, "documents")))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import resampled

    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import resolved_pages

    return resolved_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .imatch import compared_with_edits

    out = compared_with_edits(table(spark, sf_dir, "documents"))
    joined = [F.concat_ws(" ", f"{c}_whole", c).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *joined, "near_edited", "near_next")


def op10_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixed

    return mixed(table(spark, sf_dir, "documents"))


def op11_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import fingerprint_text, simhash_duplicates

    return simhash_duplicates(table(spark, sf_dir, "documents")).select("doc_id", fingerprint_text("fp").alias("fingerprint"), "component_id")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened

    out = whitened(table(spark, sf_dir, "embeddings"), key="vec_id", vector="embedding")
    return out.select(F.col("id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    from . import sql

    return {"op1_ngram_jaccard_join": sql.OP1, "op2_substring_dedup": sql.OP2, "op5_suffix_array_dedup": sql.OP5, "op8_warc_revisits": sql.OP8, "op13_spelling_variants": sql.OP13}
