"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .archives import archive_round_trip
from .centroids import lloyd
from .exact_dedup import exact_classes
from .hard_negatives import hard_negatives
from .html_extract import extract_main_text
from .jaccard_join import near_components
from .katz import katz_scores
from .mixing import mix
from .packing import pack_documents
from .storage import ship_package
from .substring_dedup import remove_repeats
from .token_files import token_file_round_trip
from .toxicity import score_documents
from .vector_dedup import vector_components


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_round_trip(_read(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_round_trip(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op5_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(_read(spark, sf_dir, "documents"))


def op7_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_components(_read(spark, sf_dir, "embeddings"))


def op8_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(_read(spark, sf_dir, "documents"))


def op11_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_read(spark, sf_dir, "pages"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label of every seventh row is moved on by one, and every hundredth row asks, as the query is stated."""
    rows = _read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lloyd(_read(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_pareto_mix, op3_arc_to_warc, op4_bit_packed_tokens, op5_bigru_toxicity,
    op6_katz_backoff, op7_pq_near_dedup, op8_super_kmer_dedup, op9_ngram_jaccard_join, op10_exact_dedup,
    op11_crf_main_text, op12_threshold_negatives, op13_sharded_lloyd)}
