"""The queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bottomk import near_duplicates
from tidemark.llm.common import table
from tidemark.llm.decontaminate import contamination
from tidemark.llm.grid_join import similar_vectors
from tidemark.llm.line_runs import deduplicate_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.paragraphs import repeated_paragraphs, without_copies
from tidemark.llm.phrases import collocations
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.quality import quality
from tidemark.llm.sql import ORACLES  # noqa: F401
from tidemark.llm.surrogates import pseudonymize
from tidemark.llm.token_files import read_token_files, with_checksums, write_token_files
from tidemark.llm.toxicity import toxicity
from tidemark.llm.warc import read_archives, write_archives
from tidemark.session import scratch_dir


def op1_paragraph_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without later copies of paragraphs; ``clusters`` lists the clusters that a document's paragraphs are in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeated_paragraphs(docs)
    clusters = found.groupBy(F.col("doc").alias("doc_id")).agg(F.array_sort(F.collect_set("cluster_id")).alias("clusters"))
    return without_copies(docs, found).join(clusters, "doc_id", "left").select(
        "doc_id", "n_words", "n_repeated", "n_removed", "clusters", "text")


def op2_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_epsilon_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


def op4_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, key="tidemark").select("doc_id", "n_entities", "text")


def op5_prefix_filtered_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_run_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", "text")


def op8_zstandard_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_id_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return with_checksums(read_token_files(spark, path))


def op10_bottom_k_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_multikey_quicksort_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_shrinkage_quadratic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; labels of the held-out rows are never read."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_parentheses_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with its subtree's counts."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_paragraph_minhash_dedup, op2_cost_balanced_packing, op3_epsilon_grid_order_join, op4_keyed_surrogates,
    op5_prefix_filtered_decontamination, op6_string_kernel_toxicity, op7_line_run_suffix_array, op8_zstandard_warc,
    op9_token_id_parquet, op10_bottom_k_near_duplicates, op11_multikey_quicksort_phrases,
    op12_shrinkage_quadratic_quality, op13_parentheses_prefix_trie)}
