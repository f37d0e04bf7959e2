"""Corpus pipeline: toxicity, line dedup, near-duplicate groups, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bottomk import BROADCAST_ROWS, near_duplicates, text_mark
from tidemark.llm.common import apart, discard, small_batches, store, table
from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.line_runs import deduplicate_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.toxicity import score_texts, train, training_rows


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half. The model learns from the labelled rows of ``docs``.

    Null texts and texts without words have the score of the model's bias; every row is decided by its own text.
    The rows left are stored here, made from small batches, as whole rows go through the Python workers and back.
    """
    model = train(*training_rows(docs, table(spark, sf_dir, "labels")))
    score = "_toxicity"
    while score in docs.columns:
        score += "_"
    with small_batches(spark):
        return store(score_texts(docs, model, score).where(F.col(score) < 0.5).select(*docs.columns), "not-toxic")[0]


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document of which nothing is left goes."""
    left = deduplicate_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim("text") == "")
    own = [F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c)
           if c == "n_chars" else F.col(c) for c in docs.columns]
    return left.where(~F.coalesce(emptied, F.lit(False))).select(*own)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, 0.8): the one of smallest id, then of smallest text hash.

    Where an id repeats, each row stands for its own text; of rows equal in id and text one stays. Rows without words or without
    an id are in no group and stay.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_mark().alias("text_mark"), F.col("text").cast("string").alias("text"))
    texts, first = store(own.where("doc_id IS NOT NULL").groupBy("doc_id", "text_mark").agg(F.count("*").alias("n")), "texts")
    sized = lambda df, rows: F.broadcast(df) if rows <= BROADCAST_ROWS else df
    # further texts of one id get numbers of their own, below all ids
    several = texts.groupBy("doc_id").agg(F.min("text_mark").alias("least"), F.count("*").alias("texts")).where("texts > 1")
    lowest = min(0, texts.agg(F.min("doc_id")).first()[0] or 0)
    extra, second = store(texts.join(several, "doc_id").where("text_mark > least").select(
        "doc_id", "text_mark", (F.lit(lowest - 1) - F.monotonically_increasing_id()).alias("number")), "further-texts")
    n_extra = extra.count()
    if n_extra:
        numbered = own.join(sized(extra, n_extra), ["doc_id", "text_mark"], "left").select(F.coalesce("number", "doc_id").alias("doc_id"), "text")
    else:
        numbered = own.select("doc_id", "text")
    found = near_duplicates(numbered, width=5, with_mark=True).where("n_shingles > 0 AND doc_id IS NOT NULL")
    if n_extra:
        back = extra.select("number", F.col("doc_id").alias("id"))
        found = found.join(sized(back, n_extra), F.col("doc_id") == F.col("number"), "left").withColumn("doc_id", F.coalesce("id", "doc_id"))
    found, third = store(found.select("doc_id", "text_mark", "component_id").distinct(), "near-groups")
    heads = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_mark")).alias("head")).select(apart("component_id").alias("c"), "head")
    decided = found.join(heads, F.col("component_id") == F.col("c")).join(texts, ["doc_id", "text_mark"]).select(
        "doc_id", "text_mark", "n", (F.struct("doc_id", "text_mark") == F.col("head")).alias("stays"))
    changed, _ = store(decided.where("NOT stays OR n > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_mark").alias("_mark"), "stays"), "near-copies")
    discard(spark, first, second, third)
    rows = changed.count()
    marked = docs.withColumn("_row_mark", text_mark())
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_row_mark") == F.col("_mark"))
    kept = marked.join(sized(changed, rows), same, "left_anti").select(*docs.columns)
    again = changed.where("stays")
    n_again = again.count()
    if not n_again:
        return kept
    one = marked.join(sized(again, n_again), same, "left_semi").dropDuplicates(["doc_id", "_row_mark"])
    return kept.unionByName(one.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item of five words or more; null texts stay, repeated rows are treated alike.

    They are stored here, made from small batches, as in ``toxicity``.
    """
    with small_batches(spark):
        return store(without_contaminated(docs, table(spark, sf_dir, "benchmark")), "uncontaminated")[0]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left in sequences of 1024 tokens: a row per piece. Null texts are empty, repeated rows are packed each.

    The pieces are stored here, made from small batches: executors that ran the other stages have little memory left.
    """
    with small_batches(spark):
        return store(pack_documents(docs), "packed")[0]


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("near duplicates", near_duplicate_groups),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL expresses neither the classifier nor the tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
