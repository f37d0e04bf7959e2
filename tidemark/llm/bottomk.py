"""Near-duplicate documents by bottom-k sketches of one hash function."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bucket_links import linked_components
from tidemark.llm.common import apart, binary, discard, small_batches, store
from tidemark.llm.hashing import SPACED, shingle_sets
from tidemark.session import ship_package

WIDTH = 4
PERCENT = 80
SKETCH, FINE_SKETCH = 48, 1024
BROADCAST_ROWS = 500_000


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_mark(text: str = "text"):
    """Tells rows that repeat a ``doc_id`` with other texts apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def _sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """Set size, a 128-bit fingerprint of the whole set and the k smallest values, per document."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = shingle_sets([t or b"" for t in binary(part.column(1))], SPACED, width)
                marks = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(marks[:, 0]), pa.array(marks[:, 1]),
                    pa.array([s[:k] for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "text_mark", "n_shingles", "mark1", "mark2", "sketch"])

    return _texts(docs).withColumn("text_mark", text_mark()).mapInArrow(
        run, "doc_id long, text_mark long, n_shingles long, mark1 long, mark2 long, sketch array<long>")


def _whole_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = shingle_sets([t or b"" for t in binary(part.column(1))], SPACED, width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["id", "whole"])

    return docs.mapInArrow(run, "id long, whole binary")


def _cut_sets(sets: DataFrame, k: int) -> DataFrame:
    """``id, n, sketch`` of stored sets, with the k smallest values of each."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            whole = [np.frombuffer(s, np.int64) for s in binary(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in whole], pa.int64()),
                                              pa.array([s[:k] for s in whole], pa.list_(pa.int64()))], names=["id", "n", "sketch"])

    return sets.mapInArrow(run, "id long, n long, sketch array<long>")


def least_shared(k: int, ratio: float) -> int:
    """Values that two sets at the threshold share among the k smallest of their union: six standard errors below the mean."""
    return max(1, math.floor(k * ratio - 6 * math.sqrt(k * ratio * (1 - ratio))))


def inverted_lists(sketches: DataFrame, k: int, percent: int) -> DataFrame:
    """``sketches(id, n, sketch)`` -> ``h, id, n, ahead, score``: lists of retained values that can hold a linked pair.

    Two linked sets share at least so many values of their sketches that they share one of the globally rarest
    ones of each (the prefix); a value that occurs once, and so the common part of otherwise different texts,
    makes no list. ``ahead`` counts the rarer values of the set, where it is known whole; ``score`` is the mean
    number of sketches that a value is in.
    """
    ratio = percent / 100
    values = sketches.select("id", "n", F.explode("sketch").alias("h"))
    often = values.groupBy("h").agg(F.count("*").alias("f")).where("f > 1").select(apart("h").alias("k"), "f")
    common = values.join(often, F.col("h") == F.col("k")).select("id", "n", "h", "f")
    per_set = Window.partitionBy("id", "n")
    kept = F.least("n", F.lit(k))
    need = F.ceil(F.col("n") * percent / 100)
    # A set too small to meet a cut sketch needs its exact overlap, any other what a cut sketch shares at least.
    need = F.when(F.col("n") < math.ceil(k * ratio), need).otherwise(F.least(need, F.lit(least_shared(k, ratio))))
    ranked = common.withColumn("place", F.row_number().over(per_set.orderBy("f", "h"))).withColumn(
        "single", kept - F.count("*").over(per_set)).withColumn("score", (F.sum("f").over(per_set) + F.col("single")) / kept)
    ahead = F.when(F.col("n") <= k, F.col("single") + F.col("place") - 1).otherwise(0).cast("long")
    chosen = ranked.where(F.col("place") + F.col("single") <= kept - need + 1)
    prefixes, _ = store(chosen.select("h", "id", "n", ahead.alias("ahead"), F.col("score").cast("double").alias("score")), "prefixes")
    several = prefixes.groupBy("h").agg(F.count("*").alias("f")).where("f > 1").select(apart("h").alias("k"))
    return prefixes.join(several, F.col("h") == F.col("k"), "left_semi")


def exact_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sets ``(id, whole)`` have 100 * intersection >= percent * union."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(binary(batch.column(2)), binary(batch.column(3))):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("id").alias(i), F.col("whole").alias(w)) for i, w in (("a", "x"), ("b", "y")))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = SKETCH, fine: int = FINE_SKETCH,
                    with_mark: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_shingles, component_id, kept``.

    A document's set holds its distinct shingles of ``width`` words (white-space separated, A-Z lowered); a
    shorter text is one shingle as a whole; without words the set is empty and linked with nothing. Documents
    are linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest ``doc_id``
    reachable. A null ``doc_id`` links with nothing and is kept. Where a ``doc_id`` repeats, each row has the
    component of its own text's class, and classes with one smallest id are one; ``with_mark`` adds ``text_mark``, which tells
    the texts of such rows apart.

    Equal sets are one class, found by grouping fingerprints. A class's sketch is its k smallest values under
    one hash function, the whole set if it has fewer. Inverted lists of retained values tell which classes can have
    a partner (``inverted_lists``; a linked pair at the threshold is missed with a chance of about 6e-9, the tail beyond six
    standard errors). For these the whole sets are taken, and finer sketches of ``fine`` values make
    the lists from which pairs come, so that texts that share a passage but no more do not meet. Pairs of a list
    are compared by ``linked_components``: sizes, then the estimate from the union of the sketches (with a margin of
    five standard errors on ``k`` values, which drops a linked pair at the threshold with a chance of about 3e-6), then the exact
    similarity of the whole sets.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with small_batches(spark):
        rows, labels, members = _settled(docs, width, percent, k, fine)
    out = _with_components(rows, members, labels)
    return out if with_mark else out.drop("text_mark")


def _settled(docs: DataFrame, width: int, percent: int, k: int, fine: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows with their sketches, components of linked classes, and members of classes."""
    spark, ratio = docs.sparkSession, percent / 100
    rows, _ = store(_sketches(docs, width, k), "sketches")
    marked = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = marked.groupBy("mark1", "mark2").agg(F.min("doc_id").alias("rep"))
    members, members_path = store(classes.select("mark1", "mark2", "rep"), "classes")
    heads = marked.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")

    lists, lists_path = store(inverted_lists(heads.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch"), k, percent), "lists")
    active, active_path = store(lists.select("id").distinct(), "active")
    small = active.count() <= BROADCAST_ROWS
    chosen = _texts(docs).withColumnRenamed("doc_id", "id").join(F.broadcast(active) if small else active, "id", "left_semi")
    sets, sets_path = store(_whole_sets(chosen, width), "sets")
    sketches = heads.select(F.col("doc_id").alias("id"), "sketch").join(F.broadcast(active) if small else active, "id", "left_semi")
    sketches, sketch_path = store(sketches, "active-sketches")
    margin = 5 * math.sqrt(ratio * (1 - ratio) / k)

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = (sketches.select(F.col("id").alias(i), F.col("sketch").alias(s)) for i, s in (("a", "s"), ("b", "t")))
        union = F.slice(F.array_sort(F.array_union("s", "t")), 1, k)
        share = F.size(F.array_intersect(F.array_intersect("s", "t"), union)) / F.size(union)
        hopeful = pairs.join(y, "b").join(x, "a").where(share >= ratio - margin).select("a", "b")
        return exact_links(hopeful, sets, percent)

    finer, finer_path = store(inverted_lists(_cut_sets(sets, fine), fine, percent), "fine-lists")
    labels = linked_components(finer, verify, ratio)
    discard(spark, lists_path, finer_path, active_path, sets_path, sketch_path)
    return rows, labels, members


def _with_components(rows: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with the component of its class; classes without a link have their representative's id."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("mark1").alias("m1"), F.col("mark2").alias("m2"), F.coalesce("component", "rep").alias("c"))
    named = named.select(apart("m1").alias("m1"), "m2", "c")
    joined = rows.join(named, (F.col("mark1") == F.col("m1")) & (F.col("mark2") == F.col("m2"))
                       & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("c", "doc_id")
    return joined.select("doc_id", "text_mark", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
