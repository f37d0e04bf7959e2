"""Helpers shared by the operators: tables, scratch tables, join keys, connected components."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared scratch folder and read back, and its path.

    Cuts the lineage in a way that survives lost executors; ``discard`` removes it when it is superseded.
    Shuffle files of earlier queries that nothing refers to any more go first: Spark removes them only when the driver
    collects garbage, which it is asked to do here.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    spark._jvm.System.gc()
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Arrow batches of at most ``rows`` rows for the jobs of the block: wide rows, such as whole sets, take little memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def apart(key: str | Column) -> Column:
    """A long key as an equal-valued expression.

    Joining an aggregate on it makes Spark exchange the aggregate anew, so both sides of the join come
    straight from an exchange and adaptive execution can split a hot key of the other side.
    """
    return (F.col(key) if isinstance(key, str) else key).bitwiseXOR(F.lit(0).cast("long"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, component)``: smallest node reachable, for every node with a link.

    Alternates large-star and small-star steps (Kiveris et al. 2014) until only stars are left. Every step is an
    aggregation that combines before its shuffle and a join whose hot nodes adaptive execution can split, so
    a component of any size is spread over tasks; each round ends in a scratch table.
    Loops, nulls and repeated links are ignored; no links give an empty table.
    """
    spark = edges.sparkSession
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    start = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links, path = store(start, "links")
    while not _only_stars(links):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            apart("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v")
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("k"), "m")
        small = large.join(low, F.col("u") == F.col("k")).select("u", "v", "m").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        after, where = store(small.where("u > v").distinct(), "links")
        discard(spark, path)
        links, path = after, where
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _only_stars(links: DataFrame) -> bool:
    """Whether every larger node has one link and no smaller node is a larger one: then smaller nodes are the roots."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    row = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(
        F.max("up").alias("most"), F.max(F.when(F.col("up") > 0, F.col("down"))).alias("chain")).first()
    return (row["most"] or 0) <= 1 and not row["chain"]


def binary(column) -> list:
    """Values of an Arrow text or binary column as bytes, without decoding."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return column.cast(kind).to_pylist() if column.type != kind else column.to_pylist()
