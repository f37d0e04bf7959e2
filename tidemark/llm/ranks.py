"""Position of each row within its key, found without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import store
from tidemark.session import ship_package


def ranked(df: DataFrame, keys: list[str], order: list[Column], purpose: str) -> tuple[DataFrame, str]:
    """``df`` with ``pos`` (from 0 within equal ``keys``, in ``order``), written below the shared folder, and its path.

    Rows are dealt by ranges of keys and order, so a key of any size lies in as many tasks as it needs. Each task
    counts along its own rows; what earlier tasks hold of the same key is added after. At most one key of a task
    began before it, so these additions are at most one row per task, which bounds the broadcast. ``order`` should
    tell rows apart: rows equal in keys and order meet in one task. Null keys are keys.
    """
    spark = df.sparkSession
    ship_package(spark)
    names = df.columns
    places = [F.col(k).asc_nulls_first() for k in keys] + order
    dealt = df.repartitionByRange(*places).sortWithinPartitions(*places).select(
        *names, F.xxhash64(*keys).alias("_key"), F.spark_partition_id().cast("long").alias("_task"))
    schema = StructType([*dealt.schema.fields, StructField("_at", LongType())])

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        last, upto = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column("_key"))
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            ahead = np.zeros(len(starts), np.int64)
            if key[0] == last:
                ahead[0] = upto
            sizes = np.diff(np.append(starts, len(key)))
            at = np.arange(len(key)) - np.repeat(starts - ahead, sizes)
            last, upto = key[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=schema.names)

    counted, path = store(dealt.mapInArrow(count, schema), purpose)
    runs = counted.groupBy("_key", "_task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = runs.withColumn("ahead", F.sum("n").over(earlier)).where("ahead > 0").select("_key", "_task", "ahead")
    return counted.join(F.broadcast(shift), ["_key", "_task"], "left").select(
        *names, (F.col("_at") + F.coalesce("ahead", F.lit(0))).alias("pos")), path
