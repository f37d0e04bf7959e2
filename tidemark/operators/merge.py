"""Keyed merge (upsert) and positional write-back as plain DataFrame plans.

Row order is a column, ``_pos``. The position of each key's first row is found by an
aggregation; existing rows are then matched on position and key together. So a key
repeated any number of times, in the table or in the batch, never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import upsert_key

APPEND, UPDATE, UNCHANGED = "append", "update", "unchanged"


def _key(keys: Sequence[str]) -> Column:
    return F.array(*[upsert_key(F.col(f"`{k}`")) for k in keys])


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_key`` (array of key parts) and drop rows whose parts are all blank."""
    return df.withColumn("_key", _key(keys)).filter(F.exists("_key", lambda p: p != ""))


def last_of_batch(batch: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """One row per key: the values of its last record and the place of its first (``_first``)."""
    values = [c for c in batch.columns if c != seq]
    packed = F.struct(F.col(seq).alias("_seq"), *[F.col(f"`{c}`") for c in values])
    return (with_key(batch, keys).groupBy("_key")
            .agg(F.max(packed).alias("_new"), F.min(F.col(seq)).alias("_first")))


def _same(a: Column, b: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):  # blank and null are the same cell
        return F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))
    return a.eqNullSafe(b)


def plan_upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """The table after the merge, with ``_action`` per row.

    ``existing`` carries ``_pos``; ``batch`` carries ``seq``, the place in the batch (0 or
    more). New rows go after the last row, ordered by ``seq``; positions may have gaps. The first existing row of a
    key is its target, the last batch record of a key wins, columns absent from the batch
    keep their values, a null in the batch blanks the cell, and new keys are appended in
    first-seen order. Applying a batch twice changes nothing the second time.
    """
    types = {f.name: f.dataType for f in existing.schema.fields if f.name != "_pos"}
    incoming = [c for c in batch.columns if c != seq]
    added = {f.name: f.dataType for f in batch.schema.fields if f.name not in types and f.name != seq}
    header = {**types, **added}

    new = last_of_batch(batch, keys, seq)
    # only keys and positions of the table take part in finding the targets
    targets = with_key(existing.select(*keys, "_pos"), keys).groupBy("_key").agg(F.min("_pos").alias("_pos"))
    matched = new.join(targets, "_key", "left")

    # one outer join gives kept, updated and new rows, so the batch is reduced and exchanged once; new ones have no position
    old = lambda c: F.col(f"`{c}`") if c in types else F.lit(None).cast(header[c])
    fresh = lambda c: F.col(f"_new.`{c}`").cast(header[c])
    hit = F.col("_new").isNotNull()
    added_row = hit & F.col("_pos").isNull()
    changed = F.lit(False)
    for c in incoming:
        changed = changed | ~_same(old(c), fresh(c), header[c])
    last_pos = existing.agg(F.coalesce(F.max("_pos"), F.lit(-1)).alias("p")).scalar()
    return existing.withColumn("_key", _key(keys)).join(matched, ["_pos", "_key"], "full_outer").select(
        *[(F.when(hit, fresh(c)).otherwise(old(c)) if c in incoming else old(c)).alias(c) for c in header],
        F.when(added_row, last_pos + 1 + F.col("_first")).otherwise(F.col("_pos")).cast("bigint").alias("_pos"),
        F.when(added_row, APPEND).when(hit & changed, UPDATE).otherwise(UNCHANGED).alias("_action"))


def upsert_stats(plan: DataFrame) -> DataFrame:
    return plan.groupBy("_action").agg(F.count("*").alias("rows"))


def write_back(existing: DataFrame, new_values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Same rows, order and extra columns; only ``columns`` replaced, matched by ``_pos``."""
    renamed = new_values.select("_pos", F.lit(True).alias("_hit"),
                                *[F.col(f"`{c}`").alias(f"_v_{c}") for c in columns])
    joined = existing.join(renamed, "_pos", "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"`_v_{c}`")).otherwise(F.col(f"`{c}`")).alias(c) if c in columns
        else F.col(f"`{c}`") for c in existing.columns])
