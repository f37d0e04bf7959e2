"""Parquet tables: header-tolerant reads, snapshots and crash-safe keyed merges.

A write never overwrites what it reads. The new data is completed in a staging folder
next to the table and then moved in, partition by partition for dated tables. If the
driver dies in between, the next call finishes the move from the staging folder, and
since the merge is idempotent a repeated batch does no harm. A read takes what is complete
in the staging folder before what it replaces, so at no moment of a move is a table empty
or half old. One writer per table.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import blank
from tidemark.operators.merge import plan_upsert
from tidemark.schemas import Table

PARTITION = "_month"
HEADER = "_header.json"


# --- files ------------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def _staging(path: str) -> str:
    return path.rstrip("/") + "__staged"


def _write_header(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """The table's columns, like the header row of a sheet: reads need no file footers."""
    fs, p = _fs(spark, f"{path}/{HEADER}")
    out = fs.create(p, True)
    out.write(bytearray(schema.json().encode("utf-8")))
    out.close()


def _read_header(spark: SparkSession, path: str) -> T.StructType | None:
    if not path_exists(spark, f"{path}/{HEADER}"):
        return None
    fs, p = _fs(spark, f"{path}/{HEADER}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return T.StructType.fromJson(json.loads(text))


def finish_move(spark: SparkSession, path: str) -> None:
    """Move a completed staging folder in; also the recovery after a crash."""
    staged = _staging(path)
    if path_exists(spark, f"{staged}/_SUCCESS") and path_exists(spark, f"{staged}/{HEADER}"):
        header = _read_header(spark, staged)
        if PARTITION in header.names:
            fs, p = _fs(spark, staged)
            for status in fs.listStatus(p):
                if status.isDirectory():
                    name = status.getPath().getName()
                    _replace(spark, f"{staged}/{name}", f"{path}/{name}")
            _write_header(spark, path, header)
        else:
            _replace(spark, staged, path)
    _delete(spark, staged)


def _stage(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Complete the new data next to the table. The header, written last, marks it complete."""
    staged = _staging(path)
    _delete(spark, staged)
    if PARTITION in df.columns:
        # rebalance splits a month that is too big for one task and merges small ones
        df.hint("rebalance", PARTITION).write.partitionBy(PARTITION).parquet(staged)
    else:
        df.hint("rebalance").write.parquet(staged)
    _write_header(spark, staged, df.schema)


# --- reads ------------------------------------------------------------------
def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name: existing ones in place, missing required ones as nulls before ``_pos``."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    present = [c for c in df.columns if c != "_pos"]
    return df.select(*[F.col(f"`{c}`") for c in present],
                     *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing],
                     *[c for c in df.columns if c == "_pos"])


def _months_in(spark: SparkSession, path: str) -> list[str]:
    """Months that a dated table's folder holds, by its listing."""
    fs, p = _fs(spark, path)
    head = PARTITION + "="
    names = [status.getPath().getName() for status in fs.listStatus(p) if status.isDirectory()] if fs.exists(p) else []
    return sorted(n[len(head):] for n in names if n.startswith(head))


def _sources(spark: SparkSession, path: str) -> tuple[T.StructType | None, list[tuple[str, list[str] | None]]]:
    """The table's columns and the folders it is in just now, with the months to take from each (None: not dated).

    A staging folder counts once its header, written last, is there; what it holds is newer than the table's.
    """
    staged = _staging(path)
    complete = path_exists(spark, f"{staged}/_SUCCESS") and path_exists(spark, f"{staged}/{HEADER}")
    header = _read_header(spark, staged) if complete else _read_header(spark, path)
    if complete and PARTITION not in header.names:
        return header, [(staged, None)]
    if not path_exists(spark, path) and not complete:
        return None, []
    if header is not None and PARTITION not in header.names:
        return header, [(path, None)]
    newer = _months_in(spark, staged) if complete else []
    older = [m for m in _months_in(spark, path) if m not in newer]
    return header, [(folder, months) for folder, months in ((path, older), (staged, newer)) if months]


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Months of a dated table, in order."""
    return sorted(m for _, months in _sources(spark, path)[1] for m in months or ())


def _read(spark: SparkSession, path: str, table: Table, months: Sequence[str] | None = None) -> DataFrame:
    header, folders = _sources(spark, path)
    if not folders:
        # known to be empty when planned: joins with it go, and no task runs for it
        fields = [*table.schema.fields, T.StructField("_pos", T.LongType())]
        return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    reader = spark.read if header is None else spark.read.schema(header)
    parts = []
    for folder, held in folders:
        stored = reader.parquet(folder)
        if held is not None:
            if months is not None or len(folders) > 1:
                stored = stored.filter(F.col(PARTITION).isin([m for m in held if months is None or m in months]))
            stored = stored.drop(PARTITION)
        parts.append(align(stored, table.schema))
    return functools.reduce(DataFrame.unionByName, parts)


def read_table(spark: SparkSession, path: str, table: Table, months: Sequence[str] | None = None) -> DataFrame:
    """A stored table by header name, or an empty one with its schema if nothing was written yet.

    ``months`` (yyyy-MM) of a dated table reads those partitions only.
    """
    return _read(spark, path, table, months)


def load_watchlist(spark: SparkSession, stored: DataFrame, seed_path: str | None = None) -> DataFrame:
    """Stored rows that name a card; the seed file (tab separated) only if there are none."""
    named = stored.filter((blank("品番") != "") | (blank("名前") != "") | (blank("card_id") != ""))
    if seed_path is None or not named.isEmpty() or not path_exists(spark, seed_path):
        return named
    seed = spark.read.csv(seed_path, sep="\t", header=True, encoding="UTF-8")
    wanted = T.StructType([f for f in stored.schema.fields if f.name != "_pos"])
    return align(seed, wanted).filter((blank("品番") != "") | (blank("名前") != ""))


# --- writes -----------------------------------------------------------------
def dry_run(df: DataFrame, n: int = 5) -> DataFrame:
    """A sample of what would be written; nothing is."""
    return df.limit(n)


def write_snapshot(df: DataFrame, path: str, stamp_column: str, load_time: Column) -> bool:
    """Replace a table by ``df`` with one load time on all rows. An empty ``df`` leaves it untouched.

    ``load_time`` should be a literal: one instant for the whole load.
    """
    spark = df.sparkSession
    finish_move(spark, path)
    _stage(spark, df.withColumn(stamp_column, load_time), path)
    if spark.read.parquet(_staging(path)).isEmpty():
        _delete(spark, _staging(path))
        return False
    finish_move(spark, path)
    return True


def month(column: str | Column) -> Column:
    """Partition of a date."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit("none"))


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, table: Table, seq: str = "seq") -> bool:
    """Merge a batch into a stored table; history is never truncated. False for an empty batch.

    Dated tables are partitioned by month, and only months the batch touches are read
    and rewritten. ``batch`` is used more than once: persist it if it is costly.
    """
    finish_move(spark, path)
    if table.dated_by is None:
        if batch.isEmpty():
            return False
        merged = plan_upsert(_read(spark, path, table), batch, table.key, seq).drop("_action")
    else:
        # one value per month of dates: small whatever the size of the batch
        months = [r[0] for r in batch.select(month(table.dated_by)).distinct().collect()]
        if not months:
            return False
        merged = (plan_upsert(_read(spark, path, table, months), batch, table.key, seq).drop("_action")
                  .withColumn(PARTITION, month(table.dated_by)))
    _stage(spark, merged, path)
    finish_move(spark, path)
    return True
