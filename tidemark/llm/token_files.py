"""Token ids in Parquet: list columns with chosen encodings, row groups and page indexes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder, tokenizer_path
from tidemark.session import ship_package

ROWS = "doc_id long, n_tokens long, before long, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end: int = 2) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_tokens, before, ids``; ``before`` counts the ids of earlier rows of the task."""
    ship_package(docs.sparkSession)
    path = tokenizer or tokenizer_path()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode, before, last = encoder(path), 0, np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 200):
                raws = [raw + last for raw in encode(texts.slice(at, 200).to_pylist())]
                sizes = np.array([len(r) // 4 for r in raws], dtype=np.int64)
                ends = np.cumsum(sizes)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                               pa.array(np.frombuffer(b"".join(raws), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [names.slice(at, 200), pa.array(sizes), pa.array(before + ends - sizes), ids],
                    names=["doc_id", "n_tokens", "before", "ids"])
                before += int(ends[-1])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(run, ROWS)


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = 2,
                      row_group_bytes: int = 16 << 20, page_rows: int = 200, delta: bool = False) -> None:
    """Writes the ids of ``docs`` as Parquet files in ascending ``doc_id`` order.

    Texts, not ids, are range-partitioned: they are smaller. File names follow the partitions, so the order of
    names is the order of documents; null ids come first, repeated ones in the order of their texts. Every
    file has row groups of about ``row_group_bytes`` and pages of at most ``page_rows`` rows with column and
    offset indexes, so that a filter on ``doc_id`` reads only its pages, and metadata is read without ids.
    Ids are dictionary-encoded (two bytes and less for a vocabulary of 50,000), or by
    ``delta`` as packed differences. Extra columns are dropped; an empty table gives files without rows.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tie = F.xxhash64("text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = columns.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    writer = encode_documents(ordered, tokenizer, end).write.option("compression", "zstd")
    writer = (writer.option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", page_rows)
              .option("parquet.enable.dictionary", str(not delta).lower())
              .option("parquet.dictionary.page.size", 4 << 20)
              .option("parquet.writer.version", "PARQUET_2_0"))
    writer.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of files by ``write_token_files``.

    ``start`` counts the ids of all documents before: the file's running count plus the totals of the files
    before it, of which there is one row per file.
    """
    ship_package(spark)
    rows = spark.read.schema(ROWS).parquet(path).withColumn("file", F.col("_metadata.file_name"))
    return rows.select("doc_id", "n_tokens", "before", "ids", "file").join(
        F.broadcast(_file_starts(rows)), "file").select(
        "doc_id", (F.col("file_start") + F.col("before")).alias("start"), "n_tokens", "ids")


def _file_starts(rows: DataFrame) -> DataFrame:
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).cast("long").alias("file_start"))


def with_checksums(tokens: DataFrame) -> DataFrame:
    """Adds ``ids_crc32``, the unsigned checksum of the ids as little-endian unsigned 32-bit integers, and drops the ids."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("ids")
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            cuts = ids.offsets.to_numpy()
            raw = memoryview(flat).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    ship_package(tokens.sparkSession)
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
