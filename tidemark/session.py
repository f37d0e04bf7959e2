"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # An overwrite replaces the whole table; sources.tables rewrites single months by itself.
    "spark.sql.sources.partitionOverwriteMode": "static",
}

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above. The cluster's own settings win for anything not listed."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it gets a temporary
    folder of this machine, which on a cluster the executors could not see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_scratch.setdefault(
            spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="tidemark-"))
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    For a costly result that several branches of a plan use: it is computed once, its
    lineage ends there, and the loss of an executor costs no recomputation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def written(df: DataFrame, purpose: str):
    """``df`` in the shared scratch folder while the block runs: it stands whatever becomes of the tables it was made from."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: tasks import its walkers."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark_package")
    context.addPyFile(shutil.make_archive(target, "zip", root, "tidemark"))
    _shipped.add(context.applicationId)
