"""Repeat loads as a stream of dropped files, merged batch by batch.

There is no watermark on purpose: rows of any age may arrive and are merged by key.
A replayed micro-batch changes nothing, since the merge is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import blank
from tidemark.operators.series import carried, series_metrics
from tidemark.operators.trend import TrendLimits, card_label, group_scopes, trend_rows
from tidemark.schemas import CARD_HISTORY, GROUP_HISTORY, INDEX_HISTORY, INDEX_STATE, TREND, Table
from tidemark.session import written
from tidemark.sources.tables import finish_move, month, read_table, upsert_table


def stream_upsert(stream: DataFrame, path: str, table: Table, checkpoint: str,
                  to_batch: Callable[[DataFrame], DataFrame] = lambda df: df,
                  after: Callable[[DataFrame], None] | None = None, seq: str = "seq") -> StreamingQuery:
    """Merge every available micro-batch of ``stream`` into ``table`` and stop.

    ``to_batch`` turns raw rows into table rows with ``seq``; ``after`` runs on the
    merged batch, e.g. to refresh what depends on it.
    """

    def merge(df: DataFrame, _batch_id: int) -> None:
        batch = to_batch(df).persist()
        try:
            if upsert_table(df.sparkSession, path, batch, table, seq) and after is not None:
                after(batch)
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def add_batch(state: DataFrame, partial: DataFrame, batch_id: int) -> DataFrame:
    """State rows (``INDEX_STATE``) of the keys of a batch, after it.

    ``partial``: date, index_type, total, points of the batch alone. What the last batch gave is kept apart from what all
    earlier ones gave, so a batch that is applied twice replaces its own part and adds nothing.
    """
    keys = ["date", "index_type"]
    again = F.col("last_batch") == batch_id
    zero = F.lit(0).cast("bigint")
    earlier = lambda base, last: F.coalesce(F.when(again, F.col(base)).otherwise(F.col(base) + F.col(last)), zero)
    return partial.join(state.select(*INDEX_STATE.schema.names), keys, "left").select(
        *keys, earlier("base_total", "last_total").alias("base_total"), earlier("base_points", "last_points").alias("base_points"),
        F.lit(batch_id).cast("bigint").alias("last_batch"), F.col("total").alias("last_total"), F.col("points").alias("last_points"))


def daily_means(state: DataFrame) -> DataFrame:
    """Mean of each key and day of a state, in whole units."""
    return state.select("date", "index_type", F.expr(
        "(base_total + last_total) div (base_points + last_points)").cast("double").alias("value"))


def stream_daily_means(stream: DataFrame, state_path: str, history_path: str, checkpoint: str,
                       after: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Keep the index history of a stream of raw points ``date, index_type, amount`` (whole units) and stop when all is read.

    A day's points may come in any number of files and batches, in any order. Each batch reads and rewrites only the
    months it touches; ``after`` gets the history rows that it changed.
    """

    def merge(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        partial = df.filter(F.col("date").isNotNull() & F.col("amount").isNotNull()).groupBy("date", "index_type").agg(
            F.sum("amount").alias("total"), F.count("*").alias("points")).persist()
        try:
            months = [r[0] for r in partial.select(month("date")).distinct().collect()]
            if not months:
                return
            finish_move(spark, state_path)
            added = add_batch(read_table(spark, state_path, INDEX_STATE, months), partial, batch_id)
            with written(added.withColumn("seq", F.monotonically_increasing_id()), "state") as state:
                upsert_table(spark, state_path, state, INDEX_STATE)
                rows = daily_means(state).withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn(
                    "seq", F.monotonically_increasing_id())
                upsert_table(spark, history_path, rows, INDEX_HISTORY)
                if after is not None:
                    after(rows)
        finally:
            partial.unpersist()

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def refresh_index_trends(spark: SparkSession, history_path: str, trend_path: str, batch: DataFrame,
                         as_of: Column | str, limits: TrendLimits = TrendLimits()) -> None:
    """Recompute the trend rows of the index types a batch touched, and no others."""
    kind = F.coalesce(F.nullif(blank("index_type"), F.lit("")), F.lit("unknown"))
    touched = batch.select(kind.alias("key")).distinct()
    history = read_table(spark, history_path, INDEX_HISTORY).withColumn("key", kind).join(touched, "key", "left_semi")
    points = history.select(
        F.lit("index").alias("scope"), "key", "date",
        F.col("value").alias("price"), F.lit(None).cast("bigint").alias("trade_count"))
    _merge_trends(spark, points, trend_path, as_of, limits)


def refresh_card_trends(spark: SparkSession, history_path: str, trend_path: str, batch: DataFrame,
                        as_of: Column | str, limits: TrendLimits = TrendLimits()) -> None:
    """Recompute the trend rows of the card series a batch touched, and no others."""
    # one text is the key of the join, the metrics and the labels, so history is exchanged once for each use
    key = F.concat("card_id", F.lit("|"), blank("condition"))
    touched = batch.select(key.alias("key")).distinct()
    history = (read_table(spark, history_path, CARD_HISTORY).withColumn("key", key).withColumn("condition", blank("condition"))
               .join(touched, "key", "left_semi"))
    points = history.select(
        F.lit("card").alias("scope"), "key", "date", F.col("price").cast("double").alias("price"), "trade_count")
    # rows are for people as well: the label goes with them, else the merge would replace it by the key
    labels = carried(history.withColumnRenamed("_pos", "seq"), ["key", "condition"], ["card_name", "hinban"], ["date", "seq"]).select(
        "key", card_label(F.col("card_name"), F.col("hinban"), F.col("condition")).alias("label"))
    _merge_trends(spark, points, trend_path, as_of, limits, labels)


def refresh_group_trends(spark: SparkSession, history_path: str, group_path: str, trend_path: str, batch: DataFrame,
                         as_of: Column | str, limits: TrendLimits = TrendLimits()) -> None:
    """Renew the group series on the days a batch touched, and the trend rows of the groups that changed.

    Only those days are aggregated again, from their months of the card history, so the result does not depend on how often a
    batch is applied. A group that has left a day keeps it without a price. Trends read the group series, which is small.
    """
    days = batch.select("date").filter(F.col("date").isNotNull()).distinct()
    months = [r[0] for r in days.select(month("date")).distinct().collect()]
    if not months:
        return
    cards = read_table(spark, history_path, CARD_HISTORY, months).filter(blank("card_id") != "")
    # days are few whatever the size of the batch, so the history stays where it is
    fresh = group_scopes(cards.join(F.broadcast(days), "date", "left_semi"))
    keys = ["date", "scope", "key"]
    stored = read_table(spark, group_path, GROUP_HISTORY, months).join(F.broadcast(days), "date", "left_semi").select(*keys).distinct()
    # the outer join takes the history once; a stored group without a fresh row has no price
    rows = stored.join(fresh.select(*keys, "price", "trade_count"), keys, "full_outer").withColumn("seq", F.monotonically_increasing_id())
    with written(rows, "groups") as changed:
        upsert_table(spark, group_path, changed, GROUP_HISTORY)
        touched = changed.select("scope", "key").distinct()
        points = read_table(spark, group_path, GROUP_HISTORY).filter(F.col("price").isNotNull()).join(
            touched, ["scope", "key"], "left_semi").select("scope", "key", "date", "price", "trade_count")
        _merge_trends(spark, points, trend_path, as_of, limits)


def _merge_trends(spark, points, trend_path, as_of, limits, labels=None) -> None:
    # the history is keyed by date, so the metrics need a single shuffle
    metrics = series_metrics(points, ["scope", "key"], unique_dates=True)
    if labels is not None:
        metrics = metrics.join(labels, "key", "left")
    rows = trend_rows(metrics, as_of, limits, F.current_timestamp()).withColumn("seq", F.monotonically_increasing_id())
    rows = rows.persist()  # the merge looks at its batch more than once
    try:
        upsert_table(spark, trend_path, rows, TREND)
    finally:
        rows.unpersist()
