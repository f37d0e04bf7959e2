"""Trend classes, trend rows over four scopes, the status board and reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.numbers import fmt, stamp
from tidemark.functions.text import blank, set_of_code, trend_urgency
from tidemark.operators.series import carried, dedup_last, observed_points, series_metrics


@dataclass(frozen=True)
class TrendLimits:
    """Falls are flagged easily, rises reluctantly: a missed fall costs more."""

    down_d3: float = V.DOWN_D3
    down_streak: int = V.DOWN_STREAK
    up_d3: float = V.UP_D3
    up_streak: int = V.UP_STREAK
    min_valid_days: int = V.MIN_VALID_DAYS
    buffer_multiplier: float = V.BUFFER_MULTIPLIER

    @property
    def required_days(self) -> int:
        return max(V.MIN_VALID_DAYS, self.min_valid_days)


def classify_trend(limits: TrendLimits = TrendLimits()) -> Column:
    """Class from the metric columns: a fall needs d3 and one more sign, a rise all three."""
    d3, ma5, ma20, streak = (F.col(c) for c in ("d3", "ma5", "ma20", "streak"))
    ma_falls = F.coalesce(ma5 < ma20, F.lit(False))
    ma_rises = F.coalesce(ma5 > ma20, F.lit(False))
    undecided = (F.col("valid_days") < limits.required_days) | d3.isNull()
    return (F.when(undecided, V.UNDECIDED)
            .when((d3 < limits.down_d3) & (ma_falls | (streak <= limits.down_streak)), V.DOWN)
            .when((d3 > limits.up_d3) & ma_rises & (streak >= limits.up_streak), V.UP)
            .otherwise(V.FLAT))


def suggested_buffer(limits: TrendLimits = TrendLimits()) -> Column:
    """Twice the mean daily fall, for falling series only; unrounded (see ``export_trend``)."""
    return F.when((F.col("trend") == V.DOWN) & (F.col("avg_down") > 0),
                  F.col("avg_down") * limits.buffer_multiplier)


def with_trend(metrics: DataFrame, limits: TrendLimits = TrendLimits()) -> DataFrame:
    return (metrics.withColumn("trend", classify_trend(limits))
            .withColumn("suggested_buffer_pct", suggested_buffer(limits)))


TREND_COLUMNS = ["date", "scope", "key", "label", "d1", "d3", "d7", "ma5", "ma20", "streak", "vol20",
                 "valid_days", "trend", "suggested_buffer_pct", "imputation_basis"]


def trend_rows(metrics: DataFrame, as_of: Column | str, limits: TrendLimits = TrendLimits(),
               fetched_at: Column | None = None) -> DataFrame:
    """Rows of the trend table from metrics keyed by (scope, key) with an optional label.

    ``date`` is the last valid day, or ``as_of`` for a series without one. ``key``
    stays mechanical, ``label`` is for people.
    """
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    label = F.col("label") if "label" in metrics.columns else F.col("key")
    out = (with_trend(metrics, limits)
           .withColumn("date", F.coalesce("last_date", as_of))
           .withColumn("label", F.coalesce(F.nullif(label, F.lit("")), F.col("key")))
           .select(*TREND_COLUMNS))
    return out if fetched_at is None else out.withColumn("fetched_at", fetched_at)


def card_label(name: Column, code: Column, condition: Column) -> Column:
    """Name, [code] and condition, blanks left out."""
    bracketed = F.when(blank(code) != "", F.concat(F.lit("["), code, F.lit("]")))
    return F.concat_ws(" ", F.nullif(blank(name), F.lit("")), bracketed,
                       F.nullif(blank(condition), F.lit("")))


def group_scopes(cards: DataFrame) -> DataFrame:
    """Series of both group scopes (condition, set) from one pass over the history.

    Grouping sets expand each row twice but combine before the shuffle, so what
    moves is one row per group and date and task.
    """
    rows = (cards.select(
        F.nullif(blank("condition"), F.lit("")).alias("condition"),
        F.nullif(set_of_code("hinban"), F.lit("")).alias("card_set"),
        "date", F.col("price").cast("double").alias("price"), "trade_count")
        .filter(F.col("date").isNotNull() & F.col("price").isNotNull()
                & (F.col("trade_count").isNull() | (F.col("trade_count") > 0))))
    condition, card_set, date = F.col("condition"), F.col("card_set"), F.col("date")
    sets = rows.groupingSets([[condition, date], [card_set, date]], condition, card_set, date).agg(
        F.grouping("condition").alias("_by_set"),
        F.avg("price").alias("price"),
        F.sum(F.coalesce(F.col("trade_count"), F.lit(1))).cast("bigint").alias("trade_count"))
    name = F.when(F.col("_by_set") == 0, F.concat(F.lit("condition:"), "condition")).otherwise(
        F.concat(F.lit("set:"), "card_set"))
    return (sets.select(F.lit("group").alias("scope"), name.alias("key"), "date", "price", "trade_count")
            .filter(F.col("key").isNotNull()))


def trend_all_scopes(index: DataFrame, cards: DataFrame, as_of: Column | str,
                     limits: TrendLimits = TrendLimits(), seq: Sequence[str] = ("seq",),
                     unique_dates: bool = False) -> DataFrame:
    """Trend rows of index, card and both group scopes, computed as one set of series.

    ``index``: index_type, date, value (+ seq); ``cards``: card_id, condition, date,
    price, trade_count, card_name, hinban (+ seq).
    """
    seq = list(seq)
    place = [c for c in seq if c != "date"]  # what of the order is not selected anyway
    cards = cards.filter(blank("card_id") != "")
    no_count = F.lit(None).cast("bigint")
    kind = F.coalesce(F.nullif(blank("index_type"), F.lit("")), F.lit("unknown"))
    index_pts = index.select(
        F.lit("index").alias("scope"), kind.alias("key"), "date",
        F.col("value").cast("double").alias("price"), no_count.alias("trade_count"), *place)
    card_key = F.concat("card_id", F.lit("|"), blank("condition"))
    card_pts = cards.select(
        F.lit("card").alias("scope"), card_key.alias("key"), "date",
        F.col("price").cast("double").alias("price"), F.col("trade_count").cast("bigint"), *place)
    keys = ["key", "scope"]  # the varied column first: sorting compares its prefix
    raw = observed_points(index_pts.unionByName(card_pts), keys, keep_keys=True)
    if not unique_dates:
        # one row per date first: the group scopes below are unique by construction
        raw = dedup_last(raw, keys, seq)
    points = (raw.select(*keys, "date", "price", "trade_count").unionByName(group_scopes(cards)))
    metrics = series_metrics(points, keys, unique_dates=True)
    labels = (carried(cards.withColumn("key", card_key), ["key", "condition"], ["card_name", "hinban"], seq)
              .select(F.lit("card").alias("scope"), "key",
                      card_label(F.col("card_name"), F.col("hinban"), F.col("condition")).alias("label")))
    return trend_rows(metrics.join(labels, keys, "left"), as_of, limits)


def trend_summary(trends: DataFrame) -> DataFrame:
    """Series per class with the bases they were judged on."""
    return trends.groupBy("trend").agg(
        F.count("*").alias("series"),
        F.count_if(F.col("imputation_basis") == V.BASIS_REPEAT).alias("on_price_repeat"),
        F.array_join(F.array_sort(F.collect_set("imputation_basis")), ",").alias("bases"))


def worst_falls(trends: DataFrame, n: int = V.WORST_FALLS) -> DataFrame:
    """The ``n`` falling series with the lowest d3 (as shown, to two places)."""
    return (trends.filter(F.col("trend") == V.DOWN)
            .orderBy(F.round(F.coalesce("d3", F.lit(0.0)), 2), "scope", "key").limit(n))


def status_board(cards: DataFrame, limits: TrendLimits = TrendLimits(), watched: DataFrame | None = None,
                 seq: Sequence[str] = ("seq",), unique_dates: bool = False,
                 updated_at: Column | None = None) -> DataFrame:
    """One row per card and condition. ``watched`` (card_id) restricts; an empty one yields nothing."""
    cards = cards.filter(blank("card_id") != "")
    if watched is not None:
        cards = cards.join(watched.select("card_id").distinct(), "card_id", "left_semi")
    cards = cards.withColumn("condition", blank("condition"))
    keys = ["card_id", "condition"]
    usable = observed_points(cards, keys)
    m = with_trend(series_metrics(usable, keys, seq, unique_dates, trail=V.TRAIL_DAYS), limits)
    names = carried(cards, ["card_id"], ["card_name", "hinban"], seq)
    board = m.join(names, "card_id", "left").select(
        blank("hinban").alias("品番"), blank("card_name").alias("名前"),
        F.when(F.col("condition") == "", V.CONDITION_UNKNOWN).otherwise(F.col("condition")).alias("状態"),
        F.col("trend").alias("傾向"), F.col("suggested_buffer_pct").alias("買取調整%"),
        F.col("latest_price").cast("bigint").alias("最新価格"), F.col("latest_date").alias("最新日"),
        F.col("latest_imputed").alias("最新が補完"),
        F.col("d1").alias("d1%"), F.col("d3").alias("d3%"), F.col("d7").alias("d7%"),
        "ma5", "ma20", F.col("streak").alias("連続日数"), F.col("vol20").alias("変動%"),
        F.col("valid_days").alias("有効観測日"), F.col("record_count").alias("記録日数"),
        F.col("imputation_basis").alias("判定根拠"), F.col("price_trail").alias("直近1週間"), "card_id")
    return board if updated_at is None else board.withColumn("更新日時", updated_at)


def order_board(board: DataFrame) -> DataFrame:
    """Most urgent class first, then code, then condition.

    A global sort samples its input first. The shuffle before it keeps that from computing
    the board twice; a board is small next to the history it comes from.
    """
    return board.repartition("card_id", "状態").orderBy(trend_urgency("傾向"), "品番", "状態")


def _text_columns(df: DataFrame, one_place: set[str], two_places: set[str]) -> list[Column]:
    out = []
    for name, dtype in df.dtypes:
        q = F.col(f"`{name}`")
        if name in one_place or name in two_places:
            out.append(fmt(q, 1 if name in one_place else 2).alias(name))
        elif dtype == "timestamp":
            out.append(F.coalesce(stamp(q), F.lit("")).alias(name))
        else:
            out.append(F.coalesce(q.cast("string"), F.lit("")).alias(name))
    return out


def export_trend(trends: DataFrame) -> DataFrame:
    """Trend table as text, the way people read it."""
    return trends.select(*_text_columns(
        trends, {"ma5", "ma20", "suggested_buffer_pct"}, {"d1", "d3", "d7", "vol20"}))


def export_board(board: DataFrame) -> DataFrame:
    """Status board as text; an imputed latest price is starred."""
    marked = board.withColumn("最新が補完", F.when(F.col("最新が補完"), V.IMPUTED_MARK).otherwise(""))
    return marked.select(*_text_columns(
        marked, {"ma5", "ma20", "買取調整%"}, {"d1%", "d3%", "d7%", "変動%"}))
