"""Price series: one row per key and date, imputed days, metrics.

A series lives in a long table (keys..., date, price, trade_count). A key can
hold a third of all raw rows, so rows are first reduced to one per key and date
by an aggregation that combines before it shuffles. From then on a key has at
most as many rows as there are dates, which bounds every window below. Tables
written by the keyed merge are already unique on key and date; pass
``unique_dates=True`` for those and the whole metric chain needs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.numbers import pct_change


def _by_date(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("date")


def _whole(keys: Sequence[str]):
    # Same partitioning and order as _by_date, so both share one sort.
    return _by_date(keys).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _upto(keys: Sequence[str]):
    return _by_date(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def observed_points(rows: DataFrame, keys: Sequence[str], keep_keys: bool = False) -> DataFrame:
    """Rows usable as points: price and date present; a missing count stays null.

    With ``keep_keys`` an unusable row keeps its key under a null date, so that a
    series without any point still yields one (empty) metrics row.
    """
    usable = F.col("price").isNotNull() & F.col("date").isNotNull()
    if not keep_keys:
        return rows.filter(usable)
    return rows.withColumn("date", F.when(usable, F.col("date")))


def dedup_last(rows: DataFrame, keys: Sequence[str], seq: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per key and date: the last one in input order (``seq``).

    A single ``seq`` column is the row's place in the input and unique; values then come
    from hash aggregation with fixed-width buffers. Several columns, or ties, need the
    sort-based struct maximum.
    """
    if len(seq) == 1:
        return rows.groupBy(*keys, "date").agg(
            F.max_by("price", seq[0]).alias("price"), F.max_by("trade_count", seq[0]).alias("trade_count"))
    order = [F.col(c).alias(f"_seq{i}") for i, c in enumerate(seq)]
    last = F.max(F.struct(*order, "price", "trade_count"))
    return (rows.groupBy(*keys, "date").agg(last.alias("_last"))
            .select(*keys, "date", F.col("_last.price").alias("price"),
                    F.col("_last.trade_count").alias("trade_count")))


def _one_per_date(rows, keys, seq, unique_dates):
    if unique_dates:
        return rows.select(*keys, "date", "price", "trade_count")
    return dedup_last(rows, keys, seq)


def has_trade_count(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: whether any row carries a trade count."""
    return rows.groupBy(*keys).agg(F.bool_or(F.col("trade_count").isNotNull()).alias("has_trade_count"))


def _flag(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``counted`` (the series has trade counts), ``record_count``, ``_j`` and ``imputed_suspect``."""
    counted = F.max(F.col("trade_count").isNotNull() & F.col("date").isNotNull()).over(_whole(keys))
    seen = points.select(
        "*", counted.alias("counted"), F.lag("price").over(_by_date(keys)).alias("_prev"),
        F.count("date").over(_whole(keys)).alias("record_count"),
        F.count("date").over(_upto(keys)).alias("_j"))
    repeat = F.coalesce(F.col("price") == F.col("_prev"), F.lit(False))
    untraded = F.coalesce(F.col("trade_count") <= 0, F.lit(True))
    suspect = F.when(F.col("counted"), untraded).otherwise(repeat)
    return seen.select(*[c for c in seen.columns if c != "_prev"], suspect.alias("imputed_suspect"))


def _basis() -> Column:
    return (F.when(F.col("counted"), V.BASIS_COUNT)
            .when(F.col("record_count") > 0, V.BASIS_REPEAT).otherwise(V.BASIS_NONE))


def mark_imputed(rows: DataFrame, keys: Sequence[str], seq: Sequence[str] = ("seq",),
                 unique_dates: bool = False) -> DataFrame:
    """Flag days that only carry an old price forward.

    Basis per series: with any trade count, a day without trades; otherwise a day
    whose price equals the previous record's.
    """
    points = _one_per_date(rows.filter(F.col("date").isNotNull()), keys, seq, unique_dates)
    return _flag(points, keys).withColumn("imputation_basis", _basis()).drop("record_count", "counted", "_j")


def _profile_rows(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-row helper columns from two window passes over one partitioning and one sort.

    ``_obs`` is the price of an observed day, ``_i`` its place among ``valid_days``, ``_chg``
    the change from the previous observed day (skipping imputed ones), ``_c`` its place
    among ``_changes``. A change is undefined after a price of 0, so the places of changes
    follow from those of observations and a count of zeros.
    """
    marked = _flag(points, keys)
    observed = F.col("date").isNotNull() & ~F.col("imputed_suspect") & F.col("price").isNotNull()
    marked = marked.select("*", F.when(observed, F.col("price").cast("double")).alias("_obs"))
    part = ", ".join(f"`{k}`" for k in keys)
    zero = F.when(F.col("_obs") == 0, 1)
    placed = marked.select(
        "*",
        F.count("_obs").over(_upto(keys)).alias("_i"),
        F.count(zero).over(_upto(keys)).alias("_z"),
        F.expr(f"lag(_obs) IGNORE NULLS OVER (PARTITION BY {part} ORDER BY date)").alias("_obs_prev"),
        F.count("_obs").over(_whole(keys)).alias("valid_days"),
        F.count(zero).over(_whole(keys)).alias("_zeros"),
        F.last("_obs", ignorenulls=True).over(_whole(keys)).alias("_obs_last"))
    one_if = lambda cond: F.when(cond, 1).otherwise(0)
    return placed.select(
        "*",
        F.when(F.col("_obs").isNotNull(), pct_change("_obs", "_obs_prev")).alias("_chg"),
        (F.col("_i") - 1 - F.col("_z") + one_if(F.col("_obs") == 0)).alias("_c"),
        F.when(F.col("valid_days") > 0, F.col("valid_days") - 1 - F.col("_zeros")
               + one_if(F.col("_obs_last") == 0)).otherwise(0).alias("_changes"))


def series_metrics(rows: DataFrame, keys: Sequence[str], seq: Sequence[str] = ("seq",),
                   unique_dates: bool = False, trail: int = 0) -> DataFrame:
    """One row per series: d1 d3 d7 ma5 ma20 streak vol20 avg_down and day counts.

    ``trail`` > 0 adds ``price_trail``, the last records with imputed ones starred.
    """
    # every aggregate below keeps a fixed-width buffer, so the last step is a hash aggregation
    keys = list(keys)
    points = _one_per_date(rows, keys, seq, unique_dates)
    p = _profile_rows(points, keys)

    on = lambda cond, value: F.when(cond, value)
    obs, i, n = F.col("_obs"), F.col("_i"), F.col("valid_days")
    chg, c, total = F.col("_chg"), F.col("_c"), F.col("_changes")
    j, m = F.col("_j"), F.col("record_count")
    is_obs, is_chg = obs.isNotNull(), chg.isNotNull()
    is_latest = F.col("date").isNotNull() & (j == m)
    nth_last = lambda k: F.max(on(is_obs & (i == n - k), obs))
    recent = is_chg & (c > total - 20)
    last_c = lambda cond: F.coalesce(F.max(on(cond, c)), F.lit(0))

    measures = [
        F.max("valid_days").alias("valid_days"),
        F.max("record_count").alias("record_count"),
        F.max("counted").alias("counted"),
        F.max(on(is_obs, F.col("date"))).alias("last_date"),
        F.max("date").alias("latest_date"),
        F.max(on(is_latest, F.col("price"))).alias("latest_price"),
        F.max(on(is_latest, F.col("imputed_suspect"))).alias("latest_imputed"),
        F.max(on(is_chg & (c == total), chg)).alias("d1"),
        nth_last(0).alias("_p0"), nth_last(3).alias("_p3"), nth_last(6).alias("_p6"),
        F.avg(on(is_obs & (i > n - 5), obs)).alias("_ma5"),
        F.avg(on(is_obs & (i > n - 20), obs)).alias("_ma20"),
        F.max("_changes").alias("_changes"),
        last_c(chg > 0).alias("_up"), last_c(chg < 0).alias("_down"), last_c(chg == 0).alias("_zero"),
        F.stddev_pop(on(recent, chg)).alias("_vol"),
        F.avg(on(recent & (chg < 0), -chg)).alias("_avg_down"),
    ]
    for k in range(trail):
        slot = F.col("date").isNotNull() & (j == m - k)
        measures.append(F.max(on(slot, F.col("price").cast("bigint"))).alias(f"_t{k}"))
        measures.append(F.max(on(slot, F.col("imputed_suspect"))).alias(f"_f{k}"))

    g = p.groupBy(*keys).agg(*measures)
    n, total = F.col("valid_days"), F.col("_changes")
    streak = (F.when(total == 0, 0)
              .when(F.col("_up") == total, total - F.greatest("_down", "_zero"))
              .when(F.col("_down") == total, F.greatest("_up", "_zero") - total)
              .otherwise(0))
    out = [
        *keys,
        F.col("d1"),
        pct_change("_p0", "_p3").alias("d3"),
        pct_change("_p0", "_p6").alias("d7"),
        F.when(n >= 5, F.col("_ma5")).alias("ma5"),
        F.when(n >= 2, F.col("_ma20")).alias("ma20"),
        streak.cast("bigint").alias("streak"),
        F.when(total >= 2, F.col("_vol")).alias("vol20"),
        F.col("_avg_down").alias("avg_down"),
        "valid_days", _basis().alias("imputation_basis"), "last_date",
        "record_count", "latest_date", "latest_price", "latest_imputed",
    ]
    if trail:
        pieces = [F.concat(F.col(f"_t{k}").cast("string"), F.when(F.col(f"_f{k}"), "*").otherwise(""))
                  for k in reversed(range(trail))]
        out.append(F.concat_ws("→", *pieces).alias("price_trail"))
    return g.select(*out)


def group_series(rows: DataFrame, group: str | Column, also_by: Sequence[str] = ()) -> DataFrame:
    """Mean price and summed trades per group and date. ``group``: a column or an expression, then named group.

    Days with a count of 0 or less are left out before averaging; a missing count
    is kept and counts as one trade, so a group series always has counts.
    """
    if isinstance(group, Column):
        rows, group = rows.withColumn("group", group), "group"
    eligible = (F.col(group).isNotNull() & (F.col(group) != "") & F.col("date").isNotNull()
                & F.col("price").isNotNull()
                & (F.col("trade_count").isNull() | (F.col("trade_count") > 0)))
    return (rows.filter(eligible).groupBy(group, *also_by, "date")
            .agg(F.avg(F.col("price").cast("double")).alias("price"),
                 F.sum(F.coalesce(F.col("trade_count"), F.lit(1)).cast("bigint")).alias("trade_count")))


def index_diff(rows: DataFrame, keys: Sequence[str], seq: Sequence[str] = ("seq",),
               unique_dates: bool = False) -> DataFrame:
    """Value, difference and percent change against the previous record of the full history."""
    points = rows.withColumnRenamed("value", "price").withColumn("trade_count", F.lit(None).cast("bigint"))
    points = _one_per_date(points, keys, seq, unique_dates)
    prev = F.lag("price").over(_by_date(keys))
    return points.select(
        *keys, "date", F.col("price").alias("value"),
        (F.col("price") - prev).alias("diff"), pct_change(F.col("price"), prev).alias("diff_pct"))


def last_n(rows: DataFrame, keys: Sequence[str], n: int, order: str = "date") -> DataFrame:
    """The last ``n`` rows per key; a limit per task is applied before the shuffle."""
    recent = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("_r", F.row_number().over(recent)).filter(F.col("_r") <= n).drop("_r")


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns of the last row per key, by aggregation."""
    last = F.max_by(F.struct(*columns), F.struct(*order) if len(order) > 1 else F.col(order[0]))
    return rows.groupBy(*keys).agg(last.alias("_l")).select(*keys, "_l.*")


def price_trail(rows: DataFrame, keys: Sequence[str], n: int = V.TRAIL_DAYS, seq: Sequence[str] = ("seq",),
                unique_dates: bool = False) -> DataFrame:
    """Last ``n`` records in one cell, imputed ones starred: ``100→100*→98``."""
    keys = list(keys)
    marked = mark_imputed(rows, keys, seq, unique_dates)
    tagged = marked.withColumn("_r", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.col("date").desc())))
    slots = []
    for k in range(n):
        here = F.col("_r") == k + 1
        piece = F.concat(F.col("price").cast("bigint").cast("string"),
                         F.when(F.col("imputed_suspect"), "*").otherwise(""))
        slots.append(F.max(F.when(here, piece)).alias(f"_t{k}"))
    trail = F.concat_ws("→", *[F.col(f"_t{k}") for k in reversed(range(n))])
    return (tagged.filter(F.col("_r") <= n).groupBy(*keys).agg(*slots)
            .select(*keys, trail.alias("price_trail")))


def carried(rows: DataFrame, keys: Sequence[str], columns: Sequence[str],
            seq: Sequence[str] = ("seq",)) -> DataFrame:
    """Per key the last non-blank value of each column, in input order."""
    order = F.struct(*seq) if len(seq) > 1 else F.col(seq[0])
    keep: list[Column] = []
    for c in columns:
        seen = F.when(F.col(c) != "", order)
        keep.append(F.max_by(F.col(c), seen).alias(c))
    return rows.groupBy(*keys).agg(*keep)
