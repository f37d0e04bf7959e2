"""End-to-end jobs over stored tables: snapshot, resolve and poll, daily history and trends.

Each job reads and writes tables below one root folder (see ``tidemark.schemas``). Times
are arguments (a text in session time or a column), so that a rerun writes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions.text import blank
from tidemark.operators import audit, codes, items, match, merge, series, trend
from tidemark.operators.trend import TrendLimits
from tidemark.schemas import (
    BUYLIST, CARD_HISTORY, CARD_MASTER, CARD_STATUS, INDEX_HISTORY, MARKET_SNAPSHOT, RESOLVE_MAP, TREND, WATCHLIST, Table)
from tidemark.sources import jsondocs, pages, requests
from tidemark.sources.tables import dry_run, load_watchlist, month, read_table, stored_months, upsert_table, write_snapshot


def _at(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.name}"


def _time(at: Column | str) -> Column:
    return F.lit(at).cast("timestamp") if isinstance(at, str) else at


def _store(spark, root, table, batch, seq="seq") -> bool:
    """Merge a batch that is computed once and kept for the merge."""
    batch = batch.persist()
    try:
        return upsert_table(spark, _at(root, table), batch, table, seq)
    finally:
        batch.unpersist()


# --- buy-list snapshot ------------------------------------------------------
def buylist_items(listing: DataFrame, base: str) -> DataFrame:
    """Items of listing pages (page, html) under their table names, copies dropped."""
    found = items.dedup_items(pages.extract_listing_items(listing, base))
    return found.select(
        F.col("name").alias("商品名"), F.col("grade").alias("グレード"), F.col("price").alias("買取価格"),
        F.col("stock").alias("在庫"), F.col("accept_status").alias("受付状態"), F.col("image_url").alias("画像URL"))


def listing_audit(listing: DataFrame, base: str) -> DataFrame:
    """Distinct items of the whole listing against the greatest declared total."""
    found = items.dedup_items(pages.extract_listing_items(listing, base)).select(F.lit("listing").alias("source"))
    declared = listing.select(F.lit("listing").alias("source"), pages.declared_count("html").alias("declared"))
    return audit.completeness_audit(found, declared, ["source"])


def snapshot(root: str, listing: DataFrame, base: str, load_time: Column | str, dry: bool = False) -> DataFrame | bool:
    """Replace the buy list. A dry run returns a sample and writes nothing; no items, no write."""
    found = buylist_items(listing, base)
    if dry:
        return dry_run(found)
    return write_snapshot(found, _at(root, BUYLIST), "取得日時", _time(load_time))


# --- resolve and poll -------------------------------------------------------
def search_requests(rows: DataFrame, templates: Sequence[str], limit: int = 0) -> DataFrame:
    """URLs to look up for rows without one. ``rows``: the resolve map with ``_pos``."""
    todo = codes.unresolved(codes.flag_duplicate_codes(rows))
    if limit > 0:
        todo = todo.orderBy("_pos").limit(limit)
    return requests.build_search_requests(todo, templates)


def search_results(found_pages: DataFrame, origin: str,
                   url_patterns: Sequence[str] = tuple(V.PRODUCT_URL_PATTERNS)) -> DataFrame:
    """One link per search key from result pages (検索キー, template_no, html): first template that hits."""
    links = found_pages.select("検索キー", "template_no", pages.first_link("html", url_patterns, origin).alias("link"))
    return links.groupBy("検索キー").agg(
        F.min_by("link", F.when(F.col("link").isNotNull(), F.col("template_no"))).alias("link"))


def resolve(rows: DataFrame, results: DataFrame, resolved_at: Column | str) -> DataFrame:
    """The resolve map with codes tidied and results applied; same rows, order and extra columns."""
    done = codes.apply_resolution(codes.flag_duplicate_codes(rows), results, _time(resolved_at))
    return merge.write_back(rows, done, RESOLVE_MAP.schema.names)


def poll(root: str, rows: DataFrame, product_pages: DataFrame, load_time: Column | str) -> bool:
    """Replace the market snapshot by the numbers of resolved rows' pages (product_url, html)."""
    numbers = pages.extract_numbers(product_pages, page="product_url")
    wanted = codes.resolved(rows).select("品番", "名前", "product_url")
    # a row whose page is missing stays, without numbers
    found = wanted.join(numbers, "product_url", "left").select(
        "品番", "名前", *[blank(f"`{label}`").alias(label) for label in V.PRODUCT_NUMBER_CLASSES])
    return write_snapshot(found, _at(root, MARKET_SNAPSHOT), "取得日時", _time(load_time))


# --- history and trends -------------------------------------------------------
def index_points(normal: DataFrame, graded: DataFrame, days: int = V.DAILY_DAYS) -> DataFrame:
    """Index records of the normal and the graded page (candidates of each) under their labels."""
    kinds = (("normal", normal), ("graded", graded))
    first, second = (jsondocs.index_records(found, V.INDEX_LABELS[kind], days) for kind, found in kinds)
    return first.unionByName(second)


def store_index(spark: SparkSession, root: str, records: DataFrame, fetched_at: Column | str) -> bool:
    """Merge index points (date, index_type, value, seq); a difference is against the stored day before.

    The stored day after a new one is written again too: its difference is against the new day now. Only the months of the
    new days and the stored months next to them are read, more only while a series' neighbour may lie beyond.
    """
    path = _at(root, INDEX_HISTORY)
    records = records.persist()
    try:
        old = _with_neighbours(spark, path, records)
        both = (old.select("index_type", "date", "value", F.lit(0).alias("_new"), F.lit(0).cast("bigint").alias("seq"))
                .unionByName(records.select("index_type", "date", "value", F.lit(1).alias("_new"), "seq")))
        diffs = series.index_diff(both, ["index_type"], ["_new", "seq"])
        days = both.groupBy("index_type", "date").agg(F.max("_new").alias("_new"), F.min(F.when(F.col("_new") == 1, F.col("seq"))).alias("seq"))
        before = F.lag("_new").over(Window.partitionBy("index_type").orderBy("date"))
        places = days.withColumn("_before", before).where("_new = 1 OR _before = 1").select(
            "index_type", "date", F.coalesce("seq", F.lit(0).cast("bigint")).alias("seq"))
        # the first day read of a series may have lost its predecessor; only new days and the days after them are written
        return _store(spark, root, INDEX_HISTORY, diffs.join(places, ["index_type", "date"]).withColumn("fetched_at", _time(fetched_at)))
    finally:
        records.unpersist()


def _with_neighbours(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """Stored points of the series of ``records`` in months that hold the neighbours of all their days.

    Months are taken in runs without a stored month left out. Where the first (last) point of a series in a run is a new
    one, its neighbour may lie before (after) the run, which then grows, twice as far each time.
    """
    stored = stored_months(spark, path)
    new = [r[0] for r in records.select(month("date")).distinct().collect()]
    wanted = {m for b in new for m in (b, max((x for x in stored if x < b), default=None), min((x for x in stored if x > b), default=None)) if m}
    kinds, step = records.select("index_type").distinct(), 1
    while True:
        order = sorted({*stored, *wanted})
        run = {m: 0 for m in order}
        for a, b in zip(order, order[1:]):
            run[b] = run[a] + (a not in wanted or b not in wanted)
        old = read_table(spark, path, INDEX_HISTORY, sorted(wanted)).join(kinds, "index_type", "left_semi")
        runs = spark.createDataFrame([(m, run[m]) for m in sorted(wanted)] or [("", 0)], "month string, run int")
        points = old.select("index_type", "date", F.lit(0).alias("_new")).unionByName(records.select("index_type", "date", F.lit(1).alias("_new")))
        ends = points.withColumn("month", month("date")).join(F.broadcast(runs), "month").groupBy("run", "index_type", "date").agg(
            F.max("_new").alias("_new")).groupBy("run", "index_type").agg(
            F.min_by("_new", "date").alias("first"), F.max_by("_new", "date").alias("last")).groupBy("run").agg(
            F.max("first").alias("first"), F.max("last").alias("last")).collect()
        more: set[str] = set()
        for r in ends:
            own = [m for m in order if run[m] == r["run"] and m in wanted]
            if r["first"]:
                more |= set([x for x in stored if x < own[0]][-step:])
            if r["last"]:
                more |= set([x for x in stored if x > own[-1]][:step])
        if more <= wanted:
            return old
        wanted |= more
        step *= 2


def store_master(spark: SparkSession, root: str, cards: DataFrame, seen_at: Column | str) -> bool:
    """Merge catalogue rows (card_id, card_name, hinban, url, seq)."""
    return _store(spark, root, CARD_MASTER, cards.withColumn("last_seen_at", _time(seen_at)))


def master_cards(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, _at(root, CARD_MASTER), CARD_MASTER).withColumnRenamed("_pos", "seq")


def watchlist(spark: SparkSession, root: str, seed_path: str | None = None) -> DataFrame:
    """The watch list with ``seq``; the seed file only while nothing is stored."""
    rows = load_watchlist(spark, read_table(spark, _at(root, WATCHLIST), WATCHLIST), seed_path)
    return (rows.withColumnRenamed("_pos", "seq") if "_pos" in rows.columns
            else rows.withColumn("seq", F.monotonically_increasing_id()))


def refresh_watchlist(spark: SparkSession, root: str, seed_path: str | None = None) -> DataFrame:
    """Fill ids and urls from the catalogue and store the list; returns the stored list."""
    resolved = match.resolve_watchlist(watchlist(spark, root, seed_path), master_cards(spark, root))
    _store(spark, root, WATCHLIST, resolved)
    return watchlist(spark, root, seed_path)


def targets(spark: SparkSession, root: str, limit: int = 0, crawl_all: bool = False) -> DataFrame:
    """Pages to read next."""
    return match.plan_targets(watchlist(spark, root), master_cards(spark, root), limit, crawl_all)


def store_cards(spark: SparkSession, root: str, docs: DataFrame, cards: DataFrame, fetched_at: Column | str,
                days: int = V.DAILY_DAYS, top: int = V.SERIES_PER_PAGE) -> bool:
    """Merge the ``top`` longest series of each card page.

    ``docs``: page, kind, doc_no, json and perhaps url; ``cards``: page, card_id, card_name, hinban.
    """
    records = jsondocs.card_records(jsondocs.series_candidates(docs, top=top), cards, days)
    return _store(spark, root, CARD_HISTORY, records.withColumn("fetched_at", _time(fetched_at)))


def card_history(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, _at(root, CARD_HISTORY), CARD_HISTORY).withColumnRenamed("_pos", "seq")


# Stored positions order rows only within a month, so "last seen" goes by date first.
_INPUT_ORDER = ["date", "seq"]


def refresh_board(spark: SparkSession, root: str, updated_at: Column | str, limits: TrendLimits = TrendLimits(),
                  only: DataFrame | None = None) -> bool:
    """Recompute the status board of the watched cards, or of all while none is watched."""
    watched = only
    if watched is None:
        ids = watchlist(spark, root).filter(blank("card_id") != "").select("card_id")
        watched = None if ids.isEmpty() else ids
    board = trend.status_board(card_history(spark, root), limits, watched, _INPUT_ORDER, unique_dates=True, updated_at=_time(updated_at))
    return _store(spark, root, CARD_STATUS, board.withColumn("seq", F.monotonically_increasing_id()))


def refresh_trends(spark: SparkSession, root: str, as_of: Column | str, fetched_at: Column | str,
                   limits: TrendLimits = TrendLimits()) -> DataFrame:
    """Recompute and store the trends of all scopes; returns the counts per class."""
    index = read_table(spark, _at(root, INDEX_HISTORY), INDEX_HISTORY).withColumnRenamed("_pos", "seq")
    rows = trend.trend_all_scopes(index, card_history(spark, root), as_of, limits, _INPUT_ORDER, unique_dates=True).persist()
    try:
        upsert_table(spark, _at(root, TREND), rows.withColumn("fetched_at", _time(fetched_at)).withColumn(
            "seq", F.monotonically_increasing_id()), TREND)
        counts = trend.trend_summary(rows)
        return spark.createDataFrame(counts.collect(), counts.schema)  # one row per class
    finally:
        rows.unpersist()


def report(spark: SparkSession, root: str, query: str, updated_at: Column | str) -> tuple[DataFrame, DataFrame]:
    """Report on the cards a query names, and put them on the board."""
    history = card_history(spark, root)
    hits = match.report_hits(history, query).select("card_id")
    refresh_board(spark, root, updated_at, only=hits)
    return match.card_report(history, query, seq=_INPUT_ORDER)
