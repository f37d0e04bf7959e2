"""Registered workloads: every operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions import numbers, text, urls
from tidemark.operators import audit, codes, items, match, merge, series, trend
from tidemark.plans import flows
from tidemark.plans import inputs as I
from tidemark.schemas import CARD_HISTORY, INDEX_HISTORY, TREND, Table
from tidemark.session import scratch_dir
from tidemark.sources import jsondocs, pages, requests, tables
from tidemark.streaming import upsert as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "1970-01-01"
CARD_KEYS = ["card_id", "condition"]
SCOPE_KEYS = ["scope", "key"]
SHOP = "https://shop.example"
SEARCH_TEMPLATES = ["https://shop.example/search?keyword={q}", "https://shop.example/search?q={q}"]
PAGE_LINKS = [r"^/[A-Z][a-z]+$", r"^/[a-z]+$"]
PAGE_PATTERNS = {"track": [r"track\(([0-9]+)\)"], "link": [r'<a href="/[A-Z][a-z]+"', r'<a href="/[a-z]+"'],
                 "card": [r"/card/[0-9]+"]}
FIRST_PATTERNS = [r"/card/([0-9]+)", r"page=([0-9]+)", r"track\(([0-9]+)\)"]
CUT, OVERLAP = "1998-01-01", "1997-07-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r4(c: str, name: str | None = None) -> Column:
    """Doubles are compared at four places."""
    return F.round(F.col(f"`{c}`"), 4).alias(name or c)


def flag(c: Column | str, name: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("int").alias(name)


METRICS = ["d1", "d3", "d7", "ma5", "ma20", "vol20"]


def shown_trends(df: DataFrame) -> DataFrame:
    return df.select(I.day("date"), "scope", "key", "label", *[r4(m) for m in METRICS], "streak", "valid_days",
                     "trend", r4("suggested_buffer_pct"), "imputation_basis")


def card_series(spark, sf):
    return I.card_history(spark, sf).select(
        F.lit("card").alias("scope"), F.concat("card_id", F.lit("|"), "condition").alias("key"),
        "date", "price", "trade_count", "seq")


def card_trends(spark, sf):
    metrics = series.series_metrics(card_series(spark, sf), SCOPE_KEYS)
    return trend.trend_rows(metrics, AS_OF)


# --- series and trends ----------------------------------------------------
@query
def trend_card(spark, sf):
    return shown_trends(card_trends(spark, sf))


@query
def trend_index(spark, sf):
    points = I.index_history(spark, sf).select(
        F.lit("index").alias("scope"), F.col("index_type").alias("key"), "date",
        F.col("value").alias("price"), F.lit(None).cast("bigint").alias("trade_count"), "seq")
    return shown_trends(trend.trend_rows(series.series_metrics(points, SCOPE_KEYS, unique_dates=True), AS_OF))


def _group_trend(rows, group, prefix):
    points = series.group_series(rows, group).withColumn("scope", F.lit("group")).withColumn(
        "key", F.concat(F.lit(prefix), group))
    return shown_trends(trend.trend_rows(series.series_metrics(points, SCOPE_KEYS, unique_dates=True), AS_OF))


@query
def trend_group_condition(spark, sf):
    return _group_trend(I.card_history(spark, sf), "condition", "condition:")


@query
def trend_group_set(spark, sf):
    rows = I.named_history(spark, sf).withColumn("card_set", text.set_of_code("hinban"))
    return _group_trend(rows, "card_set", "set:")


@query
def trend_all_scopes(spark, sf):
    return shown_trends(trend.trend_all_scopes(I.index_history(spark, sf), I.named_history(spark, sf), AS_OF))


@query
def group_series(spark, sf):
    return series.group_series(I.card_history(spark, sf), "condition").select(
        "condition", I.day("date"), r4("price"), "trade_count")


@query
def dedup_last(spark, sf):
    return series.dedup_last(I.card_history(spark, sf), CARD_KEYS).select(
        *CARD_KEYS, I.day("date"), "price", "trade_count")


@query
def mark_imputed_count(spark, sf):
    return series.mark_imputed(I.card_history(spark, sf), CARD_KEYS).select(
        *CARD_KEYS, I.day("date"), "price", "trade_count", "imputation_basis", flag("imputed_suspect", "imputed"))


@query
def mark_imputed_repeat(spark, sf):
    return series.mark_imputed(I.user_series(spark, sf), ["user_id", "event_type"], unique_dates=True).select(
        "user_id", "event_type", I.day("date"), "price", "imputation_basis", flag("imputed_suspect", "imputed"))


@query
def trend_users(spark, sf):
    keys = ["user_id", "event_type"]
    m = trend.with_trend(series.series_metrics(I.user_series(spark, sf), keys, unique_dates=True))
    return m.select(*keys, *[r4(x) for x in METRICS], "streak", "valid_days", "trend",
                    r4("suggested_buffer_pct"), "imputation_basis", "record_count")


@query
def has_trade_count(spark, sf):
    return series.has_trade_count(I.card_history(spark, sf), CARD_KEYS).select(
        *CARD_KEYS, flag("has_trade_count", "has_count"))


@query
def index_diff(spark, sf):
    return series.index_diff(I.index_history(spark, sf), ["index_type"], unique_dates=True).select(
        "index_type", I.day("date"), "value", "diff", r4("diff_pct"))


@query
def last_n_days(spark, sf):
    daily = series.dedup_last(I.card_history(spark, sf), CARD_KEYS)
    return series.last_n(daily, CARD_KEYS, 5).select(*CARD_KEYS, I.day("date"), "price", "trade_count")


@query
def price_trail(spark, sf):
    return series.price_trail(I.card_history(spark, sf), CARD_KEYS)


@query
def latest_per_key(spark, sf):
    daily = series.dedup_last(I.card_history(spark, sf), CARD_KEYS)
    return series.latest_per_key(daily, CARD_KEYS, ["date"], ["date", "price", "trade_count"]).select(
        *CARD_KEYS, I.day("date"), "price", "trade_count")


@query
def carried_names(spark, sf):
    return series.carried(I.named_history(spark, sf), ["card_id"], ["card_name", "hinban"])


def shown_board(board: DataFrame) -> DataFrame:
    return board.select(
        "card_id", F.col("品番").alias("code"), F.col("名前").alias("name"), F.col("状態").alias("condition"),
        F.col("傾向").alias("trend"), r4("買取調整%", "buffer"), F.col("最新価格").alias("latest_price"),
        F.col("最新日").cast("string").alias("latest_date"), flag("最新が補完", "latest_imputed"),
        r4("d1%", "d1"), r4("d3%", "d3"), r4("d7%", "d7"), r4("ma5"), r4("ma20"),
        F.col("連続日数").alias("streak"), r4("変動%", "vol20"), F.col("有効観測日").alias("valid_days"),
        F.col("記録日数").alias("record_count"), F.col("判定根拠").alias("basis"), F.col("直近1週間").alias("trail"))


@query
def status_board(spark, sf):
    return shown_board(trend.order_board(trend.status_board(I.named_history(spark, sf))))


@query
def status_watched(spark, sf):
    watched = I.table(spark, sf, "part").filter("p_type = 'SMALL'").select(
        F.col("p_partkey").cast("string").alias("card_id"))
    return shown_board(trend.status_board(I.named_history(spark, sf), watched=watched))


@query
def export_trends(spark, sf):
    return trend.export_trend(card_trends(spark, sf))


@query
def group_by_expression(spark, sf):
    """Series per length of the card number and condition: the group is an expression."""
    digits = F.concat(F.lit("d"), F.length("card_id").cast("string"))
    return series.group_series(I.card_history(spark, sf), digits, ["condition"]).select(
        "group", "condition", I.day("date"), r4("price"), "trade_count")


@query
def trend_summary(spark, sf):
    return trend.trend_summary(card_trends(spark, sf))


@query
def worst_falls(spark, sf):
    return trend.worst_falls(card_trends(spark, sf)).select("scope", "key", F.round("d3", 2).alias("d3"), "streak", "valid_days")


# --- merge and tables -------------------------------------------------------
ORDER_KEY = ["o_custkey", "o_orderpriority"]


def _order_halves(spark, sf):
    o = I.table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    existing = o.filter(F.col("day") < F.lit(CUT).cast("date")).select(
        *ORDER_KEY, "o_orderstatus", "o_totalprice", F.concat(F.lit("memo "), F.col("o_orderkey").cast("string")).alias("memo"),
        F.col("o_orderkey").alias("_pos"))
    batch = o.filter(F.col("day") >= F.lit(OVERLAP).cast("date")).select(
        *ORDER_KEY, "o_orderstatus", "o_totalprice", I.day("day").alias("seen"), F.col("o_orderkey").alias("seq"))
    return existing, batch


@query
def upsert_plan(spark, sf):
    existing, batch = _order_halves(spark, sf)
    return merge.plan_upsert(existing, batch, ORDER_KEY).withColumnsRenamed({"_pos": "pos", "_action": "action"})


@query
def upsert_stats(spark, sf):
    existing, batch = _order_halves(spark, sf)
    return merge.upsert_stats(merge.plan_upsert(existing, batch, ORDER_KEY)).withColumnRenamed("_action", "action")


@query
def upsert_result(spark, sf):
    """Two loads into a stored dated table, the second one twice."""
    o = I.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("seq"))
    stored = Table("orders_by_day", o.drop("seq").schema, ("day", "priority"), "day")
    path = scratch_dir(spark, "upsert")
    loads = [o.filter(F.col("day") < F.lit(CUT).cast("date")), o.filter(F.col("day") >= F.lit(OVERLAP).cast("date"))]
    for batch in (*loads, loads[1]):
        tables.upsert_table(spark, path, batch, stored)
    return tables.read_table(spark, path, stored).select(I.day("day"), "priority", "total")


@query
def write_back(spark, sf):
    rows = I.resolve_rows(spark, sf)
    prepared = codes.flag_duplicate_codes(rows)
    return merge.write_back(rows, prepared, ["品番", "検索キー", "備考"]).select(
        F.col("品番").alias("code"), F.col("検索キー").alias("search_key"), F.col("備考").alias("note"),
        F.col("product_url"), F.col("_pos").alias("pos"))


@query
def snapshot_table(spark, sf):
    path = scratch_dir(spark, "snapshot")
    found = items.dedup_items(pages.extract_listing_items(I.listing_pages(spark, sf), SHOP))
    tables.write_snapshot(found, path, "loaded_at", F.lit("2026-10-10 15:00:01").cast("timestamp"))
    return spark.read.parquet(path).select(
        "name", "grade", "price", "stock", "accept_status", "image_url", numbers.stamp("loaded_at").alias("loaded_at"))


@query
def stream_upsert(spark, sf):
    return _run_stream(spark, sf)[0].select("index_type", I.day("date"), F.col("value").cast("bigint").alias("value"))


@query
def stream_trends(spark, sf):
    """Trend rows kept fresh by the stream: the state as of each series' last valid day."""
    stored = _run_stream(spark, sf)[1]
    last = series.latest_per_key(stored, SCOPE_KEYS, ["date"], [c for c in stored.columns if c not in SCOPE_KEYS])
    return shown_trends(last)


def _run_stream(spark, sf):
    """events at random over files, merged some files at a time: each day comes in many batches; trends refreshed on the way."""
    root = scratch_dir(spark, "stream")
    dropped, history, trends = f"{root}/dropped", f"{root}/index_history", f"{root}/trend"
    points = I.table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"), F.col("event_type").alias("index_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"))
    points.repartition(24, F.rand(7)).write.parquet(dropped)
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 8).parquet(dropped)

    def after(batch):
        streams.refresh_index_trends(spark, history, trends, batch, AS_OF)

    streams.stream_daily_means(stream, f"{root}/state", history, f"{root}/checkpoint", after).awaitTermination()
    return tables.read_table(spark, history, INDEX_HISTORY), tables.read_table(spark, trends, TREND)


def _run_card_stream(spark, sf, refresh):
    """Daily card rows at random over files, merged some files at a time; ``refresh`` keeps trends, whose last rows are returned."""
    root = scratch_dir(spark, "cards")
    dropped, history, trends = f"{root}/dropped", f"{root}/card_history", f"{root}/trend"
    rows = I.daily_named(spark, sf).select("date", "card_id", "card_name", "hinban", "condition", "price", "trade_count", "seq")
    rows.repartition(12, F.rand(7)).write.parquet(dropped)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 6).parquet(dropped)
    streams.stream_upsert(stream, history, CARD_HISTORY, f"{root}/checkpoint",
                          after=lambda batch: refresh(root, history, trends, batch)).awaitTermination()
    stored = tables.read_table(spark, trends, TREND)
    last = series.latest_per_key(stored, SCOPE_KEYS, ["date"], [c for c in stored.columns if c not in SCOPE_KEYS])
    return shown_trends(last)


@query
def stream_card_trends(spark, sf):
    """Trend rows of card series, refreshed batch by batch for the cards that a batch touched."""
    return _run_card_stream(spark, sf, lambda root, history, trends, batch: streams.refresh_card_trends(
        spark, history, trends, batch, AS_OF))


@query
def stream_group_trends(spark, sf):
    """Trend rows of condition and set groups, refreshed batch by batch for the days that a batch touched."""
    return _run_card_stream(spark, sf, lambda root, history, trends, batch: streams.refresh_group_trends(
        spark, history, f"{root}/groups", trends, batch, AS_OF))


@query
def store_index(spark, sf):
    """Index points stored in two loads; the second brings days of 1995 late, between stored ones."""
    root, points = scratch_dir(spark, "index"), I.slow_index(spark, sf)
    late = F.dayofmonth("date") == 17
    for rows in (points.filter(~late), points.filter(late & (F.year("date") == 1995))):
        flows.store_index(spark, root, rows, "2026-10-10 15:00:01")
    return tables.read_table(spark, f"{root}/index_history", INDEX_HISTORY).select(
        "index_type", I.day("date"), "value", "diff", r4("diff_pct"))


# --- items and audits -------------------------------------------------------
@query
def dedup_items(spark, sf):
    rows = I.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("name"), F.col("l_returnflag").alias("grade"),
        F.col("l_quantity").cast("bigint").cast("string").alias("price"), F.lit("").alias("image_url"),
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("bigint").alias("pos"),
        F.col("l_partkey").cast("string").alias("stock"))
    return items.dedup_items(rows)


@query
def listing_items(spark, sf):
    return pages.extract_listing_items(I.listing_pages(spark, sf), SHOP)


@query
def declared_count(spark, sf):
    return I.listing_pages(spark, sf).select("page", pages.declared_count("html").alias("declared"))


@query
def completeness_audit(spark, sf):
    listing = I.listing_pages(spark, sf)
    found = items.dedup_items(pages.extract_listing_items(listing, SHOP))
    declared = listing.select("page", pages.declared_count("html").alias("declared"))
    return audit.completeness_audit(found, declared, ["page"]).select(
        "page", "declared", "items", flag("checked", "checked"), flag("short", "short"))


@query
def product_numbers(spark, sf):
    return pages.extract_numbers(I.product_pages(spark, sf)).select(
        "page", F.col("最安価格").alias("lowest"), F.col("出品枚数").alias("listed"), F.col("直近取引価格").alias("last_sold"))


@query
def extraction_failures(spark, sf):
    found = pages.extract_numbers(I.product_pages(spark, sf))
    return audit.extraction_failures(found, list(V.PRODUCT_NUMBER_CLASSES)).select(
        "rows", "failed", flag("all_failed", "all_failed"))


@query
def pattern_coverage(spark, sf):
    return audit.pattern_coverage(I.table(spark, sf, "pages"), PAGE_PATTERNS, "html")


@query
def json_shape(spark, sf):
    return audit.json_shape_profile(I.table(spark, sf, "events"), "props")


@query
def json_structure(spark, sf):
    """Whole nested structures of documents that differ four levels down."""
    return audit.json_structure_profile(I.nested_docs(spark, sf), "json")


@query
def json_structure_cut(spark, sf):
    return audit.json_structure_profile(I.nested_docs(spark, sf), "json", depth=2)


@query
def json_common_structure(spark, sf):
    """One structure per document kind that holds all of its documents."""
    return audit.json_common_structure(I.nested_docs(spark, sf), "json", ["kind"])


@query
def robots_filter(spark, sf):
    rules = audit.robots_rules(I.robots_files(spark, sf), "tidemark")
    urls_ = I.table(spark, sf, "pages").select("page_id", "url")
    return audit.robots_filter(urls_, rules).select("page_id", "url", flag("allowed", "allowed"))


# --- matching ---------------------------------------------------------------
@query
def match_cards(spark, sf):
    return match.match_cards(I.match_queries(spark, sf), I.catalogue(spark, sf)).select(
        "query", "score", "card_id", "card_name", "hinban", "seq")


@query
def top_matches(spark, sf):
    hits = match.best_matches(I.match_queries(spark, sf), I.catalogue(spark, sf), V.REPORT_HITS)
    return hits.select("query", "rank", "score", "card_id")


@query
def resolve_watchlist(spark, sf):
    return match.resolve_watchlist(I.watchlist(spark, sf), I.catalogue(spark, sf)).select(
        "seq", F.col("品番").alias("code"), F.col("名前").alias("name"), "card_id", "url", F.col("メモ").alias("memo"))


@query
def names_overlap(spark, sf):
    """Watch names and catalogue names whose compact forms hold one another."""
    watched = I.watchlist(spark, sf).select(text.compact_name("名前").alias("a"))
    known = I.catalogue(spark, sf).select(text.compact_name("card_name").alias("b"))
    return match.overlapping_names(watched, known)


@query
def plan_targets(spark, sf):
    return match.plan_targets(I.watchlist(spark, sf), I.catalogue(spark, sf)).select(
        "card_id", "card_name", "hinban", "url", F.col("_part").alias("part"), "seq")


@query
def card_report(spark, sf):
    summary, _ = match.card_report(I.named_history(spark, sf), "red widget")
    return summary.select("card_id", "condition", "score", "trend", *[r4(m) for m in METRICS], "streak",
                          "valid_days", "record_count", "price_trail")


# --- codes, names, notes ----------------------------------------------------
@query
def duplicate_codes(spark, sf):
    return codes.duplicate_codes(I.resolve_rows(spark, sf))


@query
def flag_duplicates(spark, sf):
    return codes.flag_duplicate_codes(I.resolve_rows(spark, sf)).select(
        F.col("_pos").alias("pos"), F.col("品番").alias("code"), F.col("名前").alias("name"),
        F.col("検索キー").alias("search_key"), F.col("備考").alias("note"))


@query
def search_requests(spark, sf):
    rows = codes.unresolved(codes.flag_duplicate_codes(I.resolve_rows(spark, sf)))
    return requests.build_search_requests(rows, SEARCH_TEMPLATES).select(
        F.col("_pos").alias("pos"), F.col("template_no").cast("int").alias("template_no"), "url")


@query
def apply_resolution(spark, sf):
    """Results for every search key: keys that hold a code of an even-sized brand name are hits."""
    rows = codes.flag_duplicate_codes(I.resolve_rows(spark, sf))
    keys = codes.unresolved(rows).select("検索キー").distinct()
    results = keys.withColumn("link", F.when(F.length("検索キー") % 2 == 0, F.concat(F.lit(SHOP + "/products/"), F.length("検索キー").cast("string"))))
    done = codes.apply_resolution(rows, results, F.lit("2026-10-10 15:00:01").cast("timestamp"))
    return done.select(F.col("_pos").alias("pos"), "product_url", F.col("備考").alias("note"),
                       numbers.stamp("解決日時").alias("resolved_at"))


@query
def normalize_text(spark, sf):
    d = I.table(spark, sf, "documents").select("doc_id", text.normalize_name("text").alias("n"))
    return d.select("doc_id", F.md5("n").alias("name_md5"), F.length("n").alias("chars"))


@query
def normalize_codes(spark, sf):
    c = I.table(spark, sf, "customer")
    raw = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("ー"), F.col("c_custkey").cast("string"), F.lit(" –p "))
    return c.select("c_custkey", text.normalize_code(raw).alias("code"))


@query
def compact_names(spark, sf):
    d = I.table(spark, sf, "documents").select("doc_id", text.compact_name("text").alias("n"))
    return d.select("doc_id", F.md5("n").alias("compact_md5"), F.length("n").alias("chars"))


@query
def strip_memos(spark, sf):
    raw = F.concat("p_name", F.lit("（高い方） "), "p_brand", F.lit(" 安い方"))
    return I.table(spark, sf, "part").select("p_partkey", text.strip_store_memo(raw).alias("name"))


@query
def extract_codes(spark, sf):
    raw = F.concat("p_name", F.lit(" "), F.lpad("p_size", 3, "0"), F.lit(" / 165"), F.lower(F.substring("p_type", 1, 2)), F.lit(" x"))
    return I.table(spark, sf, "part").select("p_partkey", text.extract_code(raw).alias("code"))


@query
def sets_of_codes(spark, sf):
    return I.table(spark, sf, "part").select(text.set_of_code(I.part_code()).alias("card_set")).groupBy("card_set").agg(
        F.count("*").alias("cards"))


@query
def notes(spark, sf):
    note = F.concat("p_type", F.lit(" / "), "p_brand", F.lit("/ /"))
    return I.table(spark, sf, "part").select(
        "p_partkey", text.add_note(note, "SMALL").alias("added"), text.drop_note(note, "SMALL").alias("dropped"))


@query
def guess_condition(spark, sf):
    return I.table(spark, sf, "documents").select("doc_id", text.guess_condition("text").alias("condition"))


@query
def status_from_stock(spark, sf):
    closed, stock = F.col("o_orderstatus") == "F", F.when(F.col("o_orderpriority") == "5-LOW", "本日受付終了").otherwise("残り1点")
    return I.table(spark, sf, "orders").select("o_orderkey", text.status_from_stock(stock, closed).alias("status"))


@query
def trend_marks(spark, sf):
    return card_trends(spark, sf).select("key", text.trend_mark("trend").alias("mark"), text.trend_urgency("trend").alias("urgency"))


@query
def upsert_keys(spark, sf):
    c = I.table(spark, sf, "customer")
    padded = F.when(F.col("c_nationkey") == 0, F.lit(None)).otherwise(F.concat(F.lit("  "), "c_name", F.lit(" \n")))
    return c.select("c_custkey", text.upsert_key(padded).alias("name_key"), text.upsert_key("c_nationkey").alias("nation_key"))


# --- numbers, dates, urls ---------------------------------------------------
@query
def parse_numbers(spark, sf):
    o, total = I.table(spark, sf, "orders"), F.floor("o_totalprice")
    shown = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("▲"), F.format_number(total, 0), F.lit("円")))
             .when(F.col("o_orderstatus") == "P", "-").otherwise(F.concat(F.lit("￥"), F.format_number(total, 0))))
    return o.select("o_orderkey", numbers.parse_price(shown).alias("price"), text.digits_only(shown).alias("digits"),
                    numbers.whole_number("o_totalprice").alias("truncated"))


@query
def parse_diffs(spark, sf):
    amount, pct = F.format_number(F.floor("o_totalprice"), 0), F.format_string("%d.%02d", F.col("o_custkey") % 100, F.col("o_orderkey") % 100)
    sign = F.when(F.col("o_orderstatus") == "F", "▲").when(F.col("o_orderstatus") == "P", "±").otherwise("+")
    unit = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise("円")
    d = I.table(spark, sf, "orders").select("o_orderkey", numbers.parse_diff(
        F.concat(sign, amount, unit, F.lit("("), sign, pct, F.lit("%)"))).alias("d"))
    return d.select("o_orderkey", "d.amount", "d.pct")


@query
def parse_dates(spark, sf):
    when, status = F.col("o_orderdate"), F.col("o_orderstatus")
    shown = (F.when(status == "F", F.date_format(when, "yyyy年M月d日")).when(status == "P", F.date_format(when, "M月d日"))
             .otherwise(F.concat(F.lit("at "), F.date_format(when, "yyyy/MM/dd"))))
    epoch = F.unix_millis(when.cast("timestamp"))
    return I.table(spark, sf, "orders").select(
        "o_orderkey", numbers.parse_date(shown).cast("string").alias("dated"),
        numbers.parse_date(shown, 2025).cast("string").alias("in_2025"),
        numbers.epoch_date(epoch).cast("string").alias("from_epoch"))


@query
def pct_change(spark, sf):
    o = I.table(spark, sf, "lineitem")
    return o.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                    F.round(numbers.pct_change("l_extendedprice", "l_discount"), 2).alias("pct"))


@query
def japan_times(spark, sf):
    return I.table(spark, sf, "events").select("event_id", numbers.stamp(F.col("ts").cast("timestamp")).alias("stamp"))


@query
def clean_urls(spark, sf):
    messy = F.concat(F.lit("  "), F.regexp_replace("url", r"(?<!:)/", "//"), F.lit(" "))
    return I.table(spark, sf, "pages").select(
        "page_id", urls.clean_url(messy, SHOP).alias("absolute"),
        urls.clean_url(F.concat(F.lit("//img//"), F.col("page_id").cast("string")), SHOP + "/list/x").alias("same_scheme"),
        urls.clean_url(F.concat(F.lit("a/"), F.col("page_id").cast("string"), F.lit(".jpg")), SHOP + "/list/x").alias("relative"))


@query
def slugs(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", urls.slug_from_url("url").alias("slug"))


# --- pages and documents ----------------------------------------------------
@query
def extract_links(spark, sf):
    return pages.extract_links(I.table(spark, sf, "pages"), PAGE_LINKS[1:], SHOP, page="page_id")


@query
def extract_links_selected(spark, sf):
    """One product link per result page: selectors in their order, each by its first element, then any link."""
    return pages.extract_selected_links(I.result_pages(spark, sf), V.PRODUCT_LINK_SELECTORS, V.PRODUCT_URL_PATTERNS, SHOP, page="page_id")


@query
def extract_catalog(spark, sf):
    return pages.extract_catalog(I.table(spark, sf, "pages"), SHOP, PAGE_LINKS, page="page_id").select(
        "card_id", "card_name", "hinban", "url", "page", "pos")


@query
def first_match(spark, sf):
    p = I.table(spark, sf, "pages")
    return p.select("page_id", text.first_match(F.concat("url", F.lit(" "), "html"), FIRST_PATTERNS).alias("number"))


@query
def page_text(spark, sf):
    return I.table(spark, sf, "pages").select("page_id", F.md5(pages.page_text("html")).alias("text_md5"))


@query
def json_blobs(spark, sf):
    blobs = jsondocs.extract_json_blobs(I.series_pages(spark, sf), ["page"])
    return blobs.select("page", "part", "blob_no", F.length("json").alias("chars"))


@query
def json_series(spark, sf):
    blobs = jsondocs.extract_json_blobs(I.series_pages(spark, sf), ["page"])
    return jsondocs.extract_series(blobs, ["page", "blob_no"]).select(
        "page", "path", "n_points", "idx", I.day("date"), "price", "trade_count")


@query
def json_series_known_path(spark, sf):
    return jsondocs.extract_series_at(I.series_pages(spark, sf), ["page"], "$.props.mint").select(
        "page", "idx", I.day("date"), "price", "trade_count")


@query
def json_values(spark, sf):
    d = I.table(spark, sf, "events").select("event_id", F.concat("event_type", F.lit(" {x "), "props", F.lit(" tail [1]")).alias("body"))
    return jsondocs.scan_json_values(d, "body", ["event_id"])


@query
def json_values_broken(spark, sf):
    """The one value in texts with thousands of openings that are never closed."""
    return jsondocs.scan_json_values(I.broken_json(spark, sf), "body", ["page_id"])


@query
def chart_rows(spark, sf):
    return jsondocs.extract_chart_rows(I.chart_docs(spark, sf), ["page"]).select(
        "page", "path", "idx", I.day("date"), "price_01", "price_02", "price_03", "volume")


@query
def chart_series(spark, sf):
    found = jsondocs.series_candidates(I.chart_docs(spark, sf), top=None)
    return found.filter(F.contains("source", F.lit(" :: data :: "))).select(
        "page", F.split_part("source", F.lit(" :: "), F.lit(3)).alias("condition"), "n_points", I.day("date"), "price", "trade_count")


@query
def item_records(spark, sf):
    return jsondocs.extract_item_records(I.item_docs(spark, sf), ["page"], "https://cards.example")


@query
def index_records(spark, sf):
    found = jsondocs.series_candidates(I.index_docs(spark, sf))
    return jsondocs.index_records(found, F.col("page"), 20).select(
        "index_type", I.day("date"), F.col("value").cast("bigint").alias("value"))


@query
def card_records(spark, sf):
    blobs = jsondocs.extract_json_blobs(I.series_pages(spark, sf), ["page"]).select(
        "page", F.lit("embedded").alias("kind"), F.col("blob_no").alias("doc_no"), "json")
    names = I.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("page"), F.col("p_partkey").cast("string").alias("card_id"),
        F.col("p_name").alias("card_name"), I.part_code().alias("hinban"))
    return jsondocs.card_records(jsondocs.series_candidates(blobs), names).select(
        I.day("date"), "card_id", "card_name", "hinban", "condition", "price", "trade_count",
        flag("imputed_suspect", "imputed"))
