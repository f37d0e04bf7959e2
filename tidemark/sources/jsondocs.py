"""Price series and item records out of JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed_values as V
from tidemark.functions.numbers import parse_date, parse_price
from tidemark.functions.text import blank, extract_code, guess_condition, strip
from tidemark.operators.items import first_per_key
from tidemark.operators.series import mark_imputed
from tidemark.sources import json_walk
from tidemark.sources.json_scan import scan
from tidemark.sources.rowwise import expand_text

_SCRIPT = "(?s)" + V.JSON_SCRIPT_PATTERN
_PUSHED = "(?s)" + V.JSON_PUSH_PATTERN

_L, _S, _DATE = T.LongType(), T.StringType(), T.DateType()


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


def scan_json_values(texts: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Outermost JSON values found inside free text: keys, value_no, json. The work is linear in the text."""
    out = _fields(("value_no", _L), ("json", _S))
    return expand_text(texts, text, keys, out, lambda s: enumerate(scan(s)))


def extract_json_blobs(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """JSON embedded in pages: keys, part ("script" or "pushed"), blob_no, json.

    Script bodies and pushed chunks are cut out in the JVM; the walkers' own parser decides what is
    JSON, so repeated keys and NaN are kept. Pushed chunks are JSON strings; they are unescaped in
    the JVM and only pages that have any go on to the text scan. ``blob_no`` of a pushed value is
    its chunk times 2**32 plus its place in the chunk.
    """
    keys = list(keys)
    bodies = pages.select(*keys, F.posexplode(
        F.regexp_extract_all(blank(html), F.lit(_SCRIPT), F.lit(1))).alias("_no", "_body"))
    scripts = expand_text(bodies, "_body", [*keys, "_no"], _fields(("json", _S)),
                          lambda s: [(s,)] if json_walk.readable(s) else []).select(
        *keys, F.lit("script").alias("part"), F.col("_no").cast("bigint").alias("blob_no"), "json")
    chunks = (pages.filter(F.contains(blank(html), F.lit("__next_f")))
              .select(*keys, F.posexplode(
                  F.regexp_extract_all(blank(html), F.lit(_PUSHED), F.lit(1))).alias("_chunk", "_raw"))
              .select(*keys, "_chunk", F.from_json(
                  F.concat(F.lit('{"v":'), "_raw", F.lit("}")), "v string")["v"].alias("_text"))
              .filter(F.col("_text").isNotNull()))
    pushed = scan_json_values(chunks, "_text", [*keys, "_chunk"]).select(
        *keys, F.lit("pushed").alias("part"),
        # keeps chunk order, then order inside the chunk
        (F.shiftleft(F.col("_chunk").cast("bigint"), 32) + F.col("value_no")).alias("blob_no"),
        "json")
    return scripts.unionByName(pushed)


def extract_series(docs: DataFrame, keys: Sequence[str], json: str = "json") -> DataFrame:
    """Points of every series in JSON of unknown shape.

    keys, series_no, path, n_points, idx, date, price, trade_count.
    """
    def expand(text: str):
        for no, (path, found) in enumerate(json_walk.series(json_walk.load(text))):
            for idx, point in enumerate(found):
                yield (no, path, len(found), idx, *point)

    out = _fields(("series_no", _L), ("path", _S), ("n_points", _L), ("idx", _L),
                  ("date", _DATE), ("price", _L), ("trade_count", _L))
    return expand_text(docs, json, keys, out, expand)


def extract_series_at(docs: DataFrame, keys: Sequence[str], path: str, date: str = "date", price: str = "price",
                      count: str = "tradeCount", json: str = "json") -> DataFrame:
    """Points of one series at a known path; stays in the JVM."""
    item = T.ArrayType(_fields((date, _S), (price, _S), (count, _S)))
    array = F.from_json(F.get_json_object(json, path), item)
    rows = docs.select(*keys, F.posexplode(array).alias("idx", "p"))
    return (rows.select(*keys, F.col("idx").cast("bigint").alias("idx"),
                        parse_date(F.col(f"p.`{date}`")).alias("date"),
                        parse_price(F.col(f"p.`{price}`")).alias("price"),
                        parse_price(F.col(f"p.`{count}`")).alias("trade_count"))
            .filter(F.col("date").isNotNull() & F.col("price").isNotNull()))


def extract_chart_rows(docs: DataFrame, keys: Sequence[str], json: str = "json") -> DataFrame:
    """Rows of wide chart arrays: keys, chart_no, path, idx, date, price_01..03, volume."""
    columns = [column for _, column in V.CHART_PRICE_COLUMNS]

    def expand(text: str):
        for no, (path, rows) in enumerate(json_walk.charts(json_walk.load(text))):
            for idx, row in enumerate(rows):
                yield (no, path, idx, json_walk.day(row.get("date")),
                       *[json_walk.whole(row.get(c)) for c in columns], json_walk.whole(row.get("volume")))

    out = _fields(("chart_no", _L), ("path", _S), ("idx", _L), ("date", _DATE),
                  *[(c, _L) for c in columns], ("volume", _L))
    return expand_text(docs, json, keys, out, expand)


def chart_points(charts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wide chart rows as one series per condition; all share the volume as trade count."""
    wide = F.explode(F.array(*[
        F.struct(F.lit(no).cast("bigint").alias("condition_no"), F.lit(label).alias("condition"),
                 F.col(column).alias("price"))
        for no, (label, column) in enumerate(V.CHART_PRICE_COLUMNS)]))
    long = (charts.withColumn("_w", wide)
            .select(*keys, "chart_no", "path", "idx", "date", "_w.*", F.col("volume").alias("trade_count"))
            .filter(F.col("date").isNotNull() & F.col("price").isNotNull()))
    one_chart = Window.partitionBy(*keys, "chart_no", "condition")
    # places count the points that are left, so that "the last n" means n points
    return (long.withColumn("idx", (F.row_number().over(one_chart.orderBy("idx")) - 1).cast("bigint"))
            .withColumn("n_points", F.count("*").over(one_chart)))


def extract_item_records(docs: DataFrame, keys: Sequence[str], base: str, json: str = "json") -> DataFrame:
    """Catalogue rows from item records, first per slug."""
    def expand(text: str):
        for no, item in enumerate(json_walk.item_records(json_walk.load(text))):
            yield no, str(item["strSlug"]), str(item["strName"])

    out = _fields(("item_no", _L), ("slug", _S), ("name", _S))
    found = expand_text(docs, json, keys, out, expand).select(
        *keys, "item_no", strip("slug").alias("card_id"), strip("name").alias("card_name"))
    named = found.filter((F.col("card_id") != "") & (F.col("card_name") != ""))
    first = first_per_key(named, ["card_id"], [*keys, "item_no"])
    return first.select("card_id", "card_name", extract_code("card_name").alias("hinban"),
                        F.concat(F.lit(base.rstrip("/") + "/"), "card_id", F.lit("/")).alias("url"))


SOURCE_ORDER = ("api", "embedded", "decoded")


def series_candidates(docs: DataFrame, page: str = "page", top: int | None = V.SERIES_PER_PAGE) -> DataFrame:
    """The ``top`` longest series of each page from its JSON documents (ties in document order).

    ``docs``: page, kind (api, embedded, decoded), doc_no, json and, if there is one, the ``url`` a
    document came from, which becomes part of the source and so may tell the condition. Wide charts
    are read from decoded documents only. Output: page, rank, source, n_points, idx, date, price, trade_count.
    Pages go to all shuffle partitions, so the memory of a task is its share of the points.
    ``top=None`` gives all series, without a rank.
    """
    keys = [page, "kind", "doc_no", *(["url"] if "url" in docs.columns else [])]
    origin = ["kind", *keys[3:]]
    generic = extract_series(docs, keys).select(
        *keys, F.lit(0).alias("_chart"), "series_no", F.lit(0).cast("bigint").alias("_cond"),
        F.concat_ws(" :: ", *origin, "path").alias("source"), "n_points", "idx", "date", "price", "trade_count")
    wide = chart_points(extract_chart_rows(docs.filter(F.col("kind") == "decoded"), keys), keys).select(
        *keys, F.lit(1).alias("_chart"), F.col("chart_no").alias("series_no"),
        F.col("condition_no").alias("_cond"), F.concat_ws(" :: ", *origin, "path", "condition").alias("source"),
        "n_points", "idx", "date", "price", "trade_count")
    order = F.array_position(F.array(*[F.lit(k) for k in SOURCE_ORDER]), F.col("kind"))
    found = generic.unionByName(wide).withColumn("_kind", order)
    columns = ["source", "n_points", "idx", "date", "price", "trade_count"]
    if top is None:
        return found.select(page, *columns)
    # points are many and compress well: partitions merged by their shuffled size would be far too large in memory
    found = found.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), page)
    ranked = Window.partitionBy(page).orderBy(
        F.col("n_points").desc(), "_kind", "doc_no", "_chart", "series_no", "_cond")
    return (found.withColumn("rank", F.dense_rank().over(ranked)).filter(F.col("rank") <= top)
            .select(page, "rank", *columns))


def card_records(candidates: DataFrame, cards: DataFrame, days: int = V.DAILY_DAYS,
                 page: str = "page") -> DataFrame:
    """History rows of cards: the longest series of each page, their last ``days`` points.

    ``cards``: page, card_id, card_name, hinban. ``seq`` orders rows for the merge, where the
    later of two series with the same condition wins.
    """
    kept = candidates.filter(F.col("idx") >= F.col("n_points") - days)
    kept = kept.withColumn("condition", guess_condition("source")).withColumn(
        "seq", F.col("rank").cast("bigint") * 1_000_000 + F.col("idx"))
    marked = mark_imputed(kept, [page, "rank", "condition"], ["seq"])
    rows = marked.withColumn("seq", F.col("rank").cast("bigint") * 1_000_000
                             + F.date_diff(F.col("date"), F.lit("1970-01-01").cast("date")))
    return rows.join(cards, page).select(
        "date", "card_id", "card_name", "hinban", "condition", "price", "trade_count",
        "imputed_suspect", "seq")


def index_records(candidates: DataFrame, label: Column | str, days: int = V.DAILY_DAYS,
                  page: str = "page") -> DataFrame:
    """Index points: the last days of the longest series."""
    label = F.lit(label) if isinstance(label, str) else label
    kept = candidates.filter((F.col("rank") == 1) & (F.col("idx") >= F.col("n_points") - days))
    return kept.select("date", label.alias("index_type"), F.col("price").cast("double").alias("value"),
                       F.col("idx").alias("seq"))
