"""How the driver tables stand in for price tables. Everything is derived by Spark from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SEQ = ["seq"]
CONDITION_FIELDS = {"R": "mint", "A": "damaged", "N": "graded"}
PAGE_SIZE = 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The same rows over all shuffle partitions: a small file is one task, whatever is made of its rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def day(c: Column | str) -> Column:
    """Dates leave the workloads as text, the same in every engine."""
    return F.col(c).cast("string").alias(c) if isinstance(c, str) else c.cast("string")


def card_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as card prices: part = card, return flag = condition, an undiscounted line = no trade."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("card_id"), F.col("l_returnflag").alias("condition"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("bigint").alias("price"),
        F.when(F.col("l_discount") == 0, F.lit(0)).otherwise(F.col("l_quantity")).cast("bigint").alias("trade_count"),
        "l_linestatus", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))


def part_code() -> Column:
    return F.concat(F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit("/"), "p_brand")


def named_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card history with name and code per row; rows of status F carry no name."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("card_id"), "p_name", part_code().alias("hinban"))
    rows = card_history(spark, sf_dir).join(parts, "card_id", "left")
    name = F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(F.coalesce("p_name", F.lit("")))
    return rows.withColumn("card_name", name).withColumn("hinban", F.coalesce("hinban", F.lit(""))).drop("p_name")


def daily_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named history with the last row of each card, condition and date."""
    values = F.struct("price", "trade_count", "card_name", "hinban", "seq")
    rows = named_history(spark, sf_dir).groupBy("card_id", "condition", "date").agg(F.max_by(values, "seq").alias("v"))
    return rows.select("card_id", "condition", "date", "v.*")


def slow_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index over seven years: mean unit price of a return flag per ship date, in whole units."""
    return card_history(spark, sf_dir).groupBy(F.col("condition").alias("index_type"), "date").agg(
        F.expr("sum(price) div count(*)").cast("double").alias("value")).withColumn("seq", F.lit(0).cast("bigint"))


def nested_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of two kinds; every third has a text where the others have a number, four levels down."""
    size, brand = F.col("p_size").cast("string"), F.concat(F.lit('"'), "p_brand", F.lit('"'))
    deep = F.when(F.col("p_partkey") % 3 == 0, brand).otherwise(size)
    json = F.concat(F.lit('{"a":{"b":[{"c":{"d":'), deep, F.lit('}}]},"n":'), size, F.lit("}"))
    return table(spark, sf_dir, "part").select((F.col("p_partkey") % 2).alias("kind"), json.alias("json"))


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages of four kinds before the page's own html: links promoted in the head, in lists, or nowhere."""
    number = F.col("page_id").cast("string")
    about, new = '<p><a href="/trading-cards/about">About</a></p>', '<p><a href="/products/new">New</a></p>'
    kinds = [
        F.concat(F.lit(about + new + '<div class="searchResultBox"><p><a href="/x/1">-</a><a href="/trading-cards/7">-</a></p></div>'
                       '<b class="my-product"><a href="/products/'), number, F.lit('">-</a></b>')),
        F.concat(F.lit(about + '<a href="/products/'), number, F.lit('">-</a>')),
        F.concat(F.lit('<a href="/products/5">-</a><a href="/trading-cards/'), number, F.lit('">-</a>')),
        F.concat(F.lit(about + new + '<i><a href="/trading-cards/a-b/'), number, F.lit('">-</a></i>'))]
    kind = F.get(F.array(*kinds), (F.col("page_id") % 4).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(kind, "html").alias("html"))


def broken_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page a text full of openings that are never closed, around one value."""
    n = F.expr("cast(500 + page_id % 500 as int)")
    body = F.concat(F.repeat(F.lit('{"a":'), n), F.lit('[1, {"p": '), F.col("page_id").cast("string"), F.lit("}] tail "),
                    F.repeat(F.lit('["[{'), n), F.repeat(F.lit("["), n))
    return table(spark, sf_dir, "pages").select("page_id", body.alias("body"))


def index_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as index points: event type per day, mean value in whole cents."""
    return daily_index(table(spark, sf_dir, "events"), ["event_type"]).withColumnRenamed("event_type", "index_type")


def daily_index(events: DataFrame, keys: list[str]) -> DataFrame:
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    return (events.groupBy(*keys, F.col("ts").cast("date").alias("date"))
            .agg(F.expr("sum(cast(round(value * 100) as bigint)) div count(*)").cast("bigint").alias("value"))
            .withColumn("seq", F.lit(0).cast("bigint")))


def user_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense series without counts: user and event type per day, in coarse steps so that prices repeat."""
    daily = daily_index(table(spark, sf_dir, "events"), ["user_id", "event_type"])
    return daily.select("user_id", "event_type", "date", F.expr("value div 1000").alias("price"),
                        F.lit(None).cast("bigint").alias("trade_count"), "seq")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as card master."""
    card_id = F.concat(F.lit("c"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(
        card_id.alias("card_id"), F.col("p_name").alias("card_name"), part_code().alias("hinban"),
        F.concat(F.lit("https://cards.example/card/"), card_id).alias("url"), F.col("p_partkey").alias("seq"))


def match_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries of every kind out of part: names, words of names, codes, ids, urls."""
    p = catalogue(spark, sf_dir)
    kinds = F.array(
        F.col("card_name"), F.split_part("card_name", F.lit(" "), F.lit(1)),
        F.split_part("card_name", F.lit(" "), F.lit(2)), F.substring("card_name", 2, 3), F.lower("hinban"),
        F.split_part("hinban", F.lit("/"), F.lit(2)), F.upper("card_id"), F.concat("url", F.lit("/")))
    return p.select(F.explode(kinds).alias("query")).distinct()


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A watch row per part: some without code, some without name, some resolved, some by hand."""
    size, kind = F.col("p_size"), F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.when(size < 10, "").otherwise(part_code()).alias("品番"),
        F.when(kind == "SMALL", "").when(size == 20, F.concat("p_name", F.lit(" x")))
        .otherwise(F.upper("p_name")).alias("名前"),
        F.when(size == 50, F.concat(F.lit("c"), F.col("p_partkey").cast("string"))).otherwise("").alias("card_id"),
        F.when((size == 49) | (size == 50), F.concat(F.lit("https://hand.example/card/h"), F.col("p_partkey").cast("string")))
        .otherwise("").alias("url"),
        F.lit("memo").alias("メモ"), F.col("p_partkey").alias("seq"))


def resolve_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve map out of part: untidy codes and names, some resolved, notes to add and to drop."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), F.lower(part_code()), F.lit("  ")).alias("品番"),
        F.when(size < 15, F.concat("p_name", F.lit("（高い方）"))).when(size < 25, F.concat(F.lit("  "), "p_name"))
        .when(size < 30, F.concat("p_name", F.lit("  "), part_code())).otherwise("").alias("名前"),
        F.lit("").alias("検索キー"),
        F.when(size == 50, F.lit("https://shop.example/products/1")).otherwise("").alias("product_url"),
        F.lit(None).cast("timestamp").alias("解決日時"),
        F.when(size < 20, "品番重複（要確認）/ 手動").when(size < 40, " ").otherwise("a / b").alias("備考"),
        F.col("p_partkey").alias("_pos"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of 20 parts each, with a total that every other brand overstates."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    item = F.concat(
        F.when(size < 5, '<li class="item closed">').otherwise('<li class="item">'),
        F.lit('<p class="card"><img src="/up//'), F.col("p_partkey").cast("string"), F.lit('.jpg"></p><p class="name">'),
        "p_name", F.lit(' &amp; co</p><p class="tag">'), "p_brand", F.lit('</p><p class="price">'),
        F.format_number(F.floor("p_retailprice"), 0), F.lit('円</p><p class="stock">'),
        F.when(size < 10, "受付終了").otherwise("残り2点"), F.lit("</p></li>"))
    pages = (p.withColumn("page", F.expr(f"p_partkey div {PAGE_SIZE}")).withColumn("item", item)
             .groupBy("page").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "item"))).alias("items")))
    body = F.array_join(F.transform("items", lambda x: x["item"]), "\n")
    total = F.size("items") + F.when(F.col("page") % 2 == 0, 0).otherwise(1)
    html = F.concat(F.lit('<div><span id="itemCount">'), total.cast("string"), F.lit('件表示</span></div><ul id="cardList">'),
                    body, F.lit('</ul><ul id="listView"><li class="item"><p class="name">ignored</p></li></ul>'))
    return pages.select("page", html.alias("html"))


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product page per part: numbers in marked elements, in the text only, or nowhere."""
    size = F.col("p_size")
    price = F.format_number(F.floor("p_retailprice"), 0)
    body = (F.when(size < 15, F.concat(F.lit('<p class="x lowestPrice"><b>¥'), price, F.lit("</b></p>")))
            .when(size < 40, F.concat(F.lit("<p>最安値 ¥"), price, F.lit("</p>"))).otherwise(F.lit("<p>-</p>")))
    stock = (F.when(size < 25, F.concat(F.lit("<span data-testid='listing-n'>"), size.cast("string"), F.lit("枚</span>")))
             .when(size < 40, F.concat(F.lit("<i>"), size.cast("string"), F.lit(" 点の出品</i>"))).otherwise(F.lit("")))
    html = F.concat(F.lit("<html><script>var lowestPrice=1;</script><body><h1>"), "p_name", F.lit("</h1>"),
                    body, stock, F.lit("</body></html>"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), html.alias("html"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card history with one row per date, which bounds the documents below by the dates there are."""
    from tidemark.operators.series import dedup_last
    return dedup_last(card_history(spark, sf_dir), ["card_id", "condition"], HISTORY_SEQ)


def series_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per card with its series embedded as JSON, one array per condition."""
    point = F.struct("date", "price", F.col("trade_count").alias("tradeCount"))
    per = [F.array_sort(F.collect_list(F.when(F.col("condition") == flag, point))).alias(field)
           for flag, field in CONDITION_FIELDS.items()]
    docs = _daily(spark, sf_dir).groupBy("card_id").agg(*per)
    body = F.to_json(F.struct(F.struct(*CONDITION_FIELDS.values()).alias("props")))
    html = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), body,
                    F.lit("</script><script>var x = {};</script></html>"))
    return docs.select(F.col("card_id").alias("page"), html.alias("html"), body.alias("json"))


def chart_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decoded chart document per card: wide rows per date."""
    price = lambda flag: F.max(F.when(F.col("condition") == flag, F.col("price")))
    wide = (_daily(spark, sf_dir).groupBy("card_id", "date")
            .agg(price("R").alias("price_01"), price("A").alias("price_02"), price("N").alias("price_03"),
                 F.sum("trade_count").alias("volume")))
    rows = F.array_sort(F.collect_list(F.struct("date", "price_01", "price_02", "price_03", "volume")))
    return (wide.groupBy("card_id").agg(rows.alias("data"))
            .select(F.col("card_id").alias("page"), F.lit("decoded").alias("kind"), F.lit(0).alias("doc_no"),
                    F.to_json(F.struct("data")).alias("json")))


def index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per index type with its whole series."""
    points = F.array_sort(F.collect_list(F.struct("date", "value")))
    return (index_history(spark, sf_dir).groupBy("index_type").agg(points.alias("data"))
            .select(F.col("index_type").alias("page"), F.lit("api").alias("kind"), F.lit(0).alias("doc_no"),
                    F.to_json(F.struct("data")).alias("json")))


def item_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item records of 20 parts each, nested under their ids."""
    p = table(spark, sf_dir, "part").withColumn("page", F.expr(f"p_partkey div {PAGE_SIZE}"))
    record = F.struct(F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("strSlug"),
                      F.concat("p_name", F.lit(" ["), "p_brand", F.lit(" "), F.lpad("p_size", 3, "0"),
                               F.lit("/165]")).alias("strName"))
    entries = F.collect_list(F.struct(F.col("p_partkey").cast("string").alias("k"), record.alias("v")))
    return (p.groupBy("page").agg(entries.alias("e"))
            .select("page", F.to_json(F.struct(F.map_from_entries("e").alias("items"))).alias("json")))


def robots_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots file for every blog and www host of pages; other hosts have none."""
    from tidemark.functions.urls import host_of
    hosts = table(spark, sf_dir, "pages").select(host_of("url").alias("host")).distinct()
    text = ("User-agent: *\nDisallow: /en/9\nAllow: /\n\n"
            "User-agent: tidemark\nAllow: /fr/1\nDisallow: /fr/\n")
    return hosts.filter(F.col("host").rlike(r"^(blog|www)\.")).select("host", F.lit(text).alias("robots_txt"))
