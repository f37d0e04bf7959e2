"""Registered workloads over harder inputs, each with its SQL: odd pages, limits, seeds, gaps, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators import match
from tidemark.plans import flows
from tidemark.plans import inputs as I
from tidemark.plans import oracles as O
from tidemark.plans.oracles import ORACLES
from tidemark.plans.workloads import SEARCH_TEMPLATES, SHOP, flag, query
from tidemark.schemas import MARKET_SNAPSHOT
from tidemark.session import scratch_dir
from tidemark.sources import jsondocs, pages, tables

LOADED = "2026-10-10 15:00:01"


# --- watch list and targets ---------------------------------------------------
def _watch_rows(spark, sf):
    return I.watchlist(spark, sf).select("品番", "名前", "card_id", "url", "メモ")


@query
def watchlist_stored(spark, sf):
    """Stored rows that name a card; the seed does not count beside them."""
    loaded = tables.load_watchlist(spark, _watch_rows(spark, sf), f"{scratch_dir(spark, 'seed')}/none.tsv")
    return loaded.select(F.col("品番").alias("code"), F.col("名前").alias("name"), "card_id")


@query
def watchlist_seed(spark, sf):
    """The seed file, while nothing that names a card is stored."""
    seed, rows = scratch_dir(spark, "seed"), _watch_rows(spark, sf)
    rows.select("品番", "名前", "メモ").write.csv(seed, sep="\t", header=True)
    stored = rows.select(*[F.lit("").alias(c) if c != "メモ" else F.col(c) for c in rows.columns])
    loaded = tables.load_watchlist(spark, stored, seed)
    return loaded.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in (("品番", "code"), ("名前", "name"), ("url", "url"))])


_WATCHED = f"""w AS (SELECT CASE WHEN p_size < 10 THEN '' ELSE {O.CODE} END AS code,
  CASE WHEN p_type = 'SMALL' THEN '' WHEN p_size = 20 THEN p_name || ' x' ELSE upper(p_name) END AS name,
  CASE WHEN p_size = 50 THEN 'c' || p_partkey ELSE '' END AS card_id FROM part)"""
ORACLES["watchlist_stored"] = f"WITH {_WATCHED} SELECT * FROM w WHERE code <> '' OR name <> '' OR card_id <> ''"
ORACLES["watchlist_seed"] = f"WITH {_WATCHED} SELECT code, name, '' AS url FROM w WHERE code <> '' OR name <> ''"


@query
def plan_targets_limited(spark, sf):
    return match.plan_targets(I.watchlist(spark, sf), I.catalogue(spark, sf), limit=25).select(
        "card_id", "card_name", "hinban", "url", F.col("_part").alias("part"), "seq")


@query
def plan_targets_all(spark, sf):
    """Without a watch list the whole catalogue, if it is asked for."""
    return match.plan_targets(I.watchlist(spark, sf).filter("false"), I.catalogue(spark, sf), crawl_all=True).select(
        "card_id", "card_name", "hinban", "url", F.col("_part").alias("part"), "seq")


@query
def search_requests_limited(spark, sf):
    return flows.search_requests(I.resolve_rows(spark, sf), SEARCH_TEMPLATES, limit=7).select(
        F.col("_pos").alias("pos"), F.col("template_no").cast("int").alias("template_no"), "url")


ORACLES["plan_targets_limited"] = f"SELECT * FROM ({ORACLES['plan_targets']}) ORDER BY part, seq LIMIT 25"
ORACLES["plan_targets_all"] = f"""SELECT 'c' || p_partkey AS card_id, p_name AS card_name, {O.CODE} AS hinban,
  'https://cards.example/card/c' || p_partkey AS url, 0 AS part, p_partkey AS seq FROM part"""
ORACLES["search_requests_limited"] = f"""SELECT * FROM ({ORACLES['search_requests']}) x
WHERE pos IN (SELECT DISTINCT pos FROM ({ORACLES['search_requests']}) y ORDER BY pos LIMIT 7)"""


# --- pages ----------------------------------------------------------------------
def odd_listing(spark, sf):
    """Listing pages with blank items, nested markup, numeric entities; every other page has the second kind of list only."""
    size = F.col("p_size")
    name = F.when(size.between(20, 29) | (size < 10), "").otherwise(
        F.concat(F.lit("<b>"), "p_name", F.lit("</b><i>"), "p_brand", F.lit("</i>&#38;co")))
    price = F.when(size < 20, "").otherwise(F.concat(F.lit("<span>"), F.format_number(F.floor("p_retailprice"), 0), F.lit("</span><span>円</span>")))
    item = F.concat(F.lit('<li class="x item"><div><p class="name">'), name, F.lit('</p></div><p class="price">'), price,
                    F.lit('</p><div class="card"><a><img src="i/'), F.col("p_partkey").cast("string"), F.lit('.png"></a></div></li>'))
    own = I.table(spark, sf, "part").withColumn("page", F.expr(f"p_partkey div {I.PAGE_SIZE}")).withColumn("item", item).groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", "item"))).alias("items"))
    body = F.array_join(F.transform("items", lambda x: x["item"]), "")
    first = F.col("page") % 2 == 0
    decoy = '<ul id="listView"><li class="item"><p class="name">ignored</p></li></ul>'
    count = (F.when(F.col("page") % 3 == 0, F.concat(F.lit('<div class="c" id="itemCount"><i>全</i><b>&#49;'), F.size("items").cast("string"), F.lit("</b>件</div>")))
             .when(F.col("page") % 3 == 1, '<div id="itemCount">なし</div>').otherwise(""))
    html = F.concat(count, F.when(first, F.lit('<ul id="cardList">')).otherwise(F.lit('<ul id="listView">')), body, F.lit("</ul>"),
                    F.when(first, F.lit(decoy)).otherwise(F.lit("")))
    return own.select("page", html.alias("html"))


@query
def listing_items_odd(spark, sf):
    return pages.extract_listing_items(odd_listing(spark, sf), SHOP + "/list/").select("page", "pos", "name", "grade", "price", "image_url")


@query
def declared_count_odd(spark, sf):
    return odd_listing(spark, sf).select("page", pages.declared_count("html").alias("declared"))


@query
def dry_run_snapshot(spark, sf):
    """How many rows a dry run shows, and how many tables it has written."""
    root = scratch_dir(spark, "dry")
    shown = flows.snapshot(root, I.listing_pages(spark, sf), SHOP, LOADED, dry=True)
    return shown.agg(F.count("*").alias("shown")).withColumn("written", F.lit(int(tables.path_exists(spark, root))))


def _addressed(spark, sf):
    rows = I.resolve_rows(spark, sf)
    address = F.concat(F.lit(SHOP + "/products/"), F.col("_pos").cast("string"))
    return rows.withColumn("product_url", F.when(F.col("_pos") % 5 == 0, address).otherwise(F.lit("  ")))


@query
def poll_snapshot(spark, sf):
    """Numbers of the resolved rows' pages, stored; a page in seven is missing."""
    root = scratch_dir(spark, "poll")
    found = I.product_pages(spark, sf).filter("page % 7 <> 0").select(
        F.concat(F.lit(SHOP + "/products/"), F.col("page").cast("string")).alias("product_url"), "html")
    flows.poll(root, _addressed(spark, sf), found, LOADED)
    return tables.read_table(spark, f"{root}/{MARKET_SNAPSHOT.name}", MARKET_SNAPSHOT).select(
        F.trim("品番").alias("code"), F.col("最安価格").alias("lowest"), F.col("出品枚数").alias("listed"), F.col("直近取引価格").alias("last_sold"))


_ODD = """it AS (SELECT *, p_partkey // 20 AS page, CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS BIGINT) AS pos FROM part)"""
ORACLES["listing_items_odd"] = f"""WITH {_ODD} SELECT page, pos, CASE WHEN p_size BETWEEN 20 AND 29 THEN '' ELSE p_name || ' ' || p_brand || ' &co' END AS name, '' AS grade,
  CASE WHEN p_size < 20 THEN '' ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS price,
  'https://shop.example/list/i/' || p_partkey || '.png' AS image_url FROM it WHERE p_size >= 10"""
ORACLES["declared_count_odd"] = """SELECT p_partkey // 20 AS page, CASE WHEN (p_partkey // 20) % 3 = 0 THEN CAST('1' || count(*) AS BIGINT) END AS declared
FROM part GROUP BY p_partkey // 20"""
ORACLES["dry_run_snapshot"] = "SELECT least(5, count(*)) AS shown, 0 AS written FROM part"
ORACLES["poll_snapshot"] = f"""WITH {O._NUMBERS} SELECT lower({O.CODE}) AS code, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE lowest END AS lowest,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE listed END AS listed, last_sold FROM part JOIN nu ON page = p_partkey WHERE p_partkey % 5 = 0"""


# --- JSON -----------------------------------------------------------------------
@query
def json_blobs_pushed(spark, sf):
    """Script bodies with repeated keys and pushed chunks, some of them long, by their text."""
    key = F.col("p_partkey").cast("string")
    script = F.concat(F.lit('<script type="application/ld+json">{"id": '), key, F.lit(', "id": [NaN]}</script><script type="application/json">{bad</script>'))
    pad = F.when(F.col("p_partkey") % 50 == 0, F.repeat(F.lit("x [ "), F.lit(30_000))).otherwise("")
    pushed = F.concat(F.lit('<script>self.__next_f.push([1,"1:'), pad, F.lit(r'[\"p\",{\"id\":'), key, F.lit(r'}] {\"n\":\"\\u3042\"}\n"])</script>'))
    rows = I.spread(I.table(spark, sf, "part").select("p_partkey"), "p_partkey").select("p_partkey", F.concat(F.lit("<html>"), script, pushed, F.lit("</html>")).alias("html"))
    return jsondocs.extract_json_blobs(rows, ["p_partkey"]).select("p_partkey", "part", "blob_no", F.md5("json").alias("json_md5"))


ORACLES["json_blobs_pushed"] = r"""SELECT p_partkey, 'script' AS part, 0 AS blob_no, md5('{"id": ' || p_partkey || ', "id": [NaN]}') AS json_md5 FROM part
UNION ALL SELECT p_partkey, 'pushed', 0, md5('["p",{"id":' || p_partkey || '}]') FROM part
UNION ALL SELECT p_partkey, 'pushed', 1, md5('{"n":"\u3042"}') FROM part"""


@query
def card_records_gaps(spark, sf):
    """Series with days without a price, from documents whose address alone tells the condition."""
    daily = I._daily(spark, sf).filter("condition = 'R'")
    price = F.when(F.col("trade_count") % 7 == 3, F.lit(None)).otherwise(F.col("price"))
    rows = F.array_sort(F.collect_list(F.struct("date", price.alias("price"), F.col("trade_count").alias("tradeCount"))))
    kind = F.when(F.col("card_id").cast("long") % 3 == 0, "psa10").otherwise("plain")
    docs = daily.groupBy("card_id").agg(rows.alias("days")).select(
        F.col("card_id").alias("page"), F.lit("api").alias("kind"), F.lit(0).alias("doc_no"),
        F.concat(F.lit("https://cards.example/api/"), kind, F.lit("/x")).alias("url"),
        F.to_json(F.struct("days"), {"ignoreNullFields": "false"}).alias("json"))
    cards = daily.select(F.col("card_id").alias("page"), "card_id", F.lit("n").alias("card_name"), F.lit("h").alias("hinban")).distinct()
    return jsondocs.card_records(jsondocs.series_candidates(docs), cards, days=5).select(
        I.day("date"), "card_id", "condition", "price", "trade_count", flag("imputed_suspect", "imputed"))


ORACLES["card_records_gaps"] = f"""WITH {O.HISTORY}, r AS (SELECT * FROM h WHERE condition = 'R'), {O.daily('r', 'card_id, condition', O.ORDER, 'd0')},
nb AS (SELECT *, count(*) OVER (PARTITION BY card_id) AS n_points, row_number() OVER (PARTITION BY card_id ORDER BY date DESC) AS back FROM d0
       WHERE trade_count % 7 <> 3),
kp AS (SELECT * FROM nb WHERE n_points >= 2 AND back <= 5), {O.marked('card_id, condition', 'kp')}
SELECT CAST(date AS VARCHAR) AS date, card_id, CASE WHEN CAST(card_id AS BIGINT) % 3 = 0 THEN 'psa10' ELSE '{V.CONDITION_UNKNOWN}' END AS condition,
  price, trade_count, CAST(imputed AS INTEGER) AS imputed FROM mk"""


@query
def index_both_kinds(spark, sf):
    """The normal and the graded index under their labels: last days of the longest series of each page."""
    def candidates(events):
        points = F.array_sort(F.collect_list(F.struct("date", "value")))
        docs = I.daily_index(events.withColumn("all", F.lit("i")), ["all"]).groupBy("all").agg(points.alias("data")).select(
            F.col("all").alias("page"), F.lit("api").alias("kind"), F.lit(0).alias("doc_no"), F.to_json(F.struct("data")).alias("json"))
        return jsondocs.series_candidates(docs)

    events = I.table(spark, sf, "events")
    both = flows.index_points(candidates(events), candidates(events.filter("user_id % 2 = 0")), days=12)
    return both.select("index_type", I.day("date"), F.col("value").cast("bigint").alias("value"))


ORACLES["index_both_kinds"] = f"""WITH e AS (SELECT '{V.INDEX_LABELS['normal']}' AS index_type, * FROM events
  UNION ALL SELECT '{V.INDEX_LABELS['graded']}', * FROM events WHERE user_id % 2 = 0),
d AS (SELECT index_type, CAST(ts AS DATE) AS date, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) // count(*) AS value FROM e GROUP BY 1, 2)
SELECT index_type, CAST(date AS VARCHAR) AS date, value FROM d QUALIFY row_number() OVER (PARTITION BY index_type ORDER BY d.date DESC) <= 12"""


# --- reports ----------------------------------------------------------------------
@query
def card_report_detail(spark, sf):
    """The last days of the reported cards, imputed ones marked."""
    _, detail = match.card_report(I.named_history(spark, sf), "red widget")
    return detail.select("card_id", "condition", I.day("date"), "price", "trade_count", flag("imputed_suspect", "imputed"))


ORACLES["card_report_detail"] = f"""WITH {O.NAMED}, kc AS (
  SELECT card_id, min(seq) AS seq, arg_min(card_name, row(seq, card_name, hinban)) AS card_name FROM n GROUP BY 1),
hit AS (SELECT card_id, CASE WHEN card_name = 'red widget' THEN 80 ELSE 40 END AS score FROM kc
  WHERE contains(card_name, 'red widget') ORDER BY score DESC, card_name, seq LIMIT {V.REPORT_HITS}),
src AS (SELECT n.* FROM n JOIN hit USING (card_id)), {O.daily('src', 'card_id, condition', O.ORDER)}, {O.marked('card_id, condition')}
SELECT card_id, condition, CAST(date AS VARCHAR) AS date, price, trade_count, CAST(imputed AS INTEGER) AS imputed FROM mk
QUALIFY row_number() OVER (PARTITION BY card_id, condition ORDER BY mk.date DESC) <= {V.SHOW_DAYS}"""
