import json

from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators import items as I
from tidemark.sources import json_walk as W
from tidemark.sources.json_scan import scan
from tidemark.sources import jsondocs as J
from tidemark.sources import pages as P
from tidemark.sources.requests import build_search_requests

BASE = "https://store.example/list"


def item(name="", price="", stock="", grade="", img="", cls="item"):
    return (f'<li class="{cls}"><p class="card"><img src="{img}" alt="x"></p><p class="name">{name}</p>'
            f'<p class="tag">{grade}</p><p class="price">{price}</p><p class="stock end">{stock}</p></li>')


LISTING = ('<section><span id="itemCount">494件表示</span><ul id="cardList" style="display: none;">'
           + item("カード[SM2+] SR 056/049", "1,500,000円", "残り2点", "PSA10", "https://store.example//uploads/a.jpg")
           + item("B", "1,490,000円", "受付終了", cls="item closed") + item("", "", "残り1点") + item("", "5円", "本日受付終了")
           + item("ア&amp;イ <b>SR</b>", "566,000円", "残り6点", img="//img.example/x.jpg")
           + '</ul><ul id="listView">' + item("ignored", "1円") + "</ul></section>")


def listing(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "page long, html string")
    return P.extract_listing_items(df, BASE).orderBy("page", "pos").collect()


def test_listing(spark):
    rows = listing(spark, LISTING)
    assert [(r["pos"], r["name"], r["price"], r["accept_status"]) for r in rows] == [
        (0, "カード[SM2+] SR 056/049", "1500000", "募集中"), (1, "B", "1490000", "受付終了"), (3, "", "5", "受付終了"), (4, "ア&イ SR", "566000", "募集中")]
    assert [r["image_url"] for r in rows] == ["https://store.example/uploads/a.jpg", "", "", "https://img.example/x.jpg"]
    assert rows[0]["grade"] == "PSA10" and rows[0]["stock"] == "残り2点"


def test_listing_falls_back_to_the_text_list_and_survives_unclosed_items(spark):
    html = '<ul id="listView"><li class="item"><p class="name">a<p class="price">1<li class="item"><p class="name">b</ul>'
    assert [(r["page"], r["name"], r["price"]) for r in listing(spark, html, "", "<p>no list")] == [(0, "a", "1"), (0, "b", "")]


def test_declared_count(values):
    assert values(P.declared_count("x"), [LISTING, "<i id='itemCount'>なし</i>", "", None]) == [494, None, None, None]


def test_dedup_keeps_the_first_of_copies(spark):
    rows = [("a", "g", "1", "u", 2, 0, "late"), ("a", "g", "1", "u", 1, 5, "first"), ("a", "g", "2", "u", 1, 6, "other")]
    df = spark.createDataFrame(rows, "name string, grade string, price string, image_url string, page long, pos long, stock string")
    assert {r["stock"] for r in I.dedup_items(df).collect()} == {"first", "other"}
    many = spark.range(50_000).select(F.lit("a").alias("name"), F.lit("g").alias("grade"), F.lit("1").alias("price"), F.lit("u").alias("image_url"),
                                      F.col("id").alias("page"), F.lit(0).cast("long").alias("pos"))
    assert [r["page"] for r in I.dedup_items(many).collect()] == [0]


def test_links(spark, values):
    html = """<a class=x href="/brands/1">b</a><A HREF='/products/12?a=1&amp;b=2'>p</A><a href="/trading-cards/9">t</a>"""
    from tidemark.fixed_values import PRODUCT_URL_PATTERNS
    got = values(P.first_link("x", PRODUCT_URL_PATTERNS, "https://shop.example"), [html, '<a href="/x">', None])
    assert got == ["https://shop.example/trading-cards/9", None, None]  # the preferred pattern wins wherever it stands
    assert values(P.first_link("x", PRODUCT_URL_PATTERNS[1:], "https://shop.example"), [html]) == ["https://shop.example/products/12?a=1&b=2"]
    assert values(P.first_link("x", [r"/p/\d"], "https://shop.example"), ['<!-- <a href="/p/1"> --><a class=b href=/p/2>x</a>']) == ["https://shop.example/p/2"]


def test_catalogue(spark):
    pages = [(1, '<a href="/card/a-1/"><b>A</b> 001/100</a><a href="/cards/z">z</a><a href="/card/a-1">again</a>'),
             (2, '<div class="x cardList"><a href="/p/b-2">B</a></div><a href="/p/c-3">C</a>'), (3, '<a href="/card/a-1">later</a>')]
    df = P.extract_catalog(spark.createDataFrame(pages, "page long, html string"), "https://cards.example")
    assert sorted((r["card_id"], r["card_name"], r["hinban"], r["url"]) for r in df.collect()) == [
        ("a-1", "A 001/100", "001/100", "https://cards.example/card/a-1/"), ("b-2", "B", "", "https://cards.example/p/b-2")]


def test_product_numbers(spark):
    pages = [(0, '<p class="js-lowestPrice"><i>¥</i> 12,800</p><span>3 枚の出品</span><p>最終取引価格 ¥9,000</p>'),
             (1, '<p class="lowestPrice">soon</p><p class="minPrice">7</p>'), (2, "<script>最安 5</script><!-- 在庫 9 --><p>none</p>")]
    df = P.extract_numbers(spark.createDataFrame(pages, "page long, html string"))
    assert [tuple(r)[1:] for r in df.orderBy("page").collect()] == [("12800", "3", "9000"), ("7", "", ""), ("", "", "")]
    assert A.extraction_failures(df, df.columns[1:]).first() == (3, 1, False)


def test_search_requests(spark):
    df = build_search_requests(spark.createDataFrame([("006/165 カ",)], "`検索キー` string"), ["https://s.example/?k={q}", "https://s.example/?q={q}"])
    assert [(r["template_no"], r["url"]) for r in df.collect()] == [
        (0, "https://s.example/?k=006/165%20%E3%82%AB"), (1, "https://s.example/?q=006/165%20%E3%82%AB")]


# --- JSON ------------------------------------------------------------------------
def test_blobs(spark):
    html = ('<script id="__NEXT_DATA__" type="application/json">{"props":{"series":[{"d":"2026-08-01","y":100},{"d":"2026-08-02","y":120}]}}</script>'
            '<script type="application/ld+json">not json</script><script>var a={"no":1}</script>'
            '<script>self.__next_f.push([1,"a:[{\\"date\\":\\"2026-08-01\\",\\"price\\":1}] x {\\"b\\":2}"])</script>')
    df = J.extract_json_blobs(spark.createDataFrame([(7, html), (8, None)], "page long, html string"), ["page"])
    got = [(r["page"], r["part"], r["json"]) for r in df.orderBy("part", "blob_no").collect()]
    assert [g[:2] for g in got] == [(7, "pushed"), (7, "pushed"), (7, "script")]
    assert json.loads(got[0][2]) == [{"date": "2026-08-01", "price": 1}] and json.loads(got[1][2]) == {"b": 2}
    series = J.extract_series(df, ["page", "part"]).orderBy("idx").collect()
    assert [(r["path"], str(r["date"]), r["price"], r["trade_count"]) for r in series] == [
        ("props.series", "2026-08-01", 100, None), ("props.series", "2026-08-02", 120, None)]


def test_scan_of_free_text():
    assert list(scan('a:b:[{"d":1},2] {bad {"x":[1]} tail')) == ['[{"d":1},2]', '{"x":[1]}']
    assert list(scan("{" * 20_001 + "[1,2]")) == ["[1,2]"]
    assert list(scan("[" * 5000)) == []


def test_series_walk():
    two = [{"date": "2026-08-01", "price": 100, "tradeCount": 3}, {"date": "2026-08-02", "price": "110円", "tradeCount": 0}]
    found = dict(W.series({"props": {"chart": two, "single": two[:1]}, "t": [[two]]}))
    assert list(found) == ["props.chart", "t[0][0]"]
    assert [(str(d), p, c) for d, p, c in found["props.chart"]] == [("2026-08-01", 100, 3), ("2026-08-02", 110, 0)]
    assert list(W.series(two))[0][0] == "$"
    assert [p for p, _ in W.series([[two]] * 60)] == [f"[{i}][0]" for i in range(60)]
    deep = two
    for _ in range(14):
        deep = [deep]
    assert [p for p, _ in W.series(deep)] == ["[0]" * 14]
    assert W.load("[" * 200_000) is None and W.load("1" * 5000) is None and W.whole("9" * 5000) is None and W.whole("0" * 5000 + "7") == 7
    assert W.day(3e14) is None and str(W.day(2.5e11 * 1000)) != "None"
    assert [str(W.day(v)) for v in (1786978800, 1786978800000, "2026年8月18日", True, 5, "2026/13/45", None)] == ["2026-08-18"] * 3 + ["None"] * 4
    assert [W.whole(v) for v in (1.9, -1.9, float("nan"), "▲5", "-", None, True)] == [1, -1, None, -5, None, None, 1]


def test_chart_rows_and_item_records():
    rows = [{"date": "2026-08-18", "price_01": 95000, "price_02": 47000, "price_03": 680000, "volume": 3, "more": [{"date": "x", "price_02": 1}]}]
    assert [p for p, _ in W.charts({"data": rows})] == ["data", "data[0].more"]
    record = {"strSlug": "sm10b-060-054", "strName": "カード [SM10b 060/054]", "sub": {"strSlug": "no", "strName": "no"}}
    assert list(W.item_records({"items": {"168": record, "9": {"strSlug": ""}}})) == [record]


def test_candidates_and_card_records(spark):
    chart = {"data": [{"date": f"2026-08-{d:02d}", "price_01": 100 + d, "price_03": 900, "volume": d % 2} for d in range(1, 6)]}
    api = {"mint": [{"date": f"2026-07-{d:02d}", "price": d} for d in range(1, 9)]}
    docs = [(1, "decoded", 0, json.dumps(chart)), (1, "api", 0, json.dumps(api)), (1, "embedded", 0, "oops")]
    found = J.series_candidates(spark.createDataFrame(docs, "page long, kind string, doc_no long, json string"))
    ranked = {(r["rank"], r["source"], r["n_points"]) for r in found.collect()}
    assert ranked == {(1, "api :: mint", 8), (2, "decoded :: data :: 美品", 5), (3, "decoded :: data :: PSA10", 5)}
    cards = spark.createDataFrame([(1, "c", "C", "001/1")], "page long, card_id string, card_name string, hinban string")
    rows = J.card_records(found, cards, days=4).collect()
    by = {}
    for r in rows:
        by.setdefault(r["condition"], []).append((r["price"], r["imputed_suspect"]))
    assert sorted(by["美品"]) == [(5, False), (6, False), (7, False), (8, False), (102, True), (103, False), (104, True), (105, False)]
    assert [f for _, f in sorted(by["psa10"])].count(True) == 2
    index = J.index_records(found, "bihin", days=3).orderBy("date").collect()
    assert [(r["value"], r["index_type"]) for r in index] == [(6.0, "bihin"), (7.0, "bihin"), (8.0, "bihin")]


def test_known_path(spark):
    doc = json.dumps({"a": {"b": [{"date": "2026/08/01", "price": "1,000円", "tradeCount": 2}, {"date": "x", "price": 1}, {"date": "2026-08-03", "price": 5}]}})
    df = J.extract_series_at(spark.createDataFrame([(1, doc)], "page long, json string"), ["page"], "$.a.b")
    assert [(str(r["date"]), r["price"], r["trade_count"]) for r in df.orderBy("idx").collect()] == [("2026-08-01", 1000, 2), ("2026-08-03", 5, None)]


# --- audits ------------------------------------------------------------------------
def test_shapes(values):
    many = json.dumps({f"k{i}": i for i in range(13)})
    assert values(A.json_shape("x"), [many]) == ["{" + ", ".join(sorted(f"k{i}" for i in range(13))) + "}"] or values(A.json_shape("x"), [many]) == ["{" + ", ".join(f"k{i}" for i in range(13)) + "}"]
    assert values(A.json_shape("x", 12), ['{"a":1,"b":[2]}', '[{"a":1},2]', "[]", "[[[[1]]]]", '"s"', "3", "1.5", "true", "null", "oops", many]) == [
        "{a, b}", "[2件 {a}]", "[0件 ]", "[1件 [1件 [1件 ...]]]", "str", "int", "float", "bool", "NoneType", None,
        "{" + ", ".join(f"k{i}" for i in range(12)) + "...}"]


def test_robots(spark):
    text = "User-agent: *\nDisallow: /admin/\nAllow: /\n\nUser-agent: mybot\nAllow: /private/ok\nDisallow: /private/\n"
    rules = A.robots_rules(spark.createDataFrame([("a.example", text), ("b.example", None)], "host string, robots_txt string"), "mybot")
    urls = [f"https://a.example{p}" for p in ("/", "/all/", "/admin/secret", "/private/x", "/private/ok/1", "")] + ["https://b.example/admin/"]
    got = A.robots_filter(spark.createDataFrame([(u,) for u in urls], "url string"), rules)
    assert {r["url"]: r["allowed"] for r in got.collect()} == dict(zip(urls, [True, True, False, False, True, True, None]))
    assert A.may_read(got).count() == 5


def test_completeness(spark):
    items = spark.createDataFrame([(1,), (1,), (2,)], "page long")
    declared = spark.createDataFrame([(1, 2), (2, 5), (3, 0), (4, None)], "page long, declared long")
    got = {r["page"]: (r["items"], r["checked"], r["short"]) for r in A.completeness_audit(items, declared, ["page"]).collect()}
    assert got == {1: (2, True, False), 2: (1, True, True), 3: (0, False, False), 4: (0, False, False)}


# --- odd input -----------------------------------------------------------------------
def test_pushed_chunks_of_any_length_and_unusual_json(spark):
    long = json.dumps([{"date": "2026-08-01", "price": i} for i in range(20_000)])
    html = "<script>self.__next_f.push([1," + json.dumps("x:" + long) + "])</script>"
    other = '<script type="application/json">{"a":1,"a":2}</script><script type="application/json">[NaN]</script><script type="application/json">' + "[" * 200_000 + "</script>"
    df = J.extract_json_blobs(spark.createDataFrame([(1, html), (2, other)], "page long, html string"), ["page"])
    got = {(r["page"], r["part"], r["blob_no"]): r["json"] for r in df.collect()}
    assert got == {(1, "pushed", 0): long, (2, "script", 0): '{"a":1,"a":2}', (2, "script", 1): "[NaN]"}


def test_wide_charts_keep_the_last_points_of_each_series(spark):
    rows = [{"date": f"2026-{1 + d // 28:02d}-{1 + d % 28:02d}", "price_01": 5 + d, **({"price_03": 900 + d} if d >= 60 else {}), "volume": 1} for d in range(100)]
    docs = spark.createDataFrame([(1, "decoded", 0, "https://x/psa10/a", json.dumps({"data": rows}))], "page long, kind string, doc_no long, url string, json string")
    found = J.series_candidates(docs)
    assert {r["source"] for r in found.collect()} == {"decoded :: https://x/psa10/a :: data :: 美品", "decoded :: https://x/psa10/a :: data :: PSA10"}
    cards = spark.createDataFrame([(1, "c", "C", "001/1")], "page long, card_id string, card_name string, hinban string")
    kept = J.card_records(found, cards, days=30)
    assert sorted(r["price"] for r in kept.where("price >= 900").collect()) == [900 + d for d in range(70, 100)]


def test_entities_and_nested_counts(values):
    assert values(P.decode_entities(F.col("x")), ["最安値 &#165;1,000", "&#x4ef6;&amp;lt;&lt;&#38;lt;", "a &yen;5 &#0; &#xD800; &#9999999;", "plain", ""]) == [
        "最安値 ¥1,000", "件&lt;<&lt;", "a ¥5 \ufffd \ufffd \ufffd", "plain", ""]
    assert values(P.declared_count("x"), ['<span id="itemCount"><b>全</b>494&#20214;</span>', "<p id=itemCount>7</p>"]) == [494, 7]


def test_deep_and_broken_pages(spark):
    from tidemark.sources import html_nodes
    deep = "<ul id=cardList>" + "<div>" * 5000 + "<font>" * 3000 + '<li class=item><span class=name>A</span></li>'
    rows = spark.createDataFrame([(1, deep), (2, "<ul id=listView><li class=item><span class=name>B</span></li><li class=item></li></ul><![foo["), (3, None)], "page long, html string")
    assert {(r["page"], r["name"]) for r in P.extract_listing_items(rows, "https://x").collect()} == {(1, "A"), (2, "B")}
    assert html_nodes.tree(deep).text() == "A"


def test_points_of_pages_go_to_all_partitions(spark):
    text = json.dumps({"a": [{"date": f"2026-01-{d:02d}", "price": d} for d in range(1, 9)]})
    docs = spark.createDataFrame([(str(i), "api", 0, text) for i in range(50)], "page string, kind string, doc_no int, json string")
    found = J.series_candidates(docs)
    assert found.count() == 400
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
