import json
from datetime import date, timedelta

from tests.test_sources import BASE, LISTING
from tidemark.plans import flows as W
from tidemark.schemas import BUYLIST, CARD_HISTORY, CARD_STATUS, GROUP_HISTORY, INDEX_HISTORY, MARKET_SNAPSHOT, TREND, WATCHLIST
from tidemark.session import scratch_dir
from tidemark.sources.tables import read_table, upsert_table
from tidemark.streaming import upsert as U

NOW = "2026-10-10 15:00:01"
DAY0 = date(2026, 8, 1)


def stored(spark, root, table):
    return read_table(spark, f"{root}/{table.name}", table)


def test_snapshot(spark):
    root = scratch_dir(spark, "flow")
    listing = spark.createDataFrame([(1, LISTING), (2, LISTING)], "page long, html string")
    assert W.snapshot(root, listing, BASE, NOW, dry=True).count() == 4
    assert W.snapshot(root, listing, BASE, NOW)
    rows = stored(spark, root, BUYLIST)
    assert rows.count() == 4 and rows.columns == BUYLIST.schema.names
    assert not W.snapshot(root, listing.limit(0), BASE, NOW) and stored(spark, root, BUYLIST).count() == 4
    assert W.listing_audit(listing, BASE).select("items", "declared", "short").first() == (4, 494, True)


def test_resolve_and_poll(spark):
    root = scratch_dir(spark, "flow")
    rows = spark.createDataFrame(
        [("001/1 ", "ア", "", "", None, "", "keep", 0), ("002/2", "イ", "", "", None, "", "", 1), ("003/3", "ウ", "", "https://s.example/products/9", None, "", "", 2)],
        "`品番` string, `名前` string, `検索キー` string, product_url string, `解決日時` timestamp, `備考` string, memo string, _pos long")
    asked = W.search_requests(rows, ["https://s.example/?k={q}", "https://s.example/?q={q}"])
    assert asked.count() == 4 and W.search_requests(rows, ["x{q}"], limit=1).count() == 1
    html = {("001/1 ア", 0): "none", ("001/1 ア", 1): '<a href="/products/7">x</a>', ("002/2 イ", 0): "", ("002/2 イ", 1): ""}
    found = spark.createDataFrame([(k, n, h) for (k, n), h in html.items()], "`検索キー` string, template_no int, html string")
    done = W.resolve(rows, W.search_results(found, "https://s.example"), NOW).orderBy("_pos")
    got = [(r["品番"], r["product_url"], r["備考"], r["memo"]) for r in done.collect()]
    assert got == [("001/1", "https://s.example/products/7", "", "keep"), ("002/2", "", "検索ヒットなし", ""), ("003/3", "https://s.example/products/9", "", "")]
    product = spark.createDataFrame([("https://s.example/products/7", "<p>最安 ¥1,200</p>")], "product_url string, html string")
    assert W.poll(root, done, product, NOW)
    assert sorted((r["品番"], r["最安価格"]) for r in stored(spark, root, MARKET_SNAPSHOT).collect()) == [("001/1", "1200"), ("003/3", "")]


def docs(spark, prices, start=0):
    chart = {"data": [{"date": str(DAY0 + timedelta(start + i)), "price_01": p, "price_03": 900 + i, "volume": 2} for i, p in enumerate(prices)]}
    return spark.createDataFrame([("p1", "decoded", 0, json.dumps(chart))], "page string, kind string, doc_no long, json string")


def test_daily(spark, tmp_path):
    root = scratch_dir(spark, "flow")
    seed = tmp_path / "seed.tsv"
    seed.write_text("品番\t名前\tcard_id\turl\tメモ\n001/100\tアカ\t\t\t\n", encoding="utf-8")
    cards = spark.createDataFrame([("a-1", "アカ [001/100]", "001/100", "https://c.example/a-1/", 0), ("b-2", "アオ", "002/100", "u", 1)],
                                  "card_id string, card_name string, hinban string, url string, seq long")
    assert W.store_master(spark, root, cards, NOW)
    assert W.watchlist(spark, root, str(seed)).count() == 1
    assert W.refresh_watchlist(spark, root, str(seed)).select("card_id", "url").first() == ("a-1", "https://c.example/a-1/")
    assert [r["card_id"] for r in W.targets(spark, root).collect()] == ["a-1"]
    page = spark.createDataFrame([("p1", "a-1", "アカ", "001/100")], "page string, card_id string, card_name string, hinban string")

    def load(prices, start):
        W.store_cards(spark, root, docs(spark, prices, start), page, NOW)
        index = [(DAY0 + timedelta(start + i), "bihin", float(1000 + 10 * (start + i)), i) for i in range(len(prices))]
        W.store_index(spark, root, spark.createDataFrame(index, "date date, index_type string, value double, seq long"), NOW)
        W.refresh_board(spark, root, NOW)
        return {r["trend"]: r["series"] for r in W.refresh_trends(spark, root, "2026-12-31", NOW).collect()}

    load([200 - 3 * i for i in range(15)], 0)
    counts = load([200 - 3 * i for i in range(10, 20)], 10)
    assert load([200 - 3 * i for i in range(10, 20)], 10) == counts  # the same load again
    assert stored(spark, root, CARD_HISTORY).count() == 40
    board = {r["状態"]: r for r in stored(spark, root, CARD_STATUS).collect()}
    assert set(board) == {"美品", "psa10"} and board["美品"]["傾向"] == "下落" and board["美品"]["名前"] == "アカ" and board["美品"]["有効観測日"] == 20
    diffs = [r["diff"] for r in stored(spark, root, INDEX_HISTORY).orderBy("date").collect()]
    assert diffs == [None] + [10.0] * 19  # the second load looked back over the stored history
    last = {(r["scope"], r["key"]): r for r in stored(spark, root, TREND).filter("date = '2026-08-20'").collect()}
    assert set(last) == {("index", "bihin"), ("card", "a-1|美品"), ("card", "a-1|psa10"), ("group", "condition:美品"), ("group", "condition:psa10"), ("group", "set:100")}
    assert last[("card", "a-1|美品")]["label"] == "アカ [001/100] 美品"
    summary, detail = W.report(spark, root, "001/100", NOW)
    assert summary.count() == 2 and detail.count() == 40


def test_stream_replays_change_nothing(spark):
    root = scratch_dir(spark, "flow")
    rows = [(DAY0 + timedelta(i), "c", "美品", 100 + i, 1, i) for i in range(12)]
    schema = "date date, card_id string, condition string, price long, trade_count long, seq long"
    history, trends, drop = f"{root}/{CARD_HISTORY.name}", f"{root}/{TREND.name}", f"{root}/drop"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(drop)
    after = lambda batch: U.refresh_card_trends(spark, history, trends, batch, "2026-12-31")
    spark.createDataFrame(rows[:8], schema).coalesce(1).write.parquet(f"{drop}")
    U.stream_upsert(stream(), history, CARD_HISTORY, f"{root}/cp", after=after).awaitTermination()
    spark.createDataFrame(rows[5:], schema).coalesce(1).write.mode("append").parquet(drop)
    U.stream_upsert(stream(), history, CARD_HISTORY, f"{root}/cp", after=after).awaitTermination()
    state = lambda: sorted((r["date"], r["price"]) for r in stored(spark, root, CARD_HISTORY).collect())
    once = state()
    assert [p for _, p in once] == [100 + i for i in range(12)]
    U.stream_upsert(stream(), history, CARD_HISTORY, f"{root}/cp2", after=after).awaitTermination()  # everything again
    assert state() == once
    assert stored(spark, root, TREND).filter("date = '2026-08-12'").first()["valid_days"] == 12


def test_a_late_index_day_mends_the_day_after(spark):
    root = scratch_dir(spark, "flow")
    put = lambda days: W.store_index(spark, root, spark.createDataFrame(
        [(DAY0 + timedelta(d), "bihin", 1000.0 + 10 * d, i) for i, d in enumerate(days)], "date date, index_type string, value double, seq long"), NOW)
    put([0, 2])
    put([1])
    assert [r["diff"] for r in stored(spark, root, INDEX_HISTORY).orderBy("date").collect()] == [None, 10.0, 10.0]


def test_refreshed_card_trends_keep_their_labels(spark):
    root = scratch_dir(spark, "flow")
    rows = spark.createDataFrame([(DAY0 + timedelta(i), "c", "アカ", "001/100", "美品", 100 + i, 1, i) for i in range(12)],
                                 "date date, card_id string, card_name string, hinban string, condition string, price long, trade_count long, seq long")
    history, trends = f"{root}/{CARD_HISTORY.name}", f"{root}/{TREND.name}"
    upsert_table(spark, history, rows, CARD_HISTORY)
    U.refresh_card_trends(spark, history, trends, rows, "2026-12-31")
    assert [r["label"] for r in stored(spark, root, TREND).collect()] == ["アカ [001/100] 美品"]


def test_group_refresh_reads_the_card_history_once(spark, monkeypatch):
    root, plans = scratch_dir(spark, "flow"), []
    schema = "date date, card_id string, card_name string, hinban string, condition string, price long, trade_count long, seq long"
    load = lambda rows: spark.createDataFrame([(DAY0 + timedelta(i), c, "", code, "美品", p, 1, n) for n, (i, c, code, p) in enumerate(rows)], schema)
    history, groups, trends = f"{root}/{CARD_HISTORY.name}", f"{root}/groups", f"{root}/{TREND.name}"
    keep = U.written
    monkeypatch.setattr(U, "written", lambda df, purpose: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, purpose))
    for rows in ([(0, "a", "001/100", 5), (0, "b", "001/200", 7), (1, "a", "001/100", 6)], [(0, "b", "001/100", 9)]):
        upsert_table(spark, history, load(rows), CARD_HISTORY)
        U.refresh_group_trends(spark, history, groups, trends, load(rows), "2026-12-31")
    # the second load moved the only card of set 200 away: the day stays, without a price
    got = {(r["key"], r["date"].day): (r["price"], r["trade_count"]) for r in read_table(spark, groups, GROUP_HISTORY).collect()}
    assert got == {("condition:美品", 1): (7.0, 2), ("condition:美品", 2): (6.0, 1), ("set:100", 1): (7.0, 2), ("set:100", 2): (6.0, 1),
                   ("set:200", 1): (None, None)}
    assert [p.count(f"{CARD_HISTORY.name}]") for p in plans] == [1, 1]
