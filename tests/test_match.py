import random

from pyspark.sql import functions as F

from tidemark.operators import codes as C
from tidemark.operators import match as M
from tidemark.operators.trend import status_board, trend_all_scopes

CARD = "card_id string, card_name string, hinban string, url string, seq long"
WATCH = "`品番` string, `名前` string, card_id string, url string, `メモ` string, seq long"
CARDS = [("dragon-006", "ドラゴンex", "006/165", "u1", 0), ("mouse-211", "スーパーマウス", "211/SMｰP", "u2", 1),
         ("black-082", "ブラックーVMax", "082/069", "u3", 2)]


def ids(spark, query, cards=CARDS):
    hits = M.match_cards(spark.createDataFrame([(query,)], "query string"), spark.createDataFrame(cards, CARD))
    return [(r["card_id"], r["score"]) for r in M.top_matches(hits, 100).orderBy("rank").collect()]


def test_every_kind_of_query(spark):
    wanted = {"006/165": ("dragon-006", 90), "211/SM-P": ("mouse-211", 90), "211/SMｰP": ("mouse-211", 90), "ブラックーvmax": ("black-082", 80),
              "ドラゴン": ("dragon-006", 60), "マウス": ("mouse-211", 40), "165": ("dragon-006", 30), "BLACK-082": ("black-082", 100),
              "https://cards.example/card/black-082/": ("black-082", 100)}
    for query, hit in wanted.items():
        assert ids(spark, query) == [hit], query
    assert ids(spark, "存在しない") == [] and ids(spark, " ") == []


def test_exact_before_partial_all_kept(spark):
    cards = [("a", "ドラゴンex SAR", "201/165", "", 0), ("b", "ドラゴン", "006/165", "", 1)]
    assert ids(spark, "ドラゴン", cards) == [("b", 80), ("a", 60)]


def brute_score(q, c):
    if c[0].lower() == q.lower():
        return 100
    code, name, qc, qn = c[2].upper().replace(" ", ""), c[1].lower(), q.upper().replace(" ", ""), q.lower()
    if code and code == qc:
        return 90
    if name and name == qn:
        return 80
    if name.startswith(qn):
        return 60
    if qn in name:
        return 40
    return 30 if code and qc in code else 0


def test_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("ab1/") for _ in range(n))
    cards = [(f"id{i}", word(rng.randint(1, 6)), word(rng.randint(0, 4)), "", i) for i in range(150)]
    queries = sorted({word(rng.randint(1, 5)) for _ in range(60)} | {"ID3", "id77"})
    got = M.match_cards(spark.createDataFrame([(q,) for q in queries], "query string"), spark.createDataFrame(cards, CARD))
    want = {(q, c[0], s) for q in queries for c in cards if (s := brute_score(q, c))}
    rows = [(r["query"], r["card_id"], r["score"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def resolve(spark, watch, cards):
    out = M.resolve_watchlist(spark.createDataFrame(watch, WATCH), spark.createDataFrame(cards, CARD))
    return {r["seq"]: (r["card_id"], r["url"], r["メモ"]) for r in out.collect()}


def test_resolve(spark):
    cards = [("x1", "アカ", "001/100", "u1", 0), ("x2", "アオ [001/100]", "001/100", "u2", 1), ("x3", "キイロ", "002/100", "u3", 2)]
    got = resolve(spark, [
        ("001/100", "アオ", None, None, "old", 0), ("001/100", "ミドリ", "", "", "", 1), ("001/100", "", "", "", "", 2),
        ("", "キイロ", "", "typed", "m", 3), ("", "", "", "", "", 4), ("999/999", "", "", "", "m", 5), ("001/100", "アオ", "kept", "", "m", 6)], cards)
    assert got[0] == ("x2", "u2", "old")                                   # code and name agree on one
    assert got[1] == ("x2", "u2", "候補2件から先頭を採用（要確認）")           # name agrees with none: all code hits
    assert got[2][2] == "候補2件から先頭を採用（要確認）"
    assert got[3] == ("x3", "typed", "m")                                  # a url typed by hand stays
    assert got[4][2] == got[5][2] == "マスタに見つかりません（手でcard_id/urlを入れてください）"
    assert got[6] == ("kept", "", "m")


def test_resolve_counts_an_id_hit_once(spark):
    cards = [("001/100", "アカ", "001/100", "u1", 0), ("x2", "アオ", "001/100", "u2", 1)]
    assert resolve(spark, [("001/100", "", "", "", "", 0)], cards)[0] == ("001/100", "u1", "候補2件から先頭を採用（要確認）")


def test_copies_of_a_card_cost_one_row(spark):
    """A third of the catalogue is one card; it is counted, not multiplied out."""
    master = spark.range(30_000).select(
        F.col("id").cast("string").alias("card_id"), F.when(F.col("id") % 3 == 0, "hot card").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("card_name"),
        F.when(F.col("id") % 3 == 0, "1/1").otherwise("").alias("hinban"), F.lit("u").alias("url"), F.col("id").alias("seq"))
    watch = spark.createDataFrame([("1/1", "", "", "", "", 0)], WATCH)
    assert M.resolve_watchlist(watch, master).first()["メモ"] == "候補10000件から先頭を採用（要確認）"


def test_targets(spark):
    master = spark.createDataFrame(CARDS, CARD)
    watch = spark.createDataFrame([("", "", "mouse-211", "", "", 0), ("9/9", "手", "", "https://h.example/c/zz/", "", 1),
                                   ("", "", "gone", "", "", 2)], WATCH)
    got = M.plan_targets(watch, master).orderBy("_part", "seq").collect()
    assert [r["card_id"] for r in got] == ["mouse-211", "zz"]
    assert M.plan_targets(watch, master, limit=1).count() == 1
    empty = watch.limit(0)
    assert M.plan_targets(empty, master).count() == 0 and M.plan_targets(empty, master, crawl_all=True).count() == 3


def test_duplicate_codes_and_resolution(spark):
    codes = ["060/054", "060/054", "055/050", "055/050", "211/SMｰP", "211/SM-P", "001/100", "", ""]
    df = spark.createDataFrame([(c,) for c in codes], "`品番` string")
    assert {r["code"] for r in C.duplicate_codes(df).collect()} == {"060/054", "055/050", "211/SM-P"}
    rows = spark.createDataFrame(
        [("211/SMｰP", "カード（高い方）", "", "", None, "手動", "x", 0), ("211/SM-P ", "カード", "", "", None, "", "y", 1),
         ("001/100", "ハ", "", "done", None, "品番重複（要確認）", "z", 2)],
        "`品番` string, `名前` string, `検索キー` string, product_url string, `解決日時` timestamp, `備考` string, extra string, _pos long")
    flagged = C.flag_duplicate_codes(rows)
    got = {r["_pos"]: r for r in flagged.collect()}
    assert got[0]["備考"] == "手動 / 品番重複（要確認）" and got[2]["備考"] == "" and got[0]["名前"] == "カード(高い方)"
    assert got[0]["検索キー"] == got[1]["検索キー"] == "211/SM-P カード" and got[0]["extra"] == "x"
    assert C.unresolved(flagged).count() == 2 and C.resolved(flagged).count() == 1
    results = spark.createDataFrame([("211/SM-P カード", "https://s.example/1")], "`検索キー` string, link string")
    at = F.lit("2026-01-01").cast("timestamp")
    done = {r["_pos"]: r for r in C.apply_resolution(flagged, results, at).collect()}
    assert done[0]["product_url"] == "https://s.example/1" and done[0]["解決日時"] is not None and done[2]["product_url"] == "done"
    missed = C.apply_resolution(flagged, results.withColumn("link", F.lit("")), at)
    assert {r["_pos"]: r["備考"] for r in missed.collect()}[1] == "品番重複（要確認） / 検索ヒットなし"


# --- boards and scopes over a small history -------------------------------------
HISTORY = "date date, card_id string, card_name string, hinban string, condition string, price long, trade_count long, seq long"


def history(spark, *cards):
    from tests.test_series import DAY0
    from datetime import timedelta
    rows = []
    for cid, name, code, cond, prices, counts in cards:
        rows += [(DAY0 + timedelta(i), cid, name, code, cond, p, c, len(rows) + i) for i, (p, c) in enumerate(zip(prices, counts))]
    return spark.createDataFrame(rows, HISTORY)


def test_board(spark):
    df = history(spark, ("up", "", "003/100", "美品", [100 + 3 * i for i in range(20)], [2] * 20),
                 ("down", "D", "001/100", "美品", [200 - 3 * i for i in range(20)], [2] * 19 + [0]),
                 ("down", "", "", "PSA10", [500 - i for i in range(20)], [2] * 20), ("few", "F", "002/100", "", [100, 99, 98], [2] * 3),
                 ("none", "N", "", "美品", [None], [1]))
    from tidemark.operators.trend import export_board, order_board
    rows = order_board(status_board(df)).collect()
    urgency = ["下落", "判定不可", "横ばい", "上昇"]
    assert [urgency.index(r["傾向"]) for r in rows] == sorted(urgency.index(r["傾向"]) for r in rows)
    by = {(r["card_id"], r["状態"]): r for r in rows}
    assert len(by) == 4 and by[("few", "不明")]["記録日数"] == 3
    assert by[("down", "美品")]["最新が補完"] and by[("down", "PSA10")]["名前"] == "D" and by[("down", "PSA10")]["品番"] == "001/100"
    shown = {r["card_id"]: r for r in export_board(status_board(df).filter("`状態` = '美品'")).collect()}
    assert shown["down"]["最新が補完"] == "★補完" and shown["down"]["直近1週間"].endswith("*") and float(shown["down"]["d7%"]) < 0
    watched = spark.createDataFrame([("up",)], "card_id string")
    assert [r["card_id"] for r in status_board(df, watched=watched).collect()] == ["up"]
    assert status_board(df, watched=watched.limit(0)).count() == 0


def test_scopes_and_labels(spark):
    df = history(spark, ("a", "A", "001/100", "美品", [200 - 3 * i for i in range(20)], [2] * 20), ("b", "", "", "", [5], [None]),
                 ("c", "C", "x", "美品", [None], [1]))
    index = spark.createDataFrame([(r[0], "", float(r[5]), r[7]) for r in df.collect() if r[1] == "a"],
                                  "date date, index_type string, value double, seq long")
    rows = {(r["scope"], r["key"]): r for r in trend_all_scopes(index, df, "2030-01-01").collect()}
    assert set(rows) == {("index", "unknown"), ("card", "a|美品"), ("card", "b|"), ("card", "c|美品"), ("group", "condition:美品"), ("group", "set:100")}
    assert rows[("card", "a|美品")]["label"] == "A [001/100] 美品" and rows[("card", "b|")]["label"] == "b|"
    assert rows[("index", "unknown")]["imputation_basis"] == "price_repeat"
    empty = rows[("card", "c|美品")]
    assert (str(empty["date"]), empty["valid_days"], empty["imputation_basis"], empty["trend"]) == ("2030-01-01", 0, "none", "判定不可")
    # a missing count is a trade for the group, so its series has counts
    assert rows[("group", "condition:美品")]["imputation_basis"] == "trade_count"


def test_report(spark):
    df = history(spark, ("a", "ドラゴン", "001/100", "美品", [200 - 3 * i for i in range(20)], [2] * 20), ("b", "x", "", "美品", [1], [1]))
    summary, detail = M.card_report(df, "001/100", show_days=5)
    assert [(r["card_id"], r["trend"], r["score"]) for r in summary.collect()] == [("a", "下落", 90)]
    assert detail.count() == 5
