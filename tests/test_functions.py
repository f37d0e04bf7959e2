import unicodedata
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.functions import urls as U


def check(values, expression, table):
    assert values(expression, [k for k, _ in table]) == [v for _, v in table]


def test_nfkc_agrees_with_the_standard_library(spark, values):
    sample = [chr(c) for c in (*range(0x20, 0x3200), *range(0xF900, 0x10000)) if not 0xD800 <= c < 0xE000]
    assert values(X.nfkc("x"), sample) == [unicodedata.normalize("NFKC", s) for s in sample]
    assert values(X._nfkc_arrow(F.col("x")), sample[:500]) == values(X.nfkc("x"), sample[:500])


def test_codes(values):
    check(values, X.normalize_code("x"), [
        ("211/SMｰP", "211/SM-P"), ("282/SMーP", "282/SM-P"), ("224/SM－P", "224/SM-P"), ("224/SM–P", "224/SM-P"),
        ("296/XY-p", "296/XY-P"), ("206/165 ", "206/165"), (" 206/165　", "206/165"), ("0 1\n2/9", "012/9"),
        ("", ""), (None, "")])


def test_names_keep_long_vowels(values):
    check(values, X.normalize_name("x"), [
        ("スーパーボール", "スーパーボール"), ("ﾙｲｰｼﾞ", "ルイージ"), ("ボール–ex", "ボール-ex"),
        ("アカ＆アオＧＸ", "アカ&アオGX"), ("ぼうし　　(大)", "ぼうし (大)"), ("V(SA) \n\n", "V(SA)"),
        ("a \t b", "a b"), ("a\x1fb", "a b"), ("", ""), (None, "")])


def test_dash_sets_are_apart():
    assert not set(V.LONG_VOWEL_MARKS) & set(V.COMMON_HYPHENS)


def test_store_memo(values):
    check(values, X.strip_store_memo("x"), [
        ("カードVMax（高い方）", "カードVMax"), ("カードVMAX 安い方", "カードVMAX"), ("カードV(SA)", "カードV(SA)"),
        ("カード【要確認】x", "カード x"), ("カード（ 自店 ）[]", "カード"), (None, "")])


@pytest.mark.parametrize("code, name, key", [
    ("082/069", "カードVMax（高い方）", "082/069 カードVMax"), ("056/049", "カード[SM2+] SR 056/049", "カード[SM2+] SR 056/049"),
    ("211/SM-P", "カード 211/SMｰP", "カード 211/SMーP"), ("211/SM-P", "カード", "211/SM-P カード"),
    ("206/165 ", "", "206/165"), ("", "カード", "カード"), ("", "", "")])
def test_search_key(one, code, name, key):
    assert one(X.build_search_key("c", "n"), c=code, n=name) == key


def test_compact_names(values):
    check(values, X.compact_name("x"), [
        ("アカ&アオ&キイロGX [SM10b 060/054]", "アカアオキイロgx"), ("ＡＢ　１ー２", "ab12"), ("佐々木", "佐々木"), ("ー！", "")])


@pytest.mark.parametrize("a, b, expected", [
    ("アカアオキイロGX", "アカ&アオ&キイロGX [SM10b 060/054]", True), ("アカ＆アオＧＸ ＳＲ", "アカ&アオGX [x]", True),
    ("アカ＆アオＧＸ", "アカ&アオGX ＳＲ", True), ("アカ", "キイロ", False), ("", "", False)])
def test_names_overlap(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        X.compact_name("a").alias("a"), X.compact_name("b").alias("b"))
    assert df.select(X.compact_overlap("a", "b").alias("v")).first()["v"] is expected


def test_price(values):
    check(values, N.parse_price("x"), [
        ("152,443円", 152443), ("¥152,443", 152443), ("１５２，４４３", 152443), ("", None), ("-", None), (None, None),
        ("0", 0), ("▲12", -12), ("△ 5", -5), ("−7円", -7), ("12-3", 123), ("1.5", 15), ("9" * 30, None)])
    check(values, X.digits_only("x"), [
        ("¥12,800", "12800"), ("￥1,234,567 (税込)", "1234567"), ("3枚", "3"), ("", ""), ("なし", ""), ("１２", "")])


def test_whole_numbers(spark):
    df = spark.sql("SELECT explode(array(1.9D, -1.9D, double('NaN'), double('inf'), null, 152443D)) AS x")
    assert [r[0] for r in df.select(N.whole_number("x")).collect()] == [1, -1, None, None, None, 152443]


def test_diffs_and_percentages(values):
    out = values(N.parse_diff("x"), ["+1,138円(+0.75%)", "-1,138円(-0.75%)", "▲1,138円(▲0.75%)", "±0円(0.00%)", "+5(1%)", "", None])
    assert [tuple(v) for v in out] == [(1138, 0.75), (-1138, -0.75), (-1138, -0.75), (0, 0.0), (5, 1.0), (None, None), (None, None)]
    check(values, N.parse_pct("x"), [("+0.75%", 0.75), ("1,234.5 %", 1234.5), ("▲ 2％", -2.0), ("5", None), (None, None)])


def test_dates(values, spark):
    day = date(2026, 8, 18)
    check(values, N.parse_date("x"), [
        ("2026/08/18", day), ("2026-8-18", day), ("2026.08.18", day), ("2026年8月18日", day), ("at ２０２６-08-18T23:00Z", day),
        ("8月18日", None), ("2026/13/45", None), ("2026-02-30", None), ("", None), (None, None)])
    check(values, N.parse_date("x", 2026), [("8月18日", day), ("8/18", day), ("2/30", None), ("x", None)])
    df = spark.sql("SELECT explode(array(1786978800D, 1786978800000D, 12D, null)) AS x")
    assert [r[0] for r in df.select(N.epoch_date("x")).collect()] == [date(2026, 8, 18), date(2026, 8, 18), None, None]


def test_japan_time_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT timestamp '2026-10-10 15:00:01 UTC' AS t")
            assert df.select(N.stamp("t")).first()[0] == "2026-10-11 00:00:01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_export_rounding_is_half_even_on_the_binary_value(spark):
    inputs = [2.675, 0.125, -1.005, 100.0, None, float("nan"), float("inf")]
    df = spark.createDataFrame([(v,) for v in inputs], "x double")
    assert [r[0] for r in df.select(N.fmt("x", 2)).collect()] == ["2.67", "0.12", "-1.0", "100.0", "", "", ""]


def test_percent_change(spark):
    df = spark.sql("SELECT * FROM VALUES (110D, 100D), (1D, 0D), (null, 1D), (1D, null) t(a, b)")
    got = [r[0] for r in df.select(N.pct_change("a", "b")).collect()]
    assert got[0] == pytest.approx(10.0) and got[1:] == [None, None, None]


def test_slugs(values):
    check(values, U.slug_from_url("x"), [
        ("https://cards.example/card/abc-123/", "abc-123"), ("/card/xyz-9", "xyz-9"), ("", ""), (None, ""),
        ("https://cards.example", ""), ("https://cards.example/a/b?x=/c/d#e", "b"), (" /a/b;p=1 ", "b")])


def test_clean_urls(values):
    check(values, U.clean_url("x", "https://x.example/list/page"), [
        ("https://x.example//a//b.jpg", "https://x.example/a/b.jpg"), (" /a//b ", "https://x.example/a/b"),
        ("//img.example/a", "https://img.example/a"), ("b.jpg", "https://x.example/list/b.jpg"),
        ("../b.jpg", "https://x.example/b.jpg"), ("./c/../d?q=..", "https://x.example/list/d?q=.."),
        ("?p=2", "https://x.example/list/page?p=2"), ("", ""), (None, "")])


def test_quote(values):
    check(values, U.quote("x"), [("006/165 カード", "006/165%20%E3%82%AB%E3%83%BC%E3%83%89"), ("a+b~*", "a%2Bb~%2A")])


def test_extract_code(values):
    check(values, X.extract_code("x"), [
        ("カードex 006/165", "006/165"), ("カード 0６5 / 165sr x", "065/165sr"), ("名前のみ", ""), ("294/XY-P", ""), ("ex006/165", "")])
    check(values, X.set_of_code("x"), [("006/165", "165"), ("a/b/c", "c"), ("x", "x"), ("", ""), (None, "")])


def test_conditions(values):
    check(values, X.guess_condition("x"), [
        ("API x :: data.PSA10", "psa10"), ("props.kizu[0]", "キズあり"), ("a :: 美品", "美品"), ("graded_mint", "psa10"), ("chart", "不明"), (None, "不明")])


def test_notes(values):
    check(values, X.add_note("x", "検索ヒットなし"), [
        ("", "検索ヒットなし"), ("検索ヒットなし", "検索ヒットなし"), ("要確認", "要確認 / 検索ヒットなし"), (" a /  / b", "a / b / 検索ヒットなし"), (None, "検索ヒットなし")])
    check(values, X.drop_note("x", "検索ヒットなし"), [("要確認 / 検索ヒットなし", "要確認"), ("検索ヒットなし/検索ヒットなし", ""), (None, "")])


def test_first_match(values):
    patterns = V.PRODUCT_NUMBER_PATTERNS["最安価格"]
    check(values, X.first_match("x", patterns), [
        ("最安値：¥ 12,800 です", "12800"), ("最低価格 900円 最安 500", "500"), ("購入 ¥77", "77"), ("購入 77", ""), (None, "")])


def test_upsert_keys(values):
    check(values, X.upsert_key("x"), [("  a \n", "a"), ("0", "0"), (None, ""), ("　", "")])


def test_marks(values):
    check(values, X.trend_mark("x"), [("下落", "▼下落"), ("上昇", "▲上昇"), ("横ばい", "→横ばい"), ("判定不可", "?判定不可"), (None, "?判定不可")])
    check(values, X.trend_urgency("x"), [("下落", 0), ("判定不可", 1), ("横ばい", 2), ("上昇", 3), ("?", 9)])
