import statistics
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import series as S
from tidemark.operators import trend as T

DAY0 = date(2026, 8, 1)
SCHEMA = "key string, seq long, date date, price long, trade_count long"


def rows_of(key, prices, counts=3):
    counts = counts if isinstance(counts, list) else [counts] * len(prices)
    return [(key, i, DAY0 + timedelta(i), p, c) for i, (p, c) in enumerate(zip(prices, counts))]


def metrics(spark, rows, schema=SCHEMA, **kw):
    df = S.series_metrics(spark.createDataFrame(rows, schema), ["key"], **kw)
    return {r["key"]: r.asDict() for r in T.with_trend(df).collect()}


def flags(spark, rows):
    df = S.mark_imputed(spark.createDataFrame(rows, SCHEMA), ["key"]).orderBy("date")
    return [(r["imputation_basis"], r["imputed_suspect"]) for r in df.collect()]


def test_flags_from_counts(spark):
    got = flags(spark, rows_of("a", [100, 100, 100, 110], [5, 0, None, 3]))
    assert got == [("trade_count", f) for f in (False, True, True, False)]


def test_flags_from_repeated_prices(spark):
    got = flags(spark, rows_of("a", [100, 100, 105], None))
    assert got == [("price_repeat", f) for f in (False, True, False)]


def test_imputed_days_do_not_count(spark):
    prices = [120, 115, 110, 110, 110, 110, 110, 110]
    m = metrics(spark, rows_of("real", prices, [4, 3, 2, 0, 0, 0, 0, 0]) + rows_of("naive", prices, 1))
    assert (m["real"]["valid_days"], m["real"]["streak"], m["real"]["ma5"], m["real"]["record_count"]) == (3, -2, None, 8)
    assert m["real"]["d1"] < 0
    assert (m["naive"]["valid_days"], m["naive"]["streak"]) == (8, 0)


def test_classes(spark):
    falling, rising = [200 - 3 * i for i in range(20)], [100 + 3 * i for i in range(20)]
    cases = {"down": falling, "up": rising, "flat": [100 + i % 2 for i in range(20)], "ten": falling[:10], "nine": falling[:9]}
    m = metrics(spark, [r for k, p in cases.items() for r in rows_of(k, p)])
    assert {k: v["trend"] for k, v in m.items()} == {
        "down": "下落", "up": "上昇", "flat": "横ばい", "ten": "下落", "nine": "判定不可"}
    assert m["down"]["suggested_buffer_pct"] > 0 and m["up"]["suggested_buffer_pct"] is None
    assert m["ten"]["d7"] < 0


def test_falls_are_flagged_before_rises(spark):
    cases = {"down": [100 - 0.5 * i for i in range(20)], "up": [100 + 0.5 * i for i in range(20)]}
    m = metrics(spark, [r for k, p in cases.items() for r in rows_of(k, p)], SCHEMA.replace("price long", "price double"))
    assert (m["down"]["trend"], m["up"]["trend"]) == ("下落", "横ばい")


def test_d7_spans_seven_observations(spark):
    m = metrics(spark, rows_of("a", [100 - i for i in range(14)], [3 if i % 2 == 0 else 0 for i in range(14)]))
    assert m["a"]["valid_days"] == 7 and m["a"]["d7"] == pytest.approx(-12.0)


def test_group_means_leave_imputed_days_out(spark):
    rows = [("美品", DAY0, 100, 2), ("美品", DAY0, 200, 3), ("美品", DAY0 + timedelta(1), 100, 0),
            ("美品", DAY0 + timedelta(1), 300, 1), ("美品", DAY0 + timedelta(2), 50, None), ("", DAY0, 1, 1)]
    g = S.group_series(spark.createDataFrame(rows, "c string, date date, price long, trade_count long"), "c").orderBy("date")
    assert [(r["price"], r["trade_count"]) for r in g.collect()] == [(150.0, 5), (300.0, 1), (50.0, 1)]


def test_trail(spark):
    rows = rows_of("a", [100, 100, 98], [2, 0, 1]) + rows_of("b", [100 - i for i in range(20)], 2)
    df = S.price_trail(spark.createDataFrame(rows, SCHEMA), ["key"])
    got = {r["key"]: r["price_trail"] for r in df.collect()}
    assert got["a"] == "100→100*→98"
    assert len(got["b"].split("→")) == 7 and got["b"].endswith("81")
    assert metrics(spark, rows, trail=7)["a"]["price_trail"] == got["a"]


def test_same_date_keeps_the_last_row(spark):
    rows = [("a", 1, DAY0, 10, 1), ("a", 5, DAY0, 30, 0), ("a", 3, DAY0, 20, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for seq in (["seq"], ["seq", "price"]):
        assert S.dedup_last(df, ["key"], seq).collect() == [("a", DAY0, 30, 0)]


def test_index_diff_sees_the_full_history(spark):
    rows = [("bihin", DAY0 + timedelta(i), v, i) for i, v in enumerate([100.0, 110.0, 0.0, 5.0])]
    df = S.index_diff(spark.createDataFrame(rows, "index_type string, date date, value double, seq long"), ["index_type"])
    assert [(r["diff"], r["diff_pct"] and round(r["diff_pct"], 6)) for r in df.orderBy("date").collect()] == [
        (None, None), (10.0, 10.0), (-110.0, -100.0), (5.0, None)]


def test_last_n_and_latest_and_carried(spark):
    df = spark.createDataFrame(rows_of("a", [1, 2, 3, 4]), SCHEMA)
    assert sorted(r["price"] for r in S.last_n(df, ["key"], 2).collect()) == [3, 4]
    assert S.latest_per_key(df, ["key"], ["date"], ["price"]).first()["price"] == 4
    named = spark.createDataFrame([("a", 1, "x"), ("a", 2, ""), ("b", 1, None)], "key string, seq long, name string")
    assert {r["key"]: r["name"] for r in S.carried(named, ["key"], ["name"]).collect()} == {"a": "x", "b": None}


# --- against a small model -----------------------------------------------------
def model(points):
    """The rules read off one series at a time: (date, price, count) in input order."""
    last = {}
    for d, p, c in points:
        last[d] = (p, c)
    days = sorted(last)
    counted = any(last[d][1] is not None for d in days)
    valid, before = [], None
    for d in days:
        p, c = last[d]
        imputed = (c is None or c <= 0) if counted else (before is not None and p == before)
        before = p
        if not imputed and p is not None:
            valid.append(float(p))
    pct = lambda new, old: None if old == 0 else (new / old - 1) * 100
    out = dict(valid_days=len(valid), record_count=len(days), d1=None, d3=None, d7=None, ma5=None, ma20=None, streak=0, vol20=None)
    if len(valid) < 2:
        return out
    changes = [c for c in (pct(b, a) for a, b in zip(valid, valid[1:])) if c is not None]
    out["d1"] = changes[-1] if changes else None
    out["d3"] = pct(valid[-1], valid[-4]) if len(valid) >= 4 else None
    out["d7"] = pct(valid[-1], valid[-7]) if len(valid) >= 7 else None
    out["ma5"] = statistics.fmean(valid[-5:]) if len(valid) >= 5 else None
    out["ma20"] = statistics.fmean(valid[-20:])
    signs = [(c > 0) - (c < 0) for c in changes][::-1]
    if signs and signs[0]:
        run = next((i for i, s in enumerate(signs) if s != signs[0]), len(signs))
        out["streak"] = signs[0] * run
    if len(changes[-20:]) >= 2:
        out["vol20"] = statistics.pstdev(changes[-20:])
    return out


_point = st.tuples(st.integers(0, 40), st.sampled_from([None, 0, -5, 90, 100, 100, 105, 110]), st.sampled_from([None, 0, 1, 4]))
_series = st.tuples(st.booleans(), st.lists(_point, min_size=1, max_size=60))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_series, min_size=80, max_size=80))
def test_metrics_agree_with_the_model(spark, many):
    rows, wanted = [], {}
    for k, (with_counts, points) in enumerate(many):
        points = [(DAY0 + timedelta(d), p, c if with_counts else None) for d, p, c in points]
        wanted[str(k)] = model(points)
        rows += [(str(k), i, *p) for i, p in enumerate(points)]
    got = metrics(spark, rows)
    for key, want in wanted.items():
        for name, value in want.items():
            have = got[key][name]
            assert have == (value if value is None else pytest.approx(value, abs=1e-9)), (key, name, have, value)


def test_a_key_with_a_third_of_all_rows_is_combined_before_the_shuffle(spark):
    """Hot key: 60 000 copies over 30 dates. What reaches the windows is 30 rows."""
    hot = spark.range(60_000).select(
        F.lit("hot").alias("key"), F.col("id").alias("seq"), F.expr("date_add(date '2026-08-01', cast(id % 30 as int))").alias("date"),
        (F.col("id") % 1000).alias("price"), F.lit(1).cast("long").alias("trade_count"))
    cold = spark.range(120_000).select(
        F.concat(F.lit("k"), (F.col("id") % 20_000).cast("string")).alias("key"), F.col("id").alias("seq"),
        F.expr("date_add(date '2026-08-01', cast(id div 20000 as int))").alias("date"), F.lit(7).cast("long").alias("price"),
        F.lit(1).cast("long").alias("trade_count"))
    df = S.series_metrics(hot.unionByName(cold), ["key"])
    got = df.filter("key = 'hot'").first()
    assert (got["record_count"], got["latest_price"]) == (30, 999)
    assert df.count() == 20_001
