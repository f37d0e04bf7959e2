"""Broken JSON, rounding, structures, selectors, additive state, top matches, reads during a move."""

import json
import math
import random
import time
from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions.numbers import rounded_texts
from tidemark.operators import audit, match
from tidemark.plans import inputs
from tidemark.schemas import INDEX_HISTORY, INDEX_STATE
from tidemark.session import scratch_dir
from tidemark.sources import json_scan, pages, tables
from tidemark.sources.json_scan import scan
from tidemark.streaming import upsert as streams


def naive_scan(text):
    out, at, decoder = [], 0, json.JSONDecoder()
    while at < len(text):
        if text[at] in "[{":
            try:
                end = decoder.raw_decode(text, at)[1]
                out.append(text[at:end])
                at = end
                continue
            except (ValueError, RecursionError):
                pass
        at += 1
    return out


PIECES = ["[", "]", "{", "}", '"', "\\", ",", ":", "1", "-", ".", "e0", "true", "NaN", " ", "\n", '"a":', "[1]", '{"b":2}', "x", "\\u12", '\\"', "01", "\x01"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30))
def test_scan_equals_trying_every_opening(pieces):
    text = "".join(pieces)
    assert list(scan(text)) == naive_scan(text)


def test_openings_that_nothing_may_follow_cost_no_call(monkeypatch):
    calls, settle = [], json_scan._settle
    monkeypatch.setattr(json_scan, "_settle", lambda *a: calls.append(1) or settle(*a))
    text = "x [ x {x {1 [, " * 10_000 + '[ \n{"a":1}] { "b" : [ ]}'
    assert list(scan(text)) == ['[ \n{"a":1}]', '{ "b" : [ ]}']
    assert len(calls) < 10


def test_rows_of_a_small_file_are_spread(spark, tmp_path):
    spark.createDataFrame([(i,) for i in range(100)], "k long").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = inputs.spread(inputs.table(spark, str(tmp_path), "part"), "k")
    assert sorted(r["k"] for r in rows.collect()) == list(range(100))
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("unit", ["[", '{"a":', '["', '["[{', "[1,", '[[" '])
def test_scan_is_linear_in_broken_text(unit):
    def took(n):
        began = time.perf_counter()
        assert list(scan(unit * n + "]" * (unit == "]"))) == []
        return time.perf_counter() - began

    took(1000)
    short, long = took(20_000), took(160_000)
    assert long < 40 * max(short, 0.01)


def test_rounding_equals_the_exact_one():
    rng = random.Random(1)
    values = [2.675, 0.125, -0.001, -0.0, 1e300, 1e16, 1.005, -0.5, 5e-324, math.nan, math.inf]
    values += [rng.uniform(-1000, 1000) for _ in range(3000)] + [rng.randrange(-10**6, 10**6) / 8 for _ in range(3000)]
    for digits in (0, 1, 2):
        want = [str(round(v, digits)) if math.isfinite(v) else "" for v in values]
        assert list(rounded_texts(np.array(values), digits)) == want


def test_structures(spark):
    texts = ['{"a":{"b":{"c":{"d":1}}}}', '{"a":{"b":{"c":{"d":"x"}}}}', '{"a":{"b":{"c":{"d":2}}}}', "oops", None]
    docs = spark.createDataFrame([(t,) for t in texts], "json string")
    whole = {r["structure"]: r["documents"] for r in audit.json_structure_profile(docs, "json").collect()}
    assert sorted(whole.values()) == [1, 2, 2] and len(whole) == 3
    cut = {r["structure"]: r["documents"] for r in audit.json_structure_profile(docs, "json", depth=2).collect()}
    assert cut == {"OBJECT<a: OBJECT<b: ...>>": 3, None: 2}


def test_selected_links(spark):
    tests = [("", "/t/"), ("", "/p/"), ("hits", "")]
    pages_ = [
        (1, '<a href="/t/about">x</a><a href="/p/7">x</a>', "https://o/p/7"),
        (2, '<a href="/p/new">x</a><a href="/p/8">x</a><div class="my hits"><a href="/t/x">y</a><a href="/t/9">z</a></div>', "https://o/p/8"),
        (3, '<a href="/p/new">x</a><div class="hits"><b><a href="/q/5?p=/p/5">y</a></b></div>', "https://o/q/5?p=/p/5"),
        (4, "<a href='/z'>x</a>", None), (5, None, None), (6, '<!-- <a href="/p/1"> --><div class="hits"></div>', None)]
    df = spark.createDataFrame([p[:2] for p in pages_], "page long, html string")
    got = {r["page"]: r["link"] for r in pages.extract_selected_links(df, tests, [r"/t/\d+", r"/p/\d+"], "https://o").collect()}
    assert got == {p[0]: p[2] for p in pages_}


def test_best_matches_are_the_first_of_all_matches(spark):
    rng = random.Random(3)
    words = ["red", "blue", "widget", "red widget", "x"]
    cards = spark.createDataFrame([(f"c{i}", f"{rng.choice(words)} {rng.choice(words)}".strip(), f"00{rng.randrange(4)}/A{rng.randrange(3)}", "", i)
                                   for i in range(300)], "card_id string, card_name string, hinban string, url string, seq long")
    queries = spark.createDataFrame([(q,) for q in ["red", "red widget", "C7", "001/A1", "A", "x", "https://h/card/c9/", "none", ""]], "query string")
    columns = ["query", "rank", "score", "card_id"]
    for n in (1, 5, 40):
        every = match.top_matches(match.match_cards(queries, cards), n).select(*columns)
        assert sorted(map(tuple, match.best_matches(queries, cards, n).select(*columns).collect())) == sorted(map(tuple, every.collect()))


def test_state_of_a_repeated_batch(spark):
    day = date(2026, 8, 1)
    partial = lambda total, points: spark.createDataFrame([(day, "a", total, points)], "date date, index_type string, total long, points long")
    state = spark.createDataFrame([], INDEX_STATE.schema)
    keep = lambda df: spark.createDataFrame(df.collect(), INDEX_STATE.schema)
    state = keep(streams.add_batch(state, partial(10, 1), 0))
    state = keep(streams.add_batch(state, partial(20, 4), 1))
    again = keep(streams.add_batch(state, partial(20, 4), 1))
    assert streams.daily_means(state).first()["value"] == streams.daily_means(again).first()["value"] == 6.0


def test_reads_during_a_move(spark):
    path = scratch_dir(spark, "move")
    rows = lambda days, value: spark.createDataFrame([(date(2026, m, 1), "a", float(value), i) for i, m in enumerate(days)],
                                                     "date date, index_type string, value double, seq long")
    read = lambda: sorted((r["date"].month, r["value"]) for r in tables.read_table(spark, path, INDEX_HISTORY).collect())
    tables.upsert_table(spark, path, rows([1, 2, 3], 1), INDEX_HISTORY)
    changed = tables.read_table(spark, path, INDEX_HISTORY).filter("month(date) > 1").selectExpr(
        "date", "index_type", "2.0 AS value", "diff", "diff_pct", "fetched_at", "_pos")
    tables._stage(spark, changed.withColumn("value", changed["value"].cast("double")).withColumn(tables.PARTITION, tables.month("date")), path)
    assert read() == [(1, 1.0), (2, 2.0), (3, 2.0)]  # staged and not moved yet
    tables._delete(spark, f"{path}/{tables.PARTITION}=2026-02")  # between delete and rename
    assert read() == [(1, 1.0), (2, 2.0), (3, 2.0)]
    tables.finish_move(spark, path)
    assert read() == [(1, 1.0), (2, 2.0), (3, 2.0)]
    assert tables.stored_months(spark, path) == ["2026-01", "2026-02", "2026-03"]
