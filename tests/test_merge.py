from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators.trend import status_board
from tidemark.schemas import CARD_STATUS, INDEX_HISTORY, Table
from tidemark.session import scratch_dir
from tidemark.sources import tables as S

DAY = date(2026, 8, 18)
KEY = ["date", "index_type"]
OLD = "date date, index_type string, value string, fetched_at string, memo string, _pos long"
NEW = "date date, index_type string, value string, fetched_at string, seq long"


def plan(spark, existing, batch, keys=KEY, old=OLD, new=NEW):
    df = M.plan_upsert(spark.createDataFrame(existing, old), spark.createDataFrame(batch, new), keys)
    return [r.asDict() for r in df.orderBy("_pos").collect()]


def actions(rows):
    return [r["_action"] for r in rows]


def test_insert_repeat_change(spark):
    batch = [(DAY, "bihin", "100", "t1", 0), (DAY, "psa10", "200", "t1", 1)]
    assert actions(plan(spark, [], batch)) == ["append", "append"]
    stored = [(DAY, "bihin", "100", "t1", None, 0), (DAY, "psa10", "200", "t1", None, 1)]
    assert actions(plan(spark, stored, batch)) == ["unchanged", "unchanged"]
    changed = plan(spark, stored, [(DAY, "bihin", "111", "t2", 0)])
    assert actions(changed) == ["update", "unchanged"] and changed[0]["value"] == "111"


def test_batch_repeats_last_wins_first_place(spark):
    rows = plan(spark, [], [(DAY, "b", "1", "t", 0), (DAY, "a", "2", "t", 1), (DAY, "b", "3", "t", 2)])
    assert [(r["index_type"], r["value"]) for r in rows] == [("b", "3"), ("a", "2")]


def test_extra_columns_and_null_overwrite(spark):
    rows = plan(spark, [(DAY, "bihin", "100", "t1", "keep", 0)], [(DAY, "bihin", None, "t2", 0)])
    assert (rows[0]["memo"], rows[0]["value"], rows[0]["_action"]) == ("keep", None, "update")


def test_blank_and_null_are_the_same_cell(spark):
    assert actions(plan(spark, [(DAY, "x", "", "t1", None, 0)], [(DAY, "x", None, "t1", 0)])) == ["unchanged"]


def test_first_of_repeated_rows_is_the_target(spark):
    stored = [(DAY, "x", "1", "t", "a", 0), (DAY, "x", "2", "t", "b", 1), (None, "", "9", "t", "blank key", 2)]
    rows = plan(spark, stored, [(DAY, " x ", "5", "t", 0), (None, None, "7", "t", 1)])
    assert [(r["value"], r["_action"]) for r in rows] == [("5", "update"), ("2", "unchanged"), ("9", "unchanged")]


def test_zero_is_a_key_and_a_partly_blank_key_is_one(spark):
    old, new = "k long, j string, v string, _pos long", "k long, j string, v string, seq long"
    rows = plan(spark, [(0, None, "a", 0)], [(0, "", "b", 0), (None, "", "c", 1), (1, "", "d", 2)], ["k", "j"], old, new)
    assert [(r["k"], r["v"], r["_action"]) for r in rows] == [(0, "b", "update"), (1, "d", "append")]


def test_write_back_replaces_named_columns_only(spark):
    old = spark.createDataFrame([("a", "u1", "x", 0), ("b", "u2", "y", 1)], "code string, url string, extra string, _pos long")
    new = spark.createDataFrame([("A", "lost", 0)], "code string, url string, _pos long")
    assert M.write_back(old, new, ["code"]).orderBy("_pos").collect() == [("A", "u1", "x", 0), ("b", "u2", "y", 1)]


_record = st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", " a", "", None]), st.sampled_from(["1", "2", None]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_record, min_size=1, max_size=25), st.lists(_record, min_size=1, max_size=25))
def test_applying_twice_is_applying_once(spark, first, second):
    """Against a dictionary: last value per trimmed key; a second application changes nothing."""
    old, new = "k long, j string, v string, _pos long", "k long, j string, v string, seq long"
    numbered = lambda rows: [(*r, i) for i, r in enumerate(rows)]
    once = M.plan_upsert(spark.createDataFrame([], old), spark.createDataFrame(numbered(first), new), ["k", "j"])
    stored = [tuple(r) for r in once.drop("_action").collect()]
    twice = plan(spark, stored, numbered(second), ["k", "j"], old, new)
    want = {}
    for k, j, v in first + second:
        want[(str(k), (j or "").strip())] = v
    assert {(str(r["k"]), (r["j"] or "").strip()): r["v"] for r in twice} == want
    assert len(twice) == len(want)
    again = plan(spark, [tuple(r[c] for c in ("k", "j", "v", "_pos")) for r in twice], numbered(second), ["k", "j"], old, new)
    assert set(actions(again)) == {"unchanged"}


def test_a_key_repeated_in_most_rows_stays_whole(spark):
    existing = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit("old").alias("v"), F.col("id").alias("_pos"))
    batch = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") + 15_000).cast("string")).alias("k"),
        F.concat(F.lit("new"), F.col("id").cast("string")).alias("v"), F.col("id").alias("seq"))
    out = M.plan_upsert(existing, batch, ["k"]).persist()
    got = {r["_action"]: r["n"] for r in out.groupBy("_action").agg(F.count("*").alias("n")).collect()}
    assert got == {"update": 10_001, "unchanged": 19_999, "append": 10_000}
    assert out.filter("k = 'hot'").count() == 10_000
    assert out.filter("k = 'hot' and _action = 'update'").first()["v"] == "new29997"
    out.unpersist()


# --- stored tables ---------------------------------------------------------------
def index_rows(spark, days, value, start=0):
    rows = [(DAY + timedelta(d), "bihin", float(value), None, None, None, start + d) for d in days]
    return spark.createDataFrame(rows, "date date, index_type string, value double, diff double, diff_pct double, fetched_at timestamp, seq long")


def test_stored_history_grows_and_is_never_truncated(spark):
    path = scratch_dir(spark, "t")
    assert S.read_table(spark, path, INDEX_HISTORY).count() == 0
    assert S.upsert_table(spark, path, index_rows(spark, range(0, 40), 1), INDEX_HISTORY)
    assert S.upsert_table(spark, path, index_rows(spark, range(30, 60), 2), INDEX_HISTORY)
    assert not S.upsert_table(spark, path, index_rows(spark, [], 3), INDEX_HISTORY)
    stored = S.read_table(spark, path, INDEX_HISTORY)
    got = {r["date"]: r["value"] for r in stored.collect()}
    assert len(got) == 60 and got[DAY] == 1.0 and got[DAY + timedelta(30)] == 2.0
    assert stored.columns == [*INDEX_HISTORY.schema.names, "_pos"]


def test_only_touched_months_are_rewritten(spark):
    path = scratch_dir(spark, "t")
    S.upsert_table(spark, path, index_rows(spark, range(0, 60), 1), INDEX_HISTORY)
    files = lambda month: set(spark.read.parquet(f"{path}/_month={month}").inputFiles())
    before = {m: files(m) for m in ("2026-08", "2026-09", "2026-10")}
    S.upsert_table(spark, path, index_rows(spark, [20], 5), INDEX_HISTORY)
    assert files("2026-08") == before["2026-08"] and files("2026-10") == before["2026-10"]
    assert files("2026-09") != before["2026-09"]


def test_added_columns_reach_months_that_lack_them(spark):
    path = scratch_dir(spark, "t")
    S.upsert_table(spark, path, index_rows(spark, [0], 1), INDEX_HISTORY)
    S.upsert_table(spark, path, index_rows(spark, [40], 2).withColumn("memo", F.lit("by hand")), INDEX_HISTORY)
    S.upsert_table(spark, path, index_rows(spark, [40], 3), INDEX_HISTORY)
    got = S.read_table(spark, path, INDEX_HISTORY).orderBy("date").select("value", "memo").collect()
    assert got == [(1.0, None), (3.0, "by hand")]


def test_an_interrupted_move_is_finished_by_the_next_call(spark):
    path = scratch_dir(spark, "t")
    S.upsert_table(spark, path, index_rows(spark, range(0, 20), 1), INDEX_HISTORY)
    merged = M.plan_upsert(S.read_table(spark, path, INDEX_HISTORY), index_rows(spark, range(0, 3), 9), INDEX_HISTORY.key)
    S._stage(spark, merged.drop("_action").withColumn(S.PARTITION, S.month("date")), path)  # and then the driver dies
    # complete staged data counts from then on, moved or not
    assert sorted(r["value"] for r in S.read_table(spark, path, INDEX_HISTORY).collect()) == [1.0] * 17 + [9.0] * 3
    S.upsert_table(spark, path, index_rows(spark, [30], 4), INDEX_HISTORY)
    got = {r["date"]: r["value"] for r in S.read_table(spark, path, INDEX_HISTORY).collect()}
    assert len(got) == 21 and got[DAY] == 9.0 and got[DAY + timedelta(30)] == 4.0


def test_an_unfinished_staging_folder_is_dropped(spark):
    path = scratch_dir(spark, "t")
    S.upsert_table(spark, path, index_rows(spark, [0], 1), INDEX_HISTORY)
    index_rows(spark, [0], 9).drop("seq").write.parquet(S._staging(path))  # no header: not complete
    S.finish_move(spark, path)
    assert not S.path_exists(spark, S._staging(path))
    assert S.read_table(spark, path, INDEX_HISTORY).first()["value"] == 1.0


def test_board_rows_do_not_grow(spark):
    path = scratch_dir(spark, "t")
    schema = "date date, card_id string, card_name string, hinban string, condition string, price long, trade_count long, seq long"
    rows = [(DAY + timedelta(i), "a", "A", "001/100", "美品", 100 - i, 2, i) for i in range(21)]
    for n in (20, 21):
        board = status_board(spark.createDataFrame(rows[:n], schema)).withColumn("seq", F.lit(0).cast("long"))
        S.upsert_table(spark, path, board, CARD_STATUS)
    stored = S.read_table(spark, path, CARD_STATUS).collect()
    assert len(stored) == 1 and stored[0]["最新価格"] == 80


def test_snapshot_replaces_with_one_load_time_and_skips_empty(spark):
    path, at = scratch_dir(spark, "t"), F.lit("2026-10-10 15:00:01").cast("timestamp")
    assert S.write_snapshot(spark.createDataFrame([("a",), ("b",)], "name string"), path, "loaded_at", at)
    assert S.write_snapshot(spark.createDataFrame([("c",)], "name string"), path, "loaded_at", at)
    assert not S.write_snapshot(spark.createDataFrame([], "name string"), path, "loaded_at", at)
    assert [r["name"] for r in spark.read.parquet(path).collect()] == ["c"]


def test_watchlist_seed_only_when_nothing_is_stored(spark, tmp_path):
    seed = tmp_path / "seed.tsv"
    seed.write_text("品番\t名前\tcard_id\turl\tメモ\n001/1\tA\t\t\t\n\t\t\t\tnote\n", encoding="utf-8")
    schema = "`品番` string, `名前` string, card_id string, url string, `メモ` string, _pos long"
    blank_row, typed = (None, "", None, None, "x", 0), ("002/2", None, None, None, None, 1)
    load = lambda rows: [r["品番"] for r in S.load_watchlist(spark, spark.createDataFrame(rows, schema), str(seed)).collect()]
    assert load([blank_row]) == ["001/1"]
    assert load([blank_row, typed]) == ["002/2"]


def test_dry_run_writes_nothing(spark):
    assert S.dry_run(spark.range(100)).count() == 5


def test_undated_tables(spark):
    path, t = scratch_dir(spark, "t"), Table("m", spark.createDataFrame([], "k string, v string").schema, ("k",))
    for v in ("1", "2"):
        S.upsert_table(spark, path, spark.createDataFrame([("a", v, 0)], "k string, v string, seq long"), t)
    assert S.read_table(spark, path, t).drop("_pos").collect() == [("a", "2")]


def test_batch_and_missing_table_are_computed_once_or_not_at_all(spark):
    path = scratch_dir(spark, "once")
    index_rows(spark, range(0, 40), 1).write.parquet(path)
    existing = index_rows(spark, range(0, 9), 1).withColumnRenamed("seq", "_pos")
    plan = M.plan_upsert(existing, spark.read.parquet(path), INDEX_HISTORY.key)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    empty = S.read_table(spark, scratch_dir(spark, "nothing"), INDEX_HISTORY)
    assert empty.columns == [*INDEX_HISTORY.schema.names, "_pos"] and empty.dtypes[-1] == ("_pos", "bigint")
    assert "LocalRelation <empty>" in empty._jdf.queryExecution().optimizedPlan().toString()
