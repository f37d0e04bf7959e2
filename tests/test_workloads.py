"""Every registered query against its SQL, and the shape of the plans that matter at scale."""

import pytest

import __spark_entry__ as entry_points
from oracle_check import compare, duck
from tidemark.operators import series as S
from tidemark.plans.oracles import ORACLES
from tidemark.plans.workloads import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == ""


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "trend" in df.columns and df.count() > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_of_a_keyed_history_need_one_shuffle(spark):
    rows = spark.createDataFrame([], "k string, date date, price long, trade_count long, seq long")
    one = plan_of(S.series_metrics(rows, ["k"], unique_dates=True, trail=7))
    assert one.count("Exchange hashpartitioning") == 1 and one.count("Sort [") == 1 and "SortAggregate" not in one
    raw = plan_of(S.series_metrics(rows, ["k"]))
    assert raw.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in raw


@pytest.mark.parametrize("name", ["match_cards", "resolve_watchlist", "names_overlap", "plan_targets", "upsert_plan", "trend_all_scopes",
                                  "flag_duplicates", "robots_filter", "pattern_coverage", "card_report"])
def test_no_pairing_of_everything_with_everything(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    try:
        text = plan_of(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_what_is_needed(spark):
    text = plan_of(QUERIES["trend_card"](spark, SF))
    scan = text[text.index("FileScan"):]
    assert "l_tax" not in scan and "l_linestatus" not in scan


def test_row_limits_apply_before_the_shuffle(spark):
    for name in ("last_n_days", "top_matches", "card_records"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SF))
