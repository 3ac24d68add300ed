"""What the plans must look like for the operators to hold at scale."""

import re

import pytest

from conftest import SF
from millrace.operators.rolling import Rolling, rolling
from millrace.plans import QUERIES
from millrace.plans.bindings import load, travel

DAY = 86_400


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def ran(df) -> str:
    df.collect()
    return plan(df)


ONE_PASS = ["point_in_time", "point_in_time_tiled", "training_set", "merge_upsert", "knn_topk", "drift_baseline", "auroc"]


@pytest.mark.parametrize("name", ONE_PASS)
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_frames_share_one_exchange(spark):
    specs = [Rolling("a", "price", 7 * DAY), Rolling("b", None, 7 * DAY), Rolling("c", "price", 180 * DAY)]
    text = plan(rolling(travel(spark, SF), ["user_id"], "sec", specs, "frames"))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_pit_has_one_exchange_for_the_rows(spark):
    text = plan(QUERIES["point_in_time"](spark, SF))
    # One for the union of both sides; the other prepares the feature side.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_profile_reads_once_and_reuses_counts(spark):
    text = ran(QUERIES["profile_by_slice"](spark, SF))
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_filters_and_columns_reach_the_files(spark):
    text = plan(QUERIES["scan_parquet"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*l_returnflag", text)
    assert "l_comment" not in text and "l_extendedprice" not in text
    stats = plan(QUERIES["segment_accuracy"](spark, SF))
    assert "text" not in re.search(r"ReadSchema: struct<[^>]*n_chars[^>]*>", stats).group(0)


def test_latest_per_key_combines_before_the_shuffle(spark):
    text = plan(QUERIES["latest_per_key"](spark, SF))
    assert "partial_max_by" in text


def test_no_python_in_relational_operators(spark):
    for name in ("training_set", "profile_by_window", "chunk_text", "html_to_text", "dialogue_context", "anomaly_diag"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text, name


def test_load_keeps_time_without_zone(spark):
    assert dict(load(spark, SF, "events").dtypes)["ts"] == "timestamp_ntz"
