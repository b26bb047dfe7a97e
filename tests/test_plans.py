"""Plan properties every registered query must keep (checked on the plan, not run)."""

import re

import pytest

from clickmart.queries import QUERIES

SF = "/root/testdata/sf0.001"
# writes happen while these queries are built, so they are planned separately
PYTHON_OK = {"model_accuracy", "train_score_roundtrip", "score_by_loaded_pipeline", "score_users_by_day", "stream_score_users", "count_vectors"}


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(q(spark, SF)) for name, q in sorted(QUERIES.items())}


def test_no_cross_or_nested_loop_joins(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_no_row_at_a_time_python(plans):
    assert not {n for n, p in plans.items() if "BatchEvalPython" in p}


def test_arrow_python_only_in_the_classifier(plans):
    assert not {n for n, p in plans.items() if "ArrowEvalPython" in p and n not in PYTHON_OK}


def test_unused_columns_are_pruned(plans):
    # the events table has a `props` column no query uses; pages carry `html`
    for name, p in plans.items():
        for rs in re.findall(r"ReadSchema: (struct<.*>)", p):
            assert "props:" not in rs, name
            assert "html:" not in rs, name


def test_event_type_filter_reaches_the_scan(plans):
    assert "PushedFilters: [In(event_type, [purchase,view])]" in plans["distinct_items"]
    assert "PushedFilters: [In(event_type, [purchase,view])]" in plans["events_newest_first"]


def test_top_n_has_no_merge_of_all_partitions(plans):
    for name in ("top_domains", "visits_to_top_domains", "count_vectors", "domain_feature_array", "user_features"):
        assert "TakeOrderedAndProject" not in plans[name], name
