"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry_points
from punctuality.operators import delays, sampling
from punctuality.operators.clean import clean, prune
from punctuality.plans import pipeline
from punctuality.plans import rollup as rolled
from punctuality.sources.flights import land, read_landed

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df):
    return {
        name
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))
        for name in re.findall(r"(\w+):", schema)
    }


@pytest.fixture(scope="module")
def landed(spark, edge, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("plans") / "landed")
    land(edge, target)
    return read_landed(spark, target)


def test_scan_reads_needed_columns_only(landed, edge):
    for df in (landed, edge):
        months = delays.monthly_delays(clean(prune(df)))
        assert read_columns(months) == {
            "CANCELLED", "ARR_DELAY", "DEP_DELAY", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "FL_DATE",
        }
        assert "DISTANCE" not in read_columns(rolled.delay_rollup(prune(df)))


def test_cleaning_reaches_the_scan(landed):
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan(clean(prune(landed))))[1]
    assert "EqualTo(CANCELLED,0.0)" in pushed
    for name in ("ARR_DELAY", "DEP_DELAY", "OP_UNIQUE_CARRIER", "ORIGIN", "DEST"):
        assert f"IsNotNull({name})" in pushed


def test_year_filter_prunes_folders(landed):
    assert "PartitionFilters: [isnotnull(FL_YEAR" in plan(prune(landed.filter("FL_YEAR = 2019")))


def test_top_k_does_not_sort_everything(landed):
    top = plan(delays.top_origin_delays(delays.origin_delays(clean(prune(landed)))))
    assert "TakeOrderedAndProject" in top and "rangepartitioning" not in top


def test_aggregates_combine_before_one_shuffle(landed):
    for df in (
        rolled.delay_rollup(prune(landed)), pipeline.refined_rollup(landed),
        delays.origin_delays(clean(prune(landed))),
    ):
        text = plan(df)
        assert text.count("Exchange") == 1
        assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
        assert "partial_" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_log_status_is_one_hash_aggregation(spark):
    text = plan(entry_points.queries()["log_step_status"](spark, SF_DIR))
    assert text.count("Exchange") == 1 and "SortAggregate" not in text and "Sort " not in text


def test_sample_and_split_do_not_shuffle(landed):
    cleaned = clean(prune(landed))
    for df in (sampling.sample_by_key(cleaned), *sampling.split_by_key(cleaned)):
        assert "Exchange" not in plan(df) and "Sort" not in plan(df)


def test_model_sample_combines_before_one_shuffle(landed):
    text = plan(pipeline.model_sample(clean(prune(landed))))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
    assert "EqualTo(CANCELLED,0.0)" in text


def test_share_needs_no_join(landed):
    text = plan(delays.delay_cause_share(delays.delay_causes(clean(prune(landed)))))
    assert "Join" not in text and "Window" not in text and "CartesianProduct" not in text


# Their few rows describe a fitted model, which the driver holds.
FROM_THE_MODEL = {"delay_model", "feature_importance", "top_feature", "importance_percent", "planted_top_feature"}


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.text_queries())))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry_points.queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    assert "LocalTableScan" not in text or name in FROM_THE_MODEL
