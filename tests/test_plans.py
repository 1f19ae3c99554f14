"""The physical plans keep the shape that scale needs."""

import contextlib
import io

import pytest
from helpers import SF

from footfall import fixtures, sinks, sources
from footfall.fixtures import FIXTURE_CONFIG as CONFIG
from footfall.operators import filters as X
from footfall.operators import metrics as M
from footfall.operators import running as W
from footfall.plans.queries import QUERIES


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


BATCH = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "sink_", "scan_", "refit_"))]
#: What these aggregate besides numbers is small: titles, a mark for each site, stored bitmaps.
SMALL_TEXT = ("campaign_codes", "hwm_snapshot_across_days", "uv_rollup")


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_no_python_no_spreading_by_size_and_hash_aggregates(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in (
        "CartesianProduct",
        "BroadcastNestedLoopJoin",
        "BatchEvalPython",
        "ArrowEvalPython",
        "RoundRobinPartitioning",
        *(() if name in SMALL_TEXT else ("SortAggregate",)),
    ):
        assert word not in text


@pytest.mark.parametrize("name", ["pvuv_by_day", "running_pvuv", "pvuv_by_activity", "pvuv_by_minute"])
def test_metrics_aggregate_by_hash_in_one_scan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "SortAggregate" not in text
    assert "Expand" not in text
    assert text.count("Scan parquet") <= 2  # the tree and the node's details


def test_triggers_aggregate_by_hash(spark):
    hits = X.main_site_hits(fixtures.hits(spark, SF), CONFIG, "cuc", "rc", "un")
    assert "SortAggregate" not in plan(W._triggers(hits, ["date", "ws"], W._arrival(hits, ("arrival", "event_id")), False))


def test_top_items_limit_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["topn_per_category"](spark, SF))


def test_only_the_needed_columns_are_read(spark):
    text = plan(QUERIES["pvuv_by_day"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_raw_tests_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/hits"
    fixtures.hits(spark, SF).write.parquet(path)
    hits = X.main_site_hits(spark.read.parquet(path), CONFIG, "cuc", "rc", "un")
    text = plan(M.four_metrics(hits, ["date", "ws"]))
    assert "StringContains(line,WS=10000001)" in text
    assert "ReadSchema: struct<line:string>" in text


def test_one_day_reads_one_partition(spark, tmp_path):
    path = f"{tmp_path}/metrics"
    sinks.write_by_date(sinks.metrics_to_long(QUERIES["pvuv_by_day"](spark, SF)), path)
    text = plan(sources.scan_metric_snapshot(spark, path, "2024-01-15"))
    assert "PartitionFilters: [isnotnull(date" in text
