"""The landing table, stored sets of visitors, panes, audits, bucketed tables and start offsets."""

import os

import pytest
from helpers import SF, hits, line, lines, tuples
from pyspark.sql import functions as F
from test_plans import plan
from test_streaming import Feed, hit

from footfall import fixtures, sinks, sources, streaming
from footfall.fixtures import FIXTURE_CONFIG as CONFIG
from footfall.operators import goods as G
from footfall.operators import metrics as M
from footfall.operators import topn as T
from footfall.operators import visitors as V
from footfall.operators.filters import main_site_hits
from footfall.operators.records import with_reason
from footfall.sources import landing


def test_a_landed_day_is_replaced_as_a_whole_and_pruned(spark, tmp_path):
    path = f"{tmp_path}/hits"
    whole = fixtures.hits(spark, SF)
    landing.land_hits(whole, path, files=2)
    day = whole.filter(F.contains("line", F.lit("|_|2024-01-15T")))
    landing.land_hits(day.limit(40), path, files=2)
    landing.land_hits(day, path, files=2)
    landed = landing.landed_main_site_hits(spark, path, CONFIG)
    want = main_site_hits(whole, CONFIG, "cuc", "rc", "un")
    for frame in (landed, want):
        frame.count()
    assert tuples(M.four_metrics(landed, ["date", "ws"]), "date", *M.METRICS) == tuples(
        M.four_metrics(want, ["date", "ws"]), "date", *M.METRICS
    )
    text = plan(M.four_metrics(landing.landed_main_site_hits(spark, path, CONFIG, ["2024-01-15"]), ["date", "ws"]))
    assert "PartitionFilters" in text and "2024-01-15" in text
    assert "EqualTo(ws,10000001)" in text and "IsNull(cle)" in text
    assert "2024-01-15" in {d.removeprefix("date=") for d in os.listdir(path)}


def test_visitor_sets_count_each_visitor_once(spark, tmp_path):
    rows = [(i, i, f"2024-01-0{1 + i % 3}", "10:00:00", f"v{i * 7 % 50}" if i % 11 else None, "1", "") for i in range(400)]
    frame = hits(spark, rows)
    sets = V.VisitorSets(spark, str(tmp_path))
    for version in range(4):
        sets.add(frame.filter(F.col("event_id") % 4 == version), version)
        sets.add(frame, version)  # a replay
    assert tuples(sets.count("date", "ws"), "date", "uv") == tuples(M.unique_visitors(frame, ["date"]), "date", "uv")
    assert sets.count().first().uv == 51
    numbers = sorted(r.number for r in sets.dictionary.read().collect())
    assert numbers == list(range(51))
    assert "member" not in plan(sets.count("date"))


def test_numbers_of_known_members_stay(spark):
    known = spark.createDataFrame([("a", 0), ("b", 1)], "member string, number bigint")
    new = V.number_new(spark.createDataFrame([(m,) for m in "abcdde"], "member string"), known).collect()
    assert {r.member for r in new} == set("cde") and sorted(r.number for r in new) == [2, 3, 4]


@pytest.mark.parametrize("length, slide", [("60 seconds", "20 seconds"), ("60 seconds", "1 second"), ("50 seconds", "20 seconds")])
def test_panes_give_the_windows_of_the_engine(spark, length, slide):
    rows = [(f"u i{i % 3} c{i % 2}", 1_700_000_000 + i * i % 397 + 0.25 * (i % 4)) for i in range(120)] + [("u i9 c9", None)]
    frame = spark.createDataFrame(rows, "line string, t double")
    clicks = T.click_keys(frame.select("line", F.timestamp_seconds("t").alias("ts")))
    columns = ("window_start", "window_end", "category", "item", "click_count")
    plain = clicks.groupBy(F.window("ts", length, slide), "category", "item").agg(F.count("*").alias("click_count"))
    plain = plain.select("window.start", "window.end", "category", "item", "click_count").toDF(*columns)
    got = T.sliding_click_counts(clicks, length, slide)
    assert tuples(got, *columns) == tuples(plain, *columns)
    before = plan(got).split("Exchange")[0]
    assert "Expand" not in plan(got) and "Generate" not in plan(T.pane_counts(clicks, length, slide)), before


def test_audit_counts_and_keeps_what_a_stream_drops(spark, tmp_path):
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    feed.add(hit(1, "a"), "not a hit", hit(2, "b").replace("10.0.0.1", "a Spider"), hit(3, "c").replace("T10:", "T99:"))
    feed.add(hit(1, "a"), hit(2, "b").split("?")[0])
    query = streaming.stream_audit(feed.stream(), out, f"{tmp_path}/cp")
    query.awaitTermination()
    rows = tuples(streaming.read_audit(spark, out), "batch_id", *streaming.AUDIT)
    assert rows == [(0, 4, 1, 1, 1, 1, 0), (1, 2, 1, 0, 0, 0, 1)]
    rejects = streaming.read_rejects(spark, out, "event_id bigint, line string")
    assert tuples(rejects, "batch_id", "event_id", "reason") == [
        (0, 1, "fields"), (0, 2, "bot"), (0, 3, "time"), (1, 5, "query"),
    ]
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [4, 2]  # each line once


def test_a_reason_for_each_line_that_is_not_parsed(spark):
    rows = with_reason(lines(spark, line("WS=1"), "x", line("").rstrip("?"), line("WS=1", time="none"))).collect()
    assert [r.reason for r in rows] == [None, "fields", "query", "time"]


def test_a_bucketed_dimension_is_not_shuffled(spark, tmp_path):
    dimension = G.goods_dimension(fixtures.goods(spark, SF), fixtures.website(spark, SF))
    stored = sinks.store_table(dimension, "footfall_test_dimension", f"{tmp_path}/dim", ["pcode"], 8)
    events = spark.createDataFrame([(i, str(i), 1) for i in range(50)], "event_id bigint, pcode string, state int")
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = G.enrich_goods_state(events, stored)
        text = plan(joined).split("(1) ")[0]
        assert text.count("Exchange") == 1 and "SortMergeJoin" in text
        assert "Bucketed: true" in plan(joined)
        want = tuples(G.enrich_goods_state(events, dimension).fillna(""), "event_id", "goods_name", "website_name")
        assert tuples(joined.fillna(""), "event_id", "goods_name", "website_name") == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        spark.sql("drop table footfall_test_dimension")


def test_start_offsets_move_expired_partitions_only():
    first, last = {0: 10, 1: 20, 2: 30}, {0: 100, 1: 200, 2: 300}
    assert sources.start_offsets(None, first, last) == last
    assert sources.start_offsets(None, first, last, "earliest") == first
    assert sources.start_offsets({0: 5, 1: 50, 2: 300}, first, last) == {0: 10, 1: 50, 2: 300}
    assert sources.start_offsets({0: 10, 1: 201}, first, last) == {0: 10, 1: 20, 2: 30}
    assert sources.start_offsets({0: 50, 7: 1}, {0: 10}, {0: 100}) == {0: 50}
    assert sources.start_offsets({}, {}, {}) == {}
    for bad in (("other", last), ("latest", {0: 1})):
        with pytest.raises(ValueError):
            sources.start_offsets(None, first, bad[1], bad[0])
