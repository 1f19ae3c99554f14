"""Campaigns, goods, top items, sinks."""

import json
import pytest
from helpers import line, lines, tuples
from pyspark.sql import functions as F

from footfall import sinks, sources
from footfall.fixtures import FIXTURE_CONFIG as CONFIG
from footfall.operators import campaigns as C
from footfall.operators import filters as X
from footfall.operators import goods as G
from footfall.operators import topn as T

GOOD = "WS=10000001&PS=www.mall-a.example"


def titled(spark, rows):
    return spark.createDataFrame(rows, "title string, date string, minute string")


@pytest.fixture
def known(spark):
    return spark.sql("select * from values ('A', 'tt1'), ('B', 'tt7') as c(title, code)")


NEW = [
    ("Z", "2024-01-01", "10:00:00"),
    ("Y", "2024-01-01", "10:00:00"),
    ("A", "2024-01-01", "09:00:00"),
    ("X", "2024-01-01", "09:30:00"),
    ("W", "2024-01-02", "00:00:00"),
    ("Z", "2024-01-02", "00:00:00"),
    ("V", "2023-12-31", "23:59:00"),
]


def test_codes_follow_first_appearance_then_title(spark, known):
    want = [
        ("A", "tt1"), ("B", "tt7"), ("V", "tt8"), ("W", "tt12"),
        ("X", "tt9"), ("Y", "tt10"), ("Z", "tt11"),
    ]
    assert tuples(C.campaign_codes(titled(spark, NEW), known), "title", "code") == want
    shuffled = titled(spark, NEW[::-1]).repartition(5)
    assert tuples(C.campaign_codes(shuffled, known), "title", "code") == want


def test_codes_are_stable_when_run_again(spark, known):
    once = C.campaign_codes(titled(spark, NEW), known)
    again = C.campaign_codes(titled(spark, NEW + [("U", "2020-01-01", "00:00:00")]), once)
    codes = dict(tuples(again, "title", "code"))
    assert codes["U"] == "tt13"
    assert {t: codes[t] for t, _ in tuples(once, "title", "code")} == dict(tuples(once, "title", "code"))


def test_start_code_and_empty_dimension(spark, known):
    new = C.new_campaign_codes(titled(spark, NEW[:1]), known, start_code=100)
    assert tuples(new, "title", "code") == [("Z", "tt100")]
    taken = C.new_campaign_codes(titled(spark, NEW[:1]), known, start_code=2)
    assert not set(tuples(taken, "code")) & set(tuples(known, "code"))
    empty = known.filter("false")
    assert tuples(C.campaign_codes(titled(spark, NEW[:1]), empty), "title", "code") == [("Z", "tt1")]


def test_codes_sharing_titles_are_pooled(spark):
    both = spark.sql("select * from values ('T1', 'tt1'), ('T2', 'tt1') as c(title, code)")
    seen = (("T1", "a"), ("T2", "a"), ("T2", "b"))
    texts = [line(f"{GOOD}&PU=/activity/1&TT={t}&CUC={c}&RC=0&UN=n") for t, c in seen]
    source = lines(spark, *texts)
    hits = C.activity_hits(source, CONFIG)
    assert tuples(C.metrics_by_campaign(hits, both), "code", "pv", "uv", "rc", "un") == [("tt1", 3, 2, 2, 1)]


def test_activity_tests(spark):
    source = lines(
        spark,
        line(f"{GOOD}&PU=http%3A%2F%2Fs%2Factivity%2F1&x=activity"),
        line(f"{GOOD}&PU=my-activity"),
        line(f"{GOOD}&PU=x&TT=activity"),
        line(f"{GOOD}&PU=x"),
    )
    ids = {
        t: [e for (e,) in tuples(C.activity_hits(source, CONFIG, t), "event_id")]
        for t in ("path", "word", "raw")
    }
    assert ids == {"path": [0], "word": [0, 1], "raw": [0, 1, 2]}
    with pytest.raises(ValueError):
        C.activity_hits(source, CONFIG, "other")


def event(code, state, port):
    return f"||show::goodsstore::{code}::{state}::{port}||"


def test_goods_events_one_row_each(spark):
    source = lines(
        spark,
        line(f"{GOOD}&CLE={event(12, 0, 'wap')}x{event(34, 1, 'pc')}"),
        line(f"{GOOD}&CLE={event('012', 0, 'wap')}"),
        line(f"{GOOD}&CLE={event(5, 12, 'wap')}"),
        line(f"{GOOD}&CLE={event(5, 1, 'WAP')}"),
        line(f"{GOOD}&CLE="),
        line(f"{GOOD}"),
        line(f"WS=2&PS=www.mall-a.example&CLE={event(7, 0, 'pc')}"),
    )
    rows = G.goods_events(X.goods_hits(source, CONFIG))
    assert tuples(rows, "event_id", "pos", "port", "pcode", "state") == [
        (0, 0, "wap", "12", 0), (0, 1, "pc", "34", 1),
    ]


def test_unknown_goods_are_kept(spark):
    events = spark.createDataFrame([("1", 0), ("2", 1), ("3", 1)], "pcode string, state int")
    goods = spark.createDataFrame(
        [("g1", "1", 10), ("g2", "2", 99)], "goods_name string, goods_business_cd string, website_cd int"
    )
    website = spark.createDataFrame([(10, "shop")], "website_cd int, website_name string")
    rows = G.enrich_goods_state(events, G.goods_dimension(goods, website))
    assert set(map(tuple, rows.select("pcode", "state", "goods_name", "website_name").collect())) == {
        ("1", 0, "g1", "shop"), ("2", 1, "g2", None), ("3", 1, None, None),
    }


def test_upsert_updates_inserts_and_keeps_with_null_keys(spark):
    schema = "k string, j string, v int"
    old = spark.createDataFrame([("a", None, 1), ("b", "x", 1), (None, None, 1)], schema)
    new = spark.createDataFrame([("a", None, 2), ("c", "x", 2), (None, None, None)], schema)
    rows = set(map(tuple, sinks.upsert(old, new, ["k", "j"]).collect()))
    assert rows == {("a", None, 2), ("b", "x", 1), ("c", "x", 2), (None, None, None)}


def test_keyed_batches_replay_and_compact(spark, tmp_path):
    path, target = f"{tmp_path}/t", f"{tmp_path}/u"
    schema = "date string, ws string, minute string, pv int"

    def batch(pv, *minutes):
        return spark.createDataFrame([("2024-01-01", "s", m, pv) for m in minutes], schema)

    sinks.write_batch(batch(1, "a", "b"), path, 0)
    sinks.write_batch(batch(2, "b", "c"), path, 1)
    sinks.write_batch(batch(3, "b", "c"), path, 1)
    want = [("2024-01-01", "a", 1), ("2024-01-01", "b", 3), ("2024-01-01", "c", 3)]
    read = sinks.read_keyed(spark, path, sinks.SNAPSHOT_KEYS)
    assert tuples(read, "date", "minute", "pv") == want
    sinks.compact(
        spark, path, target, 1, lambda r: sinks.latest_by_key(r, sinks.SNAPSHOT_KEYS, "batch_id")
    )
    sinks.write_batch(batch(4, "a"), target, 2)
    read = sinks.read_keyed(spark, target, sinks.SNAPSHOT_KEYS)
    assert tuples(read, "date", "minute", "pv") == [("2024-01-01", "a", 4), *want[1:]]


def test_write_by_date_replaces_only_its_dates(spark, tmp_path):
    path = f"{tmp_path}/t"
    for rows in ([(1, "2024-01-01"), (2, "2024-01-02")], [(3, "2024-01-02")]):
        sinks.write_by_date(spark.createDataFrame(rows, "v int, date string"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 3]


def test_top_items_break_ties_by_name(spark):
    counts = spark.createDataFrame(
        [("c", i, n) for i, n in (("b", 5), ("a", 5), ("d", 4), ("e", 4))] + [("k", "z", 1)],
        "category string, item string, click_count int",
    )
    assert tuples(T.top_items(counts), "category", "rank", "item") == [
        ("c", 1, "a"), ("c", 2, "b"), ("c", 3, "d"), ("k", 1, "z"),
    ]


def test_click_lines_without_a_category_are_dropped(spark):
    source = spark.createDataFrame([("u i c",), ("u i",), ("",)], "line string")
    assert tuples(T.click_keys(source), "category", "item") == [("c", "i")]


def test_hits_path():
    assert sources.hits_path("hdfs://x/logs/", "20240105") == "hdfs://x/logs/2024/01/05/*/traffic*"
    assert sources.hits_path("r", "20240105", "/other/*") == "/other/*"


def test_scan_hits_day_reads_only_that_day(spark, tmp_path):
    for day, text in (("2024/01/05", "one"), ("2024/01/06", "two")):
        for hour in ("00", "23"):
            lines(spark, f"{text}-{hour}").select("line").write.text(f"{tmp_path}/{day}/{hour}/traffic-1")
    rows = sources.scan_hits_day(spark, str(tmp_path), "20240105")
    assert tuples(rows, "line") == [("one-00",), ("one-23",)]


def test_kafka_options():
    assert sources.kafka_options("h:1", "t")["startingOffsets"] == "latest"
    options = sources.kafka_options("h:1", "t", from_start=True)
    assert options["startingOffsets"] == "earliest"
    assert (options["subscribe"], options["failOnDataLoss"]) == ("t", "false")
    options = sources.kafka_options("h:1", "t", offsets={0: 23, 1: -2}, most_per_batch=1000)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 23, "1": -2}}
    assert options["maxOffsetsPerTrigger"] == "1000"


def test_metric_keys(spark):
    rows = spark.createDataFrame([("PV:20240101:site",)], "key string")
    assert tuples(sinks.metric_key_parts(rows), "kind", "date", "site") == [("PV", "20240101", "site")]


def test_daily_export_with_a_missing_metric(spark):
    rows = spark.createDataFrame(
        [("PV", "d", "s", 5), ("UV", "d", "s", 3), ("PV", "d", "t", 2), ("RC", "d", "s", 1)],
        "kind string, date string, site string, value bigint",
    )
    assert {tuple(r) for r in sinks.daily_export(rows).collect()} == {("d", "s", 3, 5), ("d", "t", None, 2)}


def test_running_list_is_newest_first(spark):
    rows = spark.createDataFrame(
        [("d", "10:00:00", 1), ("d", "10:05:00", 4)], "date string, minute string, pv bigint"
    )
    assert [r.entry for r in sinks.running_list(rows).collect()] == ["10:05:00--4", "10:00:00--1"]


def test_lookup_of_titles_counts_every_registered_hit(spark, known):
    hits = spark.createDataFrame([(t,) for t in "AABC"], "title string").withColumn("n", F.lit(1))
    rows = C.campaign_lookup(hits, known)
    assert tuples(rows, "title", "code") == [("A", "tt1"), ("A", "tt1"), ("B", "tt7")]
