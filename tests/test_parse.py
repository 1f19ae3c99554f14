import pytest
from helpers import line, lines, tuples
from pyspark.sql import functions as F

from footfall.functions import parse as P
from footfall.operators import filters as X
from footfall.operators import records as R


def params(spark, query, empty=P.EMPTY_VALUE):
    rows = R.params_text(R.parse_records(lines(spark, line(query))), empty)
    return rows.select("params").first().params


@pytest.mark.parametrize(
    "query, expected",
    [
        ("k=v", {"k": "v"}),
        ("k=&x=1", {"k": "NULL", "x": "1"}),
        ("k&x=1", {"k": "NULL", "x": "1"}),
        ("a=b=c&x=1", {"x": "1"}),
        ("a==b&x=1", {"x": "1"}),
        ("a==&x=1", {"a": "NULL", "x": "1"}),
        ("a=v==&x=1", {"a": "v", "x": "1"}),
        ("=&x=1", {"x": "1"}),
        ("==&x=1", {"x": "1"}),
        ("x=1&&y=2", {"x": "1", "y": "2"}),
        ("=v&x=1", {"x": "1"}),
        ("k=1&k=2", {"k": "2"}),
        ("k=1&k=", {"k": "NULL"}),
        ("k=1&k=a=b", {"k": "1"}),
        ("x=1?y=2", {"x": "1"}),
    ],
)
def test_parameter_rules(spark, query, expected):
    assert params(spark, query) == expected


def test_empty_value_may_stay_blank(spark):
    assert params(spark, "k=&x&y=1", empty="") == {"k": "", "x": "", "y": "1"}


@pytest.mark.parametrize(
    "query",
    ["WS=1", "WS=", "WS", "WS=1&WS=2", "WS=1&WS=a=b", "WS==", "WS=v==", "WS==v", "XWS=1", "WSX=1",
     "WS=1&WS", "SWSPID=p&WS=2&X=WS", "a&WS=3?WS=4"],
)
def test_single_field_agrees_with_the_map(spark, query):
    records = R.with_fields(R.params_text(R.parse_records(lines(spark, line(query)))), "ws", "sws")
    row = records.first()
    assert row.ws == row.params.get("WS")
    assert row.sws == row.params.get("SWSPID")


@pytest.mark.parametrize(
    "text, reason",
    [
        ("", "fields"),
        ("a|_|b|_|2024-01-01T02:57:10+08:00", "fields"),
        ("a|_|b|_|2024-01-01T02:57:10+08:00?x=1", "fields"),
        ("a|_|b|_|2024-01-01|_|http://h?x=1", "time"),
        ("a|_|b|_|2024-01-01T2:5|_|http://h?x=1", "time"),
        ("a|_|b|_|2024-01-01T02:57|_|http://h", "query"),
        ("a|_|b|_|2024-01-01T02:57|_|http://h?", "query"),
        ("a|_|b|_|2024-01-01T02:57|_|http://h???", "query"),
    ],
)
def test_rejects(spark, text, reason):
    source = lines(spark, text)
    assert R.parse_records(source).count() == 0
    assert [r.reason for r in R.rejects(source).collect()] == [reason]


def test_records_and_rejects_split_the_lines(spark):
    source = lines(spark, line("x=1"), "bad", line(""), line("?x=1"), line("y"))
    good = {r.event_id for r in R.parse_records(source).collect()}
    bad = {r.event_id for r in R.rejects(source).collect()}
    assert (good, bad) == ({0, 3, 4}, {1, 2})


def test_more_fields_and_marks_in_unread_fields(spark):
    text = line("WS=1&CUC=c", head="a?b&c=d|_|u?T") + "|_|tail?WS=9"
    row = R.with_fields(R.parse_records(lines(spark, text)), "ws", "cuc").first()
    assert (row.ws, row.cuc, row.date, row.minute) == ("1", "c", "2024-01-01", "02:57:00")


@pytest.mark.parametrize(
    "time", ["2024-01-01T02:57:00+08:00", "2024-01-01T02:57:59", "2024-01-01T02:57", "2024-01-01T02:57+00:00"]
)
def test_wall_clock_time(spark, time):
    row = R.parse_records(lines(spark, line("x=1", time))).first()
    assert (row.date, row.minute) == ("2024-01-01", "02:57:00")


def test_parameters_named_date_or_time_do_not_overwrite(spark):
    row = R.parse_records(lines(spark, line("date=x&time=y&minute=z"))).first()
    assert (row.date, row.minute) == ("2024-01-01", "02:57:00")


@pytest.mark.parametrize(
    "text, decoded",
    [
        ("a%20b", "a b"),
        ("a%2520b", "a b"),
        ("a%252520b", "a b"),
        ("a%25252520b", "a%20b"),
        ("a+b", "a b"),
        ("a%2Bb", "a b"),
        ("bad%zz", "NULL"),
        ("bad%2", "NULL"),
        ("%E5%95%86%E5%9F%8E", "商城"),
        ("", ""),
        (None, None),
    ],
)
def test_url_decode(spark, text, decoded):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(P.url_decode(F.col("t")).alias("d")).first().d == decoded


def test_absent_page_url_and_title_read_as_sentinels(spark):
    row = R.with_fields(R.parse_records(lines(spark, line("x=1"))), "pu", "page_url", "title").first()
    assert (row.pu, row.page_url, row.title) == (None, "PU-NULL", "TT-NULL")


def test_minute_number_keeps_order_and_round_trips(spark):
    minutes = [f"{h:02d}:{m:02d}:00" for h in (0, 9, 10, 23) for m in (0, 5, 59)]
    df = spark.createDataFrame([(m,) for m in minutes], "m string")
    number = P.minute_number(F.col("m"))
    rows = df.select("m", number.alias("n"), P.minute_text(number).alias("back")).orderBy("n")
    assert [r.m for r in rows.collect()] == minutes
    assert all(r.m == r.back for r in rows.collect())


def test_minute_epoch_ms(spark):
    df = spark.createDataFrame([("2024-01-01", "02:57:00"), ("x", "02:57:00")], "d string, m string")
    rows = [r[0] for r in df.select(P.minute_epoch_ms(F.col("d"), F.col("m"))).collect()]
    assert rows == ["1704077820000", None]


def test_results_do_not_depend_on_map_or_ansi_settings(spark):
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert params(spark, "k=1&k=2&z") == {"k": "2", "z": "NULL"}
            assert R.parse_records(lines(spark, "a", line("k=1"))).count() == 1
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


# -- filters ----------------------------------------------------------------


def test_bot_filter_looks_at_the_whole_line(spark):
    source = lines(spark, line("x=1"), line("x=sPiDeR"), line("x=1", head="BaiduSPIDER|_|u"))
    assert tuples(source.filter(X.not_bot(F.col("line"))), "event_id") == [(0,)]


def test_raw_site_filter_needs_a_following_parameter(spark):
    source = lines(spark, line("WS=10000001&x=1"), line("x=1&WS=10000001"))
    raw = source.filter(X.raw_main_site(F.col("line"), "10000001"))
    assert tuples(raw, "event_id") == [(0,)]
    parsed = R.with_fields(R.parse_records(source), "ws").filter(X.main_site("10000001"))
    assert tuples(parsed, "event_id") == [(0,), (1,)]


@pytest.mark.parametrize(
    "query, malls",
    [
        ("PS=www.mall-a.example", ["main"]),
        ("PS=www.mall-b.example", ["second"]),
        ("PS=pay.example&PU=http%253A%252F%252Fp%253Fplat%253D4", ["main"]),
        ("PS=pay.example&PU=x%3Fplat%3D8", ["second"]),
        ("PS=pay.example&PU=x%3Fplat%3D7", []),
        ("PS=community.example&PU=%2Fbrand%2Fthink", ["main", "second"]),
        ("PS=blog.example&PU=SHOPID%3D1", ["main"]),
        ("PS=www.mall-a.example&PU=ShopId%3D2", ["main", "second"]),
        ("PU=shopid%3D2", ["second"]),
        ("PU=x%26shopid%3D2", []),
        ("PS=www.mall-a.example&PU=bad%zz", ["main"]),
        ("x=1", []),
    ],
)
def test_mall_rules(spark, query, malls):
    from footfall.fixtures import FIXTURE_CONFIG as config

    rows = R.with_fields(R.parse_records(lines(spark, line(query))), "ps", "page_url")
    assert [m for (m,) in tuples(X.classify_mall(rows, config.malls), "mall")] == malls
    assert rows.filter(X.shop_flow(config.malls)).count() == bool(malls)


def test_config_round_trips_as_json():
    import dataclasses
    import json

    from footfall.config import TrafficConfig
    from footfall.fixtures import FIXTURE_CONFIG as config

    assert TrafficConfig.from_json(json.dumps(dataclasses.asdict(config))) == config
