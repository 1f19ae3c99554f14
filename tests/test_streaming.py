"""Micro-batches, late data and replays; batch equality at scale is in test_oracles."""

import pytest

from helpers import line, tuples
from pyspark.sql import functions as F

from footfall import sinks, sources, streaming
from footfall.fixtures import FIXTURE_CONFIG as CONFIG
from footfall.operators import metrics as M
from footfall.operators import running as W
from footfall.operators.filters import main_site_hits

GOOD = "WS=10000001&PS=www.mall-a.example"
SCHEMA = "event_id bigint, line string"


def hit(minute, cuc, rc="1", un="", day="01", tail=""):
    return line(f"{GOOD}&CUC={cuc}&RC={rc}&UN={un}{tail}", f"2024-01-{day}T10:{minute:02d}:00+08:00")


class Feed:
    """A folder of files; each ``add`` is one micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.rows = spark, f"{path}/in", []

    def add(self, *texts):
        start = len(self.rows)
        rows = [(start + i, t) for i, t in enumerate(texts)]
        self.rows += rows
        frame = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(self.path)

    def stream(self):
        return sources.stream_files(self.spark, self.path, SCHEMA, max_files=1)

    def batch(self):
        return self.spark.createDataFrame(self.rows, SCHEMA)


def daily_of(feed):
    hits = main_site_hits(feed.batch(), CONFIG, "cuc", "rc", "un")
    return tuples(M.four_metrics(hits, ["date", "ws"]), "date", *M.METRICS)


BATCHES = [
    [hit(1, "a", "0", "n1"), hit(2, "b"), hit(2, "a")],
    [hit(5, "a"), hit(6, "c", "0", "n1"), hit(1, "b", "0")],
    [hit(0, "d", un="n2"), hit(0, "a", day="02"), hit(6, "c", "0")],
]


def test_daily_metrics_go_on_from_the_checkpoint(spark, tmp_path):
    feed, out, checkpoint = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"
    for texts in BATCHES:
        feed.add(*texts)
        streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, checkpoint).awaitTermination()
        got = tuples(streaming.read_pvuv_by_day(spark, out), "date", *M.METRICS)
        assert got == daily_of(feed)
    written = sinks.read_batches(spark, out)
    assert written.select("batch_id").distinct().count() == 3
    assert written.filter("batch_id = 1").count() <= 2 * len(BATCHES[1])


def test_folded_batches_read_as_the_single_ones(spark, tmp_path):
    feed, out, checkpoint = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"
    for texts in [*BATCHES, *BATCHES[::-1]]:
        feed.add(*texts)
        query = streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, checkpoint, fold_every=2)
        query.awaitTermination()
        assert tuples(streaming.read_pvuv_by_day(spark, out), "date", *M.METRICS) == daily_of(feed)
    schema = M.partials_schema(streaming.SITE_DIMS)
    folded = sinks.read_batches(spark, f"{out}/_folded", schema=schema)
    assert tuples(folded.select("batch_id").distinct(), "batch_id") == [(1,), (3,), (5,)]
    # the single batches that a reader still opens are those after the last mark
    assert sinks.read_batches(spark, out, schema=schema, after=5).count() == 0


def test_a_batch_reads_no_other(spark, tmp_path):
    """A micro-batch reads its own lines and nothing that earlier ones wrote: they are taken away."""
    import shutil

    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    jobs = {
        "snapshot": (streaming.stream_snapshot, "batch_id="),
        "uv": (streaming.stream_uv, "batch_id="),
        "daily": (streaming.stream_pvuv_by_day, "batch_id="),
    }
    for i in range(4):
        feed.add(*[hit(i, f"c{i}x{k}") for k in range(5)])
        for name, (job, folder) in jobs.items():
            query = job(feed.stream(), CONFIG, f"{out}/{name}", f"{tmp_path}/cp/{name}", fold_every=100)
            query.awaitTermination()
            assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [5]
            rows = spark.read.parquet(f"{out}/{name}/{folder}{i}")
            assert rows.count() == (5 if name == "uv" else 6 if name == "snapshot" else 5)
            shutil.rmtree(f"{out}/{name}/{folder}{i}")


def test_snapshots_read_the_state_before_and_no_older_batch(spark, tmp_path):
    import shutil

    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    for i in range(5):
        feed.add(*[hit(6 * i + k, f"c{i}x{k}") for k in range(5)])
        stream = feed.stream().withColumn("arrival", F.col("event_id"))
        streaming.stream_site_snapshots(stream, CONFIG, out, f"{tmp_path}/cp").awaitTermination()
        last = spark.read.parquet(f"{out}/snapshots/batch_id={i}").agg(F.max("pv"), F.max("uv")).first()
        assert tuple(last) == (5 * i + 5, 5 * i + 5)
        if i:
            for folder in ("state", "snapshots"):
                shutil.rmtree(f"{out}/{folder}/batch_id={i - 1}")


def test_single_batches_that_were_folded_can_be_dropped(spark, tmp_path):
    feed, out, checkpoint = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"

    def run(texts):
        feed.add(*texts)
        streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, checkpoint, fold_every=2).awaitTermination()

    for texts in BATCHES:
        run(texts)
    assert sinks.drop_folded(spark, out) == [0, 1]
    assert tuples(streaming.read_pvuv_by_day(spark, out), "date", *M.METRICS) == daily_of(feed)
    run(BATCHES[1])
    assert sinks.drop_folded(spark, out) == [2, 3] and sinks.drop_folded(spark, out) == []
    run(BATCHES[0])
    assert tuples(streaming.read_pvuv_by_day(spark, out), "date", *M.METRICS) == daily_of(feed)


def test_uv_and_snapshot_over_batches_with_late_hits(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for texts in BATCHES:
        feed.add(*texts)
    uv = streaming.stream_uv(feed.stream(), CONFIG, f"{tmp_path}/uv", f"{tmp_path}/cp1")
    uv.awaitTermination()
    assert tuples(streaming.read_uv(spark, f"{tmp_path}/uv"), "date", "uv") == [
        (d, uv) for d, _, uv, _, _ in daily_of(feed)
    ]
    snap = streaming.stream_snapshot(feed.stream(), CONFIG, f"{tmp_path}/s", f"{tmp_path}/cp2")
    snap.awaitTermination()
    rows = tuples(streaming.read_snapshot(spark, f"{tmp_path}/s"), "date", "minute", *M.METRICS)
    last = {}
    for date, _, *values in rows:
        last[date] = (date, *values)
    assert sorted(last.values()) == daily_of(feed)


def test_no_hit_is_too_late_and_no_date_moves_a_mark(spark, tmp_path):
    future = hit(1, "z").replace("2024-01-01T", "2099-01-01T")
    batches = ([hit(1, "a")], [future], [hit(2, "c")], [hit(1, "b", day="02")], [hit(3, "a", day="02")])
    feed, out, checkpoint = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"
    for texts in batches:
        feed.add(*texts)
        streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, checkpoint).awaitTermination()
    got = tuples(streaming.read_pvuv_by_day(spark, out), "date", *M.METRICS)
    assert got == daily_of(feed)
    assert [(date, pv) for date, pv, *_ in got] == [("2024-01-01", 2), ("2024-01-02", 2), ("2099-01-01", 1)]


def test_replay_of_a_batch_changes_nothing(spark, tmp_path):
    """The sink sees the last batch once more, as after a crash before the commit."""
    import os

    feed, out, checkpoint = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"
    for texts in BATCHES:
        feed.add(*texts)
    jobs = {
        "daily": streaming.stream_pvuv_by_day,
        "snapshot": streaming.stream_snapshot,
    }
    reads = {"daily": streaming.read_pvuv_by_day, "snapshot": streaming.read_snapshot}
    for name, job in jobs.items():
        path, cp = f"{out}/{name}", f"{checkpoint}/{name}"
        job(feed.stream(), CONFIG, path, cp).awaitTermination()
        before = sorted(map(str, reads[name](spark, path).collect()))
        commits = sorted(
            (f for f in os.listdir(f"{cp}/commits") if f.isdigit()), key=int
        )
        for suffix in (commits[-1], f".{commits[-1]}.crc"):
            os.remove(f"{cp}/commits/{suffix}")
        job(feed.stream(), CONFIG, path, cp).awaitTermination()
        assert sorted(map(str, reads[name](spark, path).collect())) == before


def test_new_titles_get_codes_batch_by_batch(spark, tmp_path):
    known = spark.sql("select * from values ('A', 'tt1') as c(title, code)")
    page = "&PU=/activity/1&TT="
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    feed.add(hit(3, "a", "0", "n", tail=f"{page}C"), hit(2, "a", tail=f"{page}B"))
    feed.add(hit(1, "b", tail=f"{page}0"), hit(4, "c", "0", tail=f"{page}C"), hit(4, "c", tail=f"{page}A"))
    query = streaming.stream_activity(feed.stream(), CONFIG, known, out, f"{tmp_path}/cp")
    query.awaitTermination()
    assert tuples(streaming.read_codes(spark, out), "title", "code") == [
        ("0", "tt4"), ("A", "tt1"), ("B", "tt2"), ("C", "tt3"),
    ]
    assert tuples(streaming.read_activity(spark, out), "code", "title", *M.METRICS) == [
        ("tt1", "A", 1, 1, 0, 0), ("tt2", "B", 1, 1, 0, 0),
        ("tt3", "C", 2, 2, 2, 1), ("tt4", "0", 1, 1, 0, 0),
    ]


def test_goods_state_takes_the_latest_event_not_the_last_batch(spark, tmp_path):
    def event(state):
        return f"&CLE=||show::goodsstore::7::{state}::pc||"

    dimension = spark.sql("select 'g' as goods_name, '7' as pcode, 'shop' as website_name")
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    feed.add(hit(1, "a", tail=event(0)), hit(9, "a", tail=event(2)))
    feed.add(hit(5, "a", tail=event(1)))
    query = streaming.stream_goods_state(feed.stream(), CONFIG, dimension, out, f"{tmp_path}/cp")
    query.awaitTermination()
    rows = streaming.read_goods_state(spark, out)
    assert tuples(rows, "website_name", "port", "pcode", "goods_name", "state") == [
        ("shop", "pc", "7", "g", 2)
    ]


def test_top_items_of_windows_over_batches(spark, tmp_path):
    path = f"{tmp_path}/in"
    for batch in (["10:00:05 x", "10:00:06 y"], ["10:00:30 y", "10:01:10 z"], ["10:00:07 y"]):
        rows = [(f"u {b.split()[1]} cat", f"2024-01-01 {b.split()[0]}") for b in batch]
        frame = spark.createDataFrame(rows, "line string, t string").coalesce(1)
        frame.select("line", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(path)
    stream = sources.stream_files(spark, path, sources.CLICK_SCHEMA, max_files=1)
    out = f"{tmp_path}/out"
    streaming.stream_topn_sliding(stream, out, f"{tmp_path}/cp").awaitTermination()
    rows = streaming.read_topn_sliding(spark, out, n=1)
    assert streaming.read_topn_sliding(spark, out, day="2024-01-02").count() == 0
    start = F.date_format("window_start", "HH:mm:ss").alias("start")
    assert tuples(rows.select(start, "item", "click_count"), "start", "item", "click_count") == [
        ("09:59:20", "y", 2), ("09:59:40", "y", 3), ("10:00:00", "y", 3), ("10:00:20", "y", 1),
        ("10:00:40", "z", 1), ("10:01:00", "z", 1),
    ]


def test_empty_input_writes_nothing_wrong(spark, tmp_path):
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    feed.add("not a hit")
    streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, f"{tmp_path}/cp").awaitTermination()
    assert streaming.read_pvuv_by_day(spark, out).count() == 0


@pytest.mark.parametrize("before, after", [(4, 3), (4, 6)])
def test_folding_goes_on_after_a_restart_with_another_count(spark, tmp_path, before, after):
    path = str(tmp_path / "folded")
    sinks.mark_folded(spark, path, -1)
    for i in range(13):
        sinks.write_batch(spark.range(i, i + 1), path, i)
        every = before if i < 7 else after
        for _ in range(2 if (i + 1) % every == 0 else 0):  # the second time as a replay
            sinks.fold_batches(spark, path, i, every, "id bigint", lambda rows: rows)
    found = sorted(r.id for r in sinks.read_folded(spark, path, "id bigint").collect())
    assert found == list(range(13))


ORDERED = "event_id bigint, arrival bigint, line string"


def moments(many, seed):
    """Hits of three days, mostly in order of time, some late, some early."""
    import random

    rng = random.Random(seed)
    for i in range(many):
        minute = min(179, max(0, i * 180 // many + rng.choice([0, 0, 0, 1, -3, -70, 2])))
        day, minute = divmod(minute, 60)
        yield hit(minute, f"c{rng.randrange(9)}", rng.choice("01"), rng.choice(["", "n1", "n2"]), f"{day + 1:02d}")


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_snapshots_in_the_stream_are_those_of_the_batch(spark, tmp_path, batches):
    lines = list(enumerate(moments(180, batches)))
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    size = -(-len(lines) // batches)

    def add(part):
        rows = [(i, i, text) for i, text in lines[part * size : (part + 1) * size]]
        spark.createDataFrame(rows, ORDERED).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = sources.stream_files(spark, folder, ORDERED, max_files=1)
        query = streaming.stream_site_snapshots(stream, CONFIG, out, f"{tmp_path}/cp")
        query.awaitTermination()

    for part in range(batches):
        add(part)
        if part % 3 == 0:  # the job starts anew from its checkpoint
            run()
    run()
    whole = spark.createDataFrame([(i, i, text) for i, text in lines], ORDERED)
    hits = main_site_hits(whole, CONFIG, "cuc", "rc", "un")
    columns = ("date", "ws", "minute", *M.METRICS)
    want = tuples(W.hwm_snapshot(hits, across_days=True), *columns)
    assert len(want) > 50 and tuples(streaming.read_hwm_snapshots(spark, out), *columns) == want


def test_what_a_snapshot_batch_reads_does_not_grow(spark, tmp_path):
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    for i in range(6):
        feed.add(*[hit(6 * i + k, f"c{i}x{k}") for k in range(5)])
    stream = feed.stream().withColumn("arrival", F.col("event_id"))
    query = streaming.stream_site_snapshots(stream, CONFIG, out, f"{tmp_path}/cp")
    query.awaitTermination()
    assert len({p["numInputRows"] for p in query.recentProgress if p["numInputRows"]}) == 1
    # the state that a batch reads is a row for the site, and keyed state is only looked up
    states = [spark.read.parquet(f"{out}/state/batch_id={i}").count() for i in range(6)]
    assert states == [1] * 6
    for i in range(6):
        assert spark.read.parquet(f"{out}/snapshots/batch_id={i}").count() == (4 if i == 0 else 5)


def test_a_snapshot_batch_reads_its_lines_once(spark, tmp_path):
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    for texts in BATCHES:
        feed.add(*texts)
    stream = feed.stream().withColumn("arrival", F.col("event_id"))
    query = streaming.stream_site_snapshots(stream, CONFIG, out, f"{tmp_path}/cp")
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 3, 3]


@pytest.mark.parametrize("tied", [False, True])
def test_staged_blocks_are_batches_of_as_many_files_in_order(spark, tmp_path, monkeypatch, tied):
    import os

    from footfall.streaming import staging

    monkeypatch.setattr(staging, "FILE_ROWS", 50)
    place = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")) if tied else F.col("id")
    rows = spark.range(2000, numPartitions=3).select((2000 - place).alias("n"), F.col("id").cast("string").alias("text"))
    folder = f"{tmp_path}/lines"
    files = staging.stage_in_order(rows, folder, "n")
    found = sorted((f for f in os.listdir(folder) if f.startswith("part-")), key=lambda f: os.stat(f"{folder}/{f}").st_mtime_ns)
    assert len(found) % files == 0 and (tied or (files > 4 and len(found) == 4 * files))
    last = -1
    for start in range(0, len(found), files):
        paths = [f"{folder}/{f}" for f in found[start : start + files]]
        low, high, many = spark.read.parquet(*paths).agg(F.min("n"), F.max("n"), F.count("*")).first()
        assert last < low and many >= files
        last = high
    assert tuples(spark.read.parquet(folder), "n", "text") == tuples(rows, "n", "text")


def test_replay_of_a_snapshot_batch_changes_nothing(spark, tmp_path):
    import os

    feed, out, cp = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"
    for texts in BATCHES:
        feed.add(*texts)

    def run():
        stream = feed.stream().withColumn("arrival", F.col("event_id"))
        streaming.stream_site_snapshots(stream, CONFIG, out, cp).awaitTermination()
        return sorted(map(str, streaming.read_hwm_snapshots(spark, out).collect()))

    before = run()
    last = max((f for f in os.listdir(f"{cp}/commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{cp}/commits/{name}")
    assert run() == before


def test_refit_of_a_day_takes_the_streams_place(spark, tmp_path):
    feed, out, cp = Feed(spark, tmp_path), f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        job = streaming.stream_pvuv_by_day(feed.stream(), CONFIG, out, cp, fold_every=2)
        job.awaitTermination()

    feed.add(hit(1, "a"), hit(2, "b", day="02"))
    feed.add(hit(3, "a", day="02"))
    feed.add(hit(4, "c"))
    run()
    during = streaming.read_pvuv_by_day(spark, out)
    day = spark.createDataFrame([(i, hit(i, f"m{i}")) for i in range(5)], SCHEMA)
    streaming.refit_pvuv_by_day(day, CONFIG, "2024-01-01", out)
    assert tuples(during, "date", "pv", "uv") == [("2024-01-01", 2, 2), ("2024-01-02", 2, 2)]
    after = [("2024-01-01", 5, 5), ("2024-01-02", 2, 2)]
    assert tuples(streaming.read_pvuv_by_day(spark, out), "date", "pv", "uv") == after
    for _ in range(3):  # later batches count on top, also when they are folded with earlier ones
        feed.add(hit(9, "late"), hit(9, "m1"), hit(9, "z", day="02"))
        run()
    rows = tuples(streaming.read_pvuv_by_day(spark, out), "date", "pv", "uv")
    assert rows == [("2024-01-01", 11, 6), ("2024-01-02", 5, 3)]
    streaming.refit_pvuv_by_day(day.limit(2), CONFIG, "2024-01-01", out)
    streaming.refit_pvuv_by_day(day.limit(0), CONFIG, "2024-01-02", out)
    assert tuples(streaming.read_pvuv_by_day(spark, out), "date", "pv", "uv") == [("2024-01-01", 2, 2)]


def test_a_batch_without_new_titles_writes_no_codes(spark, tmp_path):
    import os

    known = spark.sql("select * from values ('A', 'tt1') as c(title, code)")
    page = "&PU=/activity/1&TT="
    feed, out = Feed(spark, tmp_path), f"{tmp_path}/out"
    for title in "ABBAACB":
        feed.add(hit(3, "a", tail=page + title))
    streaming.stream_activity(feed.stream(), CONFIG, known, out, f"{tmp_path}/cp").awaitTermination()
    assert sorted(n for n in os.listdir(f"{out}/codes/_manifest") if n[0] == "v") == [
        "version=0", "version=2", "version=6",
    ]
    assert tuples(streaming.read_codes(spark, out), "title", "code") == [("A", "tt1"), ("B", "tt2"), ("C", "tt3")]
