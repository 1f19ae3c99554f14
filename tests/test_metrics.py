import random

import pytest
from helpers import hits, tuples
from pyspark.sql import functions as F

from footfall.operators import metrics as M
from footfall.operators import running as W
from footfall.operators.joins import lookup_join

DIMS = ["date", "ws"]


def random_rows(seed, n=300, days=2, minutes=40, late=6):
    rng = random.Random(seed)
    rows = []
    for e in range(n):
        at = e * days * minutes // n
        minute = max(0, at % minutes - rng.randrange(late))
        rows.append(
            (
                e,
                e + rng.randrange(-4, 5),
                f"2024-01-0{1 + at // minutes}",
                f"10:{minute:02d}:00",
                rng.choice([None, *[f"c{i}" for i in range(25)]]),
                rng.choice([None, "0", "1"]),
                rng.choice([None, "NULL", *[f"n{i}" for i in range(9)]]),
            )
        )
    return rows


def four(rows, un_policy="named"):
    visitors = [r[4] or "CUC-NULL" for r in rows]
    names = [r[6] for r in rows]
    if un_policy == "named":
        names = [n for n in names if n not in (None, "NULL")]
    else:
        names = [n or "UN-NULL" for n in names]
    rc = {v for v, r in zip(visitors, rows) if r[5] == "0"}
    return len(rows), len(set(visitors)), len(rc), len(set(names))


@pytest.mark.parametrize("un_policy", ["named", "sentinel"])
def test_four_metrics_against_brute_force(spark, un_policy):
    rows = random_rows(1)
    got = tuples(M.four_metrics(hits(spark, rows), DIMS, un_policy), "date", *M.METRICS)
    want = [(d, *four([r for r in rows if r[2] == d], un_policy)) for d in sorted({r[2] for r in rows})]
    assert got == want


def test_unknown_policy_is_an_error(spark):
    with pytest.raises(ValueError):
        M.named_user("other")


def test_merged_partials_equal_the_whole(spark):
    df = hits(spark, random_rows(2))
    parts = None
    for i in range(3):
        part = M.partials(df.filter(F.col("event_id") % 3 == i), DIMS, minutes=True)
        parts = part if parts is None else parts.unionByName(part)
    merged = M.merge_partials(parts, DIMS)
    assert tuples(M.totals(merged, DIMS), *DIMS, *M.METRICS) == tuples(
        M.four_metrics(df, DIMS), *DIMS, *M.METRICS
    )
    assert tuples(W.running_from_partials(merged, DIMS), "date", "minute", *M.METRICS) == tuples(
        W.running_metrics(df, DIMS), "date", "minute", *M.METRICS
    )


def test_running_against_brute_force(spark):
    rows = random_rows(3)
    got = tuples(W.running_metrics(hits(spark, rows), DIMS), "date", "minute", *M.METRICS)
    want = [
        (d, m, *four([r for r in rows if r[2] == d and r[3] <= m]))
        for d, m in sorted({(r[2], r[3]) for r in rows})
    ]
    assert got == want


def test_properties(spark):
    df = hits(spark, random_rows(4))
    daily = {r[0]: r[1:] for r in tuples(M.four_metrics(df, DIMS), "date", *M.METRICS)}
    running = tuples(W.running_metrics(df, DIMS), "date", "minute", *M.METRICS)
    delta = tuples(W.delta_prev_snapshot(W.running_metrics(df, DIMS), DIMS), "date", *M.METRICS)
    for date, (pv, uv, rc, _) in daily.items():
        assert rc <= uv <= pv
        series = [r[2:] for r in running if r[0] == date]
        assert all(a <= b for x, y in zip(series, series[1:]) for a, b in zip(x, y))
        assert series[-1] == daily[date]
        sums = tuple(sum(r[i] for r in delta if r[0] == date) for i in range(1, 5))
        assert sums == daily[date]


def snapshots(rows, across_days):
    """Hit-by-hit simulation of the high-water mark."""
    out, seen, mark = [], {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        date, minute = r[2], r[3]
        seen.setdefault(date, []).append(r)
        scope = "all" if across_days else date
        if scope not in mark:
            mark[scope] = (date, minute)
        elif (date, minute) > mark[scope]:
            mark[scope] = (date, minute)
            out.append((date, minute, *four(seen[date])))
    return sorted(out)


@pytest.mark.parametrize("across_days", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_hwm_snapshot_against_simulation(spark, seed, across_days):
    rows = random_rows(seed, n=200, days=3, minutes=25, late=12)
    got = W.hwm_snapshot(hits(spark, rows), DIMS, across_days=across_days)
    assert tuples(got, "date", "minute", *M.METRICS) == snapshots(rows, across_days)


def test_hwm_snapshot_of_a_full_day(spark):
    rows = [
        (e, e, "2024-01-01", f"{e // 60:02d}:{e % 60:02d}:00", f"c{e % 7}", "0", None)
        for e in range(1440)
    ]
    got = W.hwm_snapshot(hits(spark, rows), DIMS)
    assert tuples(got, "date", "minute", *M.METRICS) == snapshots(rows, False)


def test_hwm_snapshot_of_3000_minutes(spark):
    """The search follows the number of triggers, whatever minutes are fed."""
    rows = [
        (e, e, "2024-01-01", f"{e // 60:02d}:{e % 60:02d}:00", f"c{e % 7}", "0", None)
        for e in range(3000)
    ]
    got = W.hwm_snapshot(hits(spark, rows), DIMS)
    assert tuples(got, "minute", "pv") == [(r[3], r[0] + 1) for r in rows[1:]]


def test_a_hit_is_joined_with_a_few_triggers_at_a_time(spark):
    """Of 1,200 triggers, a row holds the ends of the runs and one run, and finds the same trigger."""
    triggers = spark.range(1200).select(
        F.lit("d").alias("date"), F.format_string("%04d", "id").alias("minute"), (F.col("id") * 10).alias("first")
    )
    runs = W._trigger_runs(triggers, ["date"])
    assert runs.agg(F.max(F.size("triggers")), F.count("*")).first() == (W.RUN, -(-1200 // W.RUN))
    hits = spark.range(12000).select(F.lit("d").alias("date"), "id")
    found = W.at_next_trigger(hits, triggers, ["date"], F.col("id"), how="left")
    wrong = found.where(~F.col("minute").eqNullSafe(F.when(F.col("id") <= 11990, F.format_string("%04d", F.ceil(F.col("id") / 10)))))
    assert found.count() == 12000 and wrong.count() == 0


def test_hwm_snapshot_when_no_lookup_is_broadcast(spark):
    rows = random_rows(9, n=200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = tuples(W.hwm_snapshot(hits(spark, rows), DIMS), "date", "minute", *M.METRICS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == snapshots(rows, False)


def test_prev_minute_needs_exactly_one_minute(spark):
    minutes = ["09:58:00", "09:59:00", "10:00:00", "10:02:00", "11:02:00"]
    rows = [(i, i, "2024-01-01", m, f"c{i}", "0", "n") for i, m in enumerate(minutes)]
    rows.append((9, 9, "2024-01-02", "00:00:00", "c", "1", None))
    running = W.running_metrics(hits(spark, rows), DIMS)
    got = tuples(W.delta_prev_minute(running, DIMS), "date", "minute", "pv")
    assert [pv for _, _, pv in got] == [1, 1, 1, 4, 5, 1]
    assert [r[0] for r in tuples(W.prev_minute(running, DIMS).filter("prev_pv is null"), "minute")] == [
        "00:00:00", "09:58:00", "10:02:00", "11:02:00",
    ]


def test_lookup_join_refuses_other_joins(spark):
    with pytest.raises(ValueError):
        lookup_join(spark.range(1), spark.range(1), ["id"], "right")
