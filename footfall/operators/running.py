"""Cumulative metrics within the day, minute snapshots, and increments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.parse import minute_number, minute_text
from footfall.operators.joins import lookup_join
from footfall.operators.metrics import METRICS, MINUTE, NAME, VISITOR, page_views, partials
from footfall.session import shared_folder


def running_totals(
    by_minute: DataFrame, dims: Sequence[str], columns: Sequence[str] = METRICS
) -> DataFrame:
    """Cumulative ``columns`` over the minutes of a day, inclusive.

    The input has a row for each minute of a ``dims`` group, at most 1,440.
    """
    order = Window.partitionBy(*dims).orderBy("minute")
    frame = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(c).over(frame).alias(c) for c in columns]
    return by_minute.select(*dims, "minute", *sums)


def running_views(hits: DataFrame, dims: Sequence[str]) -> DataFrame:
    return running_totals(page_views(hits, [*dims, "minute"]), dims, ["pv"])


def _first_seen_by_minute(members: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Members counted in the minute they are first seen, at most 1,440 rows a day."""
    kind = F.col("kind")

    def entry(test: Column, minute: Column, pv=0, uv=0, rc=0, un=0) -> Column:
        counts = [
            (c if isinstance(c, Column) else F.lit(c)).cast("bigint").alias(name)
            for name, c in (("pv", pv), ("uv", uv), ("rc", rc), ("un", un))
        ]
        return F.when(test, F.struct(minute.alias("minute"), *counts))

    first_rc = F.col("first_rc_minute")
    entries = F.array_compact(
        F.array(
            entry(kind == MINUTE, F.col("first_minute"), pv=F.col("n")),
            entry(kind == VISITOR, F.col("first_minute"), uv=1),
            entry((kind == VISITOR) & first_rc.isNotNull(), first_rc, rc=1),
            entry(kind == NAME, F.col("first_minute"), un=1),
        )
    )
    by_number = (
        members.select(*dims, F.inline(entries))
        .groupBy(*dims, "minute")
        .agg(*[F.sum(m).alias(m) for m in METRICS])
    )
    return by_number.withColumn("minute", minute_text(F.col("minute")))


def running_from_partials(members: DataFrame, dims: Sequence[str]) -> DataFrame:
    return running_totals(_first_seen_by_minute(members, dims), dims)


def running_metrics(
    hits: DataFrame, dims: Sequence[str], un_policy: str = "named"
) -> DataFrame:
    """Cumulative pv, uv, rc, un at the end of each minute that has hits.

    A running distinct count is the running sum of first-seen members.
    """
    return running_from_partials(partials(hits, dims, un_policy, minutes=True), dims)


# -- arrival order ----------------------------------------------------------


def _triggers(
    hits: DataFrame, dims: Sequence[str], order: Column, across_days: bool
) -> DataFrame:
    """Minutes whose first arrival precedes that of every later minute."""
    firsts = hits.groupBy(*dims, "minute").agg(F.min(order).alias("first"))
    later = (
        Window.partitionBy(*dims)
        .orderBy(F.desc("minute"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = firsts.withColumn("next_first", F.min("first").over(later))
    found = found.filter(F.col("next_first").isNull() | (F.col("first") < F.col("next_first")))
    if across_days:
        site = [d for d in dims if d != "date"]
        later_days = (
            Window.partitionBy(*site)
            .orderBy(F.desc("date"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        days = firsts.groupBy(*dims).agg(F.min("first").alias("day_first"))
        days = days.select(*dims, F.min("day_first").over(later_days).alias("next_day_first"))
        found = found.join(days, list(dims)).filter(
            F.col("next_day_first").isNull() | (F.col("first") < F.col("next_day_first"))
        )
    return found.select(*dims, "minute", "first")


def _stored(rows: DataFrame) -> DataFrame:
    """Rows by way of a table in the shared folder.

    They must be complete before the hits can be assigned anyway, and a
    stored table has a known size, so the join after it can be a broadcast
    instead of a shuffle of all hits.
    """
    path = f"{shared_folder(rows.sparkSession, 'triggers')}/table"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _next_trigger(triggers: Column, order: Column) -> Column:
    """The first of the sorted triggers that is not before ``order``.

    Binary search, with as many halvings as the array's size takes.
    """

    def step(before: Column, power: Column) -> Column:
        probe = before + power
        trigger = F.get(triggers, probe - 1)
        return F.when(F.coalesce(trigger["first"] < order, F.lit(False)), probe).otherwise(before)

    halvings = F.floor(F.log2(F.size(triggers))).cast("int")
    powers = F.transform(
        F.sequence(halvings, F.lit(0), F.lit(-1)),
        lambda k: F.call_function("shiftleft", F.lit(1), k),
    )
    return F.get(triggers, F.aggregate(powers, F.lit(0), step))


def _arrival(rows: DataFrame, order: Sequence[str]) -> Column:
    """The order of arrival as one value.

    Two numbers of 19 digits are packed in a decimal, which hash aggregation can hold;
    other types are compared as a struct.
    """
    numbers = all(rows.schema[name].dataType.typeName() in ("long", "integer") for name in order)
    if len(order) == 2 and numbers:
        least = F.lit(-(1 << 63))
        high, low = (F.coalesce(name, least).cast("decimal(38,0)") for name in order)
        return (high * F.lit("1" + "0" * 19).cast("decimal(20,0)") + low).cast("decimal(38,0)")
    return F.struct(*order)


def arrival_order(rows: DataFrame, order: Sequence[str]) -> Column:
    """The order of arrival as one value, as triggers have it in ``first``."""
    return _arrival(rows, order)


def arrival_triggers(
    hits: DataFrame, dims: Sequence[str], order: Sequence[str], across_days: bool = False
) -> DataFrame:
    """``dims, minute, first``: the minutes that pass the mark, and the arrival that does."""
    return _triggers(hits, dims, _arrival(hits, order), across_days)


#: How many triggers a row is joined with at a time.
RUN = 32


def _trigger_runs(triggers: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``dims, run, last, triggers``: the triggers in arrays of ``RUN``, numbered from the first, with the last arrival of each."""
    place = F.row_number().over(Window.partitionBy(*dims).orderBy("first"))
    numbered = triggers.withColumn("run", F.floor((place - 1) / RUN).cast("int"))
    return numbered.groupBy(*dims, "run").agg(
        F.max("first").alias("last"), F.sort_array(F.collect_list(F.struct("first", "minute"))).alias("triggers")
    )


def _in_runs(hits: DataFrame, runs: DataFrame, dims: Sequence[str], order: Column, how: str) -> DataFrame:
    """``hits`` with the ``minute`` of the first trigger that is not before their ``order``, else NULL.

    A row goes through the joins with two short arrays, the ends of the runs and then one run, and never with
    all triggers of its group, which would be copied for each row.
    """
    ends = runs.groupBy(*dims).agg(
        F.sort_array(F.collect_list(F.struct(F.col("last").alias("first"), "run"))).alias("_ends")
    )
    # the search is interpreted, so the order is a column that it reads
    placed = lookup_join(hits.withColumn("_order", order), ends, dims, how)
    placed = placed.withColumn("run", _next_trigger(F.col("_ends"), F.col("_order"))["run"]).drop("_ends")
    found = lookup_join(placed, runs.drop("last"), [*dims, "run"], how)
    minute = _next_trigger(F.col("triggers"), F.col("_order"))["minute"]
    return found.withColumn("minute", minute).drop("triggers", "run", "_order")


def at_next_trigger(
    hits: DataFrame, triggers: DataFrame, dims: Sequence[str], order: Column, how: str = "inner"
) -> DataFrame:
    """Hits with the ``minute`` of the first trigger that does not come before their ``order``.

    Hits after the last trigger have NULL with ``how="left"``, and are left out otherwise.
    """
    return _in_runs(hits, _trigger_runs(triggers, dims), dims, order, how)


def hwm_snapshot(
    hits: DataFrame,
    dims: Sequence[str] = ("date", "ws"),
    order: Sequence[str] = ("arrival", "event_id"),
    un_policy: str = "named",
    across_days: bool = False,
    marks: DataFrame | None = None,
    mark_dims: Sequence[str] | None = None,
) -> DataFrame:
    """Snapshots in arrival order, one each time the minute passes the high-water mark.

    A hit that arrives late counts in the next snapshot of its day, and never
    emits one for its own old minute. The first trigger only sets the mark.
    With ``across_days`` one mark runs through all dates of a site; without,
    each date starts its own. The hits are read twice: to find the triggers,
    and to assign each hit to the next one.

    With ``mark_dims`` several ``dims`` groups share a mark, which the hits ``marks`` move
    (by default the same hits): each time it rises, every group seen so far gets a snapshot.
    """
    if mark_dims is not None:
        return _shared_snapshots(hits, dims, order, un_policy, hits if marks is None else marks, mark_dims)
    arrival = _arrival(hits, order)
    triggers = _triggers(hits, dims, arrival, across_days)
    runs = _stored(_trigger_runs(triggers, dims))
    counted = _in_runs(hits, runs, dims, arrival, "inner").filter(F.col("minute").isNotNull())
    snapshots = running_metrics(counted, dims, un_policy)
    if not across_days:
        earlier = Window.partitionBy(*dims).orderBy("minute")
        numbered = snapshots.withColumn("_n", F.row_number().over(earlier))
        return numbered.filter(F.col("_n") > 1).drop("_n")
    site = [d for d in dims if d != "date"]
    mark = triggers.groupBy(*site).agg(F.min(F.struct("date", "minute")).alias("_mark"))
    start = mark.select(*site, F.col("_mark.date").alias("date"), F.col("_mark.minute").alias("minute"))
    return snapshots.join(start, [*dims, "minute"], "left_anti")


def _shared_snapshots(
    hits: DataFrame,
    dims: Sequence[str],
    order: Sequence[str],
    un_policy: str,
    marks: DataFrame,
    mark_dims: Sequence[str],
) -> DataFrame:
    """A snapshot of each ``dims`` group whenever the mark of its ``mark_dims`` group rises."""
    triggers = _triggers(marks, mark_dims, _arrival(marks, order), False)
    runs = _stored(_trigger_runs(triggers, mark_dims))
    assigned = _in_runs(hits, runs, mark_dims, _arrival(hits, order), "inner")
    changed = running_metrics(assigned.filter(F.col("minute").isNotNull()), dims, un_policy)
    groups = changed.groupBy(*dims).agg(F.min(minute_number(F.col("minute"))).alias("_since"))
    groups = groups.withColumn("_since", minute_text(F.col("_since")))
    # all triggers but the first
    after = F.when(F.col("run") == 0, F.slice("triggers", 2, RUN)).otherwise(F.col("triggers"))
    rises = runs.select(*mark_dims, F.explode(after).alias("_rise"))
    rises = rises.select(*mark_dims, F.col("_rise.minute").alias("minute"))
    cells = groups.join(rises, list(mark_dims)).filter(F.col("minute") >= F.col("_since")).drop("_since")
    # the first trigger is no snapshot, but its counts go on into the next ones
    cells = cells.unionByName(groups.select(*dims, F.col("_since").alias("minute"))).distinct()
    so_far = Window.partitionBy(*dims).orderBy("minute")
    filled = cells.join(changed, [*dims, "minute"], "left")
    filled = filled.select(*dims, "minute", *[F.last(m, True).over(so_far).alias(m) for m in METRICS])
    return filled.join(rises, [*mark_dims, "minute"], "left_semi").select(*dims, "minute", *METRICS)


def emitted_minutes(snapshots: DataFrame) -> DataFrame:
    """How many snapshots each date has had."""
    return snapshots.groupBy("date").agg(F.count("*").alias("emitted"))


# -- increments -------------------------------------------------------------


def _minute_number(minute: Column) -> Column:
    """Minutes since midnight."""
    number = minute_number(minute)
    return F.floor(number / 100) * 60 + number % 100


def prev_minute(running: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Each row with the values of exactly one minute earlier, NULL if there is no such row.

    The row of one minute earlier can only be the preceding one of its day, so
    a window does it, without joining the table to itself.
    """
    order = Window.partitionBy(*dims).orderBy("minute")
    adjacent = F.lag(_minute_number(F.col("minute"))).over(order) == (
        _minute_number(F.col("minute")) - 1
    )
    previous = [F.when(adjacent, F.lag(m).over(order)).alias(f"prev_{m}") for m in METRICS]
    return running.select("*", *previous)


def delta_prev_minute(running: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Increment to exactly one minute earlier; the whole value if there is no such row."""
    rows = prev_minute(running, dims)
    deltas = [(F.col(m) - F.coalesce(F.col(f"prev_{m}"), F.lit(0))).alias(m) for m in METRICS]
    return rows.select(*dims, "minute", *deltas)


def delta_prev_snapshot(running: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Increment to the previous snapshot of the day, however old."""
    order = Window.partitionBy(*dims).orderBy("minute")
    deltas = [(F.col(m) - F.lag(m, 1, 0).over(order)).alias(m) for m in METRICS]
    return running.select(*dims, "minute", *deltas)
