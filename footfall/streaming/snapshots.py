"""Snapshots in arrival order, written by the running stream when a hit passes the mark.

Two states go from batch to batch. The members seen so far are keyed state of the engine: each is looked up
by its key, so what a batch reads of it follows the batch. The mark of each site, and the totals of
the dates that can still get a snapshot, are a table of a few rows, written anew for each batch.
The triggers of a batch follow from that mark and the batch alone.

Arrival is the order of batches, and ``order`` within a batch. The first trigger of a site only sets
its mark. A hit of a date that the mark has left is in no snapshot any more. The keyed state
holds every member of every date; a new checkpoint, beside the state folder of the old one,
begins without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.config import TrafficConfig
from footfall.functions.parse import minute_number, minute_text
from footfall.operators.filters import main_site_hits
from footfall.operators.metrics import METRICS, NAME, VISITOR, contributions
from footfall.operators.running import arrival_order, arrival_triggers, at_next_trigger
from footfall.sinks import read_batches, write_batch
from footfall.streaming.jobs import start

FIRST, HIT = "first", "hit"


def _members(hits: DataFrame, kept: Sequence[str], un_policy: str) -> DataFrame:
    """``(kept, kind, member)``: a row for each member that a hit stands for, by one pass over the hits."""
    members = contributions(hits, kept, un_policy)
    first = F.when(F.col("is_rc") & (F.col("kind") == VISITOR), FIRST)
    rows = members.select(*kept, F.explode(F.array("kind", first)).alias("kind"), "member")
    return rows.where(F.col("kind").isNotNull())


def _rows(hits: DataFrame, dims: Sequence[str], order: Sequence[str], un_policy: str) -> DataFrame:
    """A row for each hit, and a ``new`` row for each member not seen before.

    Both come from the same shuffle of the few columns that count, with all of them, so that Spark reads and parses
    the lines once and uses that shuffle twice.
    """
    kept = [*dims, "minute", *order]
    views = hits.select(*kept, "cuc", "rc", "un").repartition(*order)
    new = _members(views, kept, un_policy).dropDuplicates([*dims, "kind", "member"])
    nothing = [F.lit(None).cast("string").alias(c) for c in ("kind", "member")]
    # columns of their own, else the union keeps an alias below the shuffle of one side, and Spark takes them for two
    named = [F.col(c).alias(c) for c in views.columns]
    views = views.select(*named, *nothing, F.lit(False).alias("new"))
    return views.unionByName(new.withColumn("new", F.lit(True)), allowMissingColumns=True)


def _state_schema(dims: Sequence[str]) -> str:
    totals = ", ".join(f"{m} bigint" for m in METRICS)
    return ", ".join([*(f"{d} string" for d in dims), "mark int", totals])


def stream_hwm_snapshots(
    hits: DataFrame,
    path: str,
    checkpoint: str,
    dims: Sequence[str] = ("date", "ws"),
    order: Sequence[str] = ("arrival", "event_id"),
    un_policy: str = "named",
    every: str | None = None,
) -> StreamingQuery:
    """Snapshots of ``hits`` for each ``dims`` group, by one mark through all dates of a site.

    ``date`` is one of ``dims``. A batch writes its snapshots and the state after it, in folders of its
    own; a replay replaces both, from the state of the batch before.
    """
    dims = list(dims)
    site = [d for d in dims if d != "date"]
    schema, keys = _state_schema(dims), [*dims, "kind", "member"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        kept = [batch]
        try:
            before = _read_state(spark, path, batch_id - 1, schema)
            views = batch.where(~F.col("new")).withColumn("_at", arrival_order(batch, order))
            seen = _members(views, [*dims, "_at"], un_policy).withColumn("new", F.lit(False))
            new = batch.where("new").select(*keys, F.lit(None).cast(views.schema["_at"].dataType).alias("_at"), "new")
            # a new member counts at its first arrival in this batch
            firsts = seen.unionByName(new).groupBy(*keys).agg(F.min("_at").alias("_at"), F.max("new").alias("new"))
            firsts = firsts.where("new").select(*dims, "kind", "_at")
            events = views.select(*dims, F.lit(HIT).alias("kind"), "_at").unionByName(firsts)

            marks = before.where("mark is not null").select(*site, F.col("date").alias("_date"), F.col("mark").alias("_mark"))
            triggers = arrival_triggers(views, dims, order, across_days=True)
            number = minute_number(F.col("minute"))
            later = triggers.join(marks, site, "left").where(
                F.col("_date").isNull()
                | (F.col("date") > F.col("_date"))
                | ((F.col("date") == F.col("_date")) & (number > F.col("_mark")))
            )
            # a row for each minute at most; its size is known when it is there, so that it can be a broadcast
            later = later.select(*triggers.columns).persist()
            kept.append(later)
            later.count()
            counted = at_next_trigger(events, later, dims, F.col("_at"), how="left")
            kind = F.col("kind")
            sums = counted.groupBy(*dims, "minute").agg(
                *[
                    F.count_if(kind == k).alias(m)
                    for m, k in zip(METRICS, (HIT, VISITOR, FIRST, NAME))
                ]
            )
            carried = before.select(*dims, F.lit("").alias("minute"), *METRICS)
            # the totals before come first, what follows the last trigger last
            place = F.coalesce("minute", F.lit("~"))
            so_far = Window.partitionBy(*dims).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
            running = carried.unionByName(sums).select(
                *dims, "minute", *[F.sum(m).over(so_far).alias(m) for m in METRICS]
            )
            running = running.persist()
            kept.append(running)
            first = later.join(marks.select(*site), site, "left_anti").groupBy(*site)
            first = first.agg(F.min(F.struct("date", "minute")).alias("_first"))
            first = first.select(*site, "_first.*")
            snapshots = running.where("minute is not null and minute != ''").join(
                first, [*dims, "minute"], "left_anti"
            )
            write_batch(snapshots, f"{path}/snapshots", batch_id)

            risen = later.groupBy(*site).agg(F.max(F.struct("date", "minute")).alias("_risen"))
            risen = risen.select(*site, F.col("_risen.date").alias("_date"), minute_number(F.col("_risen.minute")).alias("_mark"))
            now = marks.unionByName(risen).groupBy(*site).agg(F.max(F.struct("_date", "_mark")).alias("_now"))
            now = now.select(*site, F.col("_now._date").alias("_date"), F.col("_now._mark").alias("_mark"))
            totals = running.groupBy(*dims).agg(*[F.max(m).alias(m) for m in METRICS])
            # totals only grow, so the greatest is the last; dates behind the mark get no snapshot any more
            state = totals.join(now, site).where("date >= _date")
            state = state.select(*dims, F.when(F.col("date") == F.col("_date"), F.col("_mark")).alias("mark"), *METRICS)
            write_batch(state.coalesce(1), f"{path}/state", batch_id)
        finally:
            for rows in reversed(kept):
                rows.unpersist()

    return start(_rows(hits, dims, order, un_policy), write, checkpoint, every=every)


def _read_state(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    if batch_id < 0:
        nothing = spark.range(0)
        return nothing.select(F.from_json(F.lit("{}"), schema).alias("s")).select("s.*")
    return spark.read.schema(schema).parquet(f"{path}/state/batch_id={batch_id}")


def stream_site_snapshots(
    lines: DataFrame, config: TrafficConfig, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Snapshots of the main site."""
    return stream_hwm_snapshots(main_site_hits(lines, config, "cuc", "rc", "un"), path, checkpoint, **options)


def read_hwm_snapshots(spark: SparkSession, path: str, dims: Sequence[str] = ("date", "ws")) -> DataFrame:
    """All snapshots written so far."""
    schema = ", ".join([*(f"{d} string" for d in dims), "minute string", *(f"{m} bigint" for m in METRICS)])
    return read_batches(spark, f"{path}/snapshots", schema=schema).drop("batch_id")
