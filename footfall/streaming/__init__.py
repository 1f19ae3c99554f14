"""Streaming jobs. All read ``line`` columns and share the batch operators.

Exactly-once totals: the checkpoint fixes the content of each micro-batch, and
its output goes to a folder named after the batch, replaced on replay. What a
batch writes is associative and is merged when read, so late data always counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.config import TrafficConfig
from footfall.functions.parse import minute_text
from footfall.operators import campaigns as campaign_ops
from footfall.operators import goods as goods_ops
from footfall.operators.filters import goods_hits, main_site_hits, not_bot
from footfall.operators.metrics import (
    merge_partials,
    partials,
    partials_schema,
    totals,
    visitor,
)
from footfall.operators.records import REASONS, with_reason
from footfall.operators.running import running_from_partials
from footfall.operators.topn import click_keys, pane_counts, top_items, windows_of_panes
from footfall.sinks import (
    fold_batches,
    mark_folded,
    read_batches,
    read_folded,
    replace_day,
    write_batch,
)
from footfall.sinks.versions import KeyedTable, LogTable
from footfall.streaming.jobs import start
from footfall.streaming.snapshots import (  # noqa: F401
    read_hwm_snapshots,
    stream_hwm_snapshots,
    stream_site_snapshots,
)

SITE_DIMS = ("date", "ws")


# -- metrics, from partials ---------------------------------------------------


def stream_metrics(
    hits: DataFrame,
    dims: Sequence[str],
    path: str,
    checkpoint: str,
    un_policy: str = "named",
    minutes: bool = False,
    every: str | None = None,
    fold_every: int = 64,
) -> StreamingQuery:
    """The four metrics of any stream of ``hits`` for each ``dims`` group; ``date`` is one of them.

    A batch writes its partials: one row for each member it saw. Partials are associative, so
    no state is kept between batches and nothing is ever too late: an old hit counts under
    its own date, and a wrong future date is a group of its own that moves no mark. Readers merge
    them. Each ``fold_every`` batches are folded into one, at a cost in proportion to their rows.
    """
    dims = list(dims)
    schema = partials_schema(dims)
    mark_folded(hits.sparkSession, path, -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(partials(batch, dims, un_policy, minutes), path, batch_id, ["date"])
        if (batch_id + 1) % fold_every == 0:
            fold = lambda rows: merge_partials(rows, dims)
            fold_batches(batch.sparkSession, path, batch_id, fold_every, schema, fold, ["date"])

    return start(hits, write, checkpoint, every=every)


def read_partials(spark: SparkSession, path: str, dims: Sequence[str]) -> DataFrame:
    return merge_partials(read_folded(spark, path, partials_schema(dims)), dims)


def read_metrics(spark: SparkSession, path: str, dims: Sequence[str] = SITE_DIMS) -> DataFrame:
    """The four metrics over all hits so far; filter on ``date`` to read few folders."""
    return totals(read_partials(spark, path, dims), dims)


def read_running(spark: SparkSession, path: str, dims: Sequence[str] = SITE_DIMS) -> DataFrame:
    """Cumulative metrics by minute over all hits so far, of a stream with ``minutes``."""
    return running_from_partials(read_partials(spark, path, dims), dims)


def stream_pvuv_by_day(
    lines: DataFrame, config: TrafficConfig, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """The four metrics of the main site by day."""
    hits = main_site_hits(lines, config, "cuc", "rc", "un")
    return stream_metrics(hits, SITE_DIMS, path, checkpoint, **options)


def read_pvuv_by_day(spark: SparkSession, path: str) -> DataFrame:
    return read_metrics(spark, path)


def refit_metrics(
    hits: DataFrame,
    dims: Sequence[str],
    date: str,
    path: str,
    upto: int | None = None,
    un_policy: str = "named",
    minutes: bool = False,
) -> None:
    """Count ``date`` anew from ``hits``, in place of what the stream at ``path`` wrote for it.

    ``hits`` are those of the day in the batches up to ``upto`` (default: the last one written); what
    later batches bring for the day counts on top. Readers see the old count until the new one is complete.
    """
    rows = partials(hits.filter(F.col("date") == F.lit(date)), list(dims), un_policy, minutes)
    replace_day(rows, path, date, upto)


def refit_pvuv_by_day(lines: DataFrame, config: TrafficConfig, date: str, path: str, **options) -> None:
    """The four metrics of the main site for one day of ``lines``, in place of the stream's."""
    refit_metrics(main_site_hits(lines, config, "cuc", "rc", "un"), SITE_DIMS, date, path, **options)


def stream_snapshot(
    lines: DataFrame, config: TrafficConfig, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Cumulative metrics of the main site by minute.

    Late hits correct the later minutes of their day: what is read always equals
    the batch result over all hits so far.
    """
    hits = main_site_hits(lines, config, "cuc", "rc", "un")
    return stream_metrics(hits, SITE_DIMS, path, checkpoint, minutes=True, **options)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return read_running(spark, path)


UV_SCHEMA = "date string, ws string, cuc string"


def stream_uv(
    lines: DataFrame,
    config: TrafficConfig,
    path: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = 64,
) -> StreamingQuery:
    """Exact distinct visitors across batches; a batch writes the visitors it saw."""
    hits = main_site_hits(lines, config, "cuc").select(*SITE_DIMS, visitor().alias("cuc"))
    mark_folded(hits.sparkSession, path, -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.distinct(), path, batch_id, ["date"])
        if (batch_id + 1) % fold_every == 0:
            fold_batches(
                batch.sparkSession, path, batch_id, fold_every, UV_SCHEMA, DataFrame.distinct, ["date"]
            )

    return start(hits, write, checkpoint, every=every)


def read_uv(spark: SparkSession, path: str) -> DataFrame:
    rows = read_folded(spark, path, UV_SCHEMA)
    return rows.groupBy(*SITE_DIMS).agg(F.count_distinct("cuc").alias("uv"))


# -- campaigns ----------------------------------------------------------------


ACTIVITY_DIMS = ("date", "title")


def stream_activity(
    lines: DataFrame,
    config: TrafficConfig,
    campaigns: DataFrame,
    path: str,
    checkpoint: str,
    test: str = "word",
    un_policy: str = "named",
    every: str | None = None,
    fold_every: int = 64,
) -> StreamingQuery:
    """Campaign metrics; new titles get the next codes and are counted from their first hit.

    A batch writes its partials and the titles that are new in it; without new titles it writes no codes.
    """
    hits = campaign_ops.activity_hits(lines, config, test)
    parts, dims = f"{path}/partials", list(ACTIVITY_DIMS)
    schema = partials_schema(dims)
    mark_folded(hits.sparkSession, parts, -1)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(partials(batch, dims, un_policy), parts, batch_id, ["date"])
        folder = f"{parts}/batch_id={batch_id}"
        current = spark.read.option("basePath", folder).schema(schema).parquet(folder)
        codes = _codes(spark, path)
        if not codes.parts():
            codes.append(campaigns.select("title", "code"), 0)
        minute = minute_text(F.col("first_minute")).alias("minute")
        seen = current.select("title", "date", minute)
        codes.append(campaign_ops.new_campaign_codes(seen, codes.read()), batch_id + 1)
        if (batch_id + 1) % fold_every == 0:
            fold = lambda rows: merge_partials(rows, dims)
            fold_batches(spark, parts, batch_id, fold_every, schema, fold, ["date"])

    return start(hits, write, checkpoint, every=every)


def _codes(spark: SparkSession, path: str) -> LogTable:
    return LogTable(spark, f"{path}/codes", "title string, code string")


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """The campaign dimension so far."""
    return _codes(spark, path).read()


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """The campaign table: metrics, title, and the last minute with a hit."""
    members = read_partials(spark, f"{path}/partials", ACTIVITY_DIMS)
    last = members.groupBy(*ACTIVITY_DIMS).agg(F.max("last_minute").alias("last_minute"))
    rows = totals(members, ACTIVITY_DIMS).join(last, list(ACTIVITY_DIMS))
    rows = rows.withColumn("minute", minute_text(F.col("last_minute"))).drop("last_minute")
    return rows.join(read_codes(spark, path), "title")


# -- goods ------------------------------------------------------------------


NUMBERED = "decimal(38,0)"


def _goods(spark: SparkSession, path: str, version: str = NUMBERED, buckets: int = 16) -> KeyedTable:
    schema = f"website_name string, port string, pcode string, goods_name string, state int, version {version}"
    return KeyedTable(spark, path, schema, goods_ops.STATE_KEYS, buckets, order="version")


def stream_goods_state(
    lines: DataFrame,
    config: TrafficConfig,
    dimension: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    buckets: int = 16,
) -> StreamingQuery:
    """Goods states with their names, in a keyed table; a batch rewrites the buckets of its goods."""
    events = goods_ops.goods_events(goods_hits(lines, config))
    version = events.select(goods_ops.event_version(events).alias("v")).schema["v"].dataType.simpleString()

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = goods_ops.latest_states(batch, ("port", "pcode"))
        rows = goods_ops.enrich_goods_state(latest, dimension)
        by_name = rows.groupBy(*goods_ops.STATE_KEYS)
        rows = by_name.agg(F.max_by("state", "version").alias("state"), F.max("version").alias("version"))
        _goods(batch.sparkSession, path, version, buckets).merge(rows, batch_id)

    return start(events, write, checkpoint, every=every)


def read_goods_state(spark: SparkSession, path: str, version: str = NUMBERED) -> DataFrame:
    """The states so far; ``version`` is the type of their order where events are not numbered."""
    return _goods(spark, path, version).read()


# -- clicks -----------------------------------------------------------------


PANE_SCHEMA = "category string, item string, first bigint, last bigint, n bigint, day date"


def stream_topn_sliding(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    length: str = "60 seconds",
    slide: str = "20 seconds",
    every: str | None = None,
    fold_every: int = 64,
) -> StreamingQuery:
    """Item counts for sliding windows; a batch writes the counts of its own clicks, pane by pane.

    Counts add up, so a click is never too late and a batch reads no other. Readers make the windows.
    """
    mark_folded(lines.sparkSession, path, -1)
    day = F.to_date(F.timestamp_micros("last")).alias("day")

    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("category", "item", "first", "last", "day").agg(F.sum("n").alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = pane_counts(batch.filter(F.col("ts").isNotNull()), length, slide)
        write_batch(counts.select("*", day), path, batch_id, ["day"])
        if (batch_id + 1) % fold_every == 0:
            fold_batches(batch.sparkSession, path, batch_id, fold_every, PANE_SCHEMA, fold, ["day"])

    return start(click_keys(lines), write, checkpoint, every=every)


def read_topn_sliding(
    spark: SparkSession,
    path: str,
    n: int = 3,
    day: str | None = None,
    length: str = "60 seconds",
    slide: str = "20 seconds",
) -> DataFrame:
    """The top items of each window, or of the windows that begin on ``day``, over all clicks so far.

    ``length`` and ``slide`` are those of the stream. For a day, the folders from it to the end of its last window are read.
    """
    rows = read_folded(spark, path, PANE_SCHEMA)
    wanted = None if day is None else F.lit(day).cast("date")
    if wanted is not None:
        last = F.to_date(F.timestamp_add("day", F.lit(1), wanted.cast("timestamp")) + F.expr(f"interval {length}"))
        rows = rows.filter(F.col("day").between(wanted, last))
    panes = rows.groupBy("category", "item", "first", "last").agg(F.sum("n").alias("n"))
    counts = windows_of_panes(panes, length, slide)
    counts = counts if wanted is None else counts.filter(F.to_date("window_start") == wanted)
    return top_items(counts, n, ("window_start", "window_end"))


# -- audit ------------------------------------------------------------------


AUDIT = ("lines", "kept", "bot", *REASONS)


def stream_audit(
    lines: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """The rejected lines of a stream with their reasons, and how many lines each batch had, kept and rejected.

    The counts are observed while the rejects are written, so a batch is scanned once. Kept lines are not
    written; bots are counted before lines that cannot be parsed.
    """
    bot = F.when(not_bot(F.col("line")), F.lit(None)).otherwise("bot")
    marked = with_reason(lines).withColumn("reason", F.coalesce(bot, F.col("reason")))
    rejected = [F.count_if(F.col("reason") == name).alias(name) for name in AUDIT[2:]]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        kept = F.count_if(F.col("reason").isNull()).alias("kept")
        observed = batch.observe(seen, F.count(F.lit(1)).alias("lines"), kept, *rejected)
        write_batch(observed.filter(F.col("reason").isNotNull()), f"{path}/rejects", batch_id, ["reason"])
        counts = spark.range(1).select(*[F.lit(seen.get[name]).cast("bigint").alias(name) for name in AUDIT])
        write_batch(counts.coalesce(1), f"{path}/counts", batch_id)

    return start(marked, write, checkpoint, every=every)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id`` and the counts of each batch."""
    return read_batches(spark, f"{path}/counts", schema=", ".join(f"{name} bigint" for name in AUDIT))


def read_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rejected lines, of the stream's ``schema``, with ``reason`` and ``batch_id``."""
    return read_batches(spark, f"{path}/rejects", schema=f"{schema}, reason string")
