"""One query for each operator, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. ``footfall.plans.oracle``
has the independent SQL text for the same key.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import fixtures, sinks, sources, streaming
from footfall.fixtures import FIXTURE_CONFIG as CONFIG
from footfall.functions import parse as P
from footfall.operators import campaigns as campaign_ops
from footfall.operators import filters as X
from footfall.operators import goods as goods_ops
from footfall.operators import metrics as M
from footfall.operators import records as R
from footfall.operators import running as W
from footfall.operators import topn as T
from footfall.operators import visitors
from footfall.session import shared_folder
from footfall.sources import landing
from footfall.streaming.staging import stage_in_order

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIMS = ("date", "ws")
SNAPSHOT_DAY = "2024-01-15"
CAMPAIGN_TITLE = "Big Sale 0"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- inputs -----------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.parse_records(fixtures.hits(spark, sf_dir))


def _page_hits(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    return X.main_site_hits(fixtures.hits(spark, sf_dir), CONFIG, *names)


def _metric_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_hits(spark, sf_dir, "cuc", "rc", "un")


def _activity_hits(spark: SparkSession, sf_dir: str, test: str = "path") -> DataFrame:
    return campaign_ops.activity_hits(fixtures.hits(spark, sf_dir), CONFIG, test)


def _goods_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_ops.goods_events(X.goods_hits(fixtures.hits(spark, sf_dir), CONFIG))


def _goods_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return goods_ops.goods_dimension(fixtures.goods(spark, sf_dir), fixtures.website(spark, sf_dir))


def _all_site_hits(lines: DataFrame) -> DataFrame:
    """Hits of every site with the older sentinels, for page views and visitors only."""
    rows = R.with_fields(R.parse_records(lines.filter(X.raw_tokens_absent(F.col("line")))), "ws", "cuc")
    old, nothing = R.OLD_FIELD_SENTINELS, F.lit(None).cast("string")
    return rows.select(
        F.replace("date", F.lit("-"), F.lit("")).alias("date"),
        F.coalesce("ws", F.lit(old["ws"])).alias("ws"),
        F.coalesce("cuc", F.lit(old["cuc"])).alias("cuc"),
        nothing.alias("rc"),
        nothing.alias("un"),
        "minute",
    )


def _running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.running_metrics(_metric_hits(spark, sf_dir), DIMS)


def _click_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.click_counts(T.click_keys(fixtures.clicks(spark, sf_dir)))


#: Folders of staged lines and the files of a micro-batch, by application and input.
_STAGED: dict[tuple[str, str], tuple[str, int]] = {}


def stage_lines(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The hits as files in order of arrival, written once for all streams of an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        folder = f"{shared_folder(spark, 'stream')}/lines"
        _STAGED[key] = folder, stage_in_order(fixtures.hits(spark, sf_dir), folder, "arrival")
    return _STAGED[key]


def _staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits as a stream of several micro-batches."""
    folder, files = stage_lines(spark, sf_dir)
    return sources.stream_files(spark, folder, "event_id bigint, arrival bigint, line string", files)


def _stream_metrics(spark: SparkSession, hits: DataFrame, dims: tuple[str, ...]) -> DataFrame:
    path = _run(lambda p, c: streaming.stream_metrics(hits, dims, p, c, fold_every=2), spark)
    return streaming.read_metrics(spark, path, dims)


def _run(start: Callable[[str, str], object], spark: SparkSession) -> str:
    """Run a stream over all available input; return its output folder."""
    base = shared_folder(spark, "out")
    start(f"{base}/data", f"{base}/checkpoint").awaitTermination()
    return f"{base}/data"


# -- sources ----------------------------------------------------------------


@query
def scan_hits_day(spark, sf_dir):
    root = shared_folder(spark, "days")
    lines = fixtures.hits(spark, sf_dir).select("line")
    for day in ("14", "15", "16"):
        of_day = lines.filter(F.contains("line", F.lit(f"|_|2024-01-{day}T")))
        of_day.write.text(f"{root}/2024/01/{day}/00/traffic")
    return sources.scan_hits_day(spark, root, "20240115")


@query
def stream_hits(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)

    def start(path, checkpoint):
        return streaming.start(lines, lambda b, i: sinks.write_batch(b, path, i), checkpoint)

    return sinks.read_batches(spark, _run(start, spark)).drop("batch_id")


@query
def stream_clicks(spark, sf_dir):
    folder = f"{shared_folder(spark, 'stream')}/clicks"
    files = stage_in_order(fixtures.clicks(spark, sf_dir), folder, "ts")
    lines = sources.stream_files(spark, folder, sources.CLICK_SCHEMA, files)

    def start(path, checkpoint):
        return streaming.start(
            T.click_keys(lines), lambda b, i: sinks.write_batch(b, path, i), checkpoint
        )

    rows = sinks.read_batches(spark, _run(start, spark))
    return rows.groupBy("category", "item").agg(F.count("*").alias("n"))


@query
def scan_dim_tables(spark, sf_dir):
    folder, by = shared_folder(spark, "warehouse"), ["website_cd"]
    sinks.store_table(fixtures.goods(spark, sf_dir), "footfall_goods", f"{folder}/goods", by, 8)
    sinks.store_table(fixtures.website(spark, sf_dir), "footfall_website", f"{folder}/website", by, 8)
    goods, website = sources.scan_dim_tables(spark, "footfall_goods", "footfall_website")
    return goods.join(website, "website_cd").select(
        "goods_name", "goods_business_cd", "website_cd", "website_name"
    )


def _landed(spark: SparkSession, sf_dir: str) -> str:
    path = f"{shared_folder(spark, 'landing')}/hits"
    landing.land_hits(fixtures.hits(spark, sf_dir), path)
    return path


@query
def land_hits(spark, sf_dir):
    rows = landing.landed(spark, _landed(spark, sf_dir))
    return rows.select("event_id", "date", "minute", "ws", "cuc", "page_url", "bot")


@query
def pvuv_by_day_landed(spark, sf_dir):
    """One day from the landing table: a partition, and of its files the row groups of the site."""
    hits = landing.landed_main_site_hits(spark, _landed(spark, sf_dir), CONFIG, [SNAPSHOT_DAY])
    return M.four_metrics(hits, DIMS)


@query
def scan_tab_pairs(spark, sf_dir):
    path = f"{shared_folder(spark, 'pairs')}/pairs"
    fixtures.pairs(spark, sf_dir).write.csv(path, sep="\t")
    return sources.scan_tab_pairs(spark, path)


@query
def scan_metric_snapshot(spark, sf_dir):
    path = f"{shared_folder(spark, 'metrics')}/metrics"
    sinks.write_by_date(sinks.metrics_to_long(pvuv_by_day(spark, sf_dir)), path)
    rows = sources.scan_metric_snapshot(spark, path, SNAPSHOT_DAY)
    return rows.select("kind", "date", "site", "value")


# -- sinks ------------------------------------------------------------------


@query
def sink_minute_snapshot(spark, sf_dir):
    path = f"{shared_folder(spark, 'snapshot')}/table"
    running = _running(spark, sf_dir)
    created = M.page_views(_page_hits(spark, sf_dir), [*DIMS, "minute"])
    zeros = [F.lit(0).cast("bigint").alias(m) for m in M.METRICS]
    sinks.upsert_table(spark, path, created.select(*DIMS, "minute", *zeros), sinks.SNAPSHOT_KEYS, 0)
    return sinks.upsert_table(spark, path, running, sinks.SNAPSHOT_KEYS, 1)


@query
def upsert_activity_metrics(spark, sf_dir):
    metrics = pvuv_by_activity(spark, sf_dir)
    stale = [F.lit(0).cast("bigint").alias(m) for m in M.METRICS]
    known = metrics.filter(F.col("code") == "tt1").select("date", "code", *stale)
    other = pvuv_by_day(spark, sf_dir).select("date", F.lit("tt0").alias("code"), *M.METRICS)
    path = f"{shared_folder(spark, 'activity')}/table"
    sinks.upsert_table(spark, path, known.unionByName(other), sinks.ACTIVITY_KEYS, 0)
    return sinks.upsert_table(spark, path, metrics, sinks.ACTIVITY_KEYS, 1)


@query
def goods_state_upsert(spark, sf_dir):
    events = _goods_events(spark, sf_dir)
    latest = goods_ops.latest_states(events, ("port", "pcode")).drop("version")
    enriched = goods_ops.enrich_goods_state(latest, _goods_dimension(spark, sf_dir))
    current = enriched.withColumn("state", F.lit(9))
    changes = enriched.filter(F.col("port") == "wap")
    path = f"{shared_folder(spark, 'goods')}/table"
    sinks.upsert_table(spark, path, current, goods_ops.STATE_KEYS, 0)
    return sinks.upsert_table(spark, path, changes, goods_ops.STATE_KEYS, 1)


@query
def export_daily_metrics(spark, sf_dir):
    return sinks.daily_export(sinks.metrics_to_long(pvuv_by_day(spark, sf_dir)))


@query
def sink_running_list(spark, sf_dir):
    return sinks.running_list(running_pv(spark, sf_dir))


@query
def sink_minute_metrics_batch(spark, sf_dir):
    path = f"{shared_folder(spark, 'minutes')}/table"
    rows = M.four_metrics(_metric_hits(spark, sf_dir), [*DIMS, "minute"])
    sinks.write_by_date(rows, path)
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))


@query
def sink_topn(spark, sf_dir):
    path = f"{shared_folder(spark, 'topn')}/table"
    sinks.write_batch(topn_per_category(spark, sf_dir), path, 0)
    return sinks.read_batches(spark, path).drop("batch_id")


@query
def emitted_minutes(spark, sf_dir):
    return W.emitted_minutes(hwm_snapshot(spark, sf_dir))


@query
def register_view(spark, sf_dir):
    sinks.register_view(pvuv_by_day(spark, sf_dir), "footfall_daily")
    return spark.sql("select date, pv, uv from footfall_daily where uv < pv")


# -- projections ------------------------------------------------------------


@query
def parse_records(spark, sf_dir):
    return _records(spark, sf_dir).select("event_id", "date", "minute", "query")


@query
def parse_params(spark, sf_dir):
    return R.params_text(_records(spark, sf_dir)).select("event_id", "params_text")


@query
def parse_params_blank(spark, sf_dir):
    return R.params_text(_records(spark, sf_dir), empty="").select("event_id", "params_text")


@query
def explode_params(spark, sf_dir):
    return R.explode_params(_records(spark, sf_dir)).select("event_id", "key", "value")


def _time_query(name: str, column) -> None:
    def run(spark, sf_dir):
        return _records(spark, sf_dir).select("event_id", column().alias(name))

    QUERIES[name] = run


_time_query("event_date", lambda: P.event_date(F.col("time")))
_time_query("event_date_compact", lambda: P.event_date_compact(F.col("time")))
_time_query("event_minute", lambda: P.event_minute(F.col("time")))
_time_query("event_minute_short", lambda: P.event_minute_short(F.col("time")))
_time_query("minute_epoch_ms", lambda: P.minute_epoch_ms(F.col("date"), F.col("minute")))


@query
def field_defaults(spark, sf_dir):
    names = list(P.FIELD_KEYS)
    rows = R.field_defaults(R.with_fields(_records(spark, sf_dir), *names), *names)
    return rows.select("event_id", *names)


@query
def url_decode_n(spark, sf_dir):
    rows = R.with_fields(_records(spark, sf_dir), "page_url", "title")
    return rows.select("event_id", "page_url", "title")


@query
def member_key(spark, sf_dir):
    rows = R.with_fields(_records(spark, sf_dir), "ws", "cuc", "un")
    rows = R.field_defaults(rows, "ws", "cuc", "un")
    return rows.select(
        "event_id", F.concat("ws", "cuc").alias("cuc_key"), F.concat("ws", "un").alias("un_key")
    )


@query
def site_label(spark, sf_dir):
    rows = R.with_fields(_records(spark, sf_dir), "ws")
    site = F.coalesce("ws", F.lit(R.OLD_FIELD_SENTINELS["ws"]))
    return rows.select("event_id", site.alias("site"), F.lit("main").alias("label"))


@query
def goods_events(spark, sf_dir):
    rows = _goods_events(spark, sf_dir)
    return rows.select("event_id", "date", "minute", "pos", "port", "pcode", "state")


@query
def click_key(spark, sf_dir):
    return T.click_keys(fixtures.clicks(spark, sf_dir)).select("line", "category", "item")


@query
def pair_key(spark, sf_dir):
    return T.pair_keys(fixtures.pairs(spark, sf_dir))


@query
def metric_key_parse(spark, sf_dir):
    rows = sinks.metrics_to_long(pvuv_by_day(spark, sf_dir))
    keyed = rows.select(F.concat_ws(":", "kind", "date", "site").alias("key"), "value")
    return sinks.metric_key_parts(keyed).select("kind", "date", "site", "value")


# -- filters ----------------------------------------------------------------


def _line_filter(name: str, test) -> None:
    def run(spark, sf_dir):
        return fixtures.hits(spark, sf_dir).filter(test(F.col("line"))).select("event_id")

    QUERIES[name] = run


def _record_filter(name: str, fields: tuple[str, ...], test) -> None:
    def run(spark, sf_dir):
        rows = R.with_fields(_records(spark, sf_dir), *fields)
        return rows.filter(test()).select("event_id")

    QUERIES[name] = run


_line_filter("filter_bots", X.not_bot)
_line_filter("filter_main_site_raw", lambda c: X.raw_main_site(c, CONFIG.main_site))
_line_filter("filter_raw_tokens", X.raw_tokens_absent)
_line_filter("filter_activity_raw", X.raw_activity)
_record_filter("filter_shop_flow", ("ps", "page_url"), lambda: X.shop_flow(CONFIG.malls))
_record_filter("filter_main_site", ("ws",), lambda: X.main_site(CONFIG.main_site))
_record_filter("filter_site_list", ("ws",), lambda: X.site_list(CONFIG.site_list))
_record_filter("filter_no_click_event", ("cle",), X.no_click_event)
_record_filter("filter_activity_path", ("page_url",), X.activity_path)
_record_filter("filter_activity_word", ("page_url",), X.activity_word)
_record_filter("filter_campaign_title", ("title",), lambda: X.campaign_title(CAMPAIGN_TITLE))
_record_filter("filter_goods_event", ("cle",), X.goods_event)


@query
def classify_mall(spark, sf_dir):
    rows = R.with_fields(_records(spark, sf_dir), "ps", "page_url")
    return X.classify_mall(rows, CONFIG.malls).select("event_id", "mall")


@query
def rejects(spark, sf_dir):
    return R.rejects(fixtures.hits(spark, sf_dir)).select("event_id", "line", "reason")


# -- joins ------------------------------------------------------------------


@query
def goods_dim_left_join(spark, sf_dir):
    return _goods_dimension(spark, sf_dir)


@query
def goods_state_enriched(spark, sf_dir):
    rows = goods_ops.enrich_goods_state(_goods_events(spark, sf_dir), _goods_dimension(spark, sf_dir))
    return rows.select("event_id", "pos", "port", "pcode", "state", "goods_name", "website_name")


@query
def campaign_lookup(spark, sf_dir):
    rows = campaign_ops.campaign_lookup(_activity_hits(spark, sf_dir), fixtures.campaigns(spark))
    return rows.select("event_id", "title", "code")


@query
def unregistered_titles(spark, sf_dir):
    rows = campaign_ops.unregistered_titles(
        _activity_hits(spark, sf_dir), fixtures.campaigns(spark)
    )
    return rows.select("date", "title")


@query
def subsite_lookup(spark, sf_dir):
    rows = _page_hits(spark, sf_dir, "sws").filter(F.col("sws").isin(*CONFIG.sub_sites))
    return rows.select("event_id", "sws")


@query
def prev_minute_join(spark, sf_dir):
    return W.prev_minute(_running(spark, sf_dir), DIMS)


# -- aggregations -----------------------------------------------------------


@query
def pv_by_day(spark, sf_dir):
    return M.page_views(_page_hits(spark, sf_dir), DIMS)


@query
def uv_by_day(spark, sf_dir):
    return M.unique_visitors(_page_hits(spark, sf_dir, "cuc"), DIMS)


@query
def uv_rollup(spark, sf_dir):
    """Visitors by day and site, day, site and in all, from stored sets that two batches have filled."""
    hits = X.site_list_hits(fixtures.hits(spark, sf_dir), CONFIG, "cuc")
    sets = visitors.VisitorSets(spark, f"{shared_folder(spark, 'sets')}/visitors")
    for version in (0, 1):
        sets.add(hits.filter(F.col("event_id") % 2 == version), version)
    levels = (("date", "ws"), ("date",), ("ws",), ())
    found = [
        sets.count(*dims).select(
            F.lit("-".join(dims) or "all").alias("level"),
            *[(F.col(d) if d in dims else F.lit("")).alias(d) for d in DIMS],
            "uv",
        )
        for dims in levels
    ]
    return reduce(DataFrame.unionByName, found)


@query
def rc_by_day(spark, sf_dir):
    return M.first_visitors(_page_hits(spark, sf_dir, "cuc", "rc"), DIMS)


@query
def un_by_day(spark, sf_dir):
    return M.named_users(_page_hits(spark, sf_dir, "un"), DIMS)


@query
def un_by_day_sentinel(spark, sf_dir):
    return M.named_users(_page_hits(spark, sf_dir, "un"), DIMS, "sentinel")


@query
def un_by_day_blank(spark, sf_dir):
    return M.named_users(_page_hits(spark, sf_dir, "un"), DIMS, "blank")


@query
def un_by_day_one(spark, sf_dir):
    return M.named_users(_page_hits(spark, sf_dir, "un"), DIMS, "one")


@query
def pvuv_by_day(spark, sf_dir):
    return M.four_metrics(_metric_hits(spark, sf_dir), DIMS)


@query
def pvuv_by_day_raw(spark, sf_dir):
    hits = X.raw_main_site_hits(fixtures.hits(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return M.four_metrics(hits, DIMS)


@query
def pv_uv_by_day(spark, sf_dir):
    return M.views_and_visitors(_page_hits(spark, sf_dir, "cuc"), DIMS)


@query
def pv_uv_all_sites(spark, sf_dir):
    rows = _all_site_hits(fixtures.hits(spark, sf_dir))
    return M.views_and_visitors(rows, DIMS, F.col("cuc"))


@query
def pvuv_by_minute(spark, sf_dir):
    return M.views_and_visitors(_page_hits(spark, sf_dir, "cuc"), ["date", "minute"])


@query
def rc_un_by_minute(spark, sf_dir):
    rows = M.four_metrics(_metric_hits(spark, sf_dir), ["date", "minute"])
    return rows.select("date", "minute", "rc", "un")


@query
def pvuv_by_subsite(spark, sf_dir):
    hits = _page_hits(spark, sf_dir, "sws", "cuc", "rc", "un")
    return M.four_metrics(hits.filter(F.col("sws").isin(*CONFIG.sub_sites)), ["date", "sws"])


@query
def pvuv_by_site_list(spark, sf_dir):
    hits = X.site_list_hits(fixtures.hits(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return M.four_metrics(hits, DIMS)


@query
def pvuv_by_activity(spark, sf_dir):
    return campaign_ops.metrics_by_campaign(
        _activity_hits(spark, sf_dir), fixtures.campaigns(spark)
    )


@query
def pvuv_by_activity_raw(spark, sf_dir):
    return campaign_ops.metrics_by_campaign(
        _activity_hits(spark, sf_dir, "raw"), fixtures.campaigns(spark)
    )


@query
def minute_pv(spark, sf_dir):
    return M.page_views(_page_hits(spark, sf_dir), ["date", "minute"])


def _title_hits(spark, sf_dir):
    return _activity_hits(spark, sf_dir).filter(X.campaign_title(CAMPAIGN_TITLE))


@query
def activity_minute_pv(spark, sf_dir):
    return M.page_views(_title_hits(spark, sf_dir), ["date", "minute"])


@query
def goods_state_latest(spark, sf_dir):
    return goods_ops.latest_goods_state(_goods_events(spark, sf_dir))


@query
def pair_counts(spark, sf_dir):
    return T.pair_counts(fixtures.pairs(spark, sf_dir))


@query
def pair_first(spark, sf_dir):
    return T.pair_first(fixtures.pairs(spark, sf_dir))


@query
def hit_count(spark, sf_dir):
    return _page_hits(spark, sf_dir).agg(F.count("*").alias("n"))


# -- windows ----------------------------------------------------------------


@query
def running_pv(spark, sf_dir):
    return W.running_views(_page_hits(spark, sf_dir), DIMS)


@query
def running_pvuv(spark, sf_dir):
    return _running(spark, sf_dir)


@query
def running_activity_pv(spark, sf_dir):
    return W.running_views(_title_hits(spark, sf_dir), ["date"])


@query
def running_site_list_metrics(spark, sf_dir):
    hits = X.site_list_hits(fixtures.hits(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return W.running_metrics(hits, DIMS)


@query
def running_activity_metrics(spark, sf_dir):
    hits = campaign_ops.campaign_lookup(_activity_hits(spark, sf_dir), fixtures.campaigns(spark))
    return W.running_metrics(hits, ["date", "code"])


@query
def delta_hwm_snapshot(spark, sf_dir):
    snapshots = W.hwm_snapshot(_metric_hits(spark, sf_dir), DIMS)
    return W.delta_prev_snapshot(snapshots, DIMS)


@query
def hwm_snapshot(spark, sf_dir):
    return W.hwm_snapshot(_metric_hits(spark, sf_dir), DIMS)


@query
def hwm_snapshot_site_list(spark, sf_dir):
    """A rise on any listed site is a snapshot of all of them."""
    hits = X.site_list_hits(fixtures.hits(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return W.hwm_snapshot(hits, DIMS, mark_dims=["date"])


@query
def hwm_snapshot_activity(spark, sf_dir):
    """A rise of the main site is a snapshot of all campaigns."""
    hits = campaign_ops.campaign_lookup(_activity_hits(spark, sf_dir), fixtures.campaigns(spark))
    marks = _page_hits(spark, sf_dir)
    return W.hwm_snapshot(hits, ["date", "code"], marks=marks, mark_dims=["date"])


@query
def hwm_snapshot_across_days(spark, sf_dir):
    return W.hwm_snapshot(_metric_hits(spark, sf_dir), DIMS, across_days=True)


@query
def delta_prev_minute(spark, sf_dir):
    return W.delta_prev_minute(_running(spark, sf_dir), DIMS)


@query
def delta_prev_snapshot(spark, sf_dir):
    return W.delta_prev_snapshot(_running(spark, sf_dir), DIMS)


@query
def topn_per_category(spark, sf_dir):
    rows = T.top_items(_click_counts(spark, sf_dir))
    return rows.select("category", "item", "click_count")


@query
def campaign_codes(spark, sf_dir):
    return campaign_ops.campaign_codes(
        _activity_hits(spark, sf_dir, "word"), fixtures.campaigns(spark)
    )


@query
def sort_minutes(spark, sf_dir):
    return running_pv(spark, sf_dir).orderBy("date", "minute")


# -- streaming --------------------------------------------------------------


@query
def stream_pvuv_by_day(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)
    path = _run(lambda p, c: streaming.stream_pvuv_by_day(lines, CONFIG, p, c), spark)
    return streaming.read_pvuv_by_day(spark, path)


@query
def stream_uv(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)
    path = _run(lambda p, c: streaming.stream_uv(lines, CONFIG, p, c), spark)
    return streaming.read_uv(spark, path)


@query
def stream_snapshot(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)
    path = _run(lambda p, c: streaming.stream_snapshot(lines, CONFIG, p, c), spark)
    return streaming.read_snapshot(spark, path)


@query
def stream_audit(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)
    return streaming.read_audit(spark, _run(lambda p, c: streaming.stream_audit(lines, p, c), spark))


@query
def stream_hwm_snapshot(spark, sf_dir):
    lines = _staged_lines(spark, sf_dir)
    path = _run(lambda p, c: streaming.stream_site_snapshots(lines, CONFIG, p, c), spark)
    return streaming.read_hwm_snapshots(spark, path)


@query
def refit_day(spark, sf_dir):
    """A stream that lost a third of a day's lines, and the day counted anew from its files."""
    of_day = F.contains("line", F.lit(f"|_|{SNAPSHOT_DAY}T"))
    lines = _staged_lines(spark, sf_dir).filter(~of_day | (F.col("event_id") % 3 != 0))
    path = _run(lambda p, c: streaming.stream_pvuv_by_day(lines, CONFIG, p, c, fold_every=2), spark)
    streaming.refit_pvuv_by_day(fixtures.hits(spark, sf_dir).filter(of_day), CONFIG, SNAPSHOT_DAY, path)
    return streaming.read_pvuv_by_day(spark, path)


@query
def stream_activity(spark, sf_dir):
    lines, known = _staged_lines(spark, sf_dir), fixtures.campaigns(spark)
    path = _run(lambda p, c: streaming.stream_activity(lines, CONFIG, known, p, c), spark)
    return streaming.read_activity(spark, path)


@query
def stream_pvuv_by_minute(spark, sf_dir):
    hits = X.main_site_hits(_staged_lines(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return _stream_metrics(spark, hits, ("date", "minute", "ws"))


@query
def stream_pvuv_by_subsite(spark, sf_dir):
    hits = X.main_site_hits(_staged_lines(spark, sf_dir), CONFIG, "sws", "cuc", "rc", "un")
    return _stream_metrics(spark, hits.filter(F.col("sws").isin(*CONFIG.sub_sites)), ("date", "sws"))


@query
def stream_pvuv_by_site_list(spark, sf_dir):
    hits = X.site_list_hits(_staged_lines(spark, sf_dir), CONFIG, "cuc", "rc", "un")
    return _stream_metrics(spark, hits, DIMS)


@query
def stream_pv_uv_all_sites(spark, sf_dir):
    rows = _stream_metrics(spark, _all_site_hits(_staged_lines(spark, sf_dir)), DIMS)
    return rows.select("date", "ws", "pv", "uv")


@query
def stream_pvuv_late(spark, sf_dir):
    """A feed with lines of a far future and of long ago among the others, in each batch."""
    day = F.when(F.col("event_id") % 97 == 0, "2099-12-31").when(F.col("event_id") % 89 == 0, "2023-12-25")
    moved = F.regexp_replace("line", F.lit(r"\|_\|[0-9-]{10}T"), F.concat(F.lit("|_|"), day, F.lit("T")))
    lines = _staged_lines(spark, sf_dir).withColumn("line", F.coalesce(moved, F.col("line")))
    path = _run(lambda p, c: streaming.stream_pvuv_by_day(lines, CONFIG, p, c, fold_every=3), spark)
    return streaming.read_pvuv_by_day(spark, path)


@query
def stream_goods_state(spark, sf_dir):
    lines, dimension = _staged_lines(spark, sf_dir), _goods_dimension(spark, sf_dir)
    path = _run(lambda p, c: streaming.stream_goods_state(lines, CONFIG, dimension, p, c), spark)
    return streaming.read_goods_state(spark, path).drop("version")


@query
def sliding_click_counts(spark, sf_dir):
    clicks = T.click_keys(fixtures.clicks(spark, sf_dir))
    rows = T.sliding_click_counts(clicks, "1 day", "8 hours")
    return rows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
        "category",
        "item",
        "click_count",
    )


@query
def stream_topn_sliding(spark, sf_dir):
    folder = f"{shared_folder(spark, 'stream')}/clicks"
    files = stage_in_order(fixtures.clicks(spark, sf_dir), folder, "ts")
    lines = sources.stream_files(spark, folder, sources.CLICK_SCHEMA, files)
    path = _run(lambda p, c: streaming.stream_topn_sliding(lines, p, c, "1 day", "8 hours"), spark)
    rows = streaming.read_topn_sliding(spark, path, length="1 day", slide="8 hours")
    return rows.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
        "category",
        "item",
        "click_count",
    )
