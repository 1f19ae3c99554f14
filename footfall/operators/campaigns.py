"""Campaign pages: lookup, metrics by code, and stable codes for new titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.config import TrafficConfig
from footfall.functions.parse import minute_number
from footfall.operators.filters import (
    activity_path,
    activity_word,
    main_site_hits,
    raw_activity,
)
from footfall.operators.joins import lookup_join
from footfall.operators.metrics import four_metrics
from footfall.operators.records import with_fields

CODE_PREFIX = "tt"


def activity_hits(lines: DataFrame, config: TrafficConfig, test: str = "path") -> DataFrame:
    """Main-site hits on campaign pages, with ``title`` and the metric fields.

    ``path``: the page URL has ``/activity/``. ``word``: it has ``activity``.
    ``raw``: the line has ``activity`` anywhere, and the URL is not looked at.
    """
    if test not in ("path", "word", "raw"):
        raise ValueError(f"unknown activity test {test!r}")
    if test == "raw":
        hits = main_site_hits(lines.filter(raw_activity(F.col("line"))), config)
    else:
        url_test = activity_path() if test == "path" else activity_word()
        hits = main_site_hits(lines, config).filter(url_test)
    return with_fields(hits, "title", "cuc", "rc", "un")


def campaign_lookup(hits: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Hits of registered titles, with their ``code``."""
    return lookup_join(hits, campaigns, ["title"], "inner")


def unregistered_titles(hits: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Titles without a code, by date. Distinct first, so the anti join is small."""
    return hits.select("date", "title").distinct().join(campaigns, "title", "left_anti")


def metrics_by_campaign(
    hits: DataFrame, campaigns: DataFrame, un_policy: str = "named"
) -> DataFrame:
    return four_metrics(campaign_lookup(hits, campaigns), ["date", "code"], un_policy)


def code_number(code: Column) -> Column:
    return F.try_to_number(F.substr(code, F.lit(len(CODE_PREFIX) + 1)), F.lit("9999999999")).cast(
        "bigint"
    )


def new_campaign_codes(
    hits: DataFrame, campaigns: DataFrame, start_code: int | None = None
) -> DataFrame:
    """``(title, code)`` for titles that have none, numbered by first appearance, then title.

    Numbers follow the highest existing one, and start at ``start_code`` at least. Titles
    are ranked within their first minute; minute counts are summed up within
    the day and day counts over the days, so no task ranks all titles.
    """
    by_date = hits.groupBy("title", "date").agg(
        F.min(minute_number(F.col("minute"))).alias("minute")
    )
    seen = F.min(F.struct("date", "minute")).alias("seen")
    new = by_date.groupBy("title").agg(seen).join(campaigns, "title", "left_anti")
    new = new.select("title", "seen.date", "seen.minute")

    def before(*by: str, order: str) -> Column:
        frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(frame), F.lit(0))

    minutes = new.groupBy("date", "minute").agg(F.count("*").alias("n"))
    days = minutes.groupBy("date").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    days = days.select("date", before("all", order="date").alias("days_before"))
    minutes = minutes.select("date", "minute", before("date", order="minute").alias("minutes_before"))
    rank = F.row_number().over(Window.partitionBy("date", "minute").orderBy("title"))
    given = F.coalesce(F.max(code_number(F.col("code"))), F.lit(0))
    highest = campaigns.agg(F.greatest(given, F.lit((start_code or 1) - 1))).scalar()
    ranked = (
        new.withColumn("rank", rank)
        .join(minutes, ["date", "minute"])
        .join(days, "date")
    )
    number = F.col("days_before") + F.col("minutes_before") + F.col("rank") + highest
    return ranked.select(
        "title", F.concat(F.lit(CODE_PREFIX), number.cast("string")).alias("code")
    )


def campaign_codes(
    hits: DataFrame, campaigns: DataFrame, start_code: int | None = None
) -> DataFrame:
    """The campaign dimension with the new titles added. Existing codes never change."""
    return campaigns.select("title", "code").unionByName(
        new_campaign_codes(hits, campaigns, start_code)
    )
