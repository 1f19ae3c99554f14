"""Stock state of goods, read from click payloads and named from product tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.goods import goods_event_fields, goods_event_texts
from footfall.operators.joins import lookup_join

STATE_KEYS = ("website_name", "port", "pcode", "goods_name")


def goods_events(hits: DataFrame) -> DataFrame:
    """One row for each goods event of a payload: ``port, pcode, state`` and its position."""
    parsed = ("line", "query", "segments", "keys", "cle", "ps", "page_url")
    kept = [c for c in hits.columns if c not in parsed]
    rows = hits.select(*kept, F.posexplode(goods_event_texts(F.col("cle"))).alias("pos", "event"))
    return rows.select(*kept, "pos", *goods_event_fields(F.col("event")))


def goods_dimension(goods: DataFrame, website: DataFrame) -> DataFrame:
    """Every product with the name of its website, NULL if the website is unknown."""
    return lookup_join(goods, website, ["website_cd"], "left").select(
        "goods_name", F.col("goods_business_cd").alias("pcode"), "website_name"
    )


def enrich_goods_state(events: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every event with product and website names, NULL when the product is unknown."""
    return lookup_join(events, dimension, ["pcode"], "left")


def event_version(events: DataFrame) -> Column:
    """The order of goods events: time, event, position, as one number where events are numbered.

    A number lets the aggregation be a hash aggregation; it has room for 10 digits of seconds of the wall
    clock, 19 of the event and 9 of the position. Other ids are compared in a struct.
    """
    if events.schema["event_id"].dataType.typeName() not in ("long", "integer"):
        return F.struct("time", "event_id", "pos")
    clock = F.try_to_timestamp(F.substring("time", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    second = F.greatest(F.coalesce(F.unix_timestamp(clock), F.lit(0)), F.lit(0))
    number = F.lit(0).cast("decimal(38,0)")
    for part, zeros in ((second, 28), (F.coalesce("event_id", F.lit(0)), 9), (F.col("pos"), 0)):
        power = F.lit("1" + "0" * zeros).cast("decimal(29,0)")
        number = (number + (part.cast("decimal(38,0)") * power).cast("decimal(38,0)")).cast("decimal(38,0)")
    return number


def latest_states(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last ``state`` of each key, with its ``version``."""
    versioned = events.withColumn("version", event_version(events))
    return versioned.groupBy(*keys).agg(
        F.max_by("state", "version").alias("state"), F.max("version").alias("version")
    )


def latest_goods_state(events: DataFrame) -> DataFrame:
    """The last state of each product and port on each date."""
    return latest_states(events, ("date", "port", "pcode")).drop("version")
