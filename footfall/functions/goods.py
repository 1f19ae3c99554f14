"""Goods events inside a click payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a goods event is ||show::goodsstore::<code>::<state>::<port>||
GOODS_EVENT = r"\|\|show::goodsstore::([1-9]\d*)::(\d)::([a-z]+)\|\|"


def has_goods_event(payload: Column) -> Column:
    return F.rlike(payload, F.lit(GOODS_EVENT))


def goods_event_texts(payload: Column) -> Column:
    """Every event of the payload, in order, as text."""
    return F.regexp_extract_all(payload, F.lit(GOODS_EVENT), F.lit(0))


def _group(event: Column, number: int) -> Column:
    return F.regexp_extract(event, GOODS_EVENT, number)


def goods_event_fields(event: Column) -> list[Column]:
    return [
        _group(event, 3).alias("port"),
        _group(event, 1).alias("pcode"),
        _group(event, 2).cast("int").alias("state"),
    ]
