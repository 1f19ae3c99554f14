"""Click counts and the top items of each category, and plain pair counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def click_keys(lines: DataFrame) -> DataFrame:
    """``user item category`` lines as ``category`` and ``item`` columns."""
    parts = F.split(F.col("line"), " ")
    return lines.select(
        "*",
        F.get(parts, F.lit(2)).alias("category"),
        F.get(parts, F.lit(1)).alias("item"),
    ).filter(F.col("category").isNotNull())


def click_counts(clicks: DataFrame, *dims: str) -> DataFrame:
    return clicks.groupBy(*dims, "category", "item").agg(F.count("*").alias("click_count"))


def _micros(duration: str) -> Column:
    """A duration such as ``60 seconds`` in microseconds; a constant in the plan."""
    return F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {duration}"))


def pane_counts(
    clicks: DataFrame, length: str = "60 seconds", slide: str = "20 seconds", *dims: str
) -> DataFrame:
    """Counts of the clicks that lie in the same windows: those that start from ``first`` to ``last``.

    Windows start at multiples of ``slide``, in microseconds. A click stays one row, however many windows
    it lies in; counts of several batches add up.
    """
    at, width, step = F.unix_micros("ts"), _micros(length), _micros(slide)
    rows = clicks.select(
        *dims,
        "category",
        "item",
        (at - width - F.pmod(at - width, step) + step).alias("first"),
        (at - F.pmod(at, step)).alias("last"),
    )
    return rows.groupBy(*dims, "category", "item", "first", "last").agg(F.count("*").alias("n"))


def windows_of_panes(panes: DataFrame, length: str = "60 seconds", slide: str = "20 seconds") -> DataFrame:
    """Counts in sliding windows from the counts of panes: a pane is added where it enters, taken off where it leaves."""
    width, step = _micros(length), _micros(slide)
    edges = F.array(
        F.struct(F.col("first").alias("at"), F.col("n").alias("change")),
        F.struct((F.col("last") + step).alias("at"), (-F.col("n")).alias("change")),
    )
    changes = panes.select("category", "item", F.inline(edges))
    changes = changes.groupBy("category", "item", "at").agg(F.sum("change").alias("change"))
    order = Window.partitionBy("category", "item").orderBy("at")
    held = changes.select(
        "category",
        "item",
        "at",
        F.lead("at").over(order).alias("until"),
        F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("click_count"),
    ).filter(F.col("click_count") > 0)
    starts = held.select(
        "category", "item", "click_count", F.explode(F.sequence(F.col("at"), F.col("until") - step, step)).alias("at")
    )
    return starts.select(
        F.timestamp_micros("at").alias("window_start"),
        F.timestamp_micros(F.col("at") + width).alias("window_end"),
        "category",
        "item",
        "click_count",
    )


def sliding_click_counts(
    clicks: DataFrame, length: str = "60 seconds", slide: str = "20 seconds"
) -> DataFrame:
    """Counts for each item in windows of event time, pane by pane; clicks without a time are in no window."""
    clicks = clicks.filter(F.col("ts").isNotNull())
    return windows_of_panes(pane_counts(clicks, length, slide), length, slide)


def top_items(counts: DataFrame, n: int = 3, within: Sequence[str] = ()) -> DataFrame:
    """The ``n`` most clicked items of each category; ties go by item name.

    The rank filter is planned as a group limit, so each task sends at most
    ``n`` rows of a category through the shuffle.
    """
    best = Window.partitionBy(*within, "category").orderBy(F.desc("click_count"), "item")
    ranked = counts.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= n)


def pair_keys(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("pair", F.concat("name", "second_name"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    return pair_keys(pairs).groupBy("pair").agg(F.count("*").alias("n"))


def pair_first(pairs: DataFrame) -> DataFrame:
    """One row for each key; the smallest, so the choice is the same every time.

    The names of a key are all beginnings of it, so the smallest is the shortest.
    """
    first = pair_keys(pairs).groupBy("pair").agg(F.min(F.length("name")).alias("n"))
    first = first.filter(F.col("pair").isNotNull())
    name = F.substr("pair", F.lit(1), F.col("n"))
    return first.select("pair", name.alias("name"), F.substr("pair", F.col("n") + 1).alias("second_name"))
