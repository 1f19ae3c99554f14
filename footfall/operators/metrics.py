"""Page views (pv), visitors (uv), first-visit visitors (rc), named users (un).

All four are exact. A hit contributes one row for each member it stands for
(its visitor, its login name, its minute). Grouping those rows by member gives
*partials*: associative, so batches merge by sum and min, and skew-safe, since
a hot site or visitor collapses in the map-side combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.parse import EMPTY_VALUE, minute_number
from footfall.operators.records import FIELD_SENTINELS, with_default

VISITOR, NAME, MINUTE = "visitor", "name", "minute"
METRICS = ("pv", "uv", "rc", "un")


def visitor() -> Column:
    """The visitor cookie; hits without one share the sentinel visitor."""
    return with_default(F.col("cuc"), "cuc")


def named_user(un_policy: str = "named") -> Column:
    """The login name that counts, else NULL.

    ``named`` leaves out absent and empty names. ``sentinel`` counts both
    sentinels as people, ``blank`` absent and empty names together as one person, and ``one``
    absent names as the person ``1``, empty ones as another.
    """
    if un_policy == "named":
        return F.nullif(F.col("un"), F.lit(EMPTY_VALUE))
    if un_policy == "blank":
        return F.coalesce(F.nullif(F.col("un"), F.lit(EMPTY_VALUE)), F.lit(""))
    if un_policy == "one":
        return F.coalesce("un", F.lit("1"))
    if un_policy == "sentinel":
        return F.coalesce(F.col("un"), F.lit(FIELD_SENTINELS["un"]))
    raise ValueError(f"unknown un_policy {un_policy!r}")


def contributions(
    hits: DataFrame, dims: Sequence[str], un_policy: str = "named", minutes: bool = False
) -> DataFrame:
    """``(dims, minute, is_rc, kind, member)``: up to three rows for a hit."""
    members = [
        F.struct(F.lit(VISITOR).alias("kind"), visitor().alias("member")),
        F.struct(F.lit(NAME).alias("kind"), named_user(un_policy).alias("member")),
    ]
    if minutes:
        members.append(F.struct(F.lit(MINUTE).alias("kind"), F.col("minute").alias("member")))
    is_rc = F.coalesce(F.col("rc") == "0", F.lit(False)).alias("is_rc")
    kept = list(dict.fromkeys([*dims, "minute"]))
    rows = hits.select(*kept, is_rc, F.inline(F.array(*members)))
    return rows.filter(F.col("member").isNotNull())


def partials(
    hits: DataFrame, dims: Sequence[str], un_policy: str = "named", minutes: bool = False
) -> DataFrame:
    """One row for each member: hit count, first and last minute, first minute as a first visit.

    Minutes are integers here: text in the aggregation state would turn the
    hash aggregate into a sort of all hits.
    """
    rows = contributions(hits, dims, un_policy, minutes)
    number = minute_number(F.col("minute"))
    return rows.groupBy(*dims, "kind", "member").agg(
        F.count("*").alias("n"),
        F.min(number).alias("first_minute"),
        F.min(F.when(F.col("is_rc"), number)).alias("first_rc_minute"),
        F.max(number).alias("last_minute"),
    )


def partials_schema(dims: Sequence[str]) -> str:
    """The columns of :func:`partials` for text ``dims``."""
    values = "kind string, member string, n bigint, first_minute int, first_rc_minute int, last_minute int"
    return ", ".join([*(f"{dim} string" for dim in dims), values])


def merge_partials(rows: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Partials of several batches as the partials of all of them."""
    return rows.groupBy(*dims, "kind", "member").agg(
        F.sum("n").alias("n"),
        F.min("first_minute").alias("first_minute"),
        F.min("first_rc_minute").alias("first_rc_minute"),
        F.max("last_minute").alias("last_minute"),
    )


def totals(members: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The four metrics for each ``dims`` group of partials."""
    is_visitor = F.col("kind") == VISITOR
    return members.groupBy(*dims).agg(
        F.coalesce(F.sum(F.when(is_visitor, F.col("n"))), F.lit(0)).alias("pv"),
        F.count_if(is_visitor).alias("uv"),
        F.count_if(is_visitor & F.col("first_rc_minute").isNotNull()).alias("rc"),
        F.count_if(F.col("kind") == NAME).alias("un"),
    )


def four_metrics(hits: DataFrame, dims: Sequence[str], un_policy: str = "named") -> DataFrame:
    return totals(partials(hits, dims, un_policy), dims)


# -- single metrics ---------------------------------------------------------
# One distinct count is planned as group-by-member, then count, so these are
# skew-safe as they stand.


def page_views(hits: DataFrame, dims: Sequence[str]) -> DataFrame:
    return hits.groupBy(*dims).agg(F.count("*").alias("pv"))


def unique_visitors(hits: DataFrame, dims: Sequence[str]) -> DataFrame:
    return hits.groupBy(*dims).agg(F.count_distinct(visitor()).alias("uv"))


def first_visitors(hits: DataFrame, dims: Sequence[str]) -> DataFrame:
    first = F.when(F.col("rc") == "0", visitor())
    return hits.groupBy(*dims).agg(F.count_distinct(first).alias("rc"))


def named_users(hits: DataFrame, dims: Sequence[str], un_policy: str = "named") -> DataFrame:
    return hits.groupBy(*dims).agg(F.count_distinct(named_user(un_policy)).alias("un"))


def views_and_visitors(
    hits: DataFrame, dims: Sequence[str], member: Column | None = None
) -> DataFrame:
    member = visitor() if member is None else member
    return hits.groupBy(*dims).agg(
        F.count("*").alias("pv"), F.count_distinct(member).alias("uv")
    )
