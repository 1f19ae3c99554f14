"""Distinct counts that roll up: visitors numbered once, their sets stored as bitmaps.

A visitor gets a number the first time it is seen, and keeps it. The set of a group is a bitmap for each bucket of
32,768 numbers. Sets of any groups are joined bit by bit, so a roll-up over days or sites is exact
and reads neither hits nor names. Numbers follow the order of commits, so the visitors of a day lie close.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.operators.metrics import visitor
from footfall.sinks.versions import LogTable

#: New visitors are numbered in so many parts.
PARTS = 1024


def number_new(members: DataFrame, known: DataFrame) -> DataFrame:
    """``member, number`` of the members that are not in ``known (member, number)``.

    Numbers go on from the greatest. Members are ranked within parts by hash, and the parts' counts
    added up, so no task ranks them all.
    """
    new = members.select("member").distinct().join(known, "member", "left_anti")
    new = new.withColumn("_part", F.pmod(F.xxhash64("member"), F.lit(PARTS)))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("member"))
    before = Window.partitionBy("_all").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = new.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_all", F.lit(0))
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    start = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).scalar()
    ranked = new.withColumn("_rank", rank).join(counts, "_part")
    return ranked.select("member", (start + F.col("_before") + F.col("_rank") - 1).alias("number"))


def bitmaps(numbered: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``dims, bucket, bits``: the sets of ``number`` of each group."""
    place = numbered.select(
        *dims,
        F.bitmap_bucket_number("number").alias("bucket"),
        F.bitmap_bit_position("number").alias("_bit"),
    )
    return place.groupBy(*dims, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def roll_up(sets: DataFrame, dims: Sequence[str]) -> DataFrame:
    """``dims, uv`` from stored sets of the same or finer groups."""
    joined = sets.groupBy(*dims, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*dims).agg(F.sum(F.bitmap_count("bits")).alias("uv"))


class VisitorSets:
    """The dictionary and the sets of visitors by ``dims``, kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str, dims: Sequence[str] = ("date", "ws")):
        self.dims = tuple(dims)
        columns = ", ".join(f"{d} string" for d in self.dims)
        self.dictionary = LogTable(spark, f"{path}/dictionary", "member string, number bigint")
        self.sets = LogTable(spark, f"{path}/sets", f"{columns}, bucket bigint, bits binary")

    def add(self, hits: DataFrame, version: int) -> None:
        """Add the visitors of a batch of ``hits``; a replay of ``version`` adds nothing."""
        seen = hits.select(*self.dims, visitor().alias("member")).distinct()
        self.dictionary.append(number_new(seen, self.dictionary.read()), version)
        numbered = seen.join(self.dictionary.read(), "member")
        self.sets.append(bitmaps(numbered, self.dims), version)

    def count(self, *dims: str) -> DataFrame:
        """Distinct visitors by some of the dims, or of all."""
        return roll_up(self.sets.read(), dims)
