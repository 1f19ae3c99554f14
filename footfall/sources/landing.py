"""A landing table of parsed hits: partitioned by date, sorted by site within its files.

Lines are parsed once, when a day lands; a day that lands again is replaced as a whole. Readers prune by date,
and by site through the statistics of the files' row groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import TrafficConfig
from footfall.functions.parse import FIELD_KEYS
from footfall.operators.filters import main_site, no_click_event, not_bot, shop_flow
from footfall.operators.records import parse_records, with_fields

#: What is read of each hit; absent parameters are NULL, ``page_url`` and ``title`` are decoded.
FIELDS = (*[name for name in FIELD_KEYS if name not in ("pu", "tt")], "page_url", "title")


def land_hits(lines: DataFrame, path: str, files: int = 8) -> None:
    """Write the hits of ``lines`` to the table at ``path``, in place of the dates that they have.

    ``lines`` hold whole days. A date gets about ``files`` files, by a hash of its rows, so a large
    one is written by many tasks.
    """
    kept = [c for c in lines.columns if c != "line"]
    bot = (~not_bot(F.col("line"))).alias("bot")
    rows = with_fields(parse_records(lines.select("*", bot)), *FIELDS)
    rows = rows.select(*kept, "date", "minute", "bot", *FIELDS)
    spread = F.pmod(F.xxhash64("minute", "cuc", "page_url", *kept), F.lit(files))
    placed = rows.withColumn("_file", spread).repartition("date", "_file")
    by_site = placed.sortWithinPartitions("date", "ws", "minute").drop("_file")
    writer = by_site.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)


def landed(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Landed hits, of some ``dates`` only if given."""
    rows = spark.read.parquet(path)
    rows = rows if dates is None else rows.filter(F.col("date").cast("string").isin(*dates))
    return rows.withColumn("date", F.col("date").cast("string"))


def landed_main_site_hits(
    spark: SparkSession, path: str, config: TrafficConfig, dates: Sequence[str] | None = None
) -> DataFrame:
    """The shop-flow page hits of the main site, as ``main_site_hits`` finds them in lines."""
    rows = landed(spark, path, dates).filter(~F.col("bot"))
    rows = rows.filter(main_site(config.main_site) & no_click_event())
    return rows.filter(shop_flow(config.malls))
