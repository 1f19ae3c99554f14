"""Turn a table into a folder of files in order of arrival, as a stream finds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.sinks.versions import _remove

#: How many rows a staged file holds at least, if there is more than one for a block.
FILE_ROWS = 25_000


def stage_in_order(rows: DataFrame, folder: str, order: str, blocks: int = 4) -> int:
    """Append ``rows`` in ``blocks`` of equal width of ``order``, earliest first; returns the files of a block.

    File sources take files by modification time, so blocks are written one after the other. The files of a block
    end in any order, so a stream must take all of them in one micro-batch: each block has the same number. They
    follow the rows, not how the table is cut into files, so all tasks of a micro-batch have as much to read.
    The rows are computed once, in the tasks that read the table.
    """
    spark, whole = rows.sparkSession, f"{folder}-unordered"
    rows.write.parquet(whole)
    stored = spark.read.schema(rows.schema).parquet(whole)
    number = F.col(order).cast("double")
    shares = [i / blocks for i in range(1, blocks)]
    low, high = stored.agg(F.min(number), F.max(number)).first()
    width = ((high - low) / blocks) or 1.0
    block = F.least(F.floor((number - low) / width), F.lit(blocks - 1))
    numbered = stored.withColumn("_block", block)
    counts = {row["_block"]: row["count"] for row in numbered.groupBy("_block").count().collect()}
    files = max(1, min(counts.get(wanted, 0) for wanted in range(blocks)) // FILE_ROWS)
    for wanted in range(blocks):
        part = numbered.filter(F.col("_block") == wanted).drop("_block")
        part.repartition(files).write.mode("append").parquet(folder)
    _remove(spark, whole)
    return files
