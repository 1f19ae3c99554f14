"""Readers. Each returns a plain DataFrame; connection settings are arguments."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR_SCHEMA = "name string, second_name string"
CLICK_SCHEMA = "line string, ts timestamp"


def hits_path(root: str, day: str, path: str = "") -> str:
    """The files of one ``yyyymmdd`` day, unless an explicit ``path`` is configured."""
    if path:
        return path
    return f"{root.rstrip('/')}/{day[0:4]}/{day[4:6]}/{day[6:8]}/*/traffic*"


def scan_hits_day(spark: SparkSession, root: str, day: str, path: str = "") -> DataFrame:
    """Hit lines of one day as ``line``."""
    return spark.read.text(hits_path(root, day, path)).withColumnRenamed("value", "line")


def scan_tab_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=PAIR_SCHEMA, quote="", escape="")


def scan_dim_tables(spark: SparkSession, goods: str, website: str) -> tuple[DataFrame, DataFrame]:
    """The product and website warehouse tables."""
    return spark.table(goods), spark.table(website)


def scan_metric_snapshot(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Stored metrics of one day in long form; only that day's partition is read."""
    rows = spark.read.parquet(path)
    return rows.filter(F.col("date") == F.lit(date)).withColumn("date", F.col("date").cast("string"))


def start_offsets(
    committed: dict[int, int] | None,
    earliest: dict[int, int],
    latest: dict[int, int],
    reset: str = "latest",
) -> dict[int, int]:
    """Where each partition of a topic starts, from what was committed and what the topic still has.

    Without commits all partitions start at ``reset``: ``earliest`` or ``latest``. With them, only a
    partition whose commit has expired moves up to its earliest message; one that was added since
    starts there too. A commit beyond the end, as after a topic was made anew, starts at the earliest.
    """
    if reset not in ("earliest", "latest"):
        raise ValueError("reset is earliest or latest")
    if earliest.keys() != latest.keys():
        raise ValueError("earliest and latest offsets are of other partitions")
    if committed is None:
        return dict(earliest if reset == "earliest" else latest)
    found = {}
    for partition, first in earliest.items():
        offset = committed.get(partition, first)
        found[partition] = offset if first <= offset <= latest[partition] else first
    return found


def kafka_options(
    servers: str,
    topic: str,
    from_start: bool = False,
    offsets: dict[int, int] | None = None,
    most_per_batch: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    They place the first run only: at the start, the end, or the ``offsets`` stored for each
    partition; later runs go on from the checkpoint. ``most_per_batch`` bounds the messages of a batch, to work off
    a backlog. Data that retention has removed is skipped, not an error.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_start else "latest",
        "failOnDataLoss": "false",
    }
    if offsets is not None:
        options["startingOffsets"] = json.dumps({topic: {str(k): v for k, v in offsets.items()}})
    if most_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(most_per_batch)
    return options


def stream_hits_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Message values of one topic as ``line``, with the arrival order of each partition."""
    options = kafka_options(servers, topic, **options)
    messages = spark.readStream.format("kafka").options(**options).load()
    return messages.select(
        F.col("value").cast("string").alias("line"),
        F.col("timestamp").alias("arrival"),
        F.concat_ws("-", F.col("partition"), F.lpad("offset", 20, "0")).alias("event_id"),
    )


def stream_files(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    max_files: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Files that appear in a folder, as a stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_lines_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines of a socket with their arrival time, as ``line`` and ``ts``."""
    lines = (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .option("includeTimestamp", "true")
        .load()
    )
    return lines.select(F.col("value").alias("line"), F.col("timestamp").alias("ts"))


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
