"""Writers, and upserts by key.

A micro-batch writes its rows to its own ``batch_id=N`` folder and overwrites
it when it is replayed, so totals never count a batch twice. A table of increments is the sum of its batches;
:func:`compact` folds old ones into one. A keyed table rewrites the buckets that a batch touches
(:mod:`footfall.sinks.versions`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.metrics import METRICS
from footfall.sinks.versions import KeyedTable, _children, _remove

SNAPSHOT_KEYS = ("date", "ws", "minute")
ACTIVITY_KEYS = ("date", "code")


# -- batch folders ----------------------------------------------------------


def write_batch(rows: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write a micro-batch; a replay of the same ``batch_id`` replaces it."""
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def read_batches(
    spark: SparkSession,
    path: str,
    before: int | None = None,
    schema: str | None = None,
    after: int | None = None,
) -> DataFrame:
    """Rows of all batches, or of those before ``before`` and after ``after``; only their folders are read.

    With a ``schema`` (without ``batch_id``) no file is opened to find the columns.
    """
    reader = spark.read.option("basePath", path)
    reader = reader.schema(f"{schema}, batch_id bigint") if schema else reader
    rows = reader.parquet(f"{path}/batch_id=*")
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if "date" in rows.columns:
        rows = rows.withColumn("date", F.col("date").cast("string"))
    rows = rows if before is None else rows.filter(F.col("batch_id") < before)
    return rows if after is None else rows.filter(F.col("batch_id") > after)


def fold_batches(
    spark: SparkSession,
    path: str,
    upto: int,
    count: int,
    schema: str,
    fold: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> None:
    """Fold all batches after the last mark up to ``upto`` into one, for readers of ``read_folded``.

    Usually these are ``count`` batches; more or fewer after a restart with another ``count``.

    Only the folders of these batches are read, so the cost does not grow with the
    table. A mark is written when the folded batch is complete; until then readers
    see the single batches, and a replay writes the same again.
    """
    marks = spark.read.schema(MARKS).parquet(f"{path}/_marks")
    last = marks.where(F.col("run").isNull() & (F.col("upto") < upto)).agg(F.max("upto")).first()[0]
    first = upto - count + 1 if last is None else last + 1
    folders = [f"{path}/batch_id={i}" for i in range(first, upto + 1)]
    rows = spark.read.option("basePath", path).schema(f"{schema}, batch_id bigint").parquet(*folders)
    write_batch(fold(rows.drop("batch_id")), f"{path}/_folded", upto, partition_by)
    mark_folded(spark, path, upto)


def drop_folded(spark: SparkSession, path: str) -> list[int]:
    """Remove the single batches that a folded one holds; returns their numbers.

    Those behind a day that was counted anew stay, as its readers take them one by one. Run it when no reader
    planned before the last fold is still at work.
    """
    marks = spark.read.schema(MARKS).parquet(f"{path}/_marks").groupBy(F.col("run").isNotNull().alias("refit"))
    found = {row.refit: row for row in marks.agg(F.max("upto").alias("last"), F.min("upto").alias("first")).collect()}
    upto = min(found[False].last, found[True].first if True in found else found[False].last)
    numbers = [int(n.removeprefix("batch_id=")) for n in _children(spark, path) if n.startswith("batch_id=")]
    gone = sorted(n for n in numbers if n <= upto)
    for number in gone:
        _remove(spark, f"{path}/batch_id={number}")
    return gone


#: What the log of marks says: batches folded up to one, or a ``date`` counted anew by a ``run``.
MARKS = "upto bigint, date string, run string, version bigint"


def _mark(spark: SparkSession, path: str, upto: int, date=None, run=None, version=None) -> None:
    values = (("upto", upto, "bigint"), ("date", date, "string"), ("run", run, "string"), ("version", version, "bigint"))
    mark = spark.range(1).select(*[F.lit(value).cast(kind).alias(name) for name, value, kind in values])
    mark.coalesce(1).write.mode("append").parquet(f"{path}/_marks")


def mark_folded(spark: SparkSession, path: str, upto: int) -> None:
    _mark(spark, path, upto)


def replace_day(rows: DataFrame, path: str, date: str, upto: int | None = None) -> None:
    """Put ``rows`` in place of what the batches up to ``upto`` hold for ``date``; readers of ``read_folded`` see it.

    The rows get a folder of their own, and then a mark: a reader finds the old rows or the new ones. Of several
    replacements of a date the last counts. ``upto`` is the last finished batch by default.
    """
    spark = rows.sparkSession
    if upto is None:
        names = [n for n in _children(spark, path) if n.startswith("batch_id=")]
        done = [n for n in names if "_SUCCESS" in _children(spark, f"{path}/{n}")]
        upto = max((int(n.removeprefix("batch_id=")) for n in done), default=-1)
    run = str(uuid.uuid4())
    rows.filter(F.col("date") == F.lit(date)).write.partitionBy("date").parquet(f"{path}/_refits/run={run}")
    version = spark.read.schema(MARKS).parquet(f"{path}/_marks").agg(F.max("version")).first()[0] or 0
    _mark(spark, path, upto, date, run, version + 1)


def read_folded(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The folded batches, the single ones after them, and the days that were counted anew.

    The marks are read once, so a reader sees all of one state. Of a replaced day it takes the new rows and
    the single batches after them, which are still there.
    """
    marks = spark.read.schema(MARKS).parquet(f"{path}/_marks")
    newest = marks.groupBy("date").agg(F.max_by(F.struct("upto", "run"), F.coalesce("version", "upto")).alias("m"))
    found = newest.select("date", "m.*").collect()
    upto = next(row.upto for row in found if row.run is None)
    refits = [row for row in found if row.run is not None]
    if not refits:
        rows = read_batches(spark, path, schema=schema, after=upto)
        if upto >= 0:
            rows = rows.unionByName(read_batches(spark, f"{path}/_folded", before=upto + 1, schema=schema))
        return rows.drop("batch_id")
    dates = [row.date for row in refits]
    replaced = F.coalesce(F.col("date").isin(dates), F.lit(False))
    after = F.lit(upto)
    for row in refits:
        after = F.when(F.col("date") == row.date, F.lit(row.upto)).otherwise(after)
    lowest = min(upto, *(row.upto for row in refits))
    rows = read_batches(spark, path, schema=schema, after=lowest).filter(F.col("batch_id") > after)
    if upto >= 0:
        folded = read_batches(spark, f"{path}/_folded", before=upto + 1, schema=schema)
        rows = rows.unionByName(folded.filter(~replaced))
    folders = [f"{path}/_refits/run={row.run}" for row in refits]
    new = spark.read.option("basePath", f"{path}/_refits").schema(f"{schema}, run string").parquet(*folders)
    new = new.withColumn("date", F.col("date").cast("string")).drop("run")
    return rows.drop("batch_id").unionByName(new)


# -- upserts ----------------------------------------------------------------


def latest_by_key(rows: DataFrame, keys: Sequence[str], version: Column | str) -> DataFrame:
    """The row with the highest version of each key; keys may be NULL."""
    values = [c for c in rows.columns if c not in keys and c != version]
    packed = F.max_by(F.struct(*values), version).alias("_row")
    return rows.groupBy(*keys).agg(packed).select(*keys, "_row.*")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``changes`` updated, or inserted where the key is new."""
    versioned = current.withColumn("_version", F.lit(0)).unionByName(
        changes.withColumn("_version", F.lit(1))
    )
    return latest_by_key(versioned, keys, "_version")


def upsert_table(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], batch_id: int, buckets: int = 16
) -> DataFrame:
    """Merge ``changes`` into the keyed table at ``path`` and read it; a replay changes nothing."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changes.schema.fields)
    table = KeyedTable(spark, path, schema, keys, buckets)
    table.merge(changes, batch_id)
    return table.read()


def read_keyed(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of changes that were only written batch by batch: all of them are merged."""
    return latest_by_key(read_batches(spark, path), keys, "batch_id")


def sum_by_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increments of the four metrics, added up."""
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in METRICS])


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    upto: int,
    fold: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> None:
    """Fold the batches up to ``upto`` into one batch of a new table at ``target``.

    ``fold`` is how the table is read: :func:`latest_by_key`, :func:`sum_by_key`
    or ``merge_partials``. The stopped stream then goes on with ``target``; the
    old folders stay valid until that switch, so a failure loses nothing.
    """
    rows = fold(read_batches(spark, path, before=upto + 1))
    write_batch(rows, target, upto, partition_by)


# -- output forms -----------------------------------------------------------


def metrics_to_long(metrics: DataFrame) -> DataFrame:
    """``kind, date, site, value`` rows of the four metrics."""
    kinds = F.array(
        *[F.struct(F.lit(m.upper()).alias("kind"), F.col(m).alias("value")) for m in METRICS]
    )
    rows = metrics.select("date", F.col("ws").alias("site"), F.inline(kinds))
    return rows.select("kind", "date", "site", "value")


def metric_key_parts(rows: DataFrame) -> DataFrame:
    """``KIND:date:site`` keys as three columns."""
    part = [F.split_part("key", F.lit(":"), F.lit(i)) for i in (1, 2, 3)]
    names = ("kind", "date", "site")
    return rows.select("*", *[p.alias(name) for p, name in zip(part, names)])


def daily_export(long_rows: DataFrame) -> DataFrame:
    """One ``(date, ws, uv, pv)`` row for each day and site."""
    wide = long_rows.groupBy("date", F.col("site").alias("ws"))
    wide = wide.pivot("kind", ["PV", "UV"]).agg(F.first("value"))
    return wide.select("date", "ws", F.col("UV").alias("uv"), F.col("PV").alias("pv"))


def running_list(running: DataFrame) -> DataFrame:
    """``HH:mm:00--total`` texts, newest first within each date."""
    entry = F.concat_ws("--", "minute", F.col("pv").cast("string"))
    return running.select("date", "minute", entry.alias("entry")).orderBy("date", F.desc("minute"))


def write_by_date(rows: DataFrame, path: str) -> None:
    """Replace only the dates that ``rows`` holds."""
    by_date = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    by_date.partitionBy("date").parquet(path)


def store_table(
    rows: DataFrame, name: str, path: str, by: Sequence[str], buckets: int
) -> DataFrame:
    """A catalog table at ``path``, bucketed and sorted by the columns that it is joined on; returns it.

    A join on these columns with rows that are shuffled to as many partitions moves none of the
    table. ``path`` is in a folder that all executors share.
    """
    writer = rows.write.mode("overwrite").option("path", path).format("parquet")
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return rows.sparkSession.table(name)


def register_view(rows: DataFrame, name: str) -> DataFrame:
    """Expose rows to SQL and return them as read from the view."""
    rows.createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def write_jdbc(rows: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()
