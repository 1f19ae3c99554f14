"""Reading the given tables, and stored intermediate results."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import shared_folder

ROOT = Path(__file__).resolve().parents[2]


#: Bytes of an Arrow batch: long texts make it few rows.
BATCH_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors where it is not on their path already, and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    here = context.master.startswith("local[") and Path.cwd() == ROOT
    if here or str(ROOT) in on_path or getattr(context, "_footfall_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="footfall-code-")) / "footfall.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in (ROOT / "footfall").rglob("*.py"):
            out.write(path, path.relative_to(ROOT))
    context.addPyFile(str(archive))
    context._footfall_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to ``spark.checkpoint.dir`` and read from there.

    The files outlive executors, and Spark removes them when the frame is no
    longer used. A session without the setting (tests) gets a folder of its own.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def slices(batches, rows: int = 512):
    """Arrow batches in slices of so many rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()
    give_back_memory()


def give_back_memory() -> None:
    """Return what the allocators keep: workers live on after the task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffles that no frame uses any more; a collection on the driver is what tells it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it where a column of ``df`` has it already."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id):
    """True for the rows kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """Up to ``rows`` of ``(doc_id, label)``, chosen by hash; at most 16 bytes each.

    Rows with a null in either column, or held out, are left out. Of repeated
    ids the largest label counts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    return (
        known.where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )


#: Bits of a filter of fixed size.
FILTER_BITS = 1 << 25


def bitmap_word(hashed):
    """The 64-bit word of the filter in which a hash has its bit."""
    return F.shiftright(F.pmod(hashed, F.lit(FILTER_BITS)), 6)


def bitmap_bit(hashed, mask):
    """Whether the bit of a hash is set in its word."""
    return F.getbit(mask, (F.pmod(hashed, F.lit(64))).cast("int")) == 1


def bitmap_rows(hashes: DataFrame, column: str) -> DataFrame:
    """A filter of fixed size over a column of 64-bit hashes, as ``(word, mask)``.

    Whatever the number of rows, it has ``FILTER_BITS`` bits at most. A set that
    fills it only lets more rows pass; an exact join must follow.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col(column), F.lit(64)).cast("int"))
    return (
        hashes.select(bitmap_word(F.col(column)).alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
    )


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """The words of ``bitmap_rows``, for use in tasks."""
    words = bitmap_rows(hashes, column).toArrow()
    filled = np.zeros(FILTER_BITS // 64, np.uint64)
    filled[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return filled


def in_bitmap(filled: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each hash (signed or not), whether its bit is set."""
    slot = hashes.astype(np.uint64) & np.uint64(len(filled) * 64 - 1)
    word = filled[(slot >> np.uint64(6)).astype(np.int64)]
    return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of undirected ``edges (a, b)``; root is the smallest node reachable.

    Alternates two steps until nothing changes: each node ties its larger
    neighbours to its smallest neighbour, then its smaller neighbours and itself
    likewise. Both are groupings with a map-side minimum and a join, so a node
    with many neighbours is never gathered in one row. Rows with nulls and loops
    are left out.
    """

    def state(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    edges = stored(
        edges.dropna()
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct()
    )
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.distinct()
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        after = state(edges)
        both = least = larger = smaller = None
        release(edges.sparkSession)
        if after == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        before = after
