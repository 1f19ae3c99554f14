"""Tables whose live files a manifest names, so that an update costs what it changes.

Each commit writes new files and then a manifest, a small table of the parts that are live. Readers take the
newest complete manifest and open just the files it names: they see the table before a commit or
after it. A commit that fails before its manifest leaves files that no one reads, and its replay writes them
again; a replay of a finished commit does nothing. ``vacuum`` removes what no kept manifest names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of any file system that Spark reads; none where it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class VersionedTable:
    """Parts of a table, each the files of one version, and the manifests that name them."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def versions(self) -> list[int]:
        """The finished commits, oldest first."""
        names = _children(self.spark, f"{self.path}/_manifest")
        found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
        return sorted(v for v in found if "_SUCCESS" in _children(self.spark, f"{self.path}/_manifest/version={v}"))

    def parts(self, version: int | None = None) -> dict[int, tuple[int, int]]:
        """The live parts after ``version`` (default: the newest commit): ``{part: (version, rows)}``."""
        versions = [v for v in self.versions() if version is None or v <= version]
        if not versions:
            return {}
        folder = f"{self.path}/_manifest/version={versions[-1]}"
        rows = self.spark.read.schema("part bigint, version bigint, n bigint").parquet(folder).collect()
        return {row.part: (row.version, row.n) for row in rows}

    def folder(self, part: int, version: int) -> str:
        return f"{self.path}/data/version={version}/part={part}"

    def commit(self, parts: dict[int, tuple[int, int]], version: int) -> None:
        rows = [(part, v, n) for part, (v, n) in sorted(parts.items())]
        manifest = self.spark.createDataFrame(rows, "part bigint, version bigint, n bigint")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifest/version={version}")

    def read_parts(self, parts: dict[int, tuple[int, int]]) -> DataFrame:
        folders = [self.folder(part, version) for part, (version, _) in sorted(parts.items())]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> DataFrame:
        """The table after the newest commit, or after ``version``."""
        return self.read_parts(self.parts(version))

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` manifests, and the files that none of these names."""
        versions = self.versions()
        live = {(v, part) for kept in versions[-keep:] for part, (v, _) in self.parts(kept).items()}
        for version in versions[:-keep]:
            _remove(self.spark, f"{self.path}/_manifest/version={version}")
        for name in _children(self.spark, f"{self.path}/data"):
            version = int(name.removeprefix("version="))
            if versions and version > versions[-1]:
                continue  # a commit that is still being written
            own = [n for n in _children(self.spark, f"{self.path}/data/{name}") if n.startswith("part=")]
            dead = [n for n in own if (version, int(n.removeprefix("part="))) not in live]
            for part in [""] if len(dead) == len(own) else dead:
                _remove(self.spark, f"{self.path}/data/{name}/{part}".rstrip("/"))


class KeyedTable(VersionedTable):
    """One row for each key, in hash buckets; a commit rewrites the buckets that it touches.

    ``buckets`` is chosen once, for files of a few hundred megabytes. Keys may be NULL. With an ``order`` column, the
    row with the greater order stays, and the later one of equals; without, the later commit.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        keys: Sequence[str],
        buckets: int = 16,
        order: str | None = None,
    ):
        super().__init__(spark, path, schema)
        self.keys, self.buckets, self.order = tuple(keys), buckets, order

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))

    def merge(self, changes: DataFrame, version: int) -> None:
        """Update or insert ``changes``, one row for each key, as commit ``version`` (later ones are greater)."""
        versions = self.versions()
        if versions and version <= versions[-1]:
            return
        # the changes are written by bucket first: they are computed once, and the buckets they touch are known
        columns = self.spark.createDataFrame([], self.schema).columns
        staged = f"{self.path}/_changes"
        changes.select(*columns, self.bucket().alias("part")).repartition("part").write.mode("overwrite").partitionBy(
            "part"
        ).parquet(staged)
        names = _children(self.spark, staged)
        touched = sorted(int(n.removeprefix("part=")) for n in names if n.startswith("part="))
        live = self.parts()
        new = self.spark.read.option("basePath", staged).schema(f"{self.schema}, part bigint")
        new = new.parquet(*[f"{staged}/part={p}" for p in touched]) if touched else None
        if new is not None:
            old = self.read_parts({p: live[p] for p in touched if p in live}).withColumn("part", self.bucket())
            merged = self._merged(old, new)
            folder = f"{self.path}/data/version={version}"
            merged.repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)
            counts = self.spark.read.option("basePath", folder).schema("part bigint").parquet(folder)
            live |= {row.part: (version, row.n) for row in counts.groupBy("part").agg(F.count("*").alias("n")).collect()}
        self.commit(live, version)

    def _merged(self, old: DataFrame, new: DataFrame) -> DataFrame:
        def without(rows: DataFrame, others: DataFrame, newer) -> DataFrame:
            named = others.select(*[F.col(k).alias(f"_{k}") for k in self.keys], *newer[1])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
            return rows.join(named, reduce(Column.__and__, same + newer[0]), "left_anti")

        if not self.order:
            return without(old, new, ([], [])).unionByName(new)
        other = F.col(self.order).alias("_order")
        older = without(old, new, ([F.col("_order") >= F.col(self.order)], [other]))
        return older.unionByName(without(new, old, ([F.col("_order") > F.col(self.order)], [other])))


class LogTable(VersionedTable):
    """Rows that are only added. A commit without rows writes nothing.

    Segments are merged when the one before is less than twice as large, so a table of ``n`` rows has at most
    about ``log2(n)`` of them, and a row is written again as often at most.
    """

    def append(self, rows: DataFrame, version: int) -> int:
        """Add ``rows`` as commit ``version``; returns how many they were."""
        versions = self.versions()
        if versions and version <= versions[-1]:
            return 0
        live = self.parts()
        rows = rows.persist()
        try:
            count = rows.count()
            if not count:
                return 0
            taken, total = [], count
            for part in sorted(live, reverse=True):
                if live[part][1] >= 2 * total:
                    break
                taken.append(part)
                total += live[part][1]
            merged = rows
            if taken:
                merged = rows.unionByName(self.read_parts({p: live.pop(p) for p in taken}))
            merged.write.mode("overwrite").parquet(self.folder(version, version))
            self.commit(live | {version: (version, total)}, version)
            return count
        finally:
            rows.unpersist()
