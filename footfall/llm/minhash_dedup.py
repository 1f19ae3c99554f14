"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard similarity.

A document's set holds its distinct word shingles, as 64-bit hashes. Two permutations
of ``UNIVERSE`` places make all coordinates of a signature: the first deals the shingles
out to places, the second gives each place its rank, and coordinate ``k`` is the least
rank of the set with the places shifted by ``k``, round the circle. Bands of coordinates
give candidates; every link is confirmed on the full sets.

Equal sets are one node, named by the smallest hash of an id and text that has it; a component is
reported by its smallest id. The candidates of a band's bucket are first compared
with its smallest node only; a group of copies becomes one component by that,
at a cost in proportion to its size. What is left are pairs of a bucket that
lie in different components: in small buckets (``SMALL``) as pairs, in larger ones as
blocks of documents by blocks, of bounded size each, in which only documents outside
the group's main component are compared with the rest. No pair that a bucket holds is left
untested unless its documents are connected already, so no connection is lost.

Null and empty texts, and those of white space, have an empty set: they are linked with
nothing and are kept. A row with a null id takes no part (``component_id`` null,
kept). Rows are documents: repeated rows get the same component, and a repeated id with
another text gets that of its text. Rows that share the smallest id of their component all stay,
so identical rows do. An empty table gives an empty one. A very long text is one set, however large; its signature is
taken in steps of bounded size. Other columns are left out, and kept by ``one_of_each``.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import bitmap, connected, in_bitmap, slices, stored
from footfall.llm.words import HASHER, ascii_words, mix, shingle_set

UNIVERSE = 1 << 20
#: At a similarity of 0.8, 42 bands of 6 coordinates miss 3 pairs in a million.
BANDS, ROWS = 42, 6
SMALL = 32
BLOCK_SHINGLES = 1 << 18


@functools.lru_cache(maxsize=2)
def permutations(universe: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of shingles, and for each place the ranks of it and the following ones."""
    rng = np.random.default_rng(20240501)
    places = rng.permutation(universe).astype(np.int32)
    ranks = rng.permutation(universe).astype(np.uint32)
    circle = np.concatenate([ranks, ranks[: coordinates - 1]])
    return places, np.lib.stride_tricks.sliding_window_view(circle, coordinates)


def signature(shingles: np.ndarray, coordinates: int = BANDS * ROWS, universe: int = UNIVERSE) -> np.ndarray:
    """All coordinates of a non-empty set of shingle hashes."""
    places, ranks = permutations(universe, coordinates)
    at = places[(shingles % np.uint64(universe)).astype(np.int64)]
    least = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(at), 1024):
        np.minimum(least, ranks[at[start : start + 1024]].min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different bands apart."""
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in rows.T:
        keys = mix(keys + column)
    return keys.view(np.int64)


def document_shingles(text: str | None, width: int) -> np.ndarray:
    return shingle_set(HASHER.array(ascii_words(text)), width)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit halves of a digest of the whole set."""
    high, low = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(high), int(low)


def row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("bigint"), docs["text"])


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``row, doc_id, n_shingles, high, low, bands`` for each row of ``docs``; no bands for an empty set."""

    def measured(batches):
        for batch in slices(batches):
            sizes, highs, lows, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                shingles = document_shingles(text, width)
                high, low = set_digest(shingles)
                sizes.append(len(shingles))
                highs.append(high)
                lows.append(low)
                bands.append(band_keys(signature(shingles)) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(highs, pa.int64()),
                    pa.array(lows, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "n_shingles", "high", "low", "bands"],
            )

    return docs.select(row_hash(docs).alias("row"), docs["doc_id"].cast("bigint").alias("doc_id"), "text").mapInArrow(
        measured, "row bigint, doc_id bigint, n_shingles bigint, high bigint, low bigint, bands array<bigint>"
    )


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)`` of the given nodes, as bytes.

    A filter of fixed size keeps the texts of other documents out of the work; what it lets through
    by chance finds no partner in the joins that follow.
    """
    wanted = bitmap(nodes.select(F.xxhash64("node").alias("h")), "h")

    def sets(batches):
        for batch in slices(batches):
            keep = in_bitmap(wanted, batch.column("h").to_numpy())
            batch = batch.filter(pa.array(keep))
            found = [document_shingles(text, width).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.binary())], names=["node", "shingles"]
            )

    rows = docs.where(docs["doc_id"].isNotNull()).select(row_hash(docs).alias("node"), "text")
    rows = rows.select("node", F.xxhash64("node").alias("h"), "text")
    return rows.mapInArrow(sets, "node bigint, shingles binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 x intersection >= percent x union, for sorted distinct hashes."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    small, large = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(small) else 0
    return 100 * common >= percent * (len(a) + len(b) - common) and common > 0


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The distinct ``pairs (a, b)`` whose full sets are similar enough."""
    pairs = stored(pairs.distinct())
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = shingle_sets(docs, nodes, width)
    joined = (
        pairs.join(sets.toDF("b", "set_b"), "b")
        .join(sets.toDF("a", "set_a"), "a")
        .select("a", "b", "set_a", "set_b")
    )

    def check(batches):
        for batch in slices(batches):
            keep = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(check, "a bigint, b bigint")


def _block_links(percent: int):
    """Links between the outsiders and the members of one pair of blocks, a spanning forest of them."""

    def root(parent: dict, x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["node", "outsider"])
        others, outsiders = rows[~rows.outsider], rows[rows.outsider]
        parent = {node: root_ for node, root_ in zip(rows.node, rows.component)}
        parent.update({component: component for component in rows.component})
        sets = [np.frombuffer(x, np.uint64) for x in others.shingles]
        sizes = np.array([len(x) for x in sets])
        found = []
        if len(sets) and len(outsiders):
            owners = np.repeat(np.arange(len(sets)), sizes)
            values = np.concatenate(sets)
            order = np.argsort(values, kind="stable")
            owners, values = owners[order], values[order]
            nodes = others.node.to_numpy()
            for node, raw in zip(outsiders.node, outsiders.shingles):
                own = np.frombuffer(raw, np.uint64)
                start, end = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                count = end - start
                at = np.repeat(start - np.concatenate([[0], count.cumsum()[:-1]]), count)
                common = np.bincount(owners[at + np.arange(len(at))], minlength=len(sets))
                enough = 100 * common >= percent * (len(own) + sizes - common)
                for other in nodes[enough & (common > 0)].tolist():
                    x, y = root(parent, node), root(parent, other)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        found.append((node, other))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def _large_buckets(members: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links within groups of large buckets, block by block.

    ``members``: ``node, pivot, component, n_shingles`` of buckets with several components.
    """
    groups = connected(members.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    nodes = (
        members.select("node", "component", "n_shingles").distinct().join(groups, "node")
    )
    by_component = nodes.groupBy("root", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    main = by_component.groupBy("root").agg(
        F.max(F.struct("n", "component")).alias("m"), F.sum("s").alias("s")
    ).select("root", F.col("m.component").alias("main"), F.ceil(F.col("s") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    nodes = stored(
        nodes.join(main, "root")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("outsider", F.col("component") != F.col("main"))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    as_rows = nodes.where("outsider").select("root", "node", "component", "outsider", F.col("block").alias("i"), every.alias("j"))
    as_columns = nodes.select("root", "node", "component", F.lit(False).alias("outsider"), every.alias("i"), F.col("block").alias("j"))
    sets = shingle_sets(docs, nodes.select("node"), width)
    wanted = as_rows.unionByName(as_columns).join(sets, "node")
    return (
        wanted.groupBy("root", "i", "j")
        .applyInPandas(_block_links(percent), "a bigint, b bigint")
    )


def components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs (doc_id, text)``."""
    return row_components(docs, width, percent).drop("row")


def row_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``components`` with the hash of each row."""
    measured = stored(signatures(docs, width))
    nodes = stored(
        measured.where("n_shingles > 0 and doc_id is not null")
        .groupBy("high", "low")
        .agg(
            F.min("row").alias("node"),
            F.min("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        )
    )
    keys = nodes.select("node", "n_shingles", F.explode("bands").alias("key"))
    buckets = (
        keys.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    members = stored(keys.join(buckets, "key"))
    stars = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = stored(confirmed(stars, docs, width, percent))

    found = connected(links)
    members = members.join(found, "node", "left").withColumn("component", F.coalesce("root", "node"))
    open_keys = (
        members.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("key")
    )
    left = stored(members.join(open_keys, "key").select("key", "size", "node", "pivot", "component", "n_shingles"))
    x = left.where(f"size <= {SMALL} and node != pivot").alias("x")
    y = left.where(f"size <= {SMALL} and node != pivot").alias("y")
    pairs = x.join(y, F.expr("x.key = y.key and x.node < y.node and x.component != y.component")).where(
        f"100 * least(x.n_shingles, y.n_shingles) >= {percent} * greatest(x.n_shingles, y.n_shingles)"
    )
    small = confirmed(pairs.selectExpr("x.node a", "y.node b"), docs, width, percent)
    large = _large_buckets(left.where(f"size > {SMALL}"), docs, width, percent)
    roots = connected(links.unionByName(small).unionByName(large))

    names = nodes.select("high", "low", "node", "doc_id").join(roots, "node", "left")
    names = names.select("high", "low", F.coalesce("root", "node").alias("root"), "doc_id")
    least = names.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    names = names.drop("doc_id").join(least, "root")
    own = F.col("n_shingles") > 0
    with_set = measured.where(own & F.col("doc_id").isNotNull()).join(names, ["high", "low"])
    without = measured.where(~own | F.col("doc_id").isNull()).withColumn("component_id", F.col("doc_id"))
    columns = ["row", "doc_id", "n_shingles", "component_id"]
    return (
        with_set.select(*columns)
        .unionByName(without.select(*columns))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one id of each component, and all rows with an empty text or a null id."""
    found = row_components(docs, width, percent)
    gone = found.where(~F.col("kept")).select(F.col("row").alias("_gone")).distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    kept = named.join(gone, row_hash(named) == gone["_gone"], "left_anti")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
