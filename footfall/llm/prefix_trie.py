"""The trie of the prefixes of rebuilt conversations, from composable fingerprints of their turns.

A conversation is rebuilt from the head of a base conversation and its own turns after its head. Its text is never
put together. Each turn stands for an affine map ``x -> a x + b`` modulo the prime 2^127 - 1, drawn from
its digest, and a sequence of turns for the product of their maps, in order. Maps are a group, so
the prefix of a rebuilt conversation is ``base head * inverse(own head) * own prefix``: one inverse
for a conversation, one product for a turn.

Equal products are one node. Two checks make that exact. A turn's reference is a digest of role and text, and
the distinct stored turns must be as many as their references. The members of a node must have one last reference
and one parent product; by induction from the root they then have the same turns. Should products ever meet by
chance, all are drawn anew with another seed.

What a node holds comes from its smallest member, its representative: the weight of a node is written
on its representative's path, summed up from the end of each path, and added up over the members of
a node, so every node of a subtree counts once and no pair of nodes is formed. Turns are sorted by range
and multiplied partition by partition; a conversation over several of them goes on
with the products of those before it, so a long one is no single task. Ids that end in a
node are joined in blocks of ``END_BLOCK`` numbers, and its digest takes the blocks one after another.

Turns are ordered by turn, nulls first, ties by the reference; repeated rows are turns of their own. Null roles
and texts are empty. Rows with a null ``conv_id`` take no part. An empty table has no nodes. Texts are
read whole, once for their digest and once for the check. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.llm.tables import stored

PRIME = (1 << 127) - 1
#: A head has fewer turns than this.
HEADS = 6
DEPTH_BLOCK = 512
END_BLOCK = 4096

Map = tuple[int, int]
IDENTITY: Map = (1, 0)
_NO_TURN = b""


def turn_map(reference: bytes, seed: int) -> Map:
    """The map of a turn: two numbers drawn from its reference, the first not zero."""
    drawn = hashlib.blake2b(reference, digest_size=32, salt=seed.to_bytes(8, "big")).digest()
    return int.from_bytes(drawn[:16], "big") % (PRIME - 1) + 1, int.from_bytes(drawn[16:], "big") % PRIME


def product(first: Map, second: Map) -> Map:
    return first[0] * second[0] % PRIME, (first[0] * second[1] + first[1]) % PRIME


def inverse(map_: Map) -> Map:
    a = pow(map_[0], -1, PRIME)
    return a, -map_[1] * a % PRIME


def to_bytes(map_: Map) -> bytes:
    return map_[0].to_bytes(16, "big") + map_[1].to_bytes(16, "big")


def from_bytes(raw: bytes) -> Map:
    return int.from_bytes(raw[:16], "big"), int.from_bytes(raw[16:], "big")


# -- turns --------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, reference`` of all turns."""
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    written = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("reference", F.unhex(F.substring(F.sha2(written, 256), 1, 32)))


def _check_references(turns: DataFrame) -> None:
    """Distinct stored turns must have distinct references."""
    distinct = turns.select("reference", "role", "text").distinct()
    clashes = distinct.groupBy("reference").count().where("count > 1")
    if not clashes.isEmpty():
        raise ValueError("two different turns have the same reference")


def placed(turns: DataFrame, seed: int = 0) -> DataFrame:
    """``conv_id, pos, reference, chars, before``: turns numbered from 0, and the product of those before each."""
    narrow = turns.select("conv_id", "turn", "reference", F.length("text").alias("chars"))
    order = (F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("reference"))
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def multiply(batches):
        part, conv, at, running = TaskContext.get().partitionId(), None, 0, IDENTITY
        for batch in batches:
            number, before = [], []
            for own, reference in zip(batch.column("conv_id").to_pylist(), batch.column("reference").to_pylist()):
                if own != conv:
                    conv, at, running = own, 0, IDENTITY
                number.append(at)
                before.append(to_bytes(running))
                at, running = at + 1, product(running, turn_map(reference, seed))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array([part] * len(number), pa.int32()),
                    pa.array(number, pa.int64()),
                    batch.column("reference"),
                    batch.column("chars"),
                    pa.array(before, pa.binary()),
                ],
                names=["conv_id", "part", "at", "reference", "chars", "before"],
            )

    rows = stored(
        ordered.mapInArrow(
            multiply, "conv_id bigint, part int, at bigint, reference binary, chars int, before binary"
        )
    )
    offsets = _offsets(rows, seed)
    if not offsets:
        return rows.select("conv_id", F.col("at").alias("pos"), "reference", "chars", "before")

    def shift(batches):
        for batch in batches:
            keys = zip(batch.column("conv_id").to_pylist(), batch.column("part").to_pylist())
            at, before = batch.column("at").to_pylist(), batch.column("before").to_pylist()
            for i, key in enumerate(keys):
                if key in offsets:
                    count, total = offsets[key]
                    at[i], before[i] = at[i] + count, to_bytes(product(total, from_bytes(before[i])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(at, pa.int64()),
                    batch.column("reference"),
                    batch.column("chars"),
                    pa.array(before, pa.binary()),
                ],
                names=["conv_id", "pos", "reference", "chars", "before"],
            )

    return rows.mapInArrow(shift, "conv_id bigint, pos bigint, reference binary, chars int, before binary")


def _offsets(rows: DataFrame, seed: int) -> dict[tuple[int, int], tuple[int, Map]]:
    """Turns and product before a conversation's part in each partition but its first.

    Rows are sorted by range, so only the first and the last conversation of a partition can be in
    another one too: at most two rows for each partition come to the driver.
    """
    counts = rows.groupBy("conv_id", "part").agg(F.max("at").alias("at"))
    several = counts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    last = counts.join(several, "conv_id").select("conv_id", "part", "at")
    found = last.join(rows, ["conv_id", "part", "at"]).select("conv_id", "part", "at", "reference", "before")
    offsets, conv, count, total = {}, None, 0, IDENTITY
    for row in sorted(found.collect(), key=lambda r: (r.conv_id, r.part)):
        if row.conv_id != conv:
            conv, count, total = row.conv_id, 0, IDENTITY
        else:
            offsets[row.conv_id, row.part] = count, total
        own = product(from_bytes(bytes(row.before)), turn_map(bytes(row.reference), seed))
        count, total = count + row.at + 1, product(total, own)
    return offsets


# -- rebuilt conversations ----------------------------------------------------


def base_of_hundred(conv_id: Column) -> Column:
    """The conversation whose head the others of its hundred share."""
    return conv_id - conv_id % 100


def head_by_checksum(conv_id: Column) -> Column:
    """The turns of a head: 0 to 5."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def members(
    turns: DataFrame,
    base: Callable[[Column], Column] = base_of_hundred,
    head: Callable[[Column], Column] = head_by_checksum,
    seed: int = 0,
) -> DataFrame:
    """``conv_id, depth, print, parent, reference, chars, turns`` for each prefix of each rebuilt conversation.

    ``print`` is the product of the prefix, ``parent`` that of the prefix before it; ``turns`` is
    the length of the rebuilt conversation.
    """
    rows = placed(turns, seed)
    turn = F.struct("pos", "reference", "chars", "before")
    info = rows.groupBy("conv_id").agg(
        (F.max("pos") + 1).alias("own"),
        F.array_sort(F.collect_list(F.when(F.col("pos") < HEADS, turn))).alias("first"),
    )
    info = stored(info)
    bases = info.select(F.col("conv_id").alias("base"), F.col("first").alias("lent"))
    info = info.select("*", head(F.col("conv_id")).alias("h"), base(F.col("conv_id")).alias("base"))
    info = info.join(bases, "base", "left")
    info = info.withColumn("lent", F.slice(F.coalesce("lent", F.expr("slice(first, 1, 0)")), 1, F.col("h")))
    borrowed = F.size("lent")
    info = info.select(
        "conv_id",
        "h",
        "lent",
        borrowed.alias("borrowed"),
        (borrowed + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns"),
        F.get(F.slice("first", 1, F.col("h")), F.least(F.col("h"), F.col("own").cast("int")) - 1).alias("last"),
    )

    def after(turn: dict | None) -> Map:
        return product(from_bytes(turn["before"]), turn_map(turn["reference"], seed)) if turn else IDENTITY

    def join_maps(batches):
        """The map from a conversation's own prefixes to the rebuilt ones."""
        for batch in batches:
            lent, last = batch.column("lent").to_pylist(), batch.column("last").to_pylist()
            joins = [to_bytes(product(after(a[-1] if a else None), inverse(after(b)))) for a, b in zip(lent, last)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "h", "borrowed", "turns")), pa.array(joins, pa.binary())],
                names=["conv_id", "h", "borrowed", "turns", "join"],
            )

    joins = info.mapInArrow(join_maps, "conv_id bigint, h int, borrowed int, turns bigint, join binary")
    heads = info.select("conv_id", "turns", F.explode("lent").alias("turn")).select(
        "conv_id",
        (F.col("turn.pos") + 1).alias("depth"),
        "turn.reference",
        "turn.chars",
        "turns",
        "turn.before",
        F.lit(to_bytes(IDENTITY)).alias("join"),
    )
    own = rows.where(F.col("pos") >= head(F.col("conv_id"))).join(joins, "conv_id")
    own = own.select(
        "conv_id",
        (F.col("borrowed") + F.col("pos") - F.col("h") + 1).alias("depth"),
        "reference",
        "chars",
        "turns",
        "before",
        "join",
    )

    def prints(batches):
        for batch in batches:
            own, parent = [], []
            columns = (batch.column(c).to_pylist() for c in ("reference", "before", "join"))
            for reference, before, join in zip(*columns):
                shorter = product(from_bytes(join), from_bytes(before))
                parent.append(to_bytes(shorter)[16:])
                own.append(to_bytes(product(shorter, turn_map(reference, seed)))[16:])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "depth")),
                    pa.array(own, pa.binary()),
                    pa.array(parent, pa.binary()),
                    *(batch.column(c) for c in ("reference", "chars", "turns")),
                ],
                names=["conv_id", "depth", "print", "parent", "reference", "chars", "turns"],
            )

    prefixes = heads.unionByName(own).mapInArrow(
        prints,
        "conv_id bigint, depth bigint, print binary, parent binary, reference binary, chars int, turns bigint",
    )
    roots = info.select(
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(to_bytes(IDENTITY)[16:]).alias("print"),
        F.lit(_NO_TURN).alias("parent"),
        F.lit(_NO_TURN).alias("reference"),
        F.lit(0).alias("chars"),
        "turns",
    )
    return prefixes.unionByName(roots)


# -- the trie -----------------------------------------------------------------


def _summed_from_the_end(rows: DataFrame) -> DataFrame:
    """``saved`` and ``leaf`` summed from each depth to the end of its conversation, block by block."""
    rows = rows.withColumn("block", F.floor(F.col("depth") / DEPTH_BLOCK))
    in_block = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth"))
    within = rows.select(
        "conv_id",
        "depth",
        "block",
        "print",
        "child",
        F.sum("saved").over(in_block).alias("saved"),
        F.sum("leaf").over(in_block).alias("leaf"),
    )
    behind = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    blocks = blocks.select(
        "conv_id",
        "block",
        F.sum("saved").over(behind).alias("saved_behind"),
        F.sum("leaf").over(behind).alias("leaf_behind"),
    ).where("saved_behind is not null")
    joined = within.join(blocks, ["conv_id", "block"], "left")
    return joined.select(
        "depth",
        "print",
        "child",
        (F.col("saved") + F.coalesce("saved_behind", F.lit(0))).alias("saved"),
        (F.col("leaf") + F.coalesce("leaf_behind", F.lit(0))).alias("leaf"),
    )


def _ends(prefixes: DataFrame) -> DataFrame:
    """``depth, print, ends_sha256`` of the nodes in which conversations end."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = (
        prefixes.where("depth = turns")
        .groupBy("depth", "print", F.floor(F.col("conv_id") / END_BLOCK).alias("block"))
        .agg(F.array_join(ids, ",").alias("ids"))
    )
    ordered = blocks.repartition("depth", "print").sortWithinPartitions("depth", "print", "block")

    def digest(batches):
        key, running = None, None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("depth", "print", "ids"))
            for depth, print_, ids in zip(*columns):
                if key == (depth, print_):
                    running.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, running.hexdigest()))
                key, running = (depth, print_), hashlib.sha256(ids.encode())
            yield _end_rows(done)
        if key is not None:
            yield _end_rows([(*key, running.hexdigest())])

    return ordered.mapInArrow(digest, "depth bigint, print binary, ends_sha256 string")


def _end_rows(rows: list[tuple[int, bytes, str]]) -> pa.RecordBatch:
    depth, print_, digest = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(depth, pa.int64()), pa.array(print_, pa.binary()), pa.array(digest, pa.string())],
        names=["depth", "print", "ends_sha256"],
    )


def _nodes(turns: DataFrame, base, head, seed: int) -> tuple[DataFrame, DataFrame] | None:
    """The stored members and their nodes; none where two prefixes have met by chance."""
    prefixes = stored(members(turns, base, head, seed))
    nodes = stored(
        prefixes.groupBy("depth", "print", "parent", "reference").agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("turns").alias("longest"),
            F.max("chars").alias("chars"),
        )
    )
    met = nodes.groupBy("depth", "print").count().where("count > 1")
    return (prefixes, nodes) if met.isEmpty() else None


def trie(
    conversations: DataFrame,
    base: Callable[[Column], Column] = base_of_hundred,
    head: Callable[[Column], Column] = head_by_checksum,
) -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``base`` names the conversation that lends its head to another, ``head`` how many turns it takes,
    fewer than ``HEADS``.
    """
    turns = _turns(conversations)
    _check_references(turns)
    seed, built = 0, None
    while built is None:
        built, seed = _nodes(turns, base, head, seed), seed + 1
    prefixes, nodes = built

    zero = F.lit(0).cast("bigint")
    own = nodes.select(
        "conv_id",
        "depth",
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        (F.col("longest") == F.col("depth")).cast("bigint").alias("leaf"),
        zero.alias("child"),
    )
    child = nodes.where("depth > 0").select(
        "conv_id",
        (F.col("depth") - 1).alias("depth"),
        zero.alias("saved"),
        zero.alias("leaf"),
        F.lit(1).cast("bigint").alias("child"),
    )
    marks = own.unionByName(child).groupBy("conv_id", "depth")
    marks = marks.agg(*[F.sum(c).alias(c) for c in ("saved", "leaf", "child")])
    marked = prefixes.select("conv_id", "depth", "print").join(marks, ["conv_id", "depth"], "left")
    marked = marked.select("conv_id", "depth", "print", *[F.coalesce(c, zero).alias(c) for c in ("saved", "leaf", "child")])
    sums = (
        _summed_from_the_end(marked)
        .groupBy("depth", "print")
        .agg(
            F.sum("child").alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
        )
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("print").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    # a node is the parent of many: the side with the children is the one that can be split
    with_parent = nodes.select("conv_id", "depth", "print", "parent", "n_convs").join(parents, ["depth", "parent"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        with_parent.join(sums, ["depth", "print"])
        .join(_ends(prefixes), ["depth", "print"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
