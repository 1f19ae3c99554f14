"""Chat formatting in windows of a token budget, with loss masks; DataFrame expressions only.

Prefix sums of the turns' tokens choose turn-aligned windows within ``budget``. Each conversation has a stride: half of
the budget, less where its system turn leaves less room. The turns that end in one stride are the new turns of a
window; where the first of them, begun in the stride before, makes them too many, it gets a window alone.
Every later window begins with the system turn and repeats the last turns before it, at most ``history``
tokens and no more than the budget leaves, so history is shortened first. Only a single new turn that is too long beside
the system turn makes a window longer than the budget. Only texts of assistant turns that are new to the
window are under the loss mask, so each target counts once.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Within roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so control strings cannot be forged
and ``read_turns`` gives the texts back.

Turns are ordered by turn (nulls first), ties by role and text; repeated rows are turns of
their own. Null roles and texts count as empty; a null ``conv_id`` is one conversation. An
empty table gives no windows. A very long turn stands in its window whole. Other
columns are left out. Prefix sums are taken by blocks of turn numbers first, so that one
long conversation is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>\n"
TURN_BLOCK = 512
#: Tokens of the marks around a turn.
OVERHEAD = 4


def estimated_tokens(text: Column) -> Column:
    """One token for each four bytes, begun ones included."""
    return F.ceil(F.octet_length(text) / 4)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _placed(turns: DataFrame) -> DataFrame:
    """With ``at`` (number of the turn) and ``start`` (tokens before it) in the conversation."""
    turns = turns.withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    turns = turns.withColumn("n", F.row_number().over(in_block)).withColumn(
        "sum", F.sum("tokens").over(in_block.rowsBetween(Window.unboundedPreceding, 0))
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(F.max("n").alias("count"), F.max("sum").alias("total"))
    blocks = blocks.select(
        F.col("conv_id").alias("conv_"),
        F.col("block").alias("block_"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("at_"),
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start_"),
    )
    same = turns["conv_id"].eqNullSafe(blocks["conv_"]) & turns["block"].eqNullSafe(blocks["block_"])
    return turns.join(blocks, same).select(
        "conv_id",
        "role",
        "text",
        (F.col("at_") + F.col("n") - 1).alias("at"),
        "tokens",
        (F.col("start_") + F.col("sum") - F.col("tokens")).alias("start"),
    )


def windows(
    conversations: DataFrame, budget: int = 1024, history: int | None = None, tokens: Column | None = None
) -> DataFrame:
    """``conv_id, window, text, n_turns, n_tokens, n_repeated, loss_spans`` from ``conv_id, turn, role, text``.

    ``loss_spans``: ``(start, end)`` in code points of ``text``. ``tokens`` gives a turn's
    tokens (default: an estimate from its bytes); ``history`` is a quarter of the budget by default. Numbers of
    windows rise, with gaps.
    """
    history = budget // 4 if history is None else history
    count = estimated_tokens(F.col("text")) if tokens is None else tokens
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", (F.coalesce(count, F.lit(0)) + OVERHEAD).cast("bigint"))
    turns = _placed(turns)
    is_system = (F.col("at") == 0) & (F.col("role") == "system")
    system = turns.where(is_system).select(
        F.col("conv_id").alias("conv_"), F.col("role").alias("role_"), F.col("text").alias("text_"), F.col("tokens").alias("system")
    )

    # the tokens of the system turn are set aside; the others are numbered from it on
    turns = turns.join(system.select("conv_", "system"), turns["conv_id"].eqNullSafe(system["conv_"]), "left")
    reserved = F.coalesce("system", F.lit(0))
    room = F.greatest(F.lit(budget) - reserved, F.lit(1))
    turns = turns.select(
        "conv_id",
        "at",
        "role",
        "text",
        "tokens",
        is_system.alias("is_system"),
        room.alias("room"),
        F.least(room, F.lit(max(1, budget // 2))).alias("stride"),
        F.when(is_system, F.lit(0)).otherwise(F.col("start") - reserved).alias("start"),
    )
    spoken = turns.where(~F.col("is_system"))
    last = F.col("start") + F.col("tokens") - 1
    spoken = spoken.withColumn("unit", F.floor(last / F.col("stride")))
    units = spoken.groupBy("conv_id", "unit").agg(F.sum("tokens").alias("total"))
    units = units.select(F.col("conv_id").alias("conv_"), F.col("unit").alias("unit_"), "total")
    same = spoken["conv_id"].eqNullSafe(units["conv_"]) & (spoken["unit"] == units["unit_"])
    begun_before = F.floor(F.col("start") / F.col("stride")) < F.col("unit")
    behind = ~begun_before & (F.col("total") > F.col("room"))
    spoken = spoken.join(units, same).withColumn("window", F.col("unit") * 2 + behind.cast("bigint"))
    spoken = spoken.drop("conv_", "unit_", "unit", "total")

    bounds = spoken.groupBy("conv_id", "window").agg(
        F.min("start").alias("first"),
        F.sum("tokens").alias("total"),
        F.max("room").alias("room"),
        F.max("stride").alias("stride"),
    )
    opening = bounds.groupBy("conv_id").agg(F.min("window").alias("window"))
    opening = opening.select(F.col("conv_id").alias("conv_"), F.col("window").alias("window_"))
    systems = turns.where("is_system")
    systems = systems.join(opening, systems["conv_id"].eqNullSafe(opening["conv_"]), "left")
    systems = systems.withColumn("window", F.coalesce("window_", F.lit(0).cast("bigint")))
    bounds = bounds.withColumn(
        "allowed", F.greatest(F.least(F.lit(history), F.col("room") - F.col("total")), F.lit(0))
    )
    # turns of these strides can be repeated: one more than the allowance spans
    strides = F.sequence(
        F.floor(F.greatest(F.col("first") - F.col("allowed"), F.lit(0)) / F.col("stride")),
        F.floor(F.col("first") / F.col("stride")),
    )
    reaching = bounds.where("allowed > 0 and first > 0").select(
        F.col("conv_id").alias("conv_"),
        F.col("window").alias("window_"),
        "first",
        "allowed",
        F.explode(strides).alias("place_"),
    )
    before = spoken.withColumn("place", F.floor(F.col("start") / F.col("stride")))
    same = before["conv_id"].eqNullSafe(reaching["conv_"]) & (before["place"] == reaching["place_"])
    repeated = before.join(reaching, same).where(
        (F.col("start") >= F.col("first") - F.col("allowed")) & (F.col("start") < F.col("first"))
    )
    repeated = repeated.withColumn("window", F.col("window_"))
    later = bounds.where("first > 0").select("conv_id", "window")
    retained = later.join(system, later["conv_id"].eqNullSafe(system["conv_"])).select(
        "conv_id",
        "window",
        F.lit(0).cast("bigint").alias("at"),
        F.col("role_").alias("role"),
        F.col("text_").alias("text"),
        F.col("system").alias("tokens"),
    )

    columns = ["conv_id", "window", "at", "role", "text", "tokens"]
    rows = (
        spoken.unionByName(systems.select(*spoken.columns))
        .select(*columns, F.lit(True).alias("new"))
        .unionByName(repeated.select(*columns, F.lit(False).alias("new")))
        .unionByName(retained.select(*columns, F.lit(False).alias("new")))
    )
    turn = F.struct(
        "at",
        F.concat(
            F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n")
        ).alias("head"),
        escape(F.col("text")).alias("body"),
        "new",
        (F.col("new") & (F.col("role") == "assistant")).alias("target"),
    )
    grouped = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.sum("tokens").alias("n_tokens")
    )
    length = F.lit(len(END))
    empty = F.struct(
        F.lit(0).cast("bigint").alias("end"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def extend(state, t):
        start = state["end"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct(
            (end + length).cast("bigint").alias("end"),
            F.when(t["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.size("turns").alias("n_turns"),
        "n_tokens",
        F.size(F.filter("turns", lambda t: ~t["new"])).alias("n_repeated"),
        F.aggregate("turns", empty, extend, lambda state: state["spans"]).alias("loss_spans"),
    )


def new_turns() -> Column:
    """The turns new to a window, as ``(role, text)``, read from its formatted text."""
    parts = F.split("text", r"<\|im_end\|>\n", -1)
    turns = F.slice(parts, F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    head = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n"
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.regexp_extract(t, head, 1)).alias("role"),
            unescape(F.regexp_replace(t, head, "")).alias("text"),
        ),
    )


def targets() -> Column:
    """The texts under a window's loss mask."""
    return F.transform(
        "loss_spans",
        lambda s: unescape(
            F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them.

    The digest of a conversation needs its text in one row.
    """
    written = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select("conv_id", "window", "text", new_turns().alias("turns"), targets().alias("targets"))
    parts = read.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(written, "").alias("turns"),
            F.array_join("targets", "").alias("loss"),
        ).alias("part"),
        F.size("turns").cast("bigint").alias("n"),
        F.length("text").cast("bigint").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"),
    )
    turns = F.array_join(F.col("parts.turns"), "")
    loss = F.array_join(F.col("parts.loss"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
