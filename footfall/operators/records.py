"""Hit lines to records, and the pieces later operators read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import parse as P

# What an absent field reads as.
FIELD_SENTINELS = {name: f"{key}-NULL" for name, key in P.FIELD_KEYS.items()}
OLD_FIELD_SENTINELS = {"ws": "00000000", "cuc": "11111111", "rc": "1", "un": ""}


def evaluate_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns that later filters read as attributes.

    Catalyst pushes a filter below a projection by copying the projected
    expressions into it, and then computes them again for the output. A
    one-row generator is a boundary it does not push through, so an expensive
    text expression runs once for each row.
    """
    kept = [F.col(f"`{name}`") for name in df.columns]
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def _with_parts(lines: DataFrame) -> DataFrame:
    line = F.col("line")
    return evaluate_once(
        lines,
        P.time_text(line).alias("_time"),
        P.url_parts(P.url_text(line)).alias("_parts"),
    )


def _is_parsable() -> Column:
    test = P.has_time(F.col("_time")) & P.has_query(F.col("_parts"))
    return F.coalesce(test, F.lit(False))


def parse_records(lines: DataFrame) -> DataFrame:
    """``lines`` with ``time``, ``date``, ``minute`` and the ``query`` string.

    Lines that cannot be parsed are dropped; :func:`rejects` returns them.
    """
    good = _with_parts(lines).filter(_is_parsable())
    return evaluate_once(
        good,
        F.col("_time").alias("time"),
        P.event_date(F.col("_time")).alias("date"),
        P.event_minute(F.col("_time")).alias("minute"),
        P.query_text(F.col("_parts")).alias("query"),
    ).drop("_time", "_parts")


def with_segments(records: DataFrame) -> DataFrame:
    """Split the query string once; fields are then looked up in the two arrays."""
    if "segments" in records.columns:
        return records
    split = evaluate_once(records, P.segments(F.col("query")).alias("segments"))
    return evaluate_once(split, P.segment_keys(F.col("segments")).alias("keys"))


#: Why a line is not parsed, in the order of the tests.
REASONS = ("fields", "time", "query")


def with_reason(lines: DataFrame) -> DataFrame:
    """``lines`` with the ``reason`` for which a line cannot be parsed, NULL where it can."""
    reason = (
        F.when(_is_parsable(), F.lit(None))
        .when(F.col("_parts").isNull(), REASONS[0])
        .when(~P.has_time(F.col("_time")), REASONS[1])
        .otherwise(REASONS[2])
    )
    return _with_parts(lines).withColumn("reason", reason).drop("_time", "_parts")


def rejects(lines: DataFrame) -> DataFrame:
    """The lines that :func:`parse_records` drops, with the reason."""
    bad = _with_parts(lines).filter(~_is_parsable())
    reason = (
        F.when(F.col("_parts").isNull(), REASONS[0])
        .when(~P.has_time(F.col("_time")), REASONS[1])
        .otherwise(REASONS[2])
    )
    return bad.withColumn("reason", reason).drop("_time", "_parts")


def with_fields(records: DataFrame, *names: str) -> DataFrame:
    """Add the named fields; NULL when the parameter is absent.

    ``page_url`` and ``title`` are the decoded ``pu`` and ``tt``, with the
    sentinel in place of an absent one.
    """
    decoded = {"page_url": "pu", "title": "tt"}
    sources = sorted({decoded.get(name, name) for name in names})
    padded = evaluate_once(records, P.padded_query(F.col("query")).alias("_padded"))
    text = F.col("_padded")
    raw = evaluate_once(padded, *[P.raw_value(text, P.FIELD_KEYS[s]).alias(f"_raw_{s}") for s in sources])
    values = [P.field_value(text, F.col(f"_raw_{s}"), P.FIELD_KEYS[s]).alias(f"_{s}") for s in sources]
    found = evaluate_once(raw, *values)

    def column(name: str) -> Column:
        source = F.col(f"_{decoded.get(name, name)}")
        return P.url_decode(with_default(source, decoded[name])) if name in decoded else source

    if set(names) & set(decoded):
        out = evaluate_once(found, *[column(name).alias(name) for name in names])
    else:
        out = found.withColumns({name: column(name) for name in names})
    return out.drop("_padded", *[f"_{s}" for s in sources], *[f"_raw_{s}" for s in sources])


def with_default(column: Column, name: str) -> Column:
    return F.coalesce(column, F.lit(FIELD_SENTINELS[name]))


def field_defaults(records: DataFrame, *names: str) -> DataFrame:
    """Put the sentinel in place of absent fields."""
    return records.withColumns({n: with_default(F.col(n), n) for n in names})


def explode_params(records: DataFrame, empty: str = P.EMPTY_VALUE) -> DataFrame:
    """One ``(key, value)`` row for each parameter of each record."""
    kept = [F.col(f"`{name}`") for name in records.columns]
    params = P.parameter_map(F.col("segments"), F.col("keys"), empty)
    return with_segments(records).select(*kept, F.explode(params).alias("key", "value"))


def params_text(records: DataFrame, empty: str = P.EMPTY_VALUE) -> DataFrame:
    """Add ``params``: the parameter map, and ``params_text``: it as sorted text."""
    params = P.parameter_map(F.col("segments"), F.col("keys"), empty)
    out = evaluate_once(with_segments(records), params.alias("params"))
    entries = F.transform(
        F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return out.withColumn("params_text", F.array_join(F.array_sort(entries), "&"))
