"""Column expressions that turn a hit line into typed fields.

A line is ``f0|_|f1|_|yyyy-MM-ddTHH:mm:ss+08:00|_|url?K=V&K=V``. Everything
here is a built-in expression, so a scan with these stays on the JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field separator, the parameters with a meaning, and the
# word that stands for a parameter without a value.
SEPARATOR = "|_|"
FIELD_KEYS = {
    "ws": "WS",
    "sws": "SWSPID",
    "cuc": "CUC",
    "rc": "RC",
    "un": "UN",
    "ps": "PS",
    "pu": "PU",
    "tt": "TT",
    "cle": "CLE",
}
EMPTY_VALUE = "NULL"


# -- the line ---------------------------------------------------------------


def _head(line: Column) -> Column:
    return F.substring_index(line, SEPARATOR, 3)


def time_text(line: Column) -> Column:
    return F.substring_index(_head(line), SEPARATOR, -1)


def url_text(line: Column) -> Column:
    """The fourth field; NULL when the line has fewer than four.

    ``substring_index`` only scans the short head; ``split`` on a longer
    separator would compile a pattern and walk the whole line for every row.
    """
    head = _head(line)
    rest = F.substr(line, F.length(head) + (len(SEPARATOR) + 1))
    return F.when(head != line, F.substring_index(rest, SEPARATOR, 1))


def url_parts(url: Column) -> Column:
    return F.split(url, r"\?", 3)


def query_text(parts: Column) -> Column:
    """Text between the first and the second ``?`` of :func:`url_parts`."""
    return F.get(parts, 1)


def has_time(time: Column) -> Column:
    """``T`` followed by at least ``HH:mm``, from 00:00 to 23:59."""
    return F.contains(time, F.lit("T")) & F.rlike(_clock(time), F.lit(r"^(?:[01][0-9]|2[0-3]):[0-5][0-9]"))


def has_query(parts: Column) -> Column:
    """There is text after the first ``?``; question marks alone are none."""
    beyond = F.rtrim(F.coalesce(F.get(parts, 2), F.lit("")), F.lit("?"))
    return F.concat(F.get(parts, 1), beyond) != ""


# -- time -------------------------------------------------------------------


def event_date(time: Column) -> Column:
    """Wall-clock date; the UTC offset is thrown away on purpose."""
    return F.substring_index(time, "T", 1)


def event_date_compact(time: Column) -> Column:
    return F.replace(event_date(time), F.lit("-"), F.lit(""))


def _clock(time: Column) -> Column:
    after = F.substring_index(F.substring_index(time, "T", 2), "T", -1)
    return F.substring_index(after, "+", 1)


def event_minute_short(time: Column) -> Column:
    return F.substring(_clock(time), 1, 5)


def event_minute(time: Column) -> Column:
    return F.concat(event_minute_short(time), F.lit(":00"))


def minute_number(minute: Column) -> Column:
    """``HH:mm`` as the integer ``HHmm``: same order, and a type that hash aggregation keeps."""
    digits = F.concat(F.substring(minute, 1, 2), F.substring(minute, 4, 2))
    return digits.cast("int")


def minute_text(number: Column) -> Column:
    digits = F.lpad(number.cast("string"), 4, "0")
    return F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2), F.lit(":00"))


def minute_epoch_ms(date: Column, minute: Column) -> Column:
    """Epoch milliseconds as text, in the session time zone; NULL when malformed."""
    stamp = F.try_to_timestamp(F.concat_ws(" ", date, minute), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.unix_millis(stamp).cast("string")


# -- the query string -------------------------------------------------------


def segments(query: Column) -> Column:
    """The ``K=V`` segments, last first, without trailing ``=``.

    ``K``, ``K=`` and ``K==`` all become ``K``, a key without a value.
    """

    def trimmed(s: Column) -> Column:
        return F.when(F.endswith(s, F.lit("=")), F.rtrim(s, F.lit("="))).otherwise(s)

    return F.transform(F.reverse(F.split(query, "&")), trimmed)


def segment_keys(segs: Column) -> Column:
    """The key of each segment; empty if its value contains ``=``, which drops the pair."""

    def key(s: Column) -> Column:
        return F.when(F.substring_index(s, "=", 2) == s, F.substring_index(s, "=", 1)).otherwise("")

    return F.transform(segs, key)


def last_segment(segs: Column, keys: Column, key: Column | str) -> Column:
    """The segment that sets ``key``, the last one if repeated; NULL if absent."""
    return F.get(segs, (F.array_position(keys, key) - 1).cast("int"))


def padded_query(query: Column) -> Column:
    """The query string with a separator on both sides, for :func:`field_value`."""
    return F.concat(F.lit("&"), query, F.lit("&"))


def raw_value(padded: Column, key: str) -> Column:
    """The text behind the last ``&K=``, up to the next separator; empty if there is none."""
    return F.substring_index(F.substring_index(padded, f"&{key}=", -1), "&", 1)


def field_value(padded: Column, raw: Column, key: str, empty: str = EMPTY_VALUE) -> Column:
    """The value of one parameter, by the rules of :func:`segments`; NULL if absent.

    It is the :func:`raw_value` unless that is empty or holds a further ``=``, or the key also
    stands without one; those rows take a pattern. All of it is generated code,
    where arrays of segments are interpreted.
    """
    pattern = rf"(?s)^.*&{key}(?:=([^&=]*)=*)?&"
    plain = (raw != "") & ~F.contains(raw, F.lit("=")) & ~F.contains(padded, F.lit(f"&{key}&"))
    absent = ~F.contains(padded, F.lit(f"&{key}"))
    found = F.coalesce(F.nullif(F.regexp_extract(padded, pattern, 1), F.lit("")), F.lit(empty))
    return F.when(plain, raw).when(absent, F.lit(None).cast("string")).when(padded.rlike(pattern), found)


def parameter_map(segs: Column, keys: Column, empty: str = EMPTY_VALUE) -> Column:
    """All parameters as a map, by the same rules; pairs without a key are dropped.

    Keys are made distinct before the map is built, so the result does not
    depend on ``spark.sql.mapKeyDedupPolicy``.
    """

    def entry(key: Column) -> Column:
        value = F.substr(last_segment(segs, keys, key), F.length(key) + 2)
        return F.struct(
            key.alias("key"), F.coalesce(F.nullif(value, F.lit("")), F.lit(empty)).alias("value")
        )

    distinct = F.array_distinct(F.filter(keys, lambda k: k != ""))
    return F.map_from_entries(F.transform(distinct, entry))


def url_decode(text: Column, times: int = 3) -> Column:
    """Percent-decode ``times`` times; malformed text becomes ``NULL`` the word."""
    decoded = text
    for _ in range(times):
        decoded = F.try_url_decode(decoded)
    return F.when(text.isNotNull(), F.coalesce(decoded, F.lit(EMPTY_VALUE)))
