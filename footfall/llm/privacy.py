"""Personal data: patterns, and terms that disclose it by co-occurrence; DataFrame expressions only.

Emails, IP addresses, card and phone numbers are found by pattern. Then the whole
corpus says which terms give them away: a term occurs with a kind of personal data, and with the value that
stands there, where it is within ``CONTEXT`` characters of it. The pointwise mutual information of term and
kind or value, as a share of the information of the kind or value itself (which it reaches when the
term never stands elsewhere), is the term's disclosure. Counts are smoothed: each term has ``PRIOR``
further occurrences, beside the kind or value as often as any term is, so terms seen once score
less than those seen often, and none is left out for being rare. A kind or value counts as ``INFORMATION`` bits at most;
beyond so many terms (a million) the verdict on a term does not depend on the size of the corpus.
Terms are cut at the edges of personal data, for all counts.
In the neighbourhood of such data, terms from ``generalise_from`` on are replaced by a placeholder, from
``remove_from`` on they are removed. ``least_contexts`` (off by default) also asks for so many different contexts.

Null and empty texts hold nothing. Repeated rows get equal results (each counts in the
corpus); null ids are carried through. Overlapping spans are all reported, and replaced as one. Ties
between spans go by start, then kind in the order email, ip, card, phone, term. An empty table gives an empty
one; a very long text is searched whole, in one row. Other
columns are left out of the report and kept by ``sanitised``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import free_name, stored

#: In this order; each with a cheap test, the pattern, and the test of a match.
KINDS = ("email", "ip", "card", "phone")
TERM_KIND = len(KINDS)
_LOCAL = "[A-Za-z0-9._%+-]"
#: A match starts where a run of its characters does, or where the last match ended.
_EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: A whole chain of digits with single separators, of 12 to 19 digits.
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TERM = r"[\p{L}\p{N}](?:\S*[\p{L}\p{N}])?"
CONTEXT = 48
#: Occurrences added to each term, beside personal data as often as any term is.
PRIOR = 3
#: Bits that a kind or value is taken to hold at most, so that thresholds mean the same in any larger corpus.
INFORMATION = 20
#: Terms to replace are broadcast up to so many bytes.
BROADCAST_BYTES = 8 << 20
#: Bytes of a term to replace, and of the row that holds those of a text.
_TERM_BYTES, _ROW_BYTES = 32, 64

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def located(text: Column, pattern: str, kind: int, valid) -> Column:
    """Spans of the non-overlapping matches for which ``valid`` holds."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(
        gaps,
        matches,
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"), F.length(match).alias("length"), valid(match).alias("valid")
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def extend(state, step):
        start = state["at"] + step["gap"]
        end = start + step["length"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(
            end.alias("at"),
            F.when(step["valid"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(steps, empty, extend, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """All spans found by pattern, by start, then kind."""
    digits = lambda match: F.length(F.regexp_replace(match, "[^0-9]", ""))
    rules = (
        (F.contains(text, F.lit("@")), _EMAIL, lambda m: F.lit(True)),
        (text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), _IP, lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        (text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), _CARD, lambda m: F.call_function("luhn_check", F.regexp_replace(m, "[ -]", ""))),
        (F.contains(text, F.lit("+")), _PHONE, lambda m: digits(m).between(9, 15)),
    )
    none = F.array().cast(_SPANS)
    found = [
        F.when(possible, located(text, pattern, kind, valid)).otherwise(none)
        for kind, (possible, pattern, valid) in enumerate(rules)
    ]
    return F.array_sort(F.concat(*found))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")
    )


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with spaces for all that ``spans`` (by start) cover, at the same length."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def extend(state, s):
        start, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        between = F.substring(text, state["at"] + 1, start - state["at"])
        return F.struct(
            end.alias("at"), F.concat(state["parts"], F.array(between, F.repeat(F.lit(" "), end - start))).alias("parts")
        )

    def finish(state):
        rest = F.substring(text, state["at"] + 1, F.length(text) - state["at"])
        return F.concat(F.array_join(state["parts"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, empty, extend, finish)).otherwise(text)


def protected(kind: Column, value: Column) -> Column:
    """What a term may disclose: the kind of a match, and its value, however it is written."""
    plain = F.when(kind.isin(KINDS.index("card"), KINDS.index("phone")), F.regexp_replace(value, "[^0-9]", ""))
    return F.array(kind.cast("bigint"), F.xxhash64(kind, plain.otherwise(F.lower(value))))


def context_terms(docs: DataFrame) -> DataFrame:
    """``row, target, start, end, term, context, copies`` for each term near personal data and outside of it.

    A target is a kind or a value; ``copies`` is the number of rows with that id and text.
    """
    found = _texts(docs).withColumn("spans", base_spans(F.col("text"))).where(F.size("spans") > 0)
    found = found.withColumn("blanked", blanked(F.col("text"), F.col("spans")))
    text, outside, length = F.col("text"), F.col("blanked"), F.length("text")

    def sides(span):
        # One character more, to leave out a run that begins before the context or ends behind it.
        first, last = span["start"] - CONTEXT - 1, span["end"] + CONTEXT + 1
        offset = F.greatest(first, F.lit(0))
        before = F.substring(outside, offset + 1, span["start"] - offset)
        whole = F.when(first >= 0, F.regexp_replace(before, r"^\S++", "")).otherwise(before)
        after = F.substring(outside, span["end"] + 1, F.least(last, length) - span["end"])
        after = F.when(last <= length, F.regexp_replace(after, r"(?<!\S)\S++$", "")).otherwise(after)
        targets = protected(span["kind"], F.substring(text, span["start"] + 1, span["end"] - span["start"]))
        own = [targets.alias("targets"), span["start"].alias("span"), span["end"].alias("span_end")]
        return F.array(
            F.struct(*own, (span["start"] - F.length(whole)).alias("offset"), whole.alias("side")),
            F.struct(*own, span["end"].alias("offset"), after.alias("side")),
        )

    rows = found.select("row", F.explode(F.flatten(F.transform("spans", sides))).alias("s")).select("row", "s.*")
    terms = rows.select(
        "row", "targets", "span", "span_end", "offset", "side",
        F.xxhash64("side").alias("context"),
        F.explode(located(F.col("side"), _TERM, TERM_KIND, lambda m: F.lit(True))).alias("t"),
    )
    start, end = F.col("offset") + F.col("t.start"), F.col("offset") + F.col("t.end")
    term = F.lower(F.substring(F.col("side"), F.col("t.start") + 1, F.col("t.end") - F.col("t.start")))
    found = terms.select(
        "row", F.explode("targets").alias("target"), "span", "span_end",
        start.alias("start"), end.alias("end"), term.alias("term"), "context",
    )
    one = found.groupBy("row", "target", "start", "end", "term", "span", "span_end").agg(
        F.count(F.lit(1)).alias("copies"), F.min("context").alias("context")
    )
    return one.groupBy("row", "target", "start", "end", "term").agg(
        F.max("copies").alias("copies"), F.min("context").alias("context")
    )


def disclosing_terms(
    docs: DataFrame, terms: DataFrame, least_contexts: int, generalise_from: float
) -> DataFrame:
    """``term, target, disclosure`` of the terms that reach ``generalise_from``, over the whole corpus."""
    sums = [F.sum("copies").alias("together")]
    if least_contexts > 1:
        sums.append(F.countDistinct("context").alias("contexts"))
    near = stored(terms.groupBy("term", "target").agg(*sums))
    # the few kinds stand beside a large part of all terms: their totals are numbers in the plan, only values are joined
    is_kind = F.col("target").between(0, len(KINDS) - 1)
    totals = near.groupBy("target").agg(F.sum("together").alias("n_target"))
    of_kind = {row.target: row.n_target for row in totals.where(is_kind).collect()}
    targets = totals.where(~is_kind)
    wanted = near.where(F.col("contexts") >= least_contexts) if least_contexts > 1 else near
    names = wanted.select(F.col("term").alias("wanted")).distinct()
    outside = blanked(F.col("text"), F.col("spans"))
    words = _texts(docs).withColumn("spans", base_spans(F.col("text"))).select(
        F.explode(F.regexp_extract_all(outside, F.lit(_TERM), F.lit(0))).alias("term")
    )
    counts = words.groupBy(F.lower("term").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    counts = stored(
        counts.join(names, F.col("term") == F.col("wanted"), "left").groupBy("wanted").agg(F.sum("n").alias("n"))
    )
    total = counts.agg(F.sum("n")).first()[0] or 1
    beside_kind = F.coalesce(*[F.when(F.col("target") == kind, F.lit(n)) for kind, n in of_kind.items()], F.lit(0))
    with_total = (
        wanted.where(is_kind)
        .withColumn("n_target", beside_kind.cast("bigint"))
        .unionByName(wanted.where(~is_kind).join(targets, "target"))
    )
    usual = F.col("n_target") / F.lit(float(total))
    share = (F.col("together") + PRIOR * usual) / (F.col("n") + PRIOR)
    known = F.greatest(usual, F.lit(2.0**-INFORMATION))
    return (
        with_total.join(counts, F.col("term") == F.col("wanted"))
        .withColumn("disclosure", F.try_divide(F.log2(share / known), -F.log2(known)))
        .where(F.col("disclosure") >= generalise_from)
        .select("term", "target", "disclosure")
    )


def term_spans(
    docs: DataFrame, least_contexts: int = 1, generalise_from: float = 0.75, remove_from: float = 0.95
) -> DataFrame:
    """``row, terms``: for each row with any, the terms to replace, as spans, and whether to remove them."""
    terms = stored(context_terms(docs))
    known = disclosing_terms(docs, terms, least_contexts, generalise_from)
    remove = F.max(F.col("disclosure") >= remove_from)
    return (
        terms.join(known, ["term", "target"])
        .groupBy("row", "start", "end")
        .agg(remove.alias("remove"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", F.lit(TERM_KIND).alias("kind"), "end", "remove"))).alias("terms"))
    )


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in (*KINDS, "term")))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame, **thresholds) -> DataFrame:
    """Counts, a digest of the spans found by pattern, and all spans, for each row of ``docs``."""
    base = _texts(docs).select("row", "doc_id", base_spans(F.col("text")).alias("base"))
    terms = term_spans(docs, **thresholds).withColumnRenamed("row", "row_")
    joined = base.join(terms, F.col("row") == F.col("row_"), "left")
    plain = F.transform(
        F.coalesce("terms", F.array().cast("array<struct<start:int,kind:int,end:int,remove:boolean>>")),
        lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")),
    )
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{name}")
        for kind, name in enumerate(KINDS)
    ]
    return joined.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", plain))).alias("spans"),
    )


def sanitised(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; ``n_chars``, if any, follows."""
    own_row, own_terms, own_spans, own_clean = (
        free_name(docs, name) for name in ("_row", "_terms", "_spans", "_clean")
    )
    terms = stored(term_spans(docs, **thresholds).select(F.col("row").alias(own_row), F.col("terms").alias(own_terms)))
    size = terms.agg(F.sum(F.size(own_terms) * _TERM_BYTES + _ROW_BYTES)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        terms = F.broadcast(terms)
    joined = docs.join(terms, F.xxhash64(docs["doc_id"], docs["text"]) == terms[own_row], "left")
    base = F.transform(
        base_spans(F.coalesce("text", F.lit(""))),
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("remove")
        ),
    )
    spans = F.array_sort(F.concat(base, F.coalesce(own_terms, F.array().cast("array<struct<start:int,kind:int,end:int,remove:boolean>>"))))
    marks = F.array(*(F.lit(f"<{kind.upper()}>") for kind in (*KINDS, "term")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    text = F.col("text")

    def extend(state, s):
        mark = F.when(s["remove"], F.lit("")).otherwise(F.get(marks, s["kind"]))
        fresh = s["start"] >= state["at"]
        between = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["parts"], F.array(between, mark))).otherwise(state["parts"]).alias("parts"),
        )

    def finish(state):
        rest = F.substring(text, state["at"] + 1, F.length(text) - state["at"])
        return F.concat(F.array_join(state["parts"], ""), rest)

    found = joined.withColumn(own_spans, spans)
    clean = F.when(F.size(own_spans) > 0, F.aggregate(own_spans, empty, extend, finish)).otherwise(text)
    found = found.withColumn(own_clean, clean)
    replaced = {"text": F.col(own_clean), "n_chars": F.length(own_clean).cast("bigint")}
    return found.select(*(replaced.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
