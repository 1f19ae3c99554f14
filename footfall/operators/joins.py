"""Joins of a large fact side to a lookup table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join each fact row to the lookup, whatever the lookup's size.

    Facts are on the left, where adaptive execution may split a hot key's partition;
    whether the lookup is broadcast is Catalyst's choice.
    """
    if how not in ("inner", "left"):
        raise ValueError("facts are on the left of an inner or left join")
    return facts.join(lookup, list(on), how)
