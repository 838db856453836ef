"""Thread kind and month from the title."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as V

# (?U) makes \w and \d cover all scripts.
_MONTH_AND_YEAR = r"(?U)\((\w+)\s+(\d{4})\)"


def classify_kind(title: Column) -> Column:
    """hiring / seekers / freelancer / other; case-sensitive, first rule wins."""
    return (
        F.when(title.startswith(V.HIRING_PREFIX), "hiring")
        .when(title.contains(V.SEEKERS_PHRASE), "seekers")
        .when(title.contains(V.FREELANCER_WORD), "freelancer")
        .otherwise("other")
    )


def month_prefix(created_at: Column) -> Column:
    """``YYYY-MM`` taken from an ISO timestamp, NULL when it is shorter than that."""
    return F.when(F.length(created_at) >= 7, F.substring(created_at, 1, 7))


def parse_month(title: Column, fallback: Column) -> Column:
    """``(July 2026)`` -> ``2026-07``.

    Only the first parenthesised word and year counts: when its word is no month the
    fallback is used, even if a later one would do.
    """
    name = F.lower(F.regexp_extract(title, _MONTH_AND_YEAR, 1))
    year = F.regexp_extract(title, _MONTH_AND_YEAR, 2)
    number = F.array_position(F.array(*map(F.lit, V.MONTH_NAMES)), name)
    return F.when(number > 0, F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0"))).otherwise(
        fallback
    )
