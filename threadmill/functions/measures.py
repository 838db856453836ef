"""Report measures: shares, bar levels, labels, costs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as V
from .text import is_blank


def percent(n: Column, total: Column) -> Column:
    """``n`` as a percentage of ``total``; 0 when there is nothing to divide by."""
    return F.coalesce(n / F.nullif(total, F.lit(0)) * 100, F.lit(0.0))


def level_index(n: Column, largest: Column) -> Column:
    """0..7: how tall a bar of ``n`` is next to the largest one."""
    top = len(V.LEVEL_GLYPHS) - 1
    return F.least(F.floor(n / F.greatest(largest, F.lit(1)) * top), F.lit(top)).cast("int")


def level_glyph(n: Column, largest: Column) -> Column:
    return F.substring(F.lit(V.LEVEL_GLYPHS), level_index(n, largest) + 1, F.lit(1))


def null_label(value: Column) -> Column:
    return F.when(is_blank(value), "null").otherwise(value)


def year_bucket(month: Column) -> Column:
    return F.substring(F.coalesce(month, F.lit("0000")), 1, 4)


def token_cost(
    input_tokens: Column, output_tokens: Column, input_rate: Column, output_rate: Column
) -> Column:
    """USD, with rates per million tokens; a missing rate costs nothing."""

    def part(tokens: Column, rate: Column) -> Column:
        return F.coalesce(tokens, F.lit(0)) / 1_000_000 * F.coalesce(rate, F.lit(0.0))

    return part(input_tokens, input_rate) + part(output_tokens, output_rate)
