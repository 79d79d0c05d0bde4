"""Column expressions shared by the operators. Everything here stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
WORD_PATTERN = r"([\p{L}\p{N}_]+)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(ts: Column | str) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def span_micros(later: Column | str, earlier: Column | str) -> Column:
    return micros(later) - micros(earlier)


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed days rounded down."""
    return F.floor(span_micros(later, earlier) / F.lit(DAY_MICROS))


def half_even(value: Column | str, places: int = 0) -> Column:
    return F.bround(as_column(value), places)


def divide(top: Column, bottom: Column, when_zero: float | None = None) -> Column:
    """Division with an explicit answer for a zero denominator."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(when_zero).cast("double"))


def strip_quotes(text: Column | str) -> Column:
    """Remove blanks and double quotes from both ends."""
    return F.regexp_replace(as_column(text), r'^[ "]+|[ "]+$', "")


def words(text: Column | str) -> Column:
    """Word tokens of a text, in order and in their own case."""
    return F.regexp_extract_all(as_column(text), F.lit(WORD_PATTERN), F.lit(1))


def pearson(vx: Column, vy: Column, vxy: Column) -> Column:
    """Correlation from central moments; 0 without overlap or without variance on either side, never outside -1 to 1."""
    value = vxy / (F.sqrt(vx) * F.sqrt(vy))
    return F.when((vx > 0) & (vy > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))).otherwise(F.lit(0.0))
