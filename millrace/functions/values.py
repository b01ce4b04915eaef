"""Column expressions that give null, never an error, on values they cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_text(value: Column) -> Column:
    """Bytes as text; null when the bytes are not UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def undecoded_bytes(value: Column) -> Column:
    """The bytes that ``utf8_text`` cannot read; null for all others."""
    return F.when(utf8_text(value).isNull(), value)


def whole_number(text: Column) -> Column:
    """Integer from text such as ``1`` or ``1.0``, cut toward zero."""
    return text.try_cast("double").try_cast("int")


def instant(text: Column) -> Column:
    """Timestamp from any ISO-like text that has a full date.

    A time without a date would be read as today's, so it is refused.
    """
    dated = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(dated, F.try_to_timestamp(text))


def epoch_millis(local_time: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    return F.timestamp_diff("MILLISECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), local_time)


def round_half_up(value: Column, places: int = 2) -> Column:
    """Round a double by its decimal value, so that x.xx5 always goes up.

    Rounding the double itself depends on the last bit, which depends on the order in which
    partitions were added. NaN, infinities and numbers beyond 29 digits stay as they are.
    """
    exact = F.round(value.try_cast("decimal(38,9)"), places).cast("double")
    return F.coalesce(exact, value)
