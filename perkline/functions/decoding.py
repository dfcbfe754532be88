"""Columns that turn change-data wire values into typed values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

_LONG_BYTES = 8


def micros_to_timestamp(micros: Column, whole_seconds: bool = False) -> Column:
    """Micro-epoch to a timestamp without zone; NULL stays NULL.

    The fraction is kept. ``whole_seconds`` drops it, for results that have to match a
    table written by a second-precision ingest. The session's time zone has no part in it.
    """
    if whole_seconds:
        micros = micros - F.pmod(micros, F.lit(1_000_000))
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def unscaled_integer(encoded: Column) -> Column:
    """Base64 of a signed big-endian integer to a long.

    The hex text is sign-extended to 64 bits, then read as a signed number. Bad
    base64 and integers beyond 8 bytes give NULL; a NUMERIC(10,2) needs 5 bytes.
    """
    raw = F.try_to_binary(encoded, F.lit("base64"))
    digits = F.hex(raw)
    fill = F.when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    extended = F.lpad(digits, 2 * _LONG_BYTES, fill)
    return F.when(F.octet_length(raw) <= _LONG_BYTES, F.conv(extended, 16, -10).cast("long"))


def connect_decimal(encoded: Column, scale: int = 2, precision: int = 10) -> Column:
    """Connect Decimal to ``decimal(precision, scale)``; undecodable or too large: NULL."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    exact = unscaled_integer(encoded).cast("decimal(20,0)") * unit
    return exact.try_cast(f"decimal({precision},{scale})")
