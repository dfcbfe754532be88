"""Display texts. All are plain column expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from perkline import fixed_values as fixed

_MICROS_PER_MINUTE = 60_000_000


def plain_number(value: Column, scale: int = 2) -> Column:
    """Decimal as text without trailing zeros: 15.00 -> 15, 25.50 -> 25.5."""
    return F.regexp_replace(value.cast(f"decimal(20,{scale})").cast("string"), r"\.?0+$", "")


def duration_text(start: Column, end: Column) -> Column:
    """``46 min``, ``1 h 30 min``, ``2 h``; started minutes are dropped."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    # Integer arithmetic that floors, also for an end before its start.
    total = ((micros - F.pmod(micros, F.lit(_MICROS_PER_MINUTE))) / _MICROS_PER_MINUTE).cast("long")
    minutes = F.pmod(total, F.lit(60))
    hours = ((total - minutes) / 60).cast("long")
    return (
        F.when(start.isNull() | end.isNull(), F.lit(fixed.DURATION_UNKNOWN))
        .when(hours == 0, F.concat(minutes, F.lit(" min")))
        .when(minutes == 0, F.concat(hours, F.lit(" h")))
        .otherwise(F.concat(hours, F.lit(" h "), minutes, F.lit(" min")))
    )


def kilometres(metres: Column) -> Column:
    """Metres to kilometres without leaving decimal arithmetic."""
    return metres.cast("decimal(20,2)") / F.lit(1000).cast("decimal(4,0)")


def distance_text(metres: Column, encoded: Column | None = None, style: str = "point") -> Column:
    """Distance for a message.

    ``point``: ``6.00 km`` with texts for a missing or undecodable value.
    ``comma``: ``10,8 km``, and NULL where there is no distance.
    ``encoded`` is the value before decoding; it tells "missing" from "invalid".
    Ties round to the even digit.
    """
    if style == "comma":
        number = F.bround(kilometres(metres), 1).cast("decimal(20,1)").cast("string")
        return F.when(metres.isNotNull(), F.concat(F.replace(number, F.lit("."), F.lit(",")), F.lit(" km")))
    if style != "point":
        raise ValueError(f"unknown distance style: {style}")
    number = F.bround(kilometres(metres), 2).cast("decimal(20,2)").cast("string")
    source = metres if encoded is None else encoded
    return (
        F.when(source.isNull(), F.lit(fixed.DISTANCE_MISSING))
        .when(metres.isNull(), F.lit(fixed.DISTANCE_INVALID))
        .otherwise(F.concat(number, F.lit(" km")))
    )


def _filled(template: str, *values: Column) -> Column:
    pieces = template.split("%s")
    columns = [F.lit(pieces[0])]
    for value, after in zip(values, pieces[1:]):
        columns += [value, F.lit(after)]
    return F.concat(*columns)


def message_text(
    first_name: Column,
    last_name: Column,
    sport: Column,
    duration: Column,
    distance: Column,
    comment: Column,
) -> Column:
    """Congratulation text; distance and comment appear only where they have content."""

    def present(value: Column) -> Column:
        return value.isNotNull() & (value != "")

    return F.concat(
        _filled(fixed.MESSAGE_START, first_name, last_name, sport),
        F.when(present(distance), _filled(fixed.MESSAGE_DISTANCE, distance)).otherwise(F.lit("")),
        _filled(fixed.MESSAGE_DURATION, duration),
        F.when(present(comment), _filled(fixed.MESSAGE_COMMENT, comment)).otherwise(F.lit("")),
    )


def commute_reason(is_valid: Column, threshold: Column) -> Column:
    number = plain_number(threshold)
    return F.when(is_valid, _filled(fixed.REASON_VALID, number)).otherwise(
        _filled(fixed.REASON_INVALID, number)
    )
