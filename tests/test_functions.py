"""Column functions against plain Python on edge cases and on many generated values."""

import base64
import datetime as dt
import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from perkline import fixed_values as fixed
from perkline.functions import decoding, periods, texts


def encode(number: int) -> str:
    size = (number if number >= 0 else number + 1).bit_length() // 8 + 1
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_integers_of_all_sizes_are_decoded(spark):
    random.seed(7)
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256, 2**63 - 1, -(2**63)]
    numbers += [random.randint(-(2**b), 2**b) for b in range(1, 63) for _ in range(5)]
    assert column(spark, [encode(n) for n in numbers], "string", decoding.unscaled_integer) == numbers


def test_decimals_known_answers(spark):
    encoded = ["B6Eg", "CSfA", "/w==", "AA==", "", None, "%%%", encode(2**64), encode(10**12)]
    assert column(spark, encoded, "string", decoding.connect_decimal) == [
        Decimal("5000.00"),
        Decimal("6000.00"),
        Decimal("-0.01"),
        Decimal("0.00"),
        Decimal("0.00"),
        None,
        None,
        None,  # beyond eight bytes
        None,  # does not fit ten digits
    ]


def test_redundant_sign_bytes_are_accepted(spark):
    padded = base64.b64encode((-5).to_bytes(8, "big", signed=True)).decode()
    assert column(spark, [padded], "string", decoding.unscaled_integer) == [-5]


def test_micro_timestamps(spark):
    micros = [1790475303158506, 0, -1, None]
    assert column(spark, micros, "long", decoding.micros_to_timestamp) == [
        dt.datetime(2026, 9, 27, 2, 15, 3, 158506),
        dt.datetime(1970, 1, 1),
        dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
        None,
    ]
    assert column(spark, micros[:1], "long", lambda c: decoding.micros_to_timestamp(c, whole_seconds=True)) == [
        dt.datetime(2026, 9, 27, 2, 15, 3)
    ]


def duration(start, end):
    if start is None or end is None:
        return "durée inconnue"
    total = int((end - start).total_seconds() // 60)
    hours, minutes = divmod(total, 60)
    if hours == 0:
        return f"{minutes} min"
    return f"{hours} h" if minutes == 0 else f"{hours} h {minutes} min"


def test_durations(spark):
    start = dt.datetime(2024, 3, 1, 8, 0, 0, 250000)
    seconds = [0, 59, 60, 2760, 5400, 7200, 7259, 86400, 90061, -30, -3600, -5000]
    pairs = [(start, start + dt.timedelta(seconds=s, microseconds=1)) for s in seconds]
    pairs += [(None, start), (start, None)]
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz"
    )
    found = df.orderBy("i").select(texts.duration_text(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [duration(a, b) for a, b in pairs]
    assert duration(*pairs[3]) == "46 min" and duration(*pairs[4]) == "1 h 30 min"


def test_distances_round_ties_to_even(spark):
    metres = [Decimal(m) for m in ("6000.00", "10800.00", "0.00", "6005.00", "6015.00", "4.99", "-20.00")]
    expected = [
        f"{(m / 1000).quantize(Decimal('0.01'), ROUND_HALF_EVEN)} km" for m in metres
    ]
    assert column(spark, metres, "decimal(10,2)", texts.distance_text) == expected
    assert expected[0] == "6.00 km"


def test_missing_and_invalid_distances_differ(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "%%%", None), (3, "B6Eg", Decimal("5000.00"))],
        "i int, wire string, metres decimal(10,2)",
    )
    found = df.orderBy("i").select(texts.distance_text(F.col("metres"), F.col("wire"))).collect()
    assert [r[0] for r in found] == ["Distance non renseignée", "Distance invalide", "5.00 km"]


def test_comma_style(spark):
    metres = [Decimal("10800.00"), Decimal("950.00"), None]
    found = column(spark, metres, "decimal(10,2)", lambda c: texts.distance_text(c, style="comma"))
    assert found == ["10,8 km", "1,0 km", None]
    with pytest.raises(ValueError):
        texts.distance_text(F.col("x"), style="other")


def test_message_leaves_out_what_is_absent(spark):
    df = spark.createDataFrame(
        [(1, "6.00 km", "Belle séance !"), (2, None, None), (3, "", "")],
        "i int, distance string, comment string",
    )
    message = texts.message_text(
        F.lit("Ana"), F.lit("Roux"), F.lit("Tennis"), F.lit("46 min"), F.col("distance"), F.col("comment")
    )
    found = [r[0] for r in df.orderBy("i").select(message).collect()]
    short = "Bravo Ana Roux ! Tu viens de terminer une activité Tennis en 46 min ! 🔥🏅"
    assert found == [
        "Bravo Ana Roux ! Tu viens de terminer une activité Tennis de 6.00 km en 46 min ! 🔥🏅\n💬 Belle séance !",
        short,
        short,
    ]


def test_reason_prints_thresholds_without_zeros(spark):
    limits = [Decimal(x) for x in ("15.00", "25.50", "100.00", "0.25")]
    found = column(spark, limits, "decimal(10,2)", lambda c: texts.commute_reason(F.lit(True), c))
    assert found == [fixed.REASON_VALID % f"{float(x):g}" for x in limits]


@pytest.mark.parametrize(
    ("as_of", "first_day"),
    [
        (dt.date(2025, 1, 24), dt.date(2024, 1, 24)),
        (dt.date(2024, 2, 29), dt.date(2023, 2, 28)),
        (dt.datetime(2025, 3, 31, 17, 5), dt.date(2024, 3, 31)),
    ],
)
def test_window_bounds(spark, as_of, first_day):
    midnight = dt.datetime.combine(first_day, dt.time())
    moments = [midnight - dt.timedelta(microseconds=1), midnight, dt.datetime(2030, 1, 1), None]
    found = column(
        spark,
        moments,
        "timestamp_ntz",
        lambda c: F.array(
            periods.in_window(c, as_of), periods.in_window(c, as_of, bounded=True), periods.too_old(c, as_of)
        ),
    )
    assert found == [
        [False, False, True],
        [True, True, False],
        [True, False, False],
        [None, None, None],
    ]
