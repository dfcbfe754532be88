"""Table shapes. The order of columns is the order in which tables are written."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

EMPLOYEES = T.StructType(
    [
        T.StructField("employee_id", T.IntegerType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("first_name", T.StringType(), False),
        T.StructField("birth_date", T.DateType(), False),
        T.StructField("business_unit", T.StringType(), False),
        T.StructField("hire_date", T.DateType(), False),
        T.StructField("gross_salary", MONEY, False),
        T.StructField("contract_type", T.StringType(), False),
        T.StructField("paid_leave_days", T.IntegerType(), False),
        T.StructField("home_address", T.StringType(), False),
        T.StructField("commute_mode", T.StringType(), False),
    ]
)

SPORT_PROFILE = T.StructType(
    [
        T.StructField("employee_id", T.IntegerType(), False),
        T.StructField("sport_type", T.StringType(), True),
    ]
)

ACTIVITIES = T.StructType(
    [
        T.StructField("activity_id", T.IntegerType(), False),
        T.StructField("employee_id", T.IntegerType(), False),
        T.StructField("start_datetime", T.TimestampNTZType(), False),
        T.StructField("sport_type", T.StringType(), False),
        T.StructField("distance_meters", MONEY, True),
        T.StructField("end_datetime", T.TimestampNTZType(), False),
        T.StructField("comment", T.StringType(), True),
    ]
)

COMMUTE_VALIDATION = T.StructType(
    [
        T.StructField("employee_id", T.IntegerType(), False),
        T.StructField("distance_km", MONEY, False),
        T.StructField("threshold_km", MONEY, True),
        T.StructField("is_sport_commute", T.BooleanType(), False),
        T.StructField("is_valid", T.BooleanType(), False),
        T.StructField("validation_reason", T.StringType(), True),
    ]
)

BENEFIT_COLUMNS = (
    "employee_id",
    "first_name",
    "last_name",
    "business_unit",
    "gross_salary",
    "commute_mode",
    "commute_distance_km",
    "is_sport_commute",
    "commute_validated",
    "activity_count",
    "total_distance_meters",
    "sport_bonus_eligible",
    "sport_bonus_amount",
    "wellbeing_days_eligible",
    "wellbeing_days_awarded",
    "calculation_date",
)

# Reporting leaves the free comment out.
ACTIVITY_EXPORT_COLUMNS = (
    "activity_id",
    "employee_id",
    "start_datetime",
    "sport_type",
    "distance_meters",
    "end_datetime",
)


def envelope(id_type: T.DataType | None = None) -> T.StructType:
    """The part of a change envelope we read.

    Times are micro-epochs and the decimal is base64 text, so both stay as they
    travel and are decoded afterwards.
    """
    key = id_type or T.IntegerType()
    after = T.StructType(
        [
            T.StructField("activity_id", key),
            T.StructField("employee_id", key),
            T.StructField("start_datetime", T.LongType()),
            T.StructField("sport_type", T.StringType()),
            T.StructField("distance_meters", T.StringType()),
            T.StructField("end_datetime", T.LongType()),
            T.StructField("comment", T.StringType()),
        ]
    )
    before = T.StructType([T.StructField("activity_id", key)])
    payload = T.StructType(
        [
            T.StructField("before", before),
            T.StructField("after", after),
            T.StructField("op", T.StringType()),
        ]
    )
    return T.StructType([T.StructField("payload", payload)])
