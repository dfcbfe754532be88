"""How the shared tables play the library's tables.

Each role is a DataFrame over a *whole* table and, under the same name in
``SQL``, the same thing as a DuckDB common table expression.

The shared tables have next to no faults, so ``recorded`` derives faults from the
values of every event (a small value makes a wrong end, a large one loses its
employee, …). Nothing is left out and nothing is sampled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = dt.date(2025, 1, 24)
# Bounds of the period reports, inside the month the events cover.
PERIOD_START = dt.datetime(2024, 1, 3)
PERIOD_END = dt.datetime(2024, 1, 28, 12)

RULES = {"BUILDING": ("WALK", "15.00"), "MACHINERY": ("BICYCLE", "25.00")}


# Declared, so that no job has to open files just to learn the columns.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("employee_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_name").alias("business_unit"),
        F.col("c_acctbal").cast("decimal(10,2)").alias("gross_salary"),
        F.col("c_mktsegment").alias("commute_mode"),
    )


def commute_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measured distance for every employee."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("employee_id"),
        F.col("c_mktsegment").alias("commute_mode"),
        ((key * 7) % 40 + 0.5).cast("decimal(12,3)").alias("distance_km"),
    )


def commute_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, metre-exact around the limits, and unknown for overdrawn accounts."""
    key = F.col("c_custkey")
    metres = ((key * 7) % 40) * 1000 + F.when(F.col("c_acctbal") < 5000, 0).otherwise(4)
    return table(spark, sf_dir, "customer").select(
        key.alias("employee_id"),
        F.col("c_mktsegment").alias("commute_mode"),
        F.when(F.col("c_acctbal") >= 0, (metres.cast("decimal(9,0)") / 1000).cast("decimal(12,3)")).alias(
            "distance_km"
        ),
    )


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("decimal(10,2)")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("activity_id"),
        F.col("user_id").alias("employee_id"),
        F.col("ts").alias("start_datetime"),
        F.col("event_type").alias("sport_type"),
        (value * 100).cast("decimal(10,2)").alias("distance_meters"),
        F.timestamp_add("SECOND", (value * 60).cast("long"), F.col("ts")).alias("end_datetime"),
        F.col("props").alias("comment"),
    )


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities as a careless source would have recorded them; large purchases come twice."""
    events = table(spark, sf_dir, "events")
    v = F.col("value").cast("decimal(10,2)")
    kind = F.col("event_type")
    delivered = events.unionByName(events.filter((kind == "purchase") & (F.col("value") >= 100)))
    return delivered.select(
        F.when(v < 250, F.col("event_id")).alias("activity_id"),
        F.when(v < 200, F.col("user_id")).alias("employee_id"),
        F.when((v < 1) & (kind == "click"), None).otherwise(F.col("ts")).alias("start_datetime"),
        F.when((kind == "error") & (v < 20), F.lit("  "))
        .when((kind == "error") & (v < 40), None)
        .otherwise(kind)
        .alias("sport_type"),
        F.when((kind == "view") & (v < 10), -v * 100)
        .when(kind != "signup", v * 100)
        .cast("decimal(10,2)")
        .alias("distance_meters"),
        F.when(
            v < 180, F.timestamp_add("SECOND", ((v.cast("int") - 5) * 60).cast("long"), F.col("ts"))
        ).alias("end_datetime"),
        F.col("props").alias("comment"),
    )


def accepted_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees whose record passes the salary rule; the others were never loaded."""
    return employees(spark, sf_dir).filter("gross_salary > 0")


def sport_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sport seen per employee; undeclared where that was an error."""
    events = table(spark, sf_dir, "events")
    first = events.groupBy(F.col("user_id").alias("employee_id")).agg(
        F.min_by("event_type", "event_id").alias("sport_type")
    )
    return first.withColumn("sport_type", F.nullif("sport_type", F.lit("error")))


def operation(event_type) -> F.Column:
    """Kind of change an event stands for."""
    return (
        F.when(event_type == "signup", "r")
        .when(event_type == "error", "d")
        .when(event_type == "view", "u")
        .otherwise("c")
    )


def encoded_decimal(unscaled) -> F.Column:
    """Long to base64 of its shortest signed big-endian form."""
    digits = F.hex(unscaled)
    even = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    signed = F.when((unscaled >= 0) & (F.substring(even, 1, 1) >= "8"), F.concat(F.lit("00"), even)).otherwise(
        even
    )
    return F.base64(F.unhex(signed))


def envelopes(events: DataFrame) -> DataFrame:
    """Events as topic messages, one per event, in the wire format. Batch or streaming.

    Distance is missing for purchases of 100 and more, and is no base64 for clicks
    below 1; clicks of 300 and more are not JSON at all.
    """
    cents = (F.col("value").cast("decimal(10,2)") * 10000).cast("long")
    value = F.col("value").cast("decimal(10,2)")
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")
    )
    distance = (
        F.when((F.col("event_type") == "purchase") & (value >= 100), None)
        .when((F.col("event_type") == "click") & (value < 1), F.lit("%%%"))
        .otherwise(encoded_decimal(cents))
    )
    row = F.struct(
        F.col("event_id").alias("activity_id"),
        F.col("user_id").alias("employee_id"),
        micros.alias("start_datetime"),
        F.col("event_type").alias("sport_type"),
        distance.alias("distance_meters"),
        (micros + (value * 60).cast("long") * 1_000_000).alias("end_datetime"),
        F.when(F.col("event_type") == "click", F.col("props")).alias("comment"),
    )
    op = operation(F.col("event_type"))
    payload = F.struct(
        F.when(op == "d", F.struct(F.col("event_id").alias("activity_id"))).alias("before"),
        F.when(op != "d", row).alias("after"),
        op.alias("op"),
    )
    text = F.to_json(F.struct(payload.alias("payload")))
    broken = (F.col("event_type") == "click") & (value >= 300)
    return events.select(
        F.when(broken, F.lit("{not json")).otherwise(text).cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes(table(spark, sf_dir, "events"))


# --- The same roles for DuckDB ---------------------------------------------------

SQL: dict[str, str] = {}

SQL["employees"] = """
employees AS (
  SELECT c_custkey AS employee_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, n_name AS business_unit,
         CAST(c_acctbal AS DECIMAL(10,2)) AS gross_salary, c_mktsegment AS commute_mode
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

SQL["rules"] = """
rules AS (
  SELECT * FROM (VALUES ('BUILDING', 'WALK', CAST(15 AS DECIMAL(10,2))),
                        ('MACHINERY', 'BICYCLE', CAST(25 AS DECIMAL(10,2))))
    AS r(commute_mode, travel_mode, threshold_km))"""

_REASON = """
CASE WHEN {valid} THEN 'Distance inférieure ou égale au seuil de ' || CAST(CAST(threshold_km AS INTEGER) AS VARCHAR) || ' km.'
     ELSE 'Distance supérieure au seuil de ' || CAST(CAST(threshold_km AS INTEGER) AS VARCHAR) || ' km.' END"""


def _validation(name: str, requests: str) -> str:
    return f"""
{name} AS (
  SELECT employee_id, CAST(round(distance_km, 2) AS DECIMAL(10,2)) AS distance_km, threshold_km,
         TRUE AS is_sport_commute, distance_km <= threshold_km AS is_valid,
         {_REASON.format(valid="distance_km <= threshold_km")} AS validation_reason
  FROM {requests} JOIN rules USING (commute_mode)
  WHERE distance_km IS NOT NULL)"""


SQL["commute_requests"] = """
commute_requests AS (
  SELECT c_custkey AS employee_id, c_mktsegment AS commute_mode,
         CAST((c_custkey * 7) % 40 + 0.5 AS DECIMAL(12,3)) AS distance_km
  FROM customer)"""

SQL["commute_answers"] = """
commute_answers AS (
  SELECT c_custkey AS employee_id, c_mktsegment AS commute_mode,
         CASE WHEN c_acctbal >= 0 THEN
           CAST((((c_custkey * 7) % 40) * 1000 + CASE WHEN c_acctbal < 5000 THEN 0 ELSE 4 END) AS DECIMAL(12,3))
             * CAST(0.001 AS DECIMAL(4,3)) END AS distance_km
  FROM customer)"""

SQL["commute_validation"] = _validation("commute_validation", "commute_requests")
SQL["commute_checked"] = _validation("commute_checked", "commute_answers")

SQL["activities"] = """
activities AS (
  SELECT event_id AS activity_id, user_id AS employee_id, ts AS start_datetime,
         event_type AS sport_type,
         CAST(CAST(value AS DECIMAL(10,2)) * 100 AS DECIMAL(10,2)) AS distance_meters,
         ts + to_seconds(CAST(trunc(CAST(value AS DECIMAL(10,2)) * 60) AS BIGINT)) AS end_datetime,
         props AS comment
  FROM events)"""

SQL["recorded"] = """
valued AS (
  SELECT *, CAST(value AS DECIMAL(10,2)) AS v FROM events),
delivered AS (
  SELECT * FROM valued UNION ALL
  SELECT * FROM valued WHERE event_type = 'purchase' AND value >= 100),
recorded AS (
  SELECT CASE WHEN v < 250 THEN event_id END AS activity_id,
         CASE WHEN v < 200 THEN user_id END AS employee_id,
         CASE WHEN v < 1 AND event_type = 'click' THEN NULL ELSE ts END AS start_datetime,
         CASE WHEN event_type = 'error' AND v < 20 THEN '  '
              WHEN event_type = 'error' AND v < 40 THEN NULL ELSE event_type END AS sport_type,
         CAST(CASE WHEN event_type = 'view' AND v < 10 THEN -v * 100
                   WHEN event_type <> 'signup' THEN v * 100 END AS DECIMAL(10,2)) AS distance_meters,
         CASE WHEN v < 180 THEN ts + to_seconds(CAST((trunc(v) - 5) * 60 AS BIGINT)) END AS end_datetime,
         props AS comment
  FROM delivered)"""

SQL["accepted_employees"] = """
accepted_employees AS (SELECT * FROM employees WHERE gross_salary > 0)"""

SQL["sport_profile"] = """
sport_profile AS (
  SELECT user_id AS employee_id, nullif(arg_min(event_type, event_id), 'error') AS sport_type
  FROM events GROUP BY user_id)"""

# What a correct decoder must read from the messages, taken from the events directly.
SQL["changes"] = """
changes AS (
  SELECT event_id AS activity_id, user_id AS employee_id, ts AS start_datetime,
         event_type AS sport_type,
         CASE WHEN event_type = 'purchase' AND v >= 100 THEN 'missing'
              WHEN event_type = 'click' AND v < 1 THEN 'invalid' ELSE 'present' END AS distance_state,
         CASE WHEN event_type = 'purchase' AND v >= 100 THEN NULL
              WHEN event_type = 'click' AND v < 1 THEN NULL
              ELSE CAST(v * 100 AS DECIMAL(10,2)) END AS distance_meters,
         ts + to_seconds(CAST(trunc(v * 60) AS BIGINT)) AS end_datetime,
         CASE WHEN event_type = 'click' THEN props END AS comment,
         CASE event_type WHEN 'signup' THEN 'r' WHEN 'error' THEN 'd' WHEN 'view' THEN 'u' ELSE 'c' END AS operation,
         event_type = 'click' AND v >= 300 AS broken,
         CAST(trunc(v * 60) AS BIGINT) AS seconds
  FROM (SELECT *, CAST(value AS DECIMAL(10,2)) AS v FROM events))"""

SQL["created"] = """
created AS (
  SELECT activity_id, employee_id, start_datetime, sport_type, distance_meters, end_datetime, comment
  FROM changes WHERE operation = 'c' AND NOT broken)"""

SQL["activity_summary"] = """
activity_summary AS (
  SELECT employee_id, count(activity_id) AS activity_count,
         sum(distance_meters) AS total_distance_meters
  FROM activities WHERE start_datetime >= TIMESTAMP '2024-01-24 00:00:00'
  GROUP BY employee_id)"""

SQL["benefits"] = """
benefits AS (
  SELECT e.employee_id, first_name, last_name, business_unit, gross_salary, commute_mode,
         c.distance_km AS commute_distance_km,
         coalesce(c.is_sport_commute, FALSE) AS is_sport_commute,
         coalesce(c.is_valid, FALSE) AS commute_validated,
         CAST(coalesce(a.activity_count, 0) AS INTEGER) AS activity_count,
         CAST(coalesce(a.total_distance_meters, 0) AS DECIMAL(20,2)) AS total_distance_meters,
         coalesce(c.is_sport_commute AND c.is_valid, FALSE) AS sport_bonus_eligible,
         CAST(CASE WHEN coalesce(c.is_sport_commute AND c.is_valid, FALSE)
                   THEN round(gross_salary * CAST(0.05 AS DECIMAL(2,2)), 2) ELSE 0 END AS DECIMAL(12,2))
           AS sport_bonus_amount,
         coalesce(a.activity_count, 0) >= 15 AS wellbeing_days_eligible,
         CASE WHEN coalesce(a.activity_count, 0) >= 15 THEN 5 ELSE 0 END AS wellbeing_days_awarded,
         DATE '2025-01-24' AS calculation_date
  FROM employees e
  LEFT JOIN commute_validation c ON e.employee_id = c.employee_id
  LEFT JOIN activity_summary a ON e.employee_id = a.employee_id)"""

BENEFITS = ("employees", "rules", "commute_requests", "commute_validation", "activities", "activity_summary", "benefits")


def with_roles(names: tuple[str, ...], select: str) -> str:
    """A query over some roles."""
    if not names:
        return select.strip()
    return "WITH " + ",".join(SQL[n] for n in names) + "\n" + select.strip()
