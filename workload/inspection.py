"""Quality suites, contracts, matching and profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from perkline import fixed_values as fixed
from perkline.functions.periods import in_window
from perkline.operators import distincts
from perkline.operators.checks import key_measures, split_by_checks, verdict
from perkline.operators.frequent import top_values
from perkline.operators.matching import (
    differing_value,
    key_differences,
    unknown_keys,
    without_value,
)
from perkline.operators.profiling import (
    column_profile,
    counts_by_month,
    counts_of_counts,
    frequencies,
    largest,
    repeated_groups,
    repeated_rows,
    shape,
)
from perkline.operators.rules import commute_rules, look_up
from perkline.plans import people, quality
from perkline.session import shared_dir
from perkline.sources.files import read_delimited, read_delimited_leniently, write_report
from workload import roles
from workload.registry import query

# --- Suites ----------------------------------------------------------------------

_ACTIVITY_CHECKS = """
, checks AS (
  SELECT 'duplicates' AS check_name, count(*) - count(DISTINCT activity_id) AS value, TRUE AS blocking FROM recorded
  UNION ALL SELECT 'null_activity_id', count(*) FILTER (activity_id IS NULL), TRUE FROM recorded
  UNION ALL SELECT 'null_employee_id', count(*) FILTER (employee_id IS NULL), TRUE FROM recorded
  UNION ALL SELECT 'invalid_sport', count(*) FILTER (sport_type IS NULL OR trim(sport_type) = ''), TRUE FROM recorded
  UNION ALL SELECT 'null_start_datetime', count(*) FILTER (start_datetime IS NULL), TRUE FROM recorded
  UNION ALL SELECT 'null_end_datetime', count(*) FILTER (end_datetime IS NULL), TRUE FROM recorded
  UNION ALL SELECT 'invalid_dates', count(*) FILTER (end_datetime < start_datetime), TRUE FROM recorded
  UNION ALL SELECT 'negative_distances', count(*) FILTER (distance_meters < 0), TRUE FROM recorded
  UNION ALL SELECT 'null_distances', count(*) FILTER (distance_meters IS NULL), FALSE FROM recorded)
"""

_VERDICT = """
SELECT CAST(sum(value) FILTER (blocking) AS BIGINT) AS blocking_errors,
       count(*) FILTER (blocking AND value > 0) AS failed_checks,
       CASE WHEN sum(value) FILTER (blocking) = 0 THEN 'OK' ELSE 'KO' END AS verdict
FROM checks"""


@query("activity_quality", ("recorded",), _ACTIVITY_CHECKS + "SELECT * FROM checks")
def _(spark, sf_dir):
    return quality.activity_quality(roles.recorded(spark, sf_dir))


@query("activity_quality_verdict", ("recorded",), _ACTIVITY_CHECKS + _VERDICT)
def _(spark, sf_dir):
    return verdict(quality.activity_quality(roles.recorded(spark, sf_dir)))


@query(
    "activity_stats",
    ("recorded",),
    """
SELECT count(*) AS total, count(DISTINCT employee_id) AS distinct_employees,
       count(DISTINCT sport_type) AS distinct_sports, min(start_datetime) AS first_activity,
       max(start_datetime) AS last_activity, max(end_datetime) AS last_end,
       count(DISTINCT activity_id) AS distinct_activity_ids
FROM recorded""",
)
def _(spark, sf_dir):
    return quality.activity_stats(roles.recorded(spark, sf_dir))


_SOURCE = ("employees", "accepted_employees", "sport_profile", "recorded")
_SOURCE_CHECKS = """
, per_employee AS (SELECT employee_id, count(*) AS n FROM recorded GROUP BY employee_id),
checks AS (
  SELECT 'total' AS check_name, count(*) AS value, FALSE AS blocking FROM recorded
  UNION ALL SELECT 'invalid_dates', count(*) FILTER (end_datetime <= start_datetime), TRUE FROM recorded
  UNION ALL SELECT 'future_activities', count(*) FILTER (end_datetime > TIMESTAMP '2025-01-24 00:00:00'), TRUE FROM recorded
  UNION ALL SELECT 'too_old_activities', count(*) FILTER (start_datetime < TIMESTAMP '2024-01-24 00:00:00'), TRUE FROM recorded
  UNION ALL SELECT 'negative_distances', count(*) FILTER (distance_meters < 0), TRUE FROM recorded
  UNION ALL SELECT 'null_distances', count(*) FILTER (distance_meters IS NULL), FALSE FROM recorded
  UNION ALL SELECT 'duplicates', count(*), TRUE FROM (
    SELECT 1 FROM recorded GROUP BY employee_id, start_datetime, sport_type HAVING count(*) > 1)
  UNION ALL SELECT 'unknown_employees', count(*), TRUE FROM recorded a
    LEFT JOIN accepted_employees e ON a.employee_id = e.employee_id WHERE e.employee_id IS NULL
  UNION ALL SELECT 'inconsistent_sports', count(*), TRUE FROM recorded a
    JOIN sport_profile p ON a.employee_id = p.employee_id WHERE a.sport_type <> p.sport_type
  UNION ALL SELECT 'activities_without_profile', count(*), TRUE FROM recorded a
    LEFT JOIN sport_profile p ON a.employee_id = p.employee_id
    WHERE p.employee_id IS NULL OR p.sport_type IS NULL
  UNION ALL SELECT 'employees_with_activity', count(DISTINCT employee_id), FALSE FROM recorded
  UNION ALL SELECT 'sports_count', count(DISTINCT sport_type), FALSE FROM recorded
  UNION ALL SELECT 'below_threshold', count(*) FILTER (n < 15), FALSE FROM per_employee
  UNION ALL SELECT 'at_least_threshold', count(*) FILTER (n >= 15), FALSE FROM per_employee)
"""


def _source_quality(spark, sf_dir):
    return quality.source_quality(
        roles.recorded(spark, sf_dir),
        roles.accepted_employees(spark, sf_dir),
        roles.sport_profile(spark, sf_dir),
        roles.AS_OF,
    )


@query("source_quality", _SOURCE, _SOURCE_CHECKS + "SELECT * FROM checks")
def _(spark, sf_dir):
    return _source_quality(spark, sf_dir)


@query("source_quality_verdict", _SOURCE, _SOURCE_CHECKS + _VERDICT)
def _(spark, sf_dir):
    return verdict(_source_quality(spark, sf_dir))


@query(
    "source_quality_within",
    _SOURCE,
    _SOURCE_CHECKS.replace("2025-01-24 00:00:00", "2024-01-20 06:30:00").replace(
        "2024-01-24 00:00:00", "2023-01-20 00:00:00"
    )
    + "SELECT * FROM checks",
)
def _(spark, sf_dir):
    # Seen from the middle of the period: some activities end in the future, none is too old.
    return quality.source_quality(
        roles.recorded(spark, sf_dir),
        roles.accepted_employees(spark, sf_dir),
        roles.sport_profile(spark, sf_dir),
        dt.datetime(2024, 1, 20, 6, 30),
    )


@query(
    "load_gate",
    ("recorded",),
    """
SELECT 'invalid_dates' AS check_name, count(*) FILTER (end_datetime <= start_datetime) AS value, TRUE AS blocking FROM recorded
UNION ALL SELECT 'negative_distances', count(*) FILTER (distance_meters < 0), TRUE FROM recorded
UNION ALL SELECT 'future_activities', count(*) FILTER (end_datetime > TIMESTAMP '2024-01-28 12:00:00'), TRUE FROM recorded""",
)
def _(spark, sf_dir):
    return quality.load_gate(roles.recorded(spark, sf_dir), roles.PERIOD_END)


@query(
    "load_summary",
    ("recorded",),
    """
SELECT count(*) AS total_activities, count(DISTINCT employee_id) AS employees_with_activity,
       count(DISTINCT sport_type) AS sports_count
FROM recorded""",
)
def _(spark, sf_dir):
    return quality.load_summary(roles.recorded(spark, sf_dir))


@query(
    "quarantined_activities",
    ("recorded",),
    """
SELECT * FROM (
  SELECT activity_id, employee_id, start_datetime, sport_type, distance_meters, end_datetime, comment,
    concat_ws(',',
      CASE WHEN activity_id IS NULL THEN 'null_activity_id' END,
      CASE WHEN employee_id IS NULL THEN 'null_employee_id' END,
      CASE WHEN sport_type IS NULL OR trim(sport_type) = '' THEN 'invalid_sport' END,
      CASE WHEN start_datetime IS NULL THEN 'null_start_datetime' END,
      CASE WHEN end_datetime IS NULL THEN 'null_end_datetime' END,
      CASE WHEN end_datetime < start_datetime THEN 'invalid_dates' END,
      CASE WHEN distance_meters < 0 THEN 'negative_distances' END) AS violations
  FROM recorded)
WHERE violations <> ''""",
)
def _(spark, sf_dir):
    _, bad = split_by_checks(roles.recorded(spark, sf_dir), quality.ACTIVITY_CHECKS)
    return bad.withColumn("violations", F.array_join("violations", ","))


# --- Contracts ---------------------------------------------------------------------


@query(
    "contract_activities",
    ("employees", "accepted_employees", "recorded"),
    """
, t AS (SELECT * FROM recorded)
SELECT 'activities' AS table_name, 'repeated_activity_id' AS check_name, count(activity_id) - count(DISTINCT activity_id) AS value FROM t
UNION ALL SELECT 'activities', 'null_activity_id', count(*) FILTER (activity_id IS NULL) FROM t
UNION ALL SELECT 'activities', 'null_employee_id', count(*) FILTER (employee_id IS NULL) FROM t
UNION ALL SELECT 'activities', 'null_start_datetime', count(*) FILTER (start_datetime IS NULL) FROM t
UNION ALL SELECT 'activities', 'null_sport_type', count(*) FILTER (sport_type IS NULL) FROM t
UNION ALL SELECT 'activities', 'null_end_datetime', count(*) FILTER (end_datetime IS NULL) FROM t
UNION ALL SELECT 'activities', 'negative_distance', count(*) FILTER (distance_meters < 0) FROM t
UNION ALL SELECT 'activities', 'end_not_after_start', count(*) FILTER (end_datetime <= start_datetime) FROM t
UNION ALL SELECT 'activities', 'too_long_sport_type', count(*) FILTER (length(sport_type) > 100) FROM t
UNION ALL SELECT 'activities', 'unknown_employee_id', count(*) FROM t
  WHERE employee_id IS NOT NULL AND employee_id NOT IN (SELECT employee_id FROM accepted_employees)""",
)
def _(spark, sf_dir):
    tables = {
        "activities": roles.recorded(spark, sf_dir),
        "employees": roles.accepted_employees(spark, sf_dir),
    }
    return quality.contract_violations("activities", tables)


_EMPLOYEE_RECORDS = """
, t AS (
  SELECT employee_id, CASE WHEN gross_salary < 9000 THEN last_name END AS last_name, first_name,
         CASE WHEN gross_salary > -900 THEN DATE '1980-01-31' END AS birth_date, business_unit,
         DATE '2020-02-29' AS hire_date, gross_salary,
         commute_mode || ' under a fixed term' AS contract_type,
         CAST(trunc(gross_salary / 100) AS INTEGER) AS paid_leave_days,
         business_unit AS home_address, repeat(commute_mode, CAST(abs(trunc(gross_salary / 400)) AS INTEGER)) AS commute_mode
  FROM employees)
"""


def _employee_records(spark, sf_dir):
    """Employees with every column of the table, some of them wrong by their salary."""
    salary = F.col("gross_salary")
    return roles.employees(spark, sf_dir).select(
        "employee_id",
        F.when(salary < 9000, F.col("last_name")).alias("last_name"),
        "first_name",
        F.when(salary > -900, F.lit("1980-01-31").cast("date")).alias("birth_date"),
        "business_unit",
        F.lit("2020-02-29").cast("date").alias("hire_date"),
        "gross_salary",
        F.concat("commute_mode", F.lit(" under a fixed term")).alias("contract_type"),
        (salary / 100).cast("int").alias("paid_leave_days"),
        F.col("business_unit").alias("home_address"),
        F.repeat("commute_mode", F.abs((salary / 400).cast("int"))).alias("commute_mode"),
    )


@query(
    "contract_employees",
    ("employees",),
    _EMPLOYEE_RECORDS
    + """
SELECT 'employees' AS table_name, 'repeated_employee_id' AS check_name, count(employee_id) - count(DISTINCT employee_id) AS value FROM t
"""
    + "".join(
        f"UNION ALL SELECT 'employees', 'null_{c}', count(*) FILTER ({c} IS NULL) FROM t\n"
        for c in (
            "employee_id last_name first_name birth_date business_unit hire_date gross_salary "
            "contract_type paid_leave_days home_address commute_mode"
        ).split()
    )
    + """UNION ALL SELECT 'employees', 'salary_not_positive', count(*) FILTER (gross_salary <= 0) FROM t
UNION ALL SELECT 'employees', 'negative_leave_days', count(*) FILTER (paid_leave_days < 0) FROM t
UNION ALL SELECT 'employees', 'too_long_last_name', count(*) FILTER (length(last_name) > 100) FROM t
UNION ALL SELECT 'employees', 'too_long_first_name', count(*) FILTER (length(first_name) > 100) FROM t
UNION ALL SELECT 'employees', 'too_long_business_unit', count(*) FILTER (length(business_unit) > 100) FROM t
UNION ALL SELECT 'employees', 'too_long_contract_type', count(*) FILTER (length(contract_type) > 20) FROM t
UNION ALL SELECT 'employees', 'too_long_commute_mode', count(*) FILTER (length(commute_mode) > 100) FROM t""",
)
def _(spark, sf_dir):
    return quality.contract_violations("employees", {"employees": _employee_records(spark, sf_dir)})


@query(
    "contract_commute",
    ("employees", "accepted_employees", "rules", "commute_answers"),
    """
, t AS (
  SELECT employee_id, distance_km - 1 AS distance_km, threshold_km - 20 AS threshold_km,
         threshold_km IS NOT NULL AS is_sport_commute, distance_km <= threshold_km AS is_valid
  FROM commute_answers LEFT JOIN rules USING (commute_mode))
SELECT 'commute_validation' AS table_name, 'repeated_employee_id' AS check_name, count(employee_id) - count(DISTINCT employee_id) AS value FROM t
UNION ALL SELECT 'commute_validation', 'null_employee_id', count(*) FILTER (employee_id IS NULL) FROM t
UNION ALL SELECT 'commute_validation', 'null_distance_km', count(*) FILTER (distance_km IS NULL) FROM t
UNION ALL SELECT 'commute_validation', 'null_is_sport_commute', count(*) FILTER (is_sport_commute IS NULL) FROM t
UNION ALL SELECT 'commute_validation', 'null_is_valid', count(*) FILTER (is_valid IS NULL) FROM t
UNION ALL SELECT 'commute_validation', 'negative_distance', count(*) FILTER (distance_km < 0) FROM t
UNION ALL SELECT 'commute_validation', 'negative_threshold', count(*) FILTER (threshold_km < 0) FROM t
UNION ALL SELECT 'commute_validation', 'unknown_employee_id', count(*) FROM t
  WHERE employee_id NOT IN (SELECT employee_id FROM accepted_employees)""",
)
def _(spark, sf_dir):
    rules = commute_rules(spark, roles.RULES)
    rows = look_up(roles.commute_answers(spark, sf_dir), rules, "commute_mode", "left").select(
        "employee_id",
        (F.col("distance_km") - 1).alias("distance_km"),
        (F.col("threshold_km") - 20).alias("threshold_km"),
        F.col("threshold_km").isNotNull().alias("is_sport_commute"),
        (F.col("distance_km") <= F.col("threshold_km")).alias("is_valid"),
    )
    tables = {"commute_validation": rows, "employees": roles.accepted_employees(spark, sf_dir)}
    return quality.contract_violations("commute_validation", tables)


@query(
    "contract_profile",
    ("employees", "accepted_employees", "sport_profile"),
    """
SELECT 'sport_profile' AS table_name, 'repeated_employee_id' AS check_name, count(employee_id) - count(DISTINCT employee_id) AS value FROM sport_profile
UNION ALL SELECT 'sport_profile', 'null_employee_id', count(*) FILTER (employee_id IS NULL) FROM sport_profile
UNION ALL SELECT 'sport_profile', 'too_long_sport_type', count(*) FILTER (length(sport_type) > 100) FROM sport_profile
UNION ALL SELECT 'sport_profile', 'unknown_employee_id', count(*) FROM sport_profile
  WHERE employee_id NOT IN (SELECT employee_id FROM accepted_employees)""",
)
def _(spark, sf_dir):
    tables = {
        "sport_profile": roles.sport_profile(spark, sf_dir),
        "employees": roles.accepted_employees(spark, sf_dir),
    }
    return quality.contract_violations("sport_profile", tables)


# --- Matching ----------------------------------------------------------------------


@query(
    "unknown_employees",
    ("employees", "accepted_employees", "recorded"),
    """
SELECT a.employee_id, count(*) AS row_count FROM recorded a
LEFT JOIN accepted_employees e ON a.employee_id = e.employee_id
WHERE e.employee_id IS NULL GROUP BY a.employee_id""",
)
def _(spark, sf_dir):
    return unknown_keys(
        roles.recorded(spark, sf_dir), roles.accepted_employees(spark, sf_dir), "employee_id"
    )


@query(
    "no_profile",
    ("sport_profile", "recorded"),
    """
SELECT a.employee_id, count(*) AS row_count FROM recorded a
LEFT JOIN sport_profile p ON a.employee_id = p.employee_id
WHERE p.employee_id IS NULL OR p.sport_type IS NULL GROUP BY a.employee_id""",
)
def _(spark, sf_dir):
    return without_value(
        roles.recorded(spark, sf_dir), roles.sport_profile(spark, sf_dir), "employee_id", "sport_type"
    )


@query(
    "sport_mismatch",
    ("sport_profile", "recorded"),
    """
SELECT a.employee_id, a.sport_type, p.sport_type AS declared, count(*) AS row_count
FROM recorded a JOIN sport_profile p ON a.employee_id = p.employee_id
WHERE a.sport_type <> p.sport_type GROUP BY ALL""",
)
def _(spark, sf_dir):
    return differing_value(
        roles.recorded(spark, sf_dir), roles.sport_profile(spark, sf_dir), "employee_id", "sport_type"
    )


@query(
    "key_difference",
    (),
    """
SELECT doc_id, 'right' AS missing_from FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT doc_id, 'left' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def _(spark, sf_dir):
    documents = roles.table(spark, sf_dir, "documents")
    return key_differences(documents, roles.table(spark, sf_dir, "labels"), "doc_id")


# --- Uniqueness and profiles ---------------------------------------------------------


@query(
    "key_uniqueness",
    ("recorded",),
    """
SELECT count(*) AS total, count(DISTINCT activity_id) AS distinct_non_null,
       (SELECT count(*) FROM (SELECT DISTINCT activity_id FROM recorded)) AS distinct_keys,
       (SELECT count(*) FROM (SELECT 1 FROM recorded GROUP BY activity_id HAVING count(*) > 1)) AS repeated_keys,
       count(*) - count(DISTINCT activity_id) AS surplus_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT activity_id FROM recorded)) AS later_rows
FROM recorded""",
)
def _(spark, sf_dir):
    return key_measures(roles.recorded(spark, sf_dir), ["activity_id"])


@query(
    "duplicate_groups",
    (),
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, sf_dir):
    return repeated_groups(roles.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_rows",
    ("recorded",),
    """
SELECT (SELECT count(*) FROM recorded) AS total,
       (SELECT count(*) FROM recorded) - (SELECT count(*) FROM (SELECT DISTINCT * FROM recorded)) AS later_rows""",
)
def _(spark, sf_dir):
    return repeated_rows(roles.recorded(spark, sf_dir))


@query(
    "duplicate_texts",
    (),
    """
SELECT count(*) AS total, count(*) - count(DISTINCT text) AS later_rows FROM documents""",
)
def _(spark, sf_dir):
    return repeated_rows(roles.table(spark, sf_dir, "documents"), ["text"], digest_text=True)


@query(
    "threshold_split",
    ("activities",),
    """
SELECT count(*) FILTER (n < 15) AS below_threshold, count(*) FILTER (n >= 15) AS at_least_threshold
FROM (SELECT employee_id, count(*) AS n FROM activities
      WHERE start_datetime >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY employee_id)""",
)
def _(spark, sf_dir):
    recent = roles.activities(spark, sf_dir).filter(in_window(F.col("start_datetime"), roles.AS_OF))
    return counts_of_counts(recent, "employee_id", 15).select("below_threshold", "at_least_threshold")


@query(
    "per_employee_stats",
    ("recorded",),
    """
SELECT count(*) AS keys, min(n) AS min_rows, max(n) AS max_rows, round(avg(n), 2) AS mean_rows,
       count(*) FILTER (n < 60) AS below_threshold, count(*) FILTER (n >= 60) AS at_least_threshold
FROM (SELECT employee_id, count(*) AS n FROM recorded GROUP BY employee_id)""",
)
def _(spark, sf_dir):
    return counts_of_counts(roles.recorded(spark, sf_dir), "employee_id", 60)


@query(
    "category_counts",
    ("recorded",),
    "SELECT sport_type, count(*) AS row_count FROM recorded GROUP BY sport_type ORDER BY row_count DESC, sport_type",
)
def _(spark, sf_dir):
    return frequencies(roles.recorded(spark, sf_dir), "sport_type")


@query(
    "value_frequencies",
    ("employees", "rules"),
    """
SELECT travel_mode, count(*) AS row_count FROM employees LEFT JOIN rules USING (commute_mode)
GROUP BY travel_mode ORDER BY row_count DESC, travel_mode""",
)
def _(spark, sf_dir):
    people = roles.employees(spark, sf_dir)
    return frequencies(
        look_up(people, commute_rules(spark, roles.RULES), "commute_mode", "left"), "travel_mode"
    )


@query(
    "monthly_counts",
    (),
    """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS row_count
FROM orders GROUP BY date_trunc('month', o_orderdate) ORDER BY month""",
)
def _(spark, sf_dir):
    return counts_by_month(roles.table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "column_profile",
    ("recorded",),
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count FROM recorded"
        for c in "activity_id employee_id start_datetime sport_type distance_meters end_datetime comment".split()
    ),
)
def _(spark, sf_dir):
    return column_profile(roles.recorded(spark, sf_dir))


def _top_values(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, rank::INT AS rank, value, row_count FROM (
  SELECT {c}::VARCHAR AS value, count(*) AS row_count,
         row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR NULLS FIRST) AS rank FROM {table} GROUP BY {c})
WHERE rank <= 20"""
        for c in columns.split()
    )


@query("top_values", (), _top_values("lineitem", "l_partkey l_orderkey l_suppkey l_returnflag"))
def _(spark, sf_dir):
    return top_values(roles.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_orderkey", "l_suppkey", "l_returnflag"])


@query("file_top_values", (), _top_values("documents", "text source lang"))
def _(spark, sf_dir):
    return top_values(roles.table(spark, sf_dir, "documents"), ["text", "source", "lang"])


_DISTINCTS = " UNION ALL ".join(
    f"""
SELECT load, '{c}' AS column_name, value_rows, distinct_values,
       (sum(value_rows) OVER (ORDER BY load))::BIGINT AS value_rows_so_far,
       (sum(coalesce(new_values, 0)) OVER (ORDER BY load))::BIGINT AS distinct_so_far, TRUE AS within_error
FROM (SELECT ts::DATE AS load, count({c}) AS value_rows, count(DISTINCT {c}) AS distinct_values FROM events GROUP BY ALL)
LEFT JOIN (SELECT load, count(*) AS new_values FROM (SELECT min(ts::DATE) AS load FROM events WHERE {c} IS NOT NULL GROUP BY {c}) GROUP BY load) USING (load)"""
    for c in ("user_id", "event_type", "props")
)


@query("distinct_history", (), _DISTINCTS)
def _(spark, sf_dir):
    # A load per day. The estimates come from stored sketches; exact numbers judge them.
    events, columns, day = roles.table(spark, sf_dir, "events"), ["user_id", "event_type", "props"], F.to_date("ts")
    path = shared_dir(spark, "sketches")
    distincts.distinct_sketches(events, columns, day).write.parquet(path)
    judged = distincts.judged(
        distincts.distinct_history(spark.read.parquet(path)), distincts.exact_distinct_history(events, columns, day)
    )
    return judged.drop("estimated_values", "estimated_so_far")


@query("table_shape", (), "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def _(spark, sf_dir):
    return shape(roles.table(spark, sf_dir, "lineitem"))


@query(
    "file_audit",
    (),
    """
SELECT 'rows' AS section, 'left' AS item, count(*) AS value FROM documents
UNION ALL SELECT 'rows', 'right', count(*) FROM labels
UNION ALL SELECT 'columns', 'left', 5
UNION ALL SELECT 'columns', 'right', 3
UNION ALL SELECT 'repeated_rows', 'left', (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT * FROM documents))
UNION ALL SELECT 'repeated_rows', 'right', (SELECT count(*) FROM labels) - (SELECT count(*) FROM (SELECT DISTINCT * FROM labels))
UNION ALL SELECT 'repeated_keys', 'left', count(*) - count(DISTINCT doc_id) FROM documents
UNION ALL SELECT 'repeated_keys', 'right', count(*) - count(DISTINCT doc_id) FROM labels
"""
    + "".join(
        f"UNION ALL SELECT 'nulls', '{side}.{c}', count(*) - count({c}) FROM {t}\n"
        for side, t, cols in (
            ("left", "documents", "doc_id text lang source n_chars"),
            ("right", "labels", "doc_id quality toxic"),
        )
        for c in cols.split()
    )
    + "".join(
        f"UNION ALL SELECT 'types', '{side}.{c}', {i}\n"
        for side, cols in (
            ("left", "doc_id bigint,text string,lang string,source string,n_chars bigint"),
            ("right", "doc_id bigint,quality int,toxic int"),
        )
        for i, c in enumerate(cols.split(","), 1)
    )
    + """UNION ALL SELECT 'missing_keys', 'right', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) HAVING count(*) > 0
UNION ALL SELECT 'missing_keys', 'left', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) HAVING count(*) > 0""",
)
def _(spark, sf_dir):
    documents = roles.table(spark, sf_dir, "documents")
    return people.audit(documents, roles.table(spark, sf_dir, "labels"), "doc_id")


@query(
    "people_audit",
    ("recorded", "sport_profile"),
    """
SELECT 'rows' AS section, 'left' AS item, count(*) AS value FROM recorded
UNION ALL SELECT 'rows', 'right', count(*) FROM sport_profile
UNION ALL SELECT 'columns', 'left', 7
UNION ALL SELECT 'columns', 'right', 2
UNION ALL SELECT 'repeated_rows', 'left', (SELECT count(*) FROM recorded) - (SELECT count(*) FROM (SELECT DISTINCT * FROM recorded))
UNION ALL SELECT 'repeated_rows', 'right', (SELECT count(*) FROM sport_profile) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sport_profile))
UNION ALL SELECT 'repeated_keys', 'left', (SELECT count(*) FROM recorded) - (SELECT count(*) FROM (SELECT DISTINCT employee_id FROM recorded))
UNION ALL SELECT 'repeated_keys', 'right', count(*) - count(DISTINCT employee_id) FROM sport_profile
"""
    + "".join(
        f"UNION ALL SELECT 'nulls', '{side}.{c}', count(*) - count({c}) FROM {t}\n"
        for side, t, cols in (
            (
                "left",
                "recorded",
                "activity_id employee_id start_datetime sport_type distance_meters end_datetime comment",
            ),
            ("right", "sport_profile", "employee_id sport_type"),
        )
        for c in cols.split()
    )
    + "".join(
        f"UNION ALL SELECT 'types', '{side}.{c}', {i}\n"
        for side, cols in (
            (
                "left",
                "activity_id bigint;employee_id bigint;start_datetime timestamp_ntz;sport_type string;"
                "distance_meters decimal(10,2);end_datetime timestamp_ntz;comment string",
            ),
            ("right", "employee_id bigint;sport_type string"),
        )
        for i, c in enumerate(cols.split(";"), 1)
    )
    + """UNION ALL SELECT 'missing_keys', 'right', count(*) FROM (
  SELECT DISTINCT employee_id FROM recorded EXCEPT SELECT employee_id FROM sport_profile) HAVING count(*) > 0
UNION ALL SELECT 'missing_keys', 'left', count(*) FROM (
  SELECT employee_id FROM sport_profile EXCEPT SELECT employee_id FROM recorded) HAVING count(*) > 0""",
)
def _(spark, sf_dir):
    return people.audit(
        roles.recorded(spark, sf_dir), roles.sport_profile(spark, sf_dir), "employee_id"
    )


@query("top_k_latest", (), "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def _(spark, sf_dir):
    return largest(roles.table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


@query(
    "file_missing_ids",
    (),
    """
SELECT doc_id, 'right' AS missing_from FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'left' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def _(spark, sf_dir):
    documents = roles.table(spark, sf_dir, "documents")
    return people.missing_ids(documents, roles.table(spark, sf_dir, "labels"), "doc_id")


@query(
    "file_frequencies",
    (),
    """
SELECT 'left' AS side, 'lang' AS column_name, lang AS column_value, count(*) AS row_count FROM documents GROUP BY lang
UNION ALL SELECT 'left', 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'right', 'quality', CAST(quality AS VARCHAR), count(*) FROM labels GROUP BY quality""",
)
def _(spark, sf_dir):
    documents = roles.table(spark, sf_dir, "documents")
    labels = roles.table(spark, sf_dir, "labels")
    return people.frequency_table(documents, ["lang", "source"], "left").unionByName(
        people.frequency_table(labels, ["quality"], "right")
    )


_HR = """
SELECT CAST(c_custkey AS INTEGER) AS employee_id, c_name AS last_name, 'Élodie, "' || c_mktsegment || '"' AS first_name,
       DATE '1980-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS birth_date, c_mktsegment AS business_unit,
       DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS hire_date,
       CAST(30000 + c_custkey % 1000 AS DECIMAL(10,2)) AS gross_salary, 'CDI' AS contract_type,
       CAST(c_nationkey AS INTEGER) AS paid_leave_days, c_name || chr(44) || ' rue' AS home_address,
       c_mktsegment AS commute_mode
FROM customer"""


# The same file, where some records lack cells or have too many, and some values are none of their type.
_BROKEN = """
SELECT CASE WHEN c_acctbal < -500 THEN 'cells' WHEN c_acctbal < 0 THEN 'cells' WHEN c_acctbal < 1000 AND c_mktsegment = 'BUILDING' THEN 'birth_date: not date; gross_salary: not decimal(10,2)'
            WHEN c_acctbal < 1000 THEN 'gross_salary: not decimal(10,2)' WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000 THEN 'last_name: missing' ELSE 'good' END AS reasons,
       count(*) AS records, CAST(sum(CASE WHEN c_acctbal >= 1000 AND NOT (c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9000) THEN c_custkey ELSE 0 END) AS BIGINT) AS good_ids
FROM customer GROUP BY 1"""


@query("hr_file_quarantine", (), _BROKEN)
def _(spark, sf_dir):
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    cells = {name: F.lit("x") for name in fixed.HR_HEADERS.values()} | {
        "employee_id": F.col("c_custkey").cast("string"),
        "last_name": F.when((segment == "HOUSEHOLD") & (balance > 9000), "").otherwise(F.col("c_name")),
        "birth_date": F.when((balance < 1000) & (segment == "BUILDING"), "31/12/1980").otherwise("1980-12-31"),
        "hire_date": F.lit("2010-01-01"),
        "gross_salary": F.when(balance < 1000, "n/a").otherwise("2500.50"),
        "paid_leave_days": F.lit("25"),
    }
    line = F.concat_ws(",", *[cells[name] for name in fixed.HR_HEADERS.values()])
    line = F.when(balance < -500, F.substring_index(line, ",", 4)).when(balance < 0, F.concat(line, F.lit(",y"))).otherwise(line)
    path = shared_dir(spark, "broken-hr")
    roles.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    raw = read_delimited_leniently(spark, path, list(fixed.HR_HEADERS))
    good, bad = people.employees_or_set_aside(raw)
    reasons = F.array_join("reasons", "; ").alias("reasons")
    both = bad.select(reasons, F.lit(0).alias("id")).unionByName(good.select(F.lit("good").alias("reasons"), F.col("employee_id").alias("id")))
    return both.groupBy("reasons").agg(F.count(F.lit(1)).alias("records"), F.sum("id").alias("good_ids"))


@query("hr_file_ingest", (), _HR)
def _(spark, sf_dir):
    # Customers as a person file with its real headers, written, read and ingested.
    key = F.col("c_custkey")
    cells = {
        "employee_id": key,
        "last_name": F.col("c_name"),
        "first_name": F.concat(F.lit('Élodie, "'), "c_mktsegment", F.lit('"')),
        "birth_date": F.date_add(F.lit("1980-01-01").cast("date"), (key % 9000).cast("int")),
        "business_unit": F.col("c_mktsegment"),
        "hire_date": F.date_add(F.lit("2010-01-01").cast("date"), (key % 3000).cast("int")),
        "gross_salary": 30000 + key % 1000,
        "contract_type": F.lit("CDI"),
        "paid_leave_days": F.col("c_nationkey"),
        "home_address": F.concat("c_name", F.lit(", rue")),
        "commute_mode": F.col("c_mktsegment"),
    }
    file = roles.table(spark, sf_dir, "customer").select(
        *[cells[name].alias(header) for header, name in fixed.HR_HEADERS.items()]
    )
    path = write_report(file, shared_dir(spark, "hr"), "people")
    return people.employees_from_file(read_delimited(spark, path))
