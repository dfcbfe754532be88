"""Benefits, wellbeing, commutes and reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from perkline.functions.periods import in_future, in_window, outside, too_old
from perkline.operators.checks import require_rows
from perkline.operators.comparing import against_expected, metric_rows
from perkline.operators.profiling import largest
from perkline.operators.rules import commute_rules, uncovered
from perkline.plans import benefits as plan, commute, quality, reporting
from perkline.session import shared_dir
from perkline.sources.files import read_delimited, write_report
from perkline.sources.tables import publish, read_published
from workload import roles
from workload.registry import query
from workload.roles import AS_OF, BENEFITS


def benefits(spark, sf_dir):
    rules = commute_rules(spark, roles.RULES)
    return plan.employee_benefits(
        roles.employees(spark, sf_dir),
        commute.validated(roles.commute_requests(spark, sf_dir), rules),
        roles.activities(spark, sf_dir),
        AS_OF,
    )


@query("employee_benefits", BENEFITS, "SELECT * FROM benefits")
def _(spark, sf_dir):
    return benefits(spark, sf_dir)


@query(
    "benefits_summary",
    BENEFITS,
    """
SELECT count(*) AS row_count, count(DISTINCT employee_id) AS distinct_employees,
       count(*) - count(DISTINCT employee_id) AS duplicates,
       count(*) FILTER (activity_count > 0) AS employees_with_activity,
       count(*) FILTER (sport_bonus_eligible) AS bonus_eligible,
       count(*) FILTER (NOT sport_bonus_eligible) AS bonus_not_eligible,
       CAST(round(sum(sport_bonus_amount), 2) AS DECIMAL(20,2)) AS bonus_total,
       count(*) FILTER (wellbeing_days_eligible) AS wellbeing_eligible,
       count(*) FILTER (NOT wellbeing_days_eligible) AS wellbeing_not_eligible,
       CAST(sum(wellbeing_days_awarded) AS BIGINT) AS wellbeing_days
FROM benefits""",
)
def _(spark, sf_dir):
    return plan.benefits_totals(benefits(spark, sf_dir))


@query(
    "benefits_by_unit",
    BENEFITS,
    """
SELECT business_unit, count(*) AS employees,
       count(*) FILTER (sport_bonus_eligible) AS bonus_eligible,
       CAST(sum(sport_bonus_amount) AS DECIMAL(20,2)) AS bonus_total,
       count(*) FILTER (wellbeing_days_eligible) AS wellbeing_eligible,
       CAST(sum(wellbeing_days_awarded) AS BIGINT) AS wellbeing_days,
       CAST(sum(activity_count) AS BIGINT) AS activities
FROM benefits GROUP BY business_unit""",
)
def _(spark, sf_dir):
    return plan.benefits_by_unit(benefits(spark, sf_dir))


_ELIGIBILITY = """
, eligibility AS (
  SELECT employee_id, count(activity_id) AS activity_count,
         count(activity_id) >= 15 AS wellbeing_days_eligible,
         CASE WHEN count(activity_id) >= 15 THEN 5 ELSE 0 END AS wellbeing_days_awarded
  FROM activities
  WHERE start_datetime >= TIMESTAMP '2024-01-24 00:00:00'
    AND start_datetime <= TIMESTAMP '2025-01-24 00:00:00'
  GROUP BY employee_id)
"""


@query("wellbeing_eligibility", ("activities",), _ELIGIBILITY + "SELECT * FROM eligibility")
def _(spark, sf_dir):
    return plan.wellbeing_eligibility(roles.activities(spark, sf_dir), AS_OF)


@query(
    "wellbeing_summary",
    ("activities",),
    _ELIGIBILITY
    + """
SELECT count(*) AS employees_with_activity,
       count(*) FILTER (NOT wellbeing_days_eligible) AS not_eligible,
       count(*) FILTER (wellbeing_days_eligible) AS eligible,
       CAST(sum(wellbeing_days_awarded) AS BIGINT) AS days_awarded,
       count(*) FILTER (wellbeing_days_eligible) * 5 AS days_expected,
       sum(wellbeing_days_awarded) = count(*) FILTER (wellbeing_days_eligible) * 5 AS days_agree
FROM eligibility""",
)
def _(spark, sf_dir):
    return plan.wellbeing_summary(
        plan.wellbeing_eligibility(roles.activities(spark, sf_dir), AS_OF)
    )


@query(
    "most_active_employees",
    ("activities",),
    _ELIGIBILITY + "SELECT * FROM eligibility ORDER BY activity_count DESC, employee_id DESC LIMIT 100",
)
def _(spark, sf_dir):
    # The report shows the first hundred; the id decides between equal counts.
    eligibility = plan.wellbeing_eligibility(roles.activities(spark, sf_dir), AS_OF)
    return largest(eligibility, ["activity_count", "employee_id"], 100)


@query(
    "wellbeing_strict_year",
    ("activities",),
    """
SELECT employee_id, count(activity_id) AS activity_count,
       count(activity_id) >= 20 AS wellbeing_days_eligible,
       CASE WHEN count(activity_id) >= 20 THEN 3 ELSE 0 END AS wellbeing_days_awarded
FROM activities
WHERE start_datetime >= TIMESTAMP '2023-01-31 00:00:00'
  AND start_datetime <= TIMESTAMP '2024-01-31 09:30:00'
GROUP BY employee_id""",
)
def _(spark, sf_dir):
    # Other parameters, and a reference time with a clock part: the lower bound is midnight.
    return plan.wellbeing_eligibility(
        roles.activities(spark, sf_dir), dt.datetime(2024, 1, 31, 9, 30), min_activities=20, days=3
    )


# --- Commutes -------------------------------------------------------------------


@query("commute_validation", ("rules", "commute_answers", "commute_checked"), "SELECT * FROM commute_checked")
def _(spark, sf_dir):
    rules = commute_rules(spark, roles.RULES)
    return commute.validated(roles.commute_answers(spark, sf_dir), rules)


@query(
    "commute_summary",
    ("rules", "commute_answers"),
    """
SELECT count(*) AS checked, count(*) FILTER (distance_km <= threshold_km) AS valid,
       count(*) FILTER (distance_km > threshold_km) AS anomalies,
       count(*) FILTER (distance_km IS NULL) AS errors
FROM commute_answers JOIN rules USING (commute_mode)""",
)
def _(spark, sf_dir):
    rules = commute_rules(spark, roles.RULES)
    return commute.summary(roles.commute_answers(spark, sf_dir), rules)


@query(
    "commute_candidates",
    ("employees", "rules"),
    """
SELECT employee_id, business_unit AS home_address, commute_mode, travel_mode
FROM employees JOIN rules USING (commute_mode) ORDER BY employee_id""",
)
def _(spark, sf_dir):
    people = roles.employees(spark, sf_dir).withColumnRenamed("business_unit", "home_address")
    return commute.candidates(people, commute_rules(spark, roles.RULES))


@query(
    "rule_coverage",
    ("employees", "rules"),
    """
SELECT commute_mode, count(*) AS row_count FROM employees
WHERE commute_mode IS NOT NULL AND commute_mode NOT IN (SELECT commute_mode FROM rules)
GROUP BY commute_mode""",
)
def _(spark, sf_dir):
    return uncovered(
        roles.employees(spark, sf_dir), commute_rules(spark, roles.RULES), "commute_mode"
    )


# --- Reports ---------------------------------------------------------------------


@query("export_benefits", BENEFITS, "SELECT * FROM benefits")
def _(spark, sf_dir):
    return reporting.benefits_view(benefits(spark, sf_dir))


@query("export_round_trip", BENEFITS, "SELECT * FROM benefits")
def _(spark, sf_dir):
    # Checked and written as a report, then read back with the types of the table.
    computed = benefits(spark, sf_dir)
    folder = shared_dir(spark, "reports")
    require_rows(computed, ["employee_id"], None, "export of benefits")
    path = write_report(reporting.benefits_view(computed), folder, "employee_benefits")
    return read_delimited(spark, path, reporting.benefits_view(computed).schema)


@query(
    "export_activities",
    ("activities",),
    """
SELECT activity_id, employee_id, start_datetime, sport_type, distance_meters, end_datetime
FROM activities""",
)
def _(spark, sf_dir):
    return reporting.activities_view(roles.activities(spark, sf_dir))


@query(
    "activity_report",
    ("activities",),
    """
, per_employee AS (SELECT employee_id, count(*) AS n FROM activities GROUP BY employee_id)
SELECT 'invalid_dates' AS check_name, count(*) FILTER (end_datetime <= start_datetime) AS value, TRUE AS blocking FROM activities
UNION ALL SELECT 'negative_distances', count(*) FILTER (distance_meters < 0), TRUE FROM activities
UNION ALL SELECT 'outside_period', count(*) FILTER (start_datetime < TIMESTAMP '2024-01-03 00:00:00'
    OR start_datetime > TIMESTAMP '2024-01-28 12:00:00'), TRUE FROM activities
UNION ALL SELECT 'total_activities', count(*), FALSE FROM activities
UNION ALL SELECT 'employees_with_activity', count(DISTINCT employee_id), FALSE FROM activities
UNION ALL SELECT 'sports_count', count(DISTINCT sport_type), FALSE FROM activities
UNION ALL SELECT 'min_per_employee', min(n), FALSE FROM per_employee
UNION ALL SELECT 'max_per_employee', max(n), FALSE FROM per_employee
UNION ALL SELECT 'mean_per_employee_x100', CAST(round(round(avg(n), 2) * 100) AS BIGINT), FALSE FROM per_employee
UNION ALL SELECT 'sport: ' || coalesce(sport_type, 'none'), count(*), FALSE FROM activities GROUP BY sport_type
UNION ALL SELECT 'below_threshold', count(*) FILTER (n < 15), FALSE FROM per_employee
UNION ALL SELECT 'at_least_threshold', count(*) FILTER (n >= 15), FALSE FROM per_employee""",
)
def _(spark, sf_dir):
    return quality.period_report(
        roles.activities(spark, sf_dir), roles.PERIOD_START, roles.PERIOD_END
    )


@query(
    "expected_vs_actual",
    BENEFITS,
    """
, measured AS (
  SELECT count(*) AS row_count, count(DISTINCT employee_id) AS distinct_employees,
         count(*) - count(DISTINCT employee_id) AS duplicates,
         count(*) FILTER (activity_count > 0) AS employees_with_activity,
         count(*) FILTER (sport_bonus_eligible) AS bonus_eligible,
         count(*) FILTER (NOT sport_bonus_eligible) AS bonus_not_eligible,
         sum(sport_bonus_amount) AS bonus_total,
         count(*) FILTER (wellbeing_days_eligible) AS wellbeing_eligible,
         count(*) FILTER (NOT wellbeing_days_eligible) AS wellbeing_not_eligible,
         sum(wellbeing_days_awarded) AS wellbeing_days
  FROM benefits),
metrics AS (
  SELECT metric_name, CAST(metric_value AS DECIMAL(20,2)) AS metric_value FROM (
    SELECT 'row_count' AS metric_name, row_count AS metric_value FROM measured
    UNION ALL SELECT 'distinct_employees', distinct_employees FROM measured
    UNION ALL SELECT 'duplicates', duplicates FROM measured
    UNION ALL SELECT 'employees_with_activity', employees_with_activity FROM measured
    UNION ALL SELECT 'bonus_eligible', bonus_eligible FROM measured
    UNION ALL SELECT 'bonus_not_eligible', bonus_not_eligible FROM measured
    UNION ALL SELECT 'bonus_total', bonus_total FROM measured
    UNION ALL SELECT 'wellbeing_eligible', wellbeing_eligible FROM measured
    UNION ALL SELECT 'wellbeing_not_eligible', wellbeing_not_eligible FROM measured
    UNION ALL SELECT 'wellbeing_days', wellbeing_days FROM measured))
SELECT metric_name, CAST(metric_value + off AS DECIMAL(20,2)) AS expected, metric_value AS actual, abs(off) < 0.01 AS matches
FROM (SELECT *, CASE length(metric_name) % 4 WHEN 0 THEN 0 WHEN 1 THEN 0.01 WHEN 2 THEN -1 ELSE 0 END AS off FROM metrics)""",
)
def _(spark, sf_dir):
    # Figures of the table read back, against expectations some of which are off by a rule.
    computed = benefits(spark, sf_dir)
    path = shared_dir(spark, "benefits")
    publish(computed, path)
    written = read_published(spark, path)
    kind = F.char_length("metric_name") % 4
    off = F.when(kind == 1, F.lit(Decimal("0.01"))).when(kind == 2, F.lit(Decimal("-1.00"))).otherwise(F.lit(Decimal("0.00")))
    wanted = metric_rows(plan.benefits_totals(computed)).withColumn(
        "metric_value", (F.col("metric_value") + off).cast("decimal(20,2)")
    )
    return against_expected(metric_rows(plan.benefits_totals(written)), wanted)


@query("load_twice", ("activities",), "SELECT * FROM activities WHERE start_datetime < TIMESTAMP '2024-01-20 00:00:00'")
def _(spark, sf_dir):
    # A reload replaces: first everything, then less; nothing of the first load stays.
    path = shared_dir(spark, "reloaded")
    rows = roles.activities(spark, sf_dir)
    publish(rows, path)
    publish(rows.filter("start_datetime < timestamp_ntz'2024-01-20 00:00:00'"), path)
    return read_published(spark, path)


@query(
    "activity_windows",
    ("activities",),
    """
SELECT count(*) FILTER (start_datetime >= TIMESTAMP '2024-01-15 00:00:00') AS in_window,
       count(*) FILTER (start_datetime >= TIMESTAMP '2024-01-15 00:00:00'
                    AND start_datetime <= TIMESTAMP '2025-01-15 00:00:00') AS in_bounded_window,
       count(*) FILTER (start_datetime < TIMESTAMP '2024-01-15 00:00:00') AS too_old
FROM activities""",
)
def _(spark, sf_dir):
    day, start = dt.date(2025, 1, 15), F.col("start_datetime")
    return roles.activities(spark, sf_dir).agg(
        F.count_if(in_window(start, day)).alias("in_window"),
        F.count_if(in_window(start, day, bounded=True)).alias("in_bounded_window"),
        F.count_if(too_old(start, day)).alias("too_old"),
    )


@query(
    "out_of_period",
    ("activities",),
    """
SELECT count(*) FILTER (end_datetime > TIMESTAMP '2024-01-28 12:00:00') AS future_activities,
       count(*) FILTER (start_datetime < TIMESTAMP '2024-01-03 00:00:00'
                    OR start_datetime > TIMESTAMP '2024-01-28 12:00:00') AS outside_period
FROM activities""",
)
def _(spark, sf_dir):
    return roles.activities(spark, sf_dir).agg(
        F.count_if(in_future(F.col("end_datetime"), roles.PERIOD_END)).alias("future_activities"),
        F.count_if(outside(F.col("start_datetime"), roles.PERIOD_START, roles.PERIOD_END)).alias(
            "outside_period"
        ),
    )
