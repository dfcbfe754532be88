"""What leaves for the reporting tool."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perkline.operators.checks import require_rows
from perkline.schemas import ACTIVITY_EXPORT_COLUMNS, BENEFIT_COLUMNS
from perkline.sources.files import write_report


def benefits_view(benefits: DataFrame) -> DataFrame:
    return benefits.select(*BENEFIT_COLUMNS)


def activities_view(activities: DataFrame) -> DataFrame:
    return activities.select(*ACTIVITY_EXPORT_COLUMNS)


def export_reports(
    benefits: DataFrame,
    activities: DataFrame,
    folder: str,
    expected_employees: int | None = None,
    single_file: bool | list[str] = False,
) -> dict[str, str]:
    """Check both tables, then write both reports. Nothing is written if a check fails.

    ``single_file`` names the reports that become one file, for a desktop tool; True means both. Activities
    have no bound, so one file of them is one task for the whole table.
    """
    single = lambda name: name in single_file if isinstance(single_file, list) else single_file
    require_rows(benefits, ["employee_id"], expected_employees, "export of benefits")
    require_rows(activities, ["activity_id"], None, "export of activities")
    return {
        "employee_benefits": write_report(benefits_view(benefits), folder, "employee_benefits", single("employee_benefits")),
        "activities": write_report(activities_view(activities), folder, "activities", single("activities")),
    }
