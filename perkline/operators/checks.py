"""Data-quality checks that count violations, judge them and stop jobs.

Checks on single rows are all counted in one pass that shuffles nothing but one
small row per task. Key checks shuffle the key columns only. Every suite ends in
the same tidy shape ``(check_name, value, blocking)``, one row per check, so
suites can be unioned, stored and compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F


class QualityError(ValueError):
    """A gate found blocking violations."""


@dataclass(frozen=True)
class Check:
    """A rule by its violation: an SQL predicate that is true on a bad row.

    A predicate that is NULL (an absent value) is no violation.
    """

    name: str
    violation: str
    blocking: bool = True


def required(column: str, name: str | None = None) -> Check:
    return Check(name or f"null_{column}", f"{column} IS NULL")


def not_blank(column: str, name: str) -> Check:
    return Check(name, f"{column} IS NULL OR trim({column}) = ''")


def max_length(column: str, length: int) -> Check:
    return Check(f"too_long_{column}", f"length({column}) > {length}")


# --- Counting -------------------------------------------------------------


def tidy(measures: DataFrame, informative: Sequence[str] = ()) -> DataFrame:
    """One row of counters to ``(check_name, value, blocking)`` rows."""
    names = measures.columns
    counters = measures.select([F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names])
    return counters.unpivot([], names, "check_name", "value").withColumn(
        "blocking", ~F.col("check_name").isin(list(informative)) if informative else F.lit(True)
    )


def violation_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Violations of all row checks in a single scan."""
    counters = [F.count_if(F.expr(c.violation)).alias(c.name) for c in checks]
    return tidy(df.agg(*counters), [c.name for c in checks if not c.blocking])


def key_measures(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How unique a key is, by every definition in use, from one grouping.

    ``total``              rows
    ``distinct_non_null``  keys without NULL parts (what ``count(DISTINCT …)`` sees)
    ``distinct_keys``      keys where NULL counts as a value
    ``repeated_keys``      keys on more than one row
    ``surplus_rows``       ``total - distinct_non_null``: rows with a NULL key count
    ``later_rows``         ``total - distinct_keys``: rows after the first of their key
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(
        total.alias("total"),
        F.count_if(complete).alias("distinct_non_null"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        (total - F.count_if(complete)).alias("surplus_rows"),
        (total - F.count(F.lit(1))).alias("later_rows"),
    )


def key_counts(
    df: DataFrame, keys: Sequence[str], name: str, measure: str = "surplus_rows"
) -> DataFrame:
    """One key measure as a tidy blocking check."""
    return tidy(key_measures(df, keys).select(F.col(measure).alias(name)))


def all_checks(*suites: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, suites)


# --- Judging --------------------------------------------------------------


def verdict(checks: DataFrame) -> DataFrame:
    """One row: ``(blocking_errors, failed_checks, verdict)``; any blocking count is KO."""
    blocked = F.col("blocking") & (F.col("value") > 0)
    errors = F.coalesce(F.sum(F.when(F.col("blocking"), F.col("value"))), F.lit(0))
    return checks.agg(
        errors.cast("long").alias("blocking_errors"),
        F.count_if(blocked).alias("failed_checks"),
    ).withColumn(
        "verdict", F.when(F.col("blocking_errors") == 0, F.lit("OK")).otherwise(F.lit("KO"))
    )


def split_by_checks(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all blocking checks, and the others with a ``violations`` array."""
    blocking = [c for c in checks if c.blocking]
    # Plain predicates choose the rows; names are gathered only for the bad ones.
    bad = reduce(
        lambda a, b: a | b, [F.coalesce(F.expr(c.violation), F.lit(False)) for c in blocking]
    )
    names = F.array_compact(F.array(*[F.when(F.expr(c.violation), F.lit(c.name)) for c in blocking]))
    return df.filter(~bad), df.filter(bad).withColumn("violations", names)


# --- Gates: the only functions here that run a job -------------------------


def enforce(checks: DataFrame, what: str) -> None:
    """Raise if a blocking check counted anything. Reads one small row per check."""
    failed = checks.filter(F.col("blocking") & (F.col("value") > 0)).orderBy("check_name").collect()
    if failed:
        found = ", ".join(f"{r['check_name']}={r['value']}" for r in failed)
        raise QualityError(f"{what} refused: {found}")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise if a key repeats, or is NULL (a NULL key cannot be matched again)."""
    enforce(key_counts(df, keys, f"repeated_{'_'.join(keys)}"), what)


def require_rows(df: DataFrame, keys: Sequence[str], expected: int | None, what: str) -> None:
    """Raise unless the key is unique and, where given, the number of rows is as expected."""
    row = key_measures(df, keys).first()
    if expected is not None and row["total"] != expected:
        raise QualityError(f"{what} refused: {row['total']} rows, expected {expected}")
    if row["later_rows"]:
        raise QualityError(f"{what} refused: {row['later_rows']} rows with a repeated key")
