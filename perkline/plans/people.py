"""Person files: first audit and ingest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from perkline import fixed_values as fixed
from perkline.operators.cleaning import correct_values, missing_to_null, rename_headers, typed_or_set_aside
from perkline.operators.matching import key_differences
from perkline.operators.profiling import repeated_rows
from perkline.schemas import EMPLOYEES, SPORT_PROFILE
from perkline.sources.files import CORRUPT


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def employees_from_file(raw: DataFrame, headers: dict[str, str] = fixed.HR_HEADERS) -> DataFrame:
    return _typed(rename_headers(raw, headers), EMPLOYEES)


def profile_from_file(raw: DataFrame, headers: dict[str, str] = fixed.SPORT_HEADERS) -> DataFrame:
    """Misspelt sports corrected, empty cells NULL."""
    named = rename_headers(raw, headers)
    corrected = correct_values(named, "sport_type", fixed.SPORT_CORRECTIONS)
    return _typed(missing_to_null(corrected, "sport_type"), SPORT_PROFILE)


def employees_or_set_aside(
    raw: DataFrame, headers: dict[str, str] = fixed.HR_HEADERS
) -> tuple[DataFrame, DataFrame]:
    """Employees of a leniently read file, and the records that are none: ``(record, reasons)``."""
    return typed_or_set_aside(rename_headers(raw, headers), EMPLOYEES, CORRUPT)


def profile_or_set_aside(
    raw: DataFrame, headers: dict[str, str] = fixed.SPORT_HEADERS
) -> tuple[DataFrame, DataFrame]:
    named = correct_values(rename_headers(raw, headers), "sport_type", fixed.SPORT_CORRECTIONS)
    return typed_or_set_aside(missing_to_null(named, "sport_type"), SPORT_PROFILE, CORRUPT)


def audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``(section, item, value)`` rows on two files that should describe the same people.

    Sections ``rows``, ``columns``, ``repeated_rows``, ``repeated_keys`` (items
    ``left`` and ``right``), ``types`` (item ``side.column type``, value: its position),
    ``nulls`` (item ``side.column``) and ``missing_keys`` (item: the side that lacks
    them). Each file is read three times: for its columns, for repeated rows (texts as
    digests) and, both files together, for the keys.
    """
    parts = [_key_sections(left, right, key)]
    for side, df in (("left", left), ("right", right)):
        parts += [
            _column_sections(df, side),
            repeated_rows(df).select(
                F.lit("repeated_rows").alias("section"), F.lit(side).alias("item"), F.col("later_rows").alias("value")
            ),
        ]
    return reduce(DataFrame.unionByName, parts)


def missing_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The ids themselves: ``(key, missing_from)``."""
    return key_differences(left, right, key)


def frequency_table(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    """``(side, column_name, column_value, row_count)`` of several columns from one scan."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("column_value")) for c in columns])
    )
    counted = df.select(cells.alias("cell")).groupBy("cell.column_name", "cell.column_value")
    return counted.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(side).alias("side"), "column_name", "column_value", "row_count"
    )


def _entries(one_row: DataFrame, entries: list[tuple[str, str, Column]]) -> DataFrame:
    """One row of numbers as ``(section, item, value)`` rows."""
    structs = [
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), v.cast("long").alias("value")) for s, i, v in entries
    ]
    return one_row.select(F.explode(F.array(*structs)).alias("entry")).select("entry.*")


def _column_sections(df: DataFrame, side: str) -> DataFrame:
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"nulls{i}") for i, n in enumerate(names)],
    )
    entries = [("rows", side, F.col("rows")), ("columns", side, F.lit(len(names)))]
    entries += [("nulls", f"{side}.{n}", F.col(f"nulls{i}")) for i, n in enumerate(names)]
    entries += [("types", f"{side}.{n} {kind}", F.lit(i + 1)) for i, (n, kind) in enumerate(df.dtypes)]
    return _entries(counts, entries)


def _key_sections(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    sides = left.select(F.col(f"`{key}`").alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(f"`{key}`").alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    keys = sides.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    later = lambda side: F.coalesce(F.sum(F.greatest(F.col(side) - 1, F.lit(0))), F.lit(0))
    counts = keys.agg(
        later("l").alias("later_left"),
        later("r").alias("later_right"),
        F.count_if(F.col("r") == 0).alias("not_right"),
        F.count_if(F.col("l") == 0).alias("not_left"),
    )
    found = _entries(
        counts,
        [
            ("repeated_keys", "left", F.col("later_left")),
            ("repeated_keys", "right", F.col("later_right")),
            ("missing_keys", "right", F.col("not_right")),
            ("missing_keys", "left", F.col("not_left")),
        ],
    )
    return found.filter((F.col("section") != "missing_keys") | (F.col("value") > 0))
