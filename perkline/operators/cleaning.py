"""Renaming, correcting and normalising input columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def rename_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rename by map; a header that is not there is an error, unknown columns stay."""
    missing = [name for name in headers if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed(headers)


def correct_values(df: DataFrame, column: str, corrections: dict[str, str]) -> DataFrame:
    """Replace whole values by map; other values and NULL stay."""
    return df.na.replace(corrections, subset=[column])


def typed_or_set_aside(
    df: DataFrame, schema: StructType, corrupt: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Text rows in the types of ``schema``, and those that do not fit: ``(record, reasons)``.

    A row is set aside if its ``corrupt`` column holds a line that could not be split, if a value is none of its
    column's type, or if one is missing where the schema allows no NULL. ``record`` is that line, or the cells as JSON. Both
    sides come from the same pass over the cells, without a shuffle; no row is in both or in neither.
    """
    line = F.lit(None).cast("string") if corrupt is None else F.col(corrupt)
    cells = [c for c in df.columns if c != corrupt]
    reasons = []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        wrong = text.isNotNull() & text.try_cast(f.dataType).isNull()
        reasons.append(F.when(wrong, F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if not f.nullable:
            reasons.append(F.when(text.isNull(), F.lit(f"{f.name}: missing")))
    judged = df.withColumn(
        "_reasons",
        F.when(line.isNotNull(), F.array(F.lit("cells"))).otherwise(F.array_compact(F.array(*reasons))),
    )
    fits = F.size("_reasons") == 0
    good = judged.filter(fits).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    record = F.coalesce(line, F.to_json(F.struct(*[f"`{c}`" for c in cells])))
    return good, judged.filter(~fits).select(record.alias("record"), F.col("_reasons").alias("reasons"))


def missing_to_null(df: DataFrame, column: str, markers: tuple[str, ...] = ("", "NaN")) -> DataFrame:
    """Turn blank text and missing-value markers into NULL."""
    text = F.trim(F.col(column))
    return df.withColumn(column, F.when(~text.isin(*markers), F.col(column)))
