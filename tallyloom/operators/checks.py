"""Validation of inputs and results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def input_report(inputs: Mapping[str, DataFrame], floors: Mapping[str, int]) -> DataFrame:
    """One row per input: name, rows, floor, ok."""
    report = None
    for name, df in inputs.items():
        floor = floors.get(name, 1)
        row = df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("input"),
            "rows",
            F.lit(floor).cast("bigint").alias("floor"),
            (F.col("rows") >= floor).alias("ok"),
        )
        report = row if report is None else report.unionByName(row)
    return report


def require_inputs(report: DataFrame) -> None:
    """Raise naming the inputs below their floor (the report has one row per input)."""
    bad = [r["input"] for r in report.where(~F.col("ok")).select("input").collect()]
    if bad:
        raise ValueError(f"too few rows in: {', '.join(sorted(bad))}")


def require_columns(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Raise if a column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found in {label}: {', '.join(missing)}")
    return df


def require_headers(header: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Sheets whose header ``(keys, name)`` lacks a required name, with the names missing."""
    wanted = F.array(*[F.lit(c) for c in columns])
    known = header.where(F.col("name").isin(columns))
    return (
        header.select(*keys).distinct()
        .join(known.groupBy(*keys).agg(F.collect_set("name").alias("_have")), keys, "left")
        .select(
            *keys,
            F.array_except(wanted, F.coalesce("_have", F.array().cast("array<string>"))).alias("missing"),
        )
        .where(F.size("missing") > 0)
    )


def unresolved_report(df: DataFrame, ident: str, by: str, ignore: list[str] = ()) -> DataFrame:
    """Rows without an id, counted per source value."""
    rows = df.where(F.col(ident).isNull())
    if ignore:
        rows = rows.where(~F.coalesce(F.col(by).isin(list(ignore)), F.lit(False)))
    return rows.groupBy(by).agg(F.count("*").alias("rows"))


def resolved(value: Column, message: str) -> Column:
    """``value``, or an error naming the problem where it is null.

    The check runs within the job that uses the column, so the input is not read twice.
    """
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(message)))


def require_none(bad: DataFrame, message: str, show: int = 5) -> None:
    """Raise if any row is left, quoting a few."""
    rows = bad.limit(show).collect()
    if rows:
        raise ValueError(f"{message}: {[r.asDict() for r in rows]}")


def content_check(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """Rows whose two readings of the same fact differ or are missing."""
    return df.withColumns({"left_value": left, "right_value": right}).where(
        ~F.coalesce(F.col("left_value") == F.col("right_value"), F.lit(False))
    )
