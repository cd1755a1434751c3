"""Month columns to rows, and bi-weekly periods to calendar months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import PERIOD_DAYS, days_in_month, month_parts, month_text


def unpivot_months(
    df: DataFrame, ids: list[str], months: list[str], year: str | Column, value: str = "volume"
) -> DataFrame:
    """Twelve month columns in calendar order to rows ``(ids, month, value)``; null cells go."""
    numbered = df.withColumn("_year", F.col(year) if isinstance(year, str) else year).select(
        *ids, "_year", *[F.col(c).alias(str(n)) for n, c in enumerate(months, start=1)]
    )
    long = numbered.unpivot(
        [*ids, "_year"], [str(n) for n in range(1, len(months) + 1)], "_month", value
    )
    return long.where(F.col(value).isNotNull()).select(
        *ids,
        F.format_string("%04d-%02d", F.col("_year").cast("int"), F.col("_month").cast("int")).alias("month"),
        value,
    )


def periods_to_months(
    df: DataFrame, keys: list[str], measures: list[str], fte: str | None, start: str = "start_date"
) -> DataFrame:
    """Share every period's measures out over the months it touches and add them up.

    ``fte`` is a rate, so its share is scaled by period days / days in the month. The sums run
    over decimal amount x whole days and are divided once at the end: exact, and independent of
    row order. Nulls are left out of a sum; a null start has no months.
    """
    parts = df.withColumn("_part", F.explode(month_parts(F.col(start))))
    day, days = F.col("_part.day"), F.col("_part.days").cast("decimal(2,0)")
    names = measures + ([fte] if fte else [])
    long = parts.select(
        *keys,
        F.trunc(day, "month").alias("_month"),
        *[(F.col(m).cast("decimal(24,8)") * days).alias(m) for m in names],
    )
    totals = long.groupBy(*keys, "_month").agg(*[F.sum(m).cast("double").alias(m) for m in names])
    return totals.select(
        *keys,
        month_text(F.col("_month")).alias("month"),
        *[(F.col(m) / F.lit(float(PERIOD_DAYS))).alias(m) for m in measures],
        *([(F.col(fte) / days_in_month(F.col("_month"))).alias(fte)] if fte else []),
    )
