"""Grouped operators that never hold one whole group in a task.

Top-k and first-row operators use ``row_number() <= k``, which Spark limits per group
before the shuffle (WindowGroupLimit), so a hot key sends k rows per input partition.
Counts, sums and ``max_by`` are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.running import running


def _columns(names: list[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_rows(
    df: DataFrame, keys: list[str], order: list[str | Column], k: int = 1, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows per key under a total order, with their rank if asked for."""
    window = W.partitionBy(*keys).orderBy(*_columns(order))
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def dedupe_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key. Unlike ``dropDuplicates`` it says which row that is."""
    return top_rows(df, keys, order)


def max_row_per_key(
    df: DataFrame, key: str, by: str, ties: list[str | Column] = (), numeric: bool = False
) -> DataFrame:
    """Row with the greatest ``by`` per key; null keys and null ``by`` are dropped.

    ``by`` compares as text unless ``numeric``; "9" is then above "10".
    """
    rank = F.col(by).cast("bigint") if numeric else F.col(by)
    rows = df.where(F.col(key).isNotNull() & F.col(by).isNotNull())
    return top_rows(rows, [key], [rank.desc(), *ties])


def group_to_json(
    df: DataFrame,
    key: str,
    columns: list[str],
    order: str | list[str],
    out: str = "json",
    part_rows: int = 100_000,
) -> DataFrame:
    """Rows per key as JSON arrays of records, nulls written out, in ``order``.

    Returns ``(key, part, out)``: consecutive parts of ``part_rows`` records, numbered from 0, so
    that no task gathers an unbounded group. A short list is one part. ``order`` is a position as
    in ``running``, unique per key.
    """
    at = [order] if isinstance(order, str) else list(order)
    rows = df.where(F.col(key).isNotNull()).select(key, *at, F.struct(*columns).alias("_record"))
    ranked = running(rows, [key], at, sums={"_rank": F.lit(1)})
    entry = F.struct(F.col("_rank"), "_record")
    packed = F.transform(F.array_sort(F.collect_list(entry)), lambda r: r["_record"])
    return ranked.groupBy(key, F.floor((F.col("_rank") - 1) / part_rows).alias("part")).agg(
        F.to_json(packed, {"ignoreNullFields": "false"}).alias(out)
    )


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def groups_per_key(df: DataFrame, key: str, item: str, out: str = "n") -> DataFrame:
    """Number of distinct items per key."""
    return df.select(key, item).distinct().groupBy(key).agg(F.count("*").alias(out))


def majority(counts: DataFrame, key: str, item: str, n: str) -> DataFrame:
    """Item holding more than half of the key's total, where there is one."""
    return (
        counts.groupBy(key)
        .agg(
            F.sum(n).alias("total"),
            F.max(n).alias("most"),
            F.max_by(item, F.struct(n, item)).alias(item),
        )
        .where(F.col("most") * 2 > F.col("total"))
        .drop("most", "total")
    )


def latest_by(value: Column, order: list[str | Column], test: Column | None = None) -> Column:
    """Aggregate: ``value`` of the last row under ``order``, optionally among rows passing a test."""
    rank = F.struct(*_columns(order))
    return F.max_by(value, rank if test is None else F.when(test, rank))


def last_k(
    df: DataFrame, keys: list[str], order: list[str | Column], test: Column, k: int = 3
) -> DataFrame:
    """Per key over its first ``k`` rows: how many rows, how many pass, any, all."""
    rows = top_rows(df.withColumn("_test", F.coalesce(test, F.lit(False))), keys, order, k)
    return rows.groupBy(*keys).agg(
        F.count("*").alias("last_n"),
        F.count_if("_test").alias("last_hits"),
        F.bool_or("_test").alias("any_hit"),
        F.bool_and("_test").alias("all_hit"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def sample_first(df: DataFrame, order: list[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows under an order, for display."""
    return df.orderBy(*_columns(order)).limit(n)
