"""Row filters, sentinel cleaning and column shaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_true(test: Column) -> Column:
    """A predicate whose null counts as false, so a test and its negation cover all rows."""
    return F.coalesce(test, F.lit(False))


def filter_all(
    df: DataFrame,
    not_in: Mapping[str, Iterable] = {},
    equals: Mapping[str, object] = {},
    is_in: Mapping[str, Iterable] = {},
) -> DataFrame:
    """Keep rows that pass every test. A null passes ``not_in`` and fails the others."""
    tests = [~is_true(F.col(c).isin(list(v))) for c, v in not_in.items()]
    tests += [F.col(c) == F.lit(v) for c, v in equals.items()]
    tests += [F.col(c).isin(list(v)) for c, v in is_in.items()]
    return df.where(reduce(Column.__and__, tests, F.lit(True)))


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def sentinel_to_null(df: DataFrame, columns: Iterable[str], values: Iterable[str]) -> DataFrame:
    """Whole-cell sentinel texts become null; absent columns are skipped."""
    marks = list(values)
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.when(~F.col(c).isin(marks), F.col(c)) for c in present})


def negative_to_null(value: Column) -> Column:
    """Negative key numbers stand for no value."""
    return F.when(value >= 0, value)


def minus_one_to_null(value: Column) -> Column:
    """Only -1 stands for no value."""
    return F.nullif(value, F.lit(-1).cast("bigint"))


def split_by(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Two complete halves; rows whose test is null go to the second."""
    yes = is_true(test)
    return df.where(yes), df.where(~yes)


def split_columns(
    df: DataFrame, key: str, sensitive: list[str], shared: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rest, sensitive) frames; ``shared`` columns stay in both."""
    return df.drop(*sensitive), df.select(key, *sensitive, *shared)


def conform(
    df: DataFrame, contract: T.StructType, renames: Mapping[str, str] = {}
) -> DataFrame:
    """Keep, order, rename and cast to the target contract. ``renames`` maps target to source."""
    return df.select(
        *[F.col(renames.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in contract]
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def drop_null_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def drop_zero(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose measure is 0; null stays (it compares unequal)."""
    return df.where(~is_true(F.col(column) == 0))


def replace_everywhere(df: DataFrame, old: str, new: str) -> DataFrame:
    """Whole-cell replacement in every text column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.replace(old, new, subset=texts) if texts else df


def ensure_columns(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Add the contract's absent columns as typed nulls."""
    missing = [f for f in contract if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def with_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division whose zero denominator gives null rather than an error."""
    return F.try_divide(numerator, denominator)
