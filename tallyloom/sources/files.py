"""File lists as DataFrames ``(path, modified)`` and the choice of files to load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.groups import top_rows


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def discover_files(spark: SparkSession, root: str, exclude: list[str] = ()) -> DataFrame:
    """All files below ``root``, sorted by path, without temporary (``.`` or ``~``) names.

    Lists names and times only; file contents are not read. Spark itself also hides names that
    start with an underscore.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("modificationTime").alias("modified"))
    )
    return visible_files(found, exclude)


def visible_files(files: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Drop temporary names and excluded paths, sort by path."""
    kept = files.where(~file_name(F.col("path")).rlike(r"^[.~]"))
    if exclude:
        kept = kept.where(~F.col("path").isin(list(exclude)))
    return kept.orderBy("path")


def latest_file(files: DataFrame, pattern: str) -> DataFrame:
    """The newest file whose name matches; ties go to the greater path."""
    return (
        files.where(file_name(F.col("path")).rlike(pattern))
        .agg(F.max(F.struct("modified", "path")).alias("_f"))
        .where(F.col("_f").isNotNull())
        .select("_f.path", "_f.modified")
    )


def last_n_files(files: DataFrame, n: int = 2, backfill: bool = False) -> DataFrame:
    """The last ``n`` files by path, or all of them on backfill."""
    return files if backfill else files.orderBy(F.col("path").desc()).limit(n)


def latest_per_group(files: DataFrame, group: str, order: str, min_group: int) -> DataFrame:
    """Per group number read from the path, the file with the greatest order number in its name.

    Both patterns hold one group of digits; a name without an order number counts as 0. Of
    several files with one order number the first by path is taken.
    """
    number = F.regexp_extract(file_name(F.col("path")), order, 1)
    keyed = files.withColumns(
        {
            "group": F.regexp_extract("path", group, 1).try_cast("int"),
            "number": F.coalesce(number.try_cast("int"), F.lit(0)),
        }
    ).where(F.col("group") >= min_group)
    return top_rows(keyed, ["group"], [F.col("number").desc(), "path"])


def with_file_attrs(df: DataFrame, column: str, pattern: str, names: list[str]) -> DataFrame:
    """Columns read out of a file name by the groups of a pattern; no match gives null."""
    return df.withColumns(
        {
            n: F.nullif(F.regexp_extract(F.col(column), pattern, i), F.lit(""))
            for i, n in enumerate(names, start=1)
        }
    )
