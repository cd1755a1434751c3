"""Table reads and writes on parquet.

Writers never overwrite the data they read from: a keyed merge returns a frame to be written
to a new path, after which the caller switches to that path. A table in buckets of its keys is merged
in place: the new contents of the touched buckets are staged first, the others stay as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.contracts import contract
from tallyloom.operators.cleaning import conform
from tallyloom.operators.groups import top_rows
from tallyloom.operators.running import match
from tallyloom.session import cut_lineage

META = contract(string="dataset", timestamp="modified")
SOURCES_META = contract(string="source", timestamp="modified")


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written; on a first run it has not."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_or_empty(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """The table's columns of a layout, or no rows before the first run."""
    if exists(spark, path):
        return read_table(spark, path, layout.fieldNames())
    return spark.createDataFrame([], layout)


def write_snapshot(df: DataFrame, path: str, layout: T.StructType) -> None:
    """Replace the table by these rows, in its contract."""
    conform(df, layout).write.mode("overwrite").parquet(path)


def upsert(
    target: DataFrame, updates: DataFrame, key: str | list[str], order: list[str | Column]
) -> DataFrame:
    """Insert or update by key; of several updates the last under ``order`` wins.

    Only the updates are ranked, and kept once: they are read for their keys and for their rows.
    Target rows pass an anti join on the key, so a small batch merges into a large table without
    shuffling it once Spark can broadcast the batch's keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    latest_first = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    latest = cut_lineage(top_rows(updates, keys, latest_first).select(*target.columns))
    return target.join(latest.select(*keys), keys, "left_anti").select(*target.columns).unionByName(latest)


BUCKET = "key_bucket"


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_buckets(df: DataFrame, path: str, key: str | list[str], buckets: int) -> None:
    """Write a table as folders of key hashes, which ``upsert_buckets`` replaces one by one.

    ``buckets`` stays with the table: a hundred to some thousands, so that a folder holds a few files.
    """
    keys = [key] if isinstance(key, str) else list(key)
    _bucketed(df, keys, buckets).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table written by ``write_buckets``."""
    return spark.read.parquet(path).drop(BUCKET)


def finish_upsert(spark: SparkSession, path: str) -> None:
    """Put the staged folders of a stopped ``upsert_buckets`` in place, if they were written whole.

    Doing it again changes nothing. Folders staged in part are removed; the table never saw them.
    """
    staged = f"{path}.staged"
    if exists(spark, f"{staged}/_SUCCESS"):
        table = spark.read.parquet(staged).repartition(BUCKET)
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    _remove(spark, staged)


def upsert_buckets(
    updates: DataFrame, path: str, key: str | list[str], order: list[str | Column], buckets: int
) -> None:
    """``upsert`` into the table at ``path``, rewriting only the folders whose keys the updates hold.

    Only those folders are read (partition pruning by a list of at most ``buckets`` numbers). Their new
    contents are first staged whole beside the table, then put in place, so it can be run again after
    a stop anywhere: before the staging ended the table is as it was, afterwards the next run first
    puts the staged folders in place. One writer at a time; reads that must not meet a switch take
    place between runs. Null keys are keys like any other; no updates change nothing.
    """
    spark = updates.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    finish_upsert(spark, path)
    target = spark.read.parquet(path)
    latest_first = [(F.col(o) if isinstance(o, str) else o).desc() for o in order]
    columns = [c for c in target.columns if c != BUCKET]
    latest = cut_lineage(_bucketed(top_rows(updates, keys, latest_first).select(*columns), keys, buckets))
    touched = [r[0] for r in latest.select(BUCKET).distinct().collect()]
    if not touched:
        return
    old = target.where(F.col(BUCKET).isin(touched))
    kept = match(old, latest.select(BUCKET, *keys), [BUCKET, *keys], "left_anti")
    merged = kept.select(*columns, BUCKET).unionByName(latest)
    merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}.staged")
    finish_upsert(spark, path)


def new_rows(df: DataFrame, existing: DataFrame, key: str | list[str]) -> DataFrame:
    return df.join(existing, key, "left_anti")


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table lacks; running it again adds nothing."""
    if exists(df.sparkSession, path):
        df = new_rows(df, df.sparkSession.read.parquet(path).select(key), key)
    df.write.mode("append").parquet(path)


def log_ingest(
    meta: DataFrame, sources_meta: DataFrame, dataset: str, files: DataFrame | None, ran_at: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Last run per dataset and modified time per source file, merged into the log tables.

    ``files`` is a file list ``(path, modified)``.
    """
    spark = meta.sparkSession
    run = conform(spark.range(1).select(
        F.lit(dataset).alias("dataset"), F.lit(str(ran_at)).alias("modified")
    ), META)
    meta = upsert(meta, run, "dataset", ["modified"])
    if files is not None:
        seen = conform(files, SOURCES_META, {"source": "path"})
        sources_meta = upsert(sources_meta, seen, "source", ["modified"])
    return meta, sources_meta
