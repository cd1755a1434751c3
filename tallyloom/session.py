"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every operator assumes."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """A session on this machine, for tests and timings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # Recording the Python call site of every column costs more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local master, where every task sees the same disk, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tallyloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths of the tables kept within each open ``scratch`` block.
_open: list[list[str]] = []


def cut_lineage(df: DataFrame, stay: bool = False) -> DataFrame:
    """Keep a frame as a table in the shared folder and go on from that.

    It is computed once, outlives lost executors, and later plans start from a plain scan. Within a
    ``scratch`` block it is removed at the block's end, unless it is to ``stay``; else the folder's
    owner decides how long such tables stay.
    """
    path = scratch_path(df.sparkSession, "kept")
    if _open and not stay:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables kept within the block at its end, when its outputs are written."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
