"""Whole texts in Arrow batches, for the operators that work on bytes inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID, TEXT = "_id", "_text"
#: Texts sent to a task's Python side at once; a longer text is a batch of its own.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of this session by bytes, whatever the length of its rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as UTF-8 bytes. Other columns, whatever their names, stay behind."""
    small_batches(df.sparkSession)
    return df.select(df[id_col].alias(ID), df[text_col].cast("string").cast("binary").alias(TEXT))


def map_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    fields: str,
    start: Callable[[], Callable[[list[bytes | None]], list]],
) -> DataFrame:
    """One output row per input row: the id and ``fields`` (DDL).

    ``start()`` runs once per task and gives a function from a batch of texts to a list of
    columns. A batch is what Spark sends at once (bounded by rows and by bytes), so a task never
    holds more than that, whatever the size of its partition.
    """
    source = texts(df, id_col, text_col)
    id_type = source.schema[ID].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = start()
        for batch in batches:
            if batch.num_rows:
                columns = of(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    schema = f"`{id_col}` {id_type}, {fields}"
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]
    return source.mapInArrow(run, schema)


def text_column(
    df: DataFrame, text_col: str, fields: str, start: Callable[[], Callable[[list[bytes | None]], list]]
) -> Column:
    """``fields`` (DDL) of each whole text as one struct column, for filters on whole rows.

    The other columns of a row wait in the JVM, so nothing is joined back and no id is needed.
    """
    small_batches(df.sparkSession)
    schema = df.sparkSession.createDataFrame([], fields).schema
    names = [f.name for f in schema]

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of = start()
        for batch in batches:
            columns = of(batch.to_pylist()) if len(batch) else [pa.array([]) for _ in names]
            yield pa.StructArray.from_arrays(columns, names)

    return run(df[text_col].cast("string").cast("binary"))
