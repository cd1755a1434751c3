"""CSV readers. Everything is read as text and cast, so a bad value raises under ANSI."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.checks import require_columns
from tallyloom.operators.running import CHUNK, match
from tallyloom.sources.records import fields as record_fields
from tallyloom.sources.records import n_fields, records

# Cell texts that mean "missing" in the extracts.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

FILE_ORDER = ["_file", "_block", "_line"]


BAD = "_bad_record"


def _options(reader, multiline: bool):
    # Without column pruning every record is cut whole, so that short ones are noticed.
    return (
        reader.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", BAD)
    )


def _with_bad(layout: T.StructType) -> T.StructType:
    return T.StructType([*layout, T.StructField(BAD, T.StringType())])


def _whole(df: DataFrame, width: int) -> DataFrame:
    """Raise where a record has fewer than ``width`` fields, which Spark would fill with nulls.

    Spark marks records of another width than expected; of those, the fields are counted.
    """
    unquoted = F.regexp_replace(BAD, r'"(?:[^"]|"")*"', "")
    fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit(""))) + 1
    quoted = F.concat(F.lit("a record is too short: "), F.substring(BAD, 1, 200))
    checked = F.when(F.col(BAD).isNotNull() & (fields < width), F.raise_error(quoted).cast("boolean"))
    return df.where(F.coalesce(checked, F.lit(True))).drop(BAD)


def _blank_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING), F.col(c)) for c in columns})


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_file, _block, _line``, which together sort rows as they stand in the files.

    Must follow the read directly. Line ids rise within an input split only, so the split's
    file and offset come first.
    """
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_line": F.monotonically_increasing_id(),
        }
    )


def _finish(df: DataFrame, layout: T.StructType, keep_order: bool) -> DataFrame:
    typed = {f.name: F.col(f.name).cast(f.dataType) for f in layout}
    extra = FILE_ORDER if keep_order else []
    return df.select(*[c.alias(n) for n, c in typed.items()], *extra)


def read_positional(
    spark: SparkSession, path, layout: T.StructType, keep_order: bool = False, multiline: bool = False
) -> DataFrame:
    """Header line replaced by a positional layout; extra trailing fields are dropped.

    A record with fewer fields than the layout raises. ``multiline`` reads line breaks inside
    quotes, in any number of splits (``records``).
    """
    if multiline:
        body = records(spark, path).where(F.col("_number") > 0)
        values = _long_enough(body, F.lit(len(layout)), len(layout))
        named = values.select(*_places(), *[F.col("_values")[i].alias(f.name) for i, f in enumerate(layout)])
        return _finish(_blank_to_null(named, layout.fieldNames()), layout, keep_order)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in layout])
    raw = _options(spark.read.schema(_with_bad(texts)), multiline).option("enforceSchema", True).csv(path)
    raw = _whole(with_file_order(raw) if keep_order else raw, len(layout))
    return _finish(_blank_to_null(raw, layout.fieldNames()), layout, keep_order)


def read_named(
    spark: SparkSession,
    path,
    layout: T.StructType,
    renames: Mapping[str, str] = {},
    keep_order: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Header-driven read: keep the layout's columns, cast, rename (``renames`` maps header to name).

    All files of one call share a header; a file with another one, or a record with fewer fields
    than the header, raises. With ``multiline`` each file is read by its own header instead
    (``read_by_header``).
    """
    if multiline:
        return read_by_header(spark, path, layout, renames, keep_order)
    header = require_columns(_options(spark.read, multiline).csv(path), layout.fieldNames(), str(path)).schema
    reader = _options(spark.read.schema(_with_bad(header)), multiline).option("enforceSchema", False)
    raw = reader.csv(path)
    raw = _whole(with_file_order(raw) if keep_order else raw, len(header))
    typed = _finish(_blank_to_null(raw, layout.fieldNames()), layout, keep_order)
    return typed.withColumnsRenamed(dict(renames))


def _places() -> list:
    """The file order of a record: its file and its first line."""
    return [F.col("_file"), F.lit(0).cast("bigint").alias("_block"), F.col("_number").alias("_line")]


def _long_enough(body: DataFrame, needed, width: int) -> DataFrame:
    """The records with their first ``width`` fields as ``_values``; one of fewer than ``needed`` raises."""
    quoted = F.concat(F.lit("a record is too short: "), F.substring("record", 1, 200))
    # Not a filter, which Spark would apply to headers as well, before these are left out.
    short = F.when(n_fields(F.col("record")) < needed, F.raise_error(quoted).cast("array<string>"))
    return body.withColumn("_values", short.otherwise(record_fields(F.col("record"), width)))


def read_by_header(
    spark: SparkSession,
    path,
    layout: T.StructType,
    renames: Mapping[str, str] = {},
    keep_order: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """Read files of different headers in one go, each by its own: columns may move, more may be there.

    The layout's columns are kept, cast and renamed (``renames`` maps header to name); of a header that
    repeats a name the first counts. A file that lacks one of the layout's columns raises, and
    names itself; so does a record with fewer fields than its header. Line breaks inside quotes are kept,
    and a file is cut into as many splits as any other (``records``). The widest header is looked up
    when the frame is made, everything else when it is used.
    """
    found = records(spark, path, chunk=chunk)
    body = found.where(F.col("_number") > 0)
    headers = found.where(F.col("_number") == 0).select("_file", F.col("record").alias("header"))
    sized = headers.withColumn("_width", n_fields(F.col("header")))
    width = sized.agg(F.max("_width")).first()[0] or 1
    titles = sized.select("_file", "_width", record_fields(F.col("header"), width).alias("_titles"))
    place = lambda name: F.array_position("_titles", F.lit(name)).cast("int")
    missing = F.filter(F.array(*[F.lit(n) for n in layout.fieldNames()]), lambda n: F.array_position("_titles", n) == 0)
    complaint = F.concat(F.lit("required columns not found in "), F.col("_file"), F.lit(": "), F.array_join(missing, ", "))
    places = F.when(F.size(missing) > 0, F.raise_error(complaint).cast("array<int>")).otherwise(
        F.array(*[place(n) for n in layout.fieldNames()])
    )
    dictionary = titles.select("_file", "_width", places.alias("_places"))
    values = _long_enough(match(body, dictionary, ["_file"], "left"), F.col("_width"), width)
    headless = F.raise_error(F.concat(F.lit("the first line is blank in "), F.col("_file"))).cast("array<int>")
    values = values.withColumn("_places", F.coalesce("_places", headless))
    named = values.select(
        *_places(),
        *[F.element_at("_values", F.col("_places")[i]).alias(f.name) for i, f in enumerate(layout)],
    )
    typed = _finish(_blank_to_null(named, layout.fieldNames()), layout, keep_order)
    return typed.withColumnsRenamed(dict(renames))


def read_preamble(
    spark: SparkSession,
    path,
    skip: int,
    width: int,
    columns: Mapping[int, str],
    layout: T.StructType,
    keep_order: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Skip ``skip`` lines and the header after them, keep columns by 0-based ordinal.

    The lines stay splittable: they are counted per split, to learn where each file's data begins.
    ``width`` is the number of fields read per record. ``multiline`` reads line breaks inside quotes
    below the preamble, whatever quotes that holds.
    """
    if multiline:
        found = records(spark, path, skip).where(F.col("_number") > skip)
        values = found.withColumn("_values", record_fields(F.col("record"), width))
        named = values.select(*_places(), *[F.col("_values")[i].alias(n) for i, n in columns.items()])
        return _finish(_blank_to_null(named, list(columns.values())), layout, keep_order)
    lines = with_file_order(spark.read.text(path))
    splits = lines.groupBy(F.col("_file").alias("_f"), F.col("_block").alias("_b")).agg(
        F.min("_line").alias("_first"), F.count("*").alias("_lines")
    )
    before = W.partitionBy("_f").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumns(
        {
            "_before": F.coalesce(F.sum("_lines").over(before), F.lit(0)),
            "_all": F.sum("_lines").over(W.partitionBy("_f")),
        }
    )
    # Ids are consecutive within a split.
    number = F.col("_before") + F.col("_line") - F.col("_first")
    behind_header = F.when(F.col("_all") > skip, number > skip).otherwise(
        F.raise_error(F.lit("preamble longer than the file")).cast("boolean")
    )
    body = lines.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))).where(behind_header)
    fields = ", ".join(f"_c{i} string" for i in range(width))
    parsed = body.where(F.trim("value") != "").select(
        *FILE_ORDER, F.from_csv("value", fields, {"escape": '"'}).alias("_r")
    )
    named = parsed.select(*FILE_ORDER, *[F.col(f"_r._c{i}").alias(n) for i, n in columns.items()])
    return _finish(_blank_to_null(named, list(columns.values())), layout, keep_order)
