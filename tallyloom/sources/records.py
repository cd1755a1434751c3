"""Records of CSV files whose quoted fields may hold line breaks, read in as many splits as Spark cuts.

Files are read as physical lines. A line begins a record where the number of quotes before it in its
file is even; a doubled quote counts two and changes nothing. Lines are numbered per file, the numbers
cut into chunks, and every chunk summed up for both states it may be entered in, inside quotes or
outside: its own parity and the last line that would begin a record. One scan over these few rows
per file says which state each chunk is entered in, so a record may cross any number of splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.running import CHUNK, match

#: A whole chunk of at least so many lines in which no record begins is an unclosed quote.
LEAST_LINES = 1000


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``(_file, _number, _all, value)``: physical lines of each file from 0.

    ``_all`` is the file's number of lines. Lines end at ``\\n``. They are counted per split first, which
    reads the files once more but moves one row per split only.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    splits = lines.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("_lines"))
    file = W.partitionBy("_file")
    splits = splits.withColumns(
        {
            "_before": F.coalesce(F.sum("_lines").over(file.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
            "_all": F.sum("_lines").over(file),
        }
    ).drop("_lines")
    # Ids are consecutive within a split.
    number = F.col("_before") + F.col("_line") - F.col("_first")
    return lines.join(splits, ["_file", "_block"]).select("_file", number.alias("_number"), "_all", "value")


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def records(spark: SparkSession, path, skip: int = 0, chunk: int = CHUNK) -> DataFrame:
    """``(_file, _number, record)``: each record once, with the number of its first line.

    The record that begins at line ``skip`` is a file's header. Line breaks inside quotes are kept, with their ``\\r``; one
    ``\\r`` at a record's end goes, and so do blank records. The first ``skip`` physical lines of each file
    are not looked at, whatever quotes they hold; a file that ends within them raises. A quote inside a
    field that is not quoted counts like any other. A quote that is not closed within about ``chunk``
    lines raises instead of gathering the rest of the file into one record.
    """
    lines = numbered_lines(spark, path).withColumn("_chunk", F.floor(F.col("_number") / chunk))
    too_short = F.raise_error(F.lit("preamble longer than the file")).cast("boolean")
    lines = lines.where(F.when(F.col("_all") <= skip, too_short).otherwise(F.col("_number") >= skip)) if skip else lines
    place = W.partitionBy("_file", "_chunk").orderBy("_number")
    before = F.coalesce(F.sum("_q").over(place.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2
    local = lines.withColumn("_q", _quotes(F.col("value"))).withColumn("_odd", before).drop("_all")
    # What each chunk does to either state; combined before it is moved.
    last = lambda state: F.max(F.when(F.col("_odd") == state, F.col("_number")))
    chunks = local.groupBy("_file", "_chunk").agg(
        F.sum("_q").alias("_q"), last(0).alias("_even"), last(1).alias("_uneven"), F.count("*").alias("_n")
    )
    behind = W.partitionBy("_file").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    entered = chunks.withColumn("_in", F.coalesce(F.sum("_q").over(behind), F.lit(0)) % 2)
    starts = F.when(F.col("_in") == 0, F.col("_even")).otherwise(F.col("_uneven"))
    never = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("_file"))).cast("long")
    starts = F.when(starts.isNull() & (F.col("_n") >= max(chunk, LEAST_LINES)), never).otherwise(starts)
    entered = entered.withColumn("_own", starts)
    carried = F.last("_own", ignorenulls=True).over(behind)
    carry = entered.select("_file", "_chunk", "_in", carried.alias("_carried"))
    known = match(local, carry, ["_file", "_chunk"])
    begins = F.when((F.col("_odd") + F.col("_in")) % 2 == 0, F.col("_number"))
    first = F.coalesce(F.last(begins, ignorenulls=True).over(place.rowsBetween(W.unboundedPreceding, 0)), F.col("_carried"))
    named = known.withColumn("_first", first)
    # A line that begins a record and closes all its quotes is the record; only the others meet.
    whole = (F.col("_first") == F.col("_number")) & (F.col("_q") % 2 == 0)
    alone = named.where(whole).select("_file", "_number", F.col("value").alias("record"))
    parts = named.where(~whole).groupBy("_file", F.col("_first").alias("_number")).agg(
        F.array_sort(F.collect_list(F.struct("_number", "value"))).alias("_parts")
    )
    joined = parts.select("_file", "_number", F.array_join(F.col("_parts.value"), "\n").alias("record"))
    ended = F.regexp_replace("record", "\r$", "")
    return alone.unionByName(joined).withColumn("record", ended).where(F.trim("record") != "")


def n_fields(record: Column) -> Column:
    """Fields of a record: commas outside quotes, and one."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def fields(record: Column, width: int) -> Column:
    """The first ``width`` fields of a record as an array of texts, null where there are fewer."""
    names = ", ".join(f"_c{i} string" for i in range(width))
    parsed = F.from_csv(record, names, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return F.array(*[parsed[f"_c{i}"] for i in range(width)])
