"""Indented lists: line numbers, missing headings and tree paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.running import CHUNK, match, running
from tallyloom.session import cut_lineage


def heading_rows(
    lines: DataFrame,
    after: str,
    heading: str,
    keys: list[str],
    name: str = "name",
    row: str = "row",
    indent: str = "indent",
    heading_indent: int = 1,
) -> DataFrame:
    """``(keys, row, name, indent)`` of a heading below the first row called ``after`` whose next
    row is indented. It sits at row + 0.5, once per key at most."""
    named = lines.where(F.col(name) == after).select(*keys, F.col(row).alias("_row"))
    below = lines.where(F.col(indent) > 0).select(*keys, (F.col(row) - 1).alias("_row"))
    first = match(named, below, [*keys, "_row"], "left_semi").groupBy(*keys).agg(F.min("_row").alias("_row"))
    return first.select(
        *keys,
        (F.col("_row") + 0.5).alias(row),
        F.lit(heading).alias(name),
        F.lit(heading_indent).cast("int").alias(indent),
    )


def insert_heading(
    df: DataFrame,
    after: str,
    heading: str,
    keys: list[str],
    name: str = "name",
    row: str = "row",
    indent: str = "indent",
    heading_indent: int = 1,
) -> DataFrame:
    """Add the heading of ``heading_rows``; ``row`` comes back as a double."""
    added = heading_rows(df, after, heading, keys, name, row, indent, heading_indent)
    return df.withColumn(row, F.col(row).cast("double")).unionByName(added, allowMissingColumns=True)


def skip_rows(df: DataFrame, name: str = "name", prefix: str = "Check -") -> DataFrame:
    """Drop blank names and names starting with ``prefix``; trim the rest."""
    text = F.regexp_replace(F.col(name), r"^\s+|\s+$", "")
    return df.withColumn(name, text).where((F.col(name) != "") & ~F.col(name).startswith(prefix))


def line_numbers(df: DataFrame, keys: list[str], row: str = "row", out: str = "line_num", chunk: int = CHUNK) -> DataFrame:
    """1-based number over the kept rows of each key."""
    return running(df, keys, row, sums={out: F.lit(1)}, chunk=chunk)


def outline_to_path(
    df: DataFrame,
    keys: list[str],
    row: str = "row",
    indent: str = "indent",
    name: str = "name",
    out: str = "tree",
    chunk: int = CHUNK,
) -> DataFrame:
    """Indented list to ``a|b|c`` paths, with line numbers.

    A row's depth is its indent, but at most one below the row before it. As a closed form:
    least(n, n + 1 + running minimum of (indent - n)) with n the line number. Each ancestor is the
    last earlier name at its depth. The greatest depth is read from the rows, which are kept as a
    table once for that and for the names.
    """
    numbered = line_numbers(df, keys, row, "line_num", chunk)
    floor = running(numbered, keys, row, mins={"_low": F.col(indent) - F.col("line_num")}, chunk=chunk)
    depth = F.least(F.col("line_num"), F.col("line_num") + 1 + F.col("_low"))
    deep = cut_lineage(floor.select(*df.columns, "line_num", depth.cast("int").alias("_depth")))
    levels = deep.agg(F.max("_depth")).first()[0] or 1
    names = {f"_a{k}": F.when(F.col("_depth") == k, F.col(name)) for k in range(1, levels + 1)}
    filled = running(deep, keys, row, lasts=names, chunk=chunk)
    steps = F.slice(F.array(*[F.col(n) for n in names]), F.lit(1), F.col("_depth"))
    return filled.select(*df.columns, "line_num", F.concat_ws("|", steps).alias(out))
