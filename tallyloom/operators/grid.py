"""Tables inside spreadsheets.

The input is a cell grid ``(file, sheet, row, col, value, indent)``, 0-based, with blank cells
absent or null. Every operator works on all sheets of all files in one job, and in one way for
sheets of every size: positions are cut into chunks, what a chunk does to a run or block is found in a
sorted array of its positions, and only these small results are carried along a sheet; cells then
take up the run or block of their own chunk. Null file and sheet names are names like any other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.a1 import cell_address, column_index, in_columns, in_rows
from tallyloom.operators.running import CHUNK, match

SHEET = ["file", "sheet"]
CELL = "file string, sheet string, row int, col int, value string, indent int"


def filled(cells: DataFrame) -> DataFrame:
    """Cells that hold a value."""
    return cells.where(F.col("value").isNotNull())


def select_sheets(cells: DataFrame, pattern: str) -> DataFrame:
    """Sheets whose name matches a regular expression."""
    return cells.where(F.col("sheet").rlike(pattern))


def cell_value(cells: DataFrame, ref: str, out: str = "value") -> DataFrame:
    """The value at one address, per sheet."""
    row, col = cell_address(ref)
    return cells.where((F.col("row") == row) & (F.col("col") == col)).select(
        *SHEET, F.col("value").alias(out)
    )


def cell_range(cells: DataFrame, ref: str) -> DataFrame:
    """The cells of a block such as ``B2:D5``."""
    first, _, last = ref.partition(":")
    (top, left), (bottom, right) = cell_address(first), cell_address(last or first)
    return cells.where(F.col("row").between(top, bottom) & F.col("col").between(left, right))


def find_cell(cells: DataFrame, text: str, start: str = "A1") -> DataFrame:
    """First cell per sheet equal to ``text`` ignoring case, scanning column by column.

    Rows above the start cell are skipped in every column. Sheets without a hit are absent.
    """
    top, left = cell_address(start)
    hits = filled(cells).where(
        (F.col("row") >= top) & (F.col("col") >= left) & (F.lower("value") == text.lower())
    )
    first = hits.groupBy(*SHEET).agg(F.min(F.struct("col", "row")).alias("_at"))
    return first.select(*SHEET, F.col("_at.row").alias("row"), F.col("_at.col").alias("col"))


def run_edges(positions: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Start and end edges of the unbroken runs in a set of positions.

    Each row is ``(keys, at, starts, ends)``: ``starts`` marks a run's first position, ``ends``
    the first position after a run.
    """
    marks = positions.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(at).alias("at"), F.lit(1).alias("own"), F.lit(0).alias("next")),
                F.struct((F.col(at) + 1).alias("at"), F.lit(0).alias("own"), F.lit(1).alias("next")),
            )
        ).alias("_m"),
    ).select(*keys, "_m.*")
    seen = marks.groupBy(*keys, "at").agg(F.max("own").alias("own"), F.max("next").alias("next"))
    return seen.select(
        *keys,
        F.col("at").alias(at),
        ((F.col("own") == 1) & (F.col("next") == 0)).alias("starts"),
        ((F.col("own") == 0) & (F.col("next") == 1)).alias("ends"),
    ).where("starts OR ends")


def next_position(cells: DataFrame, axis: str, lines: str, start: int = 0, find_empty: bool = False) -> DataFrame:
    """Next row (``axis='row'``, ``lines`` are columns) or column (``lines`` are rows) per sheet.

    First position >= ``start`` that holds data within ``lines``, or, with ``find_empty``, that
    holds none. -1 where there is none before the sheet's last used position.
    """
    across = in_columns(F.col("col"), lines) if axis == "row" else in_rows(F.col("row"), lines)
    sheets = cells.groupBy(*SHEET).agg((F.max(axis) + 1).alias("_size"))
    used = filled(cells).where(across & (F.col(axis) >= start)).select(*SHEET, axis).distinct()
    if find_empty:
        # The position before ``start`` stands in as used, so a blank start is a gap at once.
        seed = sheets.select(*SHEET, F.lit(start - 1).cast("int").alias(axis))
        edges = run_edges(used.unionByName(seed), SHEET, axis)
        found = edges.where("ends").groupBy(*SHEET).agg(F.min(axis).alias("_at"))
    else:
        found = used.groupBy(*SHEET).agg(F.min(axis).alias("_at"))
    return match(sheets, found, SHEET, "left").select(
        *SHEET,
        F.when(F.col("_at") < F.col("_size"), F.col("_at")).otherwise(F.lit(-1)).alias("position"),
    )


def _islands(cells: DataFrame, axis: str, limit: int | None, chunk: int) -> DataFrame:
    """Number the runs of used positions along ``axis`` and keep the cells inside them.

    The used positions of a chunk are one sorted array of at most ``chunk`` entries. Chunk by chunk of
    a sheet it is carried on whether the first run joins the run before it and how many runs there were.
    """
    data = filled(cells)
    used = data.groupBy(*SHEET, F.floor(F.col(axis) / chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_set(axis)).alias("_used")
    )
    # A chunk's first position always counts here; whether it goes on with a run is seen below.
    starts = F.filter("_used", lambda p, i: F.coalesce(F.get("_used", i - 1) < p - 1, F.lit(True)))
    along = W.partitionBy(*SHEET).orderBy("_chunk")
    opened = F.col("_starts") - F.col("_joins")
    carry = used.select(
        *SHEET,
        "_chunk",
        F.size(starts).alias("_starts"),
        F.get("_used", F.lit(0)).alias("_first"),
        F.element_at("_used", -1).alias("_last"),
    ).withColumn("_joins", F.coalesce(F.lag("_last").over(along) == F.col("_first") - 1, F.lit(False)).cast("int"))
    carry = carry.select(*SHEET, "_chunk", (F.sum(opened).over(along) - F.col("_starts")).alias("_before"))
    numbered = F.transform(starts, lambda p, i: F.struct(p.cast("bigint").alias("_at"), (F.col("_before") + i + 1).alias("table_no")))
    runs = match(used, carry, [*SHEET, "_chunk"]).select(*SHEET, "_chunk", F.explode(numbered).alias("_run"))
    placed = _under(data, runs.select(*SHEET, "_chunk", "_run.*"), axis, "table_no", chunk)
    return placed.where(F.col("table_no") <= limit) if limit else placed


def _under(cells: DataFrame, announced: DataFrame, axis: str, value: str, chunk: int) -> DataFrame:
    """The cells with the last ``value`` announced at or before their position, within their chunk.

    ``announced`` has the sheet keys, ``_chunk``, a bigint ``_at`` along ``axis`` and ``value``. Cells are moved
    once, by sheet and chunk.
    """
    placed = cells.withColumns({"_chunk": F.floor(F.col(axis) / chunk), "_at": F.col(axis).cast("bigint"), "_cell": F.lit(True)})
    both = placed.unionByName(announced, allowMissingColumns=True)
    # At equal positions what is announced, which is no cell, comes first.
    along = W.partitionBy(*SHEET, "_chunk").orderBy("_at", F.col("_cell").asc_nulls_first())
    last = F.last(value, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn(value, last).where("_cell").select(*cells.columns, value)


def tables_by_columns(cells: DataFrame, rows: str, limit: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Split side-by-side tables at blank columns, looking at the given rows only.

    Adds ``table_no`` from 1, left to right.
    """
    return _islands(cells.where(in_rows(F.col("row"), rows)), "col", limit, chunk)


def tables_by_rows(
    cells: DataFrame, cols: str, start: int = 0, limit: int | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Split stacked tables at blank rows, looking at the given columns only.

    Rows before ``start`` are skipped. Adds ``table_no`` from 1, top to bottom.
    """
    part = cells.where(in_columns(F.col("col"), cols) & (F.col("row") >= start))
    return _islands(part, "row", limit, chunk)


def _in_leading_run(cells: DataFrame, at: str, start: int) -> DataFrame:
    """The cells whose position lies in the unbroken run that begins exactly at ``start``.

    Cells lie at or behind ``start``. The run may be empty.
    """
    edges = run_edges(cells.select(*SHEET, at).distinct(), SHEET, at)
    ends = edges.groupBy(*SHEET).agg(
        F.min(F.when(F.col("ends"), F.col(at))).alias("_end"),
        F.bool_or(F.col("starts") & (F.col(at) == start)).alias("_begins"),
    ).where("_begins").select(*SHEET, "_end")
    return match(cells, ends, SHEET).where(F.col(at) < F.col("_end")).drop("_end")


def table_at(cells: DataFrame, start: str, header: bool = True) -> DataFrame:
    """The table whose top left corner is ``start``.

    Its right edge is the first column blank in both the header and the first data row, its
    bottom the first row blank across those columns. Header rows are kept in the result.
    """
    top, left = cell_address(start)
    first_data = top + 1 if header else top
    data = filled(cells).where((F.col("row") >= top) & (F.col("col") >= left))
    heads = _in_leading_run(data.where(F.col("row").isin(top, first_data)), "col", left)
    edge = heads.groupBy(*SHEET).agg(F.max("col").alias("_right"))
    wide = match(data, edge, SHEET).where(F.col("col") <= F.col("_right")).drop("_right")
    return _in_leading_run(wide, "row", top)


def header_names(cells: DataFrame, by: list[str] = SHEET, header_row: int | None = None) -> DataFrame:
    """``(by, col, name)`` from the header row; a repeated name keeps its first column.

    Without ``header_row`` it is the first row of each table.
    """
    if header_row is None:
        top = cells.groupBy(*by).agg(F.min("row").alias("_top"))
        heads = match(filled(cells), top, by).where(F.col("row") == F.col("_top"))
    else:
        heads = filled(cells).where(F.col("row") == header_row)
    return heads.groupBy(*by, F.col("value").alias("name")).agg(F.min("col").alias("col"))


def by_row(cells: DataFrame, keys: list[str], values: Mapping[str, Column]) -> DataFrame:
    """One output row per key with the greatest text of each value.

    Spark sorts what it takes a greatest text of, in parts before the shuffle too. There a part is an
    input split, and a few megabytes of a compressed file hold any number of cells. So cells are moved first
    and sorted once, in shuffled parts, whose number grows with the cells.
    """
    return cells.repartition(*keys).groupBy(*keys).agg(*[F.max(v).alias(n) for n, v in values.items()])


def promote_header(
    cells: DataFrame,
    names: list[str],
    by: list[str] = SHEET,
    header: DataFrame | None = None,
    header_row: int | None = None,
) -> DataFrame:
    """Header row becomes the column names: one output row per data row with the known ``names``.

    With a ``header(by, col, name)`` the cells are the data rows only. Otherwise the names come
    from ``header_row``, or from the first row of each table, and the rows below are the data.
    """
    if header is not None:
        body, head = filled(cells), header
    elif header_row is not None:
        body, head = filled(cells).where(F.col("row") > header_row), header_names(cells, by, header_row)
    else:
        top = cells.groupBy(*by).agg(F.min("row").alias("_top"))
        body, head = match(filled(cells), top, by).where(F.col("row") > F.col("_top")), header_names(cells, by)
    named = match(body, head.where(F.col("name").isin(names)), [*by, "col"], "left")
    return by_row(named, [*by, "row"], {n: F.when(F.col("name") == n, F.col("value")) for n in names})


def by_position(cells: DataFrame, names: Mapping[int, str], by: list[str] = SHEET) -> DataFrame:
    """One output row per grid row, columns taken by 0-based index; other columns are not moved."""
    wanted = filled(cells).where(F.col("col").isin(list(names)))
    return by_row(wanted, [*by, "row"], {n: F.when(F.col("col") == i, F.col("value")) for i, n in names.items()})


def merge_subheader(cells: DataFrame, anchor: str, positions: list[int], by: list[str] = SHEET) -> DataFrame:
    """Header ``(by, col, name)`` below an anchor cell with two header rows.

    Columns left of the anchor are dropped. At the given offsets from the anchor the name comes
    from the second header row. Returned with the anchor's row as ``top``.
    """
    at = find_cell(cells, anchor).select(*SHEET, F.col("row").alias("top"), F.col("col").alias("left"))
    near = match(filled(cells), at, SHEET).where(
        (F.col("col") >= F.col("left")) & F.col("row").between(F.col("top"), F.col("top") + 1)
    )
    second = (F.col("col") - F.col("left")).isin(positions)
    wanted = F.when(second, F.col("top") + 1).otherwise(F.col("top"))
    return near.where(F.col("row") == wanted).groupBy(*by, "top", F.col("value").alias("name")).agg(
        F.min("col").alias("col")
    )


def drop_columns_at(cells: DataFrame, offsets: list[int], by: list[str] = SHEET) -> DataFrame:
    """Drop columns by offset from each table's first column and close the gaps.

    ``col`` comes back as the offset within the table.
    """
    left = cells.groupBy(*by).agg(F.min("col").alias("_left"))
    moved = match(cells, left, by).withColumn("col", F.col("col") - F.col("_left")).drop("_left")
    shift: Column = F.lit(0)
    for offset in offsets:
        shift = shift + (F.col("col") > offset).cast("int")
    return moved.where(~F.col("col").isin(offsets)).withColumn("col", F.col("col") - shift)


def first_and_last_column(cells: DataFrame, by: list[str] = SHEET) -> DataFrame:
    """``(by, row, first, last)``: the leftmost and rightmost columns of each table."""
    edge = cells.groupBy(*by).agg(F.min("col").alias("_left"), F.max("col").alias("_right"))
    outer = match(filled(cells), edge, by).where((F.col("col") == F.col("_left")) | (F.col("col") == F.col("_right")))
    ends = {"first": "_left", "last": "_right"}
    return by_row(outer, [*by, "row"], {n: F.when(F.col("col") == F.col(e), F.col("value")) for n, e in ends.items()})


def block_spans(
    cells: DataFrame, start: str, end: str, start_from: str = "A", end_from: str = "B", chunk: int = CHUNK
) -> DataFrame:
    """Repeated blocks ``(sheet keys, block_no, first_row, end_row)`` between two marker texts.

    A start marker opens a block when none is open, the next end marker on the same row or
    below closes it. Per sheet a marker is read in the leftmost column holding it, at or right
    of its ``*_from`` column. ``end_row`` is null for a block that is never closed.

    Marker rows of a chunk are one sorted array of at most ``chunk`` entries. Its effect is a map from
    the state before it (open or closed) to the state behind it and a number of opened blocks; these maps
    are composed along the chunks of a sheet, after which each chunk knows its own openings and ends.
    Openings and ends alternate, so the nth end closes the nth block.
    """
    at = lambda text, first: F.min(
        F.when((F.lower("value") == text.lower()) & (F.col("col") >= column_index(first)), F.col("col"))
    )
    wanted = filled(cells).where(F.lower("value").isin(start.lower(), end.lower()))
    hits = wanted.groupBy(*SHEET, "row").agg(at(start, start_from).alias("_s"), at(end, end_from).alias("_e"))
    lead = hits.groupBy(*SHEET).agg(F.min("_s").alias("_lead_s"), F.min("_e").alias("_lead_e"))
    starts, ends = (F.coalesce(F.col(f"_{k}") == F.col(f"_lead_{k}"), F.lit(False)) for k in "se")
    marks = match(hits, lead, SHEET).select(*SHEET, "row", starts.alias("s"), ends.alias("e")).where("s or e")
    # On one row the start comes before the end, so a row with an end leaves all closed.
    mark = F.struct("row", "s", "e", (~F.col("e")).alias("open"))
    parts = marks.groupBy(*SHEET, F.floor(F.col("row") / chunk).alias("_chunk")).agg(
        F.array_sort(F.collect_list(mark)).alias("_marks")
    )

    def before(i: Column, carried: Column) -> Column:
        return F.coalesce(F.get("_marks", i - 1)["open"], carried)

    def opened(carried: Column) -> Column:
        return F.filter("_marks", lambda m, i: m["s"] & ~before(i, carried))

    def closed(carried: Column) -> Column:
        return F.filter("_marks", lambda m, i: m["e"] & (before(i, carried) | m["s"]))

    maps = parts.select(
        *SHEET,
        "_chunk",
        F.element_at("_marks", -1)["open"].alias("_open"),
        F.size(opened(F.lit(False))).alias("_if_closed"),
        F.size(opened(F.lit(True))).alias("_if_open"),
    )
    along = W.partitionBy(*SHEET).orderBy("_chunk")
    found = F.when(F.col("_is_open"), F.col("_if_open")).otherwise(F.col("_if_closed"))
    carry = maps.withColumn("_is_open", F.coalesce(F.lag("_open").over(along), F.lit(False))).select(
        *SHEET, "_chunk", "_is_open", (F.sum(found).over(along) - found).alias("_before")
    )
    known = match(parts, carry, [*SHEET, "_chunk"])
    still_open = F.col("_is_open").cast("int")
    turns = F.concat(
        F.transform(opened(F.col("_is_open")), lambda m, i: F.struct(
            (F.col("_before") + i + 1).alias("block_no"), m["row"].alias("first_row"), F.lit(None).cast("int").alias("end_row")
        )),
        F.transform(closed(F.col("_is_open")), lambda m, i: F.struct(
            (F.col("_before") - still_open + i + 1).alias("block_no"), F.lit(None).cast("int").alias("first_row"), m["row"].alias("end_row")
        )),
    )
    return known.select(*SHEET, F.explode(turns).alias("_t")).groupBy(*SHEET, F.col("_t.block_no").alias("block_no")).agg(
        F.min("_t.first_row").alias("first_row"), F.min("_t.end_row").alias("end_row")
    )


def blocks_between(
    cells: DataFrame,
    start: str,
    end: str,
    skip_head: int = 4,
    skip_tail: int = 2,
    start_from: str = "A",
    end_from: str = "B",
    chunk: int = CHUNK,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Cells of the repeated blocks, without head rows and the last rows before the end marker.

    ``spans`` are the ``block_spans`` if they are known already.

    Adds ``block_no``. A span is announced in every chunk of rows it reaches into, so each cell finds its
    block by one running value over its own chunk: cells are moved once, without a range join.
    """
    data = filled(cells)
    found = block_spans(data, start, end, start_from, end_from, chunk) if spans is None else spans
    body = found.select(
        *SHEET, "block_no", (F.col("first_row") + skip_head).alias("_top"), (F.col("end_row") - skip_tail).alias("_end")
    ).where(F.col("_top") < F.col("_end"))
    chunks = F.sequence(F.floor(F.col("_top") / chunk), F.floor((F.col("_end") - 1) / chunk))
    announced = body.withColumn("_chunk", F.explode(chunks)).select(
        *SHEET,
        "_chunk",
        F.greatest("_top", F.col("_chunk") * chunk).alias("_at"),
        F.struct("block_no", "_end").alias("_span"),
    )
    inside = _under(data, announced, "row", "_span", chunk).where(F.col("row") < F.col("_span._end"))
    return inside.select(*cells.columns, F.col("_span.block_no").alias("block_no"))


def block_heads(cells: DataFrame, spans: DataFrame, values: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Header values per block: name -> (rows below the block's first row, column)."""
    heads = None
    for name, (down, col) in values.items():
        at = filled(cells).where(F.col("col") == col).select(
            *SHEET, (F.col("row") - down).alias("first_row"), F.col("value").alias(name)
        )
        part = match(spans.select(*SHEET, "block_no", "first_row"), at, [*SHEET, "first_row"], "left")
        part = part.select(*SHEET, "block_no", name)
        heads = part if heads is None else match(heads, part, [*SHEET, "block_no"])
    return heads
