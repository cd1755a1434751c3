"""Spreadsheet operators on grids made from the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.operators import grid as g
from tallyloom.operators.checks import require_headers
from tallyloom.operators.outline import insert_heading, outline_to_path, skip_rows


def sheet(name, number, size):
    return F.concat(F.lit(name), F.floor(F.col(number) / size).cast("string")).alias("file")


def cells(df, values):
    """One cell per filled value; ``values`` maps column index to text."""
    laid = F.array(*[F.struct(F.lit(c).alias("col"), v.alias("value")) for c, v in values.items()])
    return (
        df.select("file", F.lit("S1").alias("sheet"), "row", F.explode(laid).alias("_c"))
        .select("file", "sheet", "row", "_c.col", "_c.value")
        .where(F.col("value").isNotNull())
    )


def event_rows(t):
    """A thousand events per file, one per row; an error is a blank row."""
    rows = t.events.select(
        sheet("f", "event_id", 1000), (F.col("event_id") % 1000).cast("int").alias("row"), "event_type", "event_id", "user_id"
    )
    filled = F.col("event_type") != "error"
    return cells(
        rows,
        {
            0: F.when(filled, F.col("event_type")),
            1: F.when(filled, F.col("user_id").cast("string")),
            2: F.when(filled & (F.col("event_id") % 3 != 0), F.col("event_id").cast("string")),
            9: F.lit("note"),
        },
    )


EVENT_ROWS_SQL = """
r AS (SELECT 'f' || CAST(event_id // 1000 AS VARCHAR) AS file, 'S1' AS sheet, CAST(event_id % 1000 AS INTEGER) AS row, * FROM events),
grid AS (SELECT file, sheet, row, 0 AS col, event_type AS value FROM r WHERE event_type <> 'error'
  UNION ALL SELECT file, sheet, row, 1, CAST(user_id AS VARCHAR) FROM r WHERE event_type <> 'error'
  UNION ALL SELECT file, sheet, row, 2, CAST(event_id AS VARCHAR) FROM r WHERE event_type <> 'error' AND event_id % 3 <> 0
  UNION ALL SELECT file, sheet, row, 9, 'note' FROM r)
"""


def islands_sql(axis: str, inside: str) -> str:
    return f"""
part AS (SELECT * FROM grid WHERE {inside}),
p AS (SELECT DISTINCT file, sheet, {axis} FROM part),
i AS (SELECT *, {axis} - row_number() OVER (PARTITION BY file, sheet ORDER BY {axis}) AS grp FROM p),
n AS (SELECT file, sheet, {axis}, dense_rank() OVER (PARTITION BY file, sheet ORDER BY grp) AS table_no FROM i)
SELECT file, sheet, row, col, value, table_no FROM part JOIN n USING (file, sheet, {axis})
"""


@query("tables_by_rows", f"WITH {EVENT_ROWS_SQL}, {islands_sql('row', 'col <= 5')}")
def tables_by_rows(t):
    """Stacked tables parted by blank rows; the note in column J is not looked at."""
    return g.tables_by_rows(event_rows(t), "A:F")


@query("tables_by_rows_chunked", f"WITH {EVENT_ROWS_SQL}, {islands_sql('row', 'col <= 5')}")
def tables_by_rows_chunked(t):
    """The same with chunks far smaller than a sheet."""
    return g.tables_by_rows(event_rows(t), "A:F", chunk=128)


@query(
    "first_tables_by_rows",
    f"WITH {EVENT_ROWS_SQL}, {islands_sql('row', 'col <= 5 AND row >= 6')} WHERE table_no <= 2",
)
def first_tables_by_rows(t):
    return g.tables_by_rows(event_rows(t), "A:F", start=6, limit=2)


def event_columns(t):
    """Nine hundred events per file, three per column; errors and views are blank cells."""
    n = F.col("event_id") % 900
    return t.events.where(~F.col("event_type").isin("error", "view")).select(
        sheet("g", "event_id", 900), F.lit("S1").alias("sheet"),
        (n % 3).cast("int").alias("row"), F.floor(n / 3).cast("int").alias("col"),
        F.col("event_id").cast("string").alias("value"),
    )


EVENT_COLUMNS_SQL = """
grid AS (SELECT 'g' || CAST(event_id // 900 AS VARCHAR) AS file, 'S1' AS sheet, CAST(event_id % 900 % 3 AS INTEGER) AS row,
  CAST(event_id % 900 // 3 AS INTEGER) AS col, CAST(event_id AS VARCHAR) AS value FROM events WHERE event_type NOT IN ('error', 'view'))
"""


@query("tables_by_columns", f"WITH {EVENT_COLUMNS_SQL}, {islands_sql('col', 'row <= 1')}")
def tables_by_columns(t):
    """Side-by-side tables parted by blank columns, looking at rows 1 and 2."""
    return g.tables_by_columns(event_columns(t), "1:2")


@query("tables_by_columns_chunked", f"WITH {EVENT_COLUMNS_SQL}, {islands_sql('col', 'row <= 1')}")
def tables_by_columns_chunked(t):
    """The same with chunks far smaller than a sheet; columns in the order of the input."""
    tables = g.tables_by_columns(event_columns(t), "1:2", chunk=16)
    if tables.columns != ["file", "sheet", "row", "col", "value", "table_no"]:
        raise ValueError(f"columns in another order: {tables.columns}")
    return tables


@query(
    "drop_columns_at",
    f"""WITH {EVENT_COLUMNS_SQL}, q AS ({"WITH " + islands_sql('col', 'row <= 2').strip()}),
m AS (SELECT file, sheet, table_no, min(col) AS lo FROM q GROUP BY ALL)
SELECT file, sheet, table_no, row, value, CASE WHEN col - lo > 1 THEN col - lo - 1 ELSE col - lo END AS col
FROM q JOIN m USING (file, sheet, table_no) WHERE col - lo <> 1
""",
)
def drop_columns_at(t):
    """The second column of every table goes and the rest moves up."""
    tables = g.tables_by_columns(event_columns(t), "1:3")
    return g.drop_columns_at(tables, [1], [*g.SHEET, "table_no"])


@query(
    "first_and_last_column",
    f"""WITH {EVENT_COLUMNS_SQL}, e AS (SELECT file, sheet, min(col) AS lo, max(col) AS hi FROM grid GROUP BY ALL)
SELECT file, sheet, row, max(CASE WHEN col = lo THEN value END) AS first, max(CASE WHEN col = hi THEN value END) AS last
FROM grid JOIN e USING (file, sheet) WHERE col IN (lo, hi) GROUP BY ALL
""",
)
def first_and_last_column(t):
    return g.first_and_last_column(event_columns(t))


def wide_grid(t):
    """Twelve columns of a hundred rows with scattered blanks."""
    rows = t.events.select(
        sheet("h", "event_id", 100), (F.col("event_id") % 100).cast("int").alias("row"), "event_type", "event_id"
    )
    def cell(c):
        return F.when(
            (F.col("event_type") != "error") & ((F.col("event_id") * 3 + c) % 11 != 0),
            F.concat(F.col("event_type"), F.lit(str(c))),
        )

    return cells(rows, {c: cell(c) for c in range(12)})


WIDE_SQL = """
grid AS (SELECT 'h' || CAST(event_id // 100 AS VARCHAR) AS file, 'S1' AS sheet, CAST(event_id % 100 AS INTEGER) AS row,
  CAST(c AS INTEGER) AS col, event_type || CAST(c AS VARCHAR) AS value FROM events, range(12) AS x(c)
  WHERE event_type <> 'error' AND (event_id * 3 + c) % 11 <> 0)
"""


TABLE_AT_SQL = f"""WITH {WIDE_SQL},
heads AS (SELECT DISTINCT file, col FROM grid WHERE row IN (4, 5) AND col >= 1),
hr AS (SELECT file, count(*) AS w FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY col) AS rn FROM heads) WHERE col = rn GROUP BY file),
wide AS (SELECT grid.* FROM grid JOIN hr USING (file) WHERE row >= 4 AND col >= 1 AND col < 1 + w),
rr AS (SELECT file, count(*) AS h FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY row) AS rn FROM (SELECT DISTINCT file, row FROM wide)) WHERE row = rn + 3 GROUP BY file)
SELECT file, sheet, row, col, value FROM wide JOIN rr USING (file) WHERE row < 4 + h
"""


@query("table_at", TABLE_AT_SQL)
def table_at(t):
    """Table from B5: right edge by header and first data row, bottom by the columns found."""
    return g.table_at(wide_grid(t), "B5")


def nameless(cells):
    """The grid with sheets that have no name."""
    return cells.withColumn("sheet", F.lit(None).cast("string"))


def nameless_sql(sql):
    return f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS sheet) FROM ({sql})"


@query("table_at_chunked", nameless_sql(TABLE_AT_SQL))
def table_at_chunked(t):
    return g.table_at(nameless(wide_grid(t)), "B5")


@query(
    "find_cell",
    f"WITH {WIDE_SQL}, f AS (SELECT file, sheet, min((col, row)) AS spot FROM grid WHERE value = 'view3' AND row >= 4 AND col >= 2 GROUP BY ALL) SELECT file, sheet, spot[1] AS col, spot[2] AS row FROM f",
)
def find_cell(t):
    return g.find_cell(wide_grid(t), "VIEW3", "C5")


@query(
    "cell_range",
    f"""WITH {WIDE_SQL}, v AS (SELECT file, value AS corner FROM grid WHERE row = 2 AND col = 1)
SELECT file, sheet, row, col, value, corner FROM grid LEFT JOIN v USING (file)
WHERE row BETWEEN 1 AND 4 AND col BETWEEN 1 AND 3""",
)
def cell_range(t):
    block = g.cell_range(g.select_sheets(wide_grid(t), "^S1$"), "B2:D5")
    return block.join(g.cell_value(wide_grid(t), "B3", "corner"), g.SHEET, "left")


@query(
    "next_row",
    f"""WITH {WIDE_SQL},
s AS (SELECT file, sheet, max(row) + 1 AS h, max(col) + 1 AS w FROM grid GROUP BY ALL),
u AS (SELECT DISTINCT file, row FROM grid WHERE col BETWEEN 0 AND 1 AND row >= 3),
v AS (SELECT DISTINCT file, col FROM grid WHERE row BETWEEN 5 AND 5 AND col >= 1),
gaps AS (SELECT file, x AS row FROM s, range(0, 101) AS y(x) WHERE x >= 3 AND (file, CAST(x AS INTEGER)) NOT IN (SELECT (file, row) FROM u)),
cgaps AS (SELECT file, x AS col FROM s, range(0, 13) AS y(x) WHERE x >= 1 AND (file, CAST(x AS INTEGER)) NOT IN (SELECT (file, col) FROM v))
SELECT s.file, s.sheet, coalesce((SELECT min(row) FROM u WHERE u.file = s.file), -1) AS used_row,
  coalesce((SELECT min(row) FROM gaps WHERE gaps.file = s.file AND row < h), -1) AS empty_row,
  coalesce((SELECT min(col) FROM v WHERE v.file = s.file), -1) AS used_col,
  coalesce((SELECT min(col) FROM cgaps WHERE cgaps.file = s.file AND col < w), -1) AS empty_col FROM s
""",
)
def next_row(t):
    """Next used and next blank row and column."""
    grid = wide_grid(t)
    found = [
        g.next_position(grid, axis, lines, start, empty).withColumnRenamed("position", name)
        for axis, lines, start, empty, name in [
            ("row", "A:B", 3, False, "used_row"), ("row", "A:B", 3, True, "empty_row"),
            ("col", "6", 1, False, "used_col"), ("col", "6", 1, True, "empty_col"),
        ]
    ]
    return found[0].join(found[1], g.SHEET).join(found[2], g.SHEET).join(found[3], g.SHEET)


def customer_sheets(t):
    """Fifty customers per file below a header; odd files have two columns swapped."""
    rows = t.customer.select(
        sheet("c", "c_custkey", 50), (F.col("c_custkey") % 50 + 1).cast("int").alias("row"),
        (F.floor(F.col("c_custkey") / 50) % 2 == 1).alias("odd"), "c_custkey", "c_name", "c_mktsegment",
    )
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    swap = lambda a, b: F.when(F.col("odd"), a).otherwise(b)
    body = cells(rows, {0: swap(name, key), 1: swap(key, name), 2: F.nullif("c_mktsegment", F.lit("BUILDING")), 3: F.lit("again")})
    heads = rows.select("file", "odd").distinct().withColumn("row", F.lit(0))
    return body.unionByName(
        cells(heads, {0: swap(F.lit("Name"), F.lit("Key")), 1: swap(F.lit("Key"), F.lit("Name")), 2: F.lit("Segment"), 3: F.lit("Key")})
    )


@query(
    "promote_header",
    """
SELECT 'c' || CAST(c_custkey // 50 AS VARCHAR) AS file, 'S1' AS sheet, c_custkey % 50 + 1 AS row, CAST(c_custkey AS VARCHAR) AS "Key",
  c_name AS "Name", nullif(c_mktsegment, 'BUILDING') AS "Segment" FROM customer
""",
)
def promote_header(t):
    """Columns by name whatever their order; the repeated name keeps its first column."""
    return g.promote_header(customer_sheets(t), ["Key", "Name", "Segment"])


def two_line_sheets(t):
    """Two header rows at a varying place: some files have a column to the left."""
    rows = t.supplier.select(
        F.concat(F.lit("PP#"), (F.floor(F.col("s_suppkey") / 10) + 1).cast("string"), F.lit(" 2024 x")).alias("file"),
        (F.col("s_suppkey") % 10 + 4).cast("int").alias("row"),
        (F.floor(F.col("s_suppkey") / 10) % 2).cast("int").alias("shift"), "s_suppkey", "s_name", "s_nationkey",
    )
    files = rows.select("file", "shift").distinct()
    top = files.select("file", "shift", F.lit(2).alias("row"))
    second = files.select("file", "shift", F.lit(3).alias("row"))
    parts = [
        cells(rows, {0: F.col("s_suppkey").cast("string"), 1: F.col("s_name"), 2: F.col("s_nationkey").cast("string"), 3: (F.col("s_nationkey") * 2).cast("string")}),
        cells(top, {0: F.lit("Department Number"), 1: F.lit("Department Name"), 2: F.lit("Hours"), 3: F.lit("Total")}),
        cells(second, {2: F.lit("Regular Hours"), 3: F.lit("ignored")}),
    ]
    grid = parts[0].unionByName(parts[1]).unionByName(parts[2])
    moved = grid.join(files, "file").withColumn("col", F.col("col") + F.col("shift")).drop("shift")
    lead = files.where("shift = 1").select("file", F.lit(0).alias("shift"), F.lit(2).alias("row"))
    return moved.unionByName(cells(lead, {0: F.lit("Period")}))


@query(
    "merge_subheader",
    """
SELECT 'PP#' || CAST(s_suppkey // 10 + 1 AS VARCHAR) || ' 2024 x' AS file, 'S1' AS sheet, s_suppkey % 10 + 4 AS row,
  CAST(s_suppkey AS VARCHAR) AS "Department Number", CAST(s_nationkey AS VARCHAR) AS "Regular Hours", CAST(s_nationkey * 2 AS VARCHAR) AS "Total",
  0 AS missing FROM supplier
""",
)
def merge_subheader(t):
    """Header from two rows, names checked, data below both."""
    grid = two_line_sheets(t)
    names = ["Department Number", "Regular Hours", "Total"]
    header = g.merge_subheader(grid, "Department Number", [2])
    bad = require_headers(header, names, g.SHEET).select(*g.SHEET, F.size("missing").alias("missing"))
    body = grid.where(F.col("row") >= 4)
    rows = g.promote_header(body, names, header=header.drop("top"))
    return rows.join(bad, g.SHEET, "left").fillna({"missing": 0})


def event_blocks(t):
    """A signup opens a block in column A, a purchase closes it in column B."""
    rows = t.events.select(
        sheet("b", "event_id", 1000), (F.col("event_id") % 1000).cast("int").alias("row"), "event_type", "event_id"
    )
    return cells(
        rows,
        {
            0: F.when(F.col("event_type") == "signup", "Pay Period"),
            1: F.when(F.col("event_type") == "purchase", "TOTAL"),
            2: F.col("event_id").cast("string"),
        },
    )


BLOCKS_SQL = """
r AS (SELECT 'b' || CAST(event_id // 1000 AS VARCHAR) AS file, 'S1' AS sheet, CAST(event_id % 1000 AS INTEGER) AS row, * FROM events),
m AS (SELECT file, row, CASE event_type WHEN 'signup' THEN 's' ELSE 'e' END AS kind FROM r WHERE event_type IN ('signup', 'purchase')),
k AS (SELECT *, lag(kind, 1, 'e') OVER (PARTITION BY file ORDER BY row) AS prior FROM m),
turn AS (SELECT file, row, kind, sum(CASE WHEN kind = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY row) AS block_no FROM k WHERE kind <> prior),
span AS (SELECT file, block_no, min(row) FILTER (WHERE kind = 's') AS first_row, min(row) FILTER (WHERE kind = 'e') AS end_row FROM turn GROUP BY ALL)
"""


BLOCK_ROWS_SQL = f"""WITH {BLOCKS_SQL}
SELECT r.file, sheet, block_no, r.row, CAST(event_id AS VARCHAR) AS value FROM r JOIN span ON r.file = span.file
  AND r.row >= first_row + 1 AND r.row < end_row - 1"""


@query("blocks_between", BLOCK_ROWS_SQL)
def blocks_between(t):
    """Rows of the repeated blocks without the first row and the last before the end."""
    rows = g.blocks_between(event_blocks(t), "PAY PERIOD", "TOTAL", skip_head=1, skip_tail=1)
    return rows.where("col = 2").drop("col")


@query("blocks_between_chunked", BLOCK_ROWS_SQL)
def blocks_between_chunked(t):
    rows = g.blocks_between(event_blocks(t), "PAY PERIOD", "TOTAL", skip_head=1, skip_tail=1, chunk=128)
    return rows.where("col = 2").drop("col")


@query(
    "block_spans",
    f"""WITH {BLOCKS_SQL} SELECT span.file, 'S1' AS sheet, block_no, first_row, end_row, CAST(event_id AS VARCHAR) AS head
FROM span JOIN r ON r.file = span.file AND r.row = first_row""",
)
def block_spans(t):
    grid = event_blocks(t)
    spans = g.block_spans(grid, "PAY PERIOD", "TOTAL")
    return spans.join(g.block_heads(grid, spans, {"head": (0, 2)}), [*g.SHEET, "block_no"])


@query("tables_by_rows_nameless", nameless_sql(f"WITH {EVENT_ROWS_SQL}, {islands_sql('row', 'col <= 5')}"))
def tables_by_rows_nameless(t):
    """Null sheet names are names like any other."""
    return g.tables_by_rows(nameless(event_rows(t)), "A:F", chunk=128)


@query("tables_by_columns_nameless", nameless_sql(f"WITH {EVENT_COLUMNS_SQL}, {islands_sql('col', 'row <= 1')}"))
def tables_by_columns_nameless(t):
    return g.tables_by_columns(nameless(event_columns(t)), "1:2", chunk=16)


@query("blocks_between_nameless", nameless_sql(BLOCK_ROWS_SQL))
def blocks_between_nameless(t):
    rows = g.blocks_between(nameless(event_blocks(t)), "PAY PERIOD", "TOTAL", skip_head=1, skip_tail=1, chunk=128)
    return rows.where("col = 2").drop("col")


STEP = 1_000_000_000


def customer_outline(t):
    """Region > nation > customer as an indented list, one file per region."""
    regions = t.region.select(
        F.col("r_regionkey").alias("region"), F.lit(0).cast("bigint").alias("row"), F.lit(0).alias("indent"), F.col("r_name").alias("name")
    )
    nations = t.nation.select(
        F.col("n_regionkey").alias("region"), ((F.col("n_nationkey").cast("bigint") + 1) * F.lit(STEP)).alias("row"), F.lit(1).alias("indent"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("  ")).alias("name"),
    )
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("region"), ((F.col("n_nationkey").cast("bigint") + 1) * F.lit(STEP) + F.col("c_custkey") + 1).alias("row"),
        (F.lit(2) + F.when(F.col("c_custkey") % 5 == 0, 3).otherwise(0)).alias("indent"),
        F.when(F.col("c_custkey") % 9 == 0, "Check - sum").when(F.col("c_custkey") % 9 == 1, "  ").otherwise(F.col("c_name")).alias("name"),
    )
    return regions.unionByName(nations).unionByName(people)


OUTLINE_SQL = """
WITH o AS (SELECT r_regionkey AS region, 0::BIGINT AS row, 0 AS indent, r_name AS name FROM region
  UNION ALL SELECT n_regionkey, (n_nationkey + 1) * 1000000000::BIGINT, 1, n_name FROM nation
  UNION ALL SELECT n_regionkey, (n_nationkey + 1) * 1000000000::BIGINT + c_custkey + 1, CASE WHEN c_custkey % 5 = 0 THEN 5 ELSE 2 END, c_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 9 > 1),
n AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY row) AS line_num FROM o),
d AS (SELECT *, least(line_num, line_num + 1 + min(indent - line_num) OVER (PARTITION BY region ORDER BY row)) AS depth FROM n),
a AS (SELECT *, last_value(CASE WHEN depth = 1 THEN name END IGNORE NULLS) OVER w AS a1, last_value(CASE WHEN depth = 2 THEN name END IGNORE NULLS) OVER w AS a2,
  last_value(CASE WHEN depth = 3 THEN name END IGNORE NULLS) OVER w AS a3, last_value(CASE WHEN depth = 4 THEN name END IGNORE NULLS) OVER w AS a4,
  last_value(CASE WHEN depth = 5 THEN name END IGNORE NULLS) OVER w AS a5, last_value(CASE WHEN depth = 6 THEN name END IGNORE NULLS) OVER w AS a6
  FROM d WINDOW w AS (PARTITION BY region ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT region, line_num, name, array_to_string(list_slice([a1, a2, a3, a4, a5, a6], 1, depth), '|') AS tree FROM a
"""


@query("outline_path", OUTLINE_SQL)
def outline_path(t):
    """Tree paths; blank and check rows are skipped, names trimmed."""
    paths = outline_to_path(skip_rows(customer_outline(t)), ["region"])
    return paths.select("region", "line_num", "name", "tree")


@query("outline_path_chunked", OUTLINE_SQL)
def outline_path_chunked(t):
    paths = outline_to_path(skip_rows(customer_outline(t)), ["region"], chunk=STEP // 2)
    return paths.select("region", "line_num", "name", "tree")


@query(
    "insert_heading",
    """
WITH c AS (SELECT c_custkey // 100 AS file, CAST(c_custkey % 100 AS DOUBLE) AS row, c_mktsegment AS name, CAST(c_custkey % 3 AS INTEGER) AS indent FROM customer),
h AS (SELECT a.file, min(a.row) + 0.5 AS row FROM c a JOIN c b ON a.file = b.file AND b.row = a.row + 1 AND b.indent > 0 WHERE a.name = 'BUILDING' GROUP BY a.file)
SELECT file, row, name, indent FROM c UNION ALL SELECT file, row, 'Others', 1 FROM h
""",
)
def heading(t):
    """One heading per file below the first named row followed by an indented one."""
    lines = t.customer.select(
        F.floor(F.col("c_custkey") / 100).alias("file"), (F.col("c_custkey") % 100).alias("row"),
        F.col("c_mktsegment").alias("name"), (F.col("c_custkey") % 3).cast("int").alias("indent"),
    )
    return insert_heading(lines, "BUILDING", "Others", ["file"])
