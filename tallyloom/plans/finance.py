"""Finance tables from spreadsheet cell grids.

Cells are ``(file, sheet, row, col, value, indent)``; ``file`` is the file's base name. Every
function takes all files of its kind at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.a1 import cell_address, column_index
from tallyloom.functions.dates import lenient_date, month_text, period_start
from tallyloom.operators import grid
from tallyloom.operators.checks import require_headers, require_none, resolved, unresolved_report
from tallyloom.operators.cleaning import (
    conform,
    drop_null_keys,
    drop_zero,
    fill_defaults,
    ratio,
    replace_everywhere,
)
from tallyloom.operators.groups import top_rows
from tallyloom.operators.grid import SHEET, by_position, filled
from tallyloom.operators.lookups import resolve_alias
from tallyloom.operators.outline import heading_rows, outline_to_path, skip_rows
from tallyloom.operators.periods import periods_to_months, unpivot_months
from tallyloom.operators.running import match
from tallyloom.session import cut_lineage
from tallyloom.sources import layouts
from tallyloom.sources.files import latest_per_group

MONTHS = [f"m{n}" for n in range(1, 13)]
HOURS = ["reg_hrs", "overtime_hrs", "prod_hrs", "nonprod_hrs", "total_hrs", "total_amt"]

# Sheet names, positions and headers of the workbooks.
CONTRACTED_SHEETS = r"^\d{4} DATA$"
CONTRACTED_HEADERS = {
    "Traveler Name": "name",
    "License Type": "type",
    "Cost Center": "cost_center",
    "Date End": "date_end",
    "Invoice Date": "invoice_date",
    "Regular": "reg_hrs",
    "Overtime": "overtime_hrs",
    "On-Call": "call_hrs",
    "Holiday": "holiday_hrs",
    "Call Back": "callback_hrs",
    "Other ": "other_hrs",
    "Total Hours": "total_hrs",
}
BUDGET_HISTORICAL = {
    0: "dept_id", 1: "dept_name", 2: "budget_fte", 5: "budget_prod_hrs", 6: "budget_volume",
    8: "hourly_rate",
}
BUDGET_CURRENT = {
    0: "as_of_date", 1: "dept_id", 2: "dept_name", 3: "budget_fte", 7: "budget_contracted_hours",
    8: "budget_prod_hrs", 9: "budget_volume", 10: "budget_uos", 12: "hourly_rate",
}
WORKBOOK_YEAR = r"(\d{4})"
WORKBOOK_MONTH = r"\((\d+)\)"
INCOME_ANCHOR = "Ledger Account"
INCOME_MONTH = r"^Month to Date: (\d{1,2})/(\d{4})$"
INCOME_COLUMNS = {
    0: "ledger_acct", 1: "cost_center", 2: "spend_category", 3: "revenue_category",
    4: "actual", 5: "budget", 11: "actual_ytd", 12: "budget_ytd",
}
BLANK = "(Blank)"
HOURS_COLUMNS = {
    "A": "dept_number", "B": "dept", "C": "reg_hrs", "D": "overtime_hrs", "G": "prod_hrs",
    "M": "nonprod_hrs", "N": "total_hrs", "Z": "total_amt", "AB": "total_fte",
}
HOURS_ANCHOR = "Department Number"
HOURS_SUBHEADERS = [2, 3, 4, 6]
HOURS_REQUIRED = {
    "Regular Hours": "reg_hrs",
    "CALLBK - CALLBACK": "callback_hrs",
    "DBLTME - DOUBLETIME": "double_hrs",
    "OT_1.5 - OVERTIME": "ot_hrs",
    "Total Productive Hours": "prod_hrs",
    "Total Non-Productive Hours": "nonprod_hrs",
    "Total Productive/Non-Productive Hours": "total_hrs",
    "Total Dollars": "total_amt",
    "Total FTE": "total_fte",
}
HOURS_FILE = r"(?i)PP#(\d+) (\d+) "
BALANCE_FILE = r"^\((\d+)\)\s*(\w+)\s*(\d{4})\s"
BALANCE_PERIOD = r"^(\d{4})\s*-\s*(\w+)"
BALANCE_FIRST_ROW = 8
BALANCE_AFTER = "Net Patient Accounts Receivable"
BALANCE_HEADING = "Other Receivables"


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _volume_rows(data: DataFrame, units: DataFrame) -> DataFrame:
    """Rows ``dept_id, dept_name, m1..m12, year`` to one row per filled month, with the unit."""
    long = unpivot_months(data, [*SHEET, "dept_id", "dept_name"], MONTHS, "year")
    named = long.join(units, [*SHEET, "dept_id"], "left")
    return conform(named, layouts.VOLUMES)


def _units(table: DataFrame) -> DataFrame:
    """Unit per department: third column of a table; the last row of a department decides."""
    rows = by_position(table, {0: "dept_id", 2: "unit"}, SHEET).where(F.col("dept_id").isNotNull())
    return top_rows(rows, [*SHEET, "dept_id"], [F.col("row").desc()]).select(*SHEET, "dept_id", "unit")


def newest_workbooks(cells: DataFrame, first_year: int = 0) -> DataFrame:
    """Cells of the newest workbook of each year; year and month stand in the file name."""
    names = cells.select(F.col("file").alias("path")).distinct()
    newest = latest_per_group(names, WORKBOOK_YEAR, WORKBOOK_MONTH, first_year)
    return cells.join(newest.select(F.col("path").alias("file")), "file", "left_semi")


def historical_volumes(cells: DataFrame, rows: str) -> DataFrame:
    """Side-by-side tables, one per year; only the first has a unit column.

    ``rows`` are the sheet rows that hold them; a first column that goes on below raises.
    """
    key = [*SHEET, "table_no"]
    bottom = int(rows.partition(":")[2])
    below = filled(cells).where((F.col("col") == 0) & (F.col("row") == bottom))
    require_none(below.select(*SHEET, "value"), f"volumes go on below the rows {rows}")
    # Read for the left edges, the years, the units and the data: kept once.
    tables = cut_lineage(grid.tables_by_columns(cells, rows).drop("indent"))
    left = tables.groupBy(*key).agg(F.min("col").alias("_left"))
    placed = match(tables, left, key).withColumn("col", F.col("col") - F.col("_left")).drop("_left")
    units = _units(placed.where("table_no = 1"))
    first = F.col("table_no") == 1
    flat = placed.where(~(first & (F.col("col") == 2))).withColumn(
        "col", F.col("col") - (first & (F.col("col") > 2)).cast("int")
    )
    top = int(rows.partition(":")[0]) - 1
    years = (
        flat.where((F.col("row") == top) & F.col("col").isin(2, 3))
        .groupBy(*key)
        .agg(F.min_by("value", "col").cast("double").cast("int").alias("year"))
    )
    names = {0: "dept_id", 1: "dept_name"} | {n + 1: m for n, m in enumerate(MONTHS, start=1)}
    data = by_position(flat.where(F.col("row") >= top + 2), names, key).join(years, key, "left")
    return _volume_rows(
        data.withColumn("year", resolved(F.col("year"), "a volume table has no year")), units
    )


def current_volumes(cells: DataFrame) -> DataFrame:
    """One table per workbook from A1: id, name, unit, twelve months; the year is in the file name."""
    # Read for the units and for the data.
    table = cut_lineage(grid.table_at(cells, "A1").where(F.col("row") > 0))
    names = {0: "dept_id", 1: "dept_name"} | {n + 2: m for n, m in enumerate(MONTHS, start=1)}
    year = F.regexp_extract("file", r"(\d{4})", 1).cast("int")
    return _volume_rows(by_position(table, names).withColumn("year", year), _units(table))


def _budget(df: DataFrame) -> DataFrame:
    measures = [f.name for f in layouts.BUDGET if f.dataType.typeName() == "double"]
    kept = drop_null_keys(df, ["dept_id"])
    return conform(fill_defaults(kept, {m: 0.0 for m in measures}), layouts.BUDGET)


def historical_budget(
    cells: DataFrame, budget_sheet: str, hours_sheet: str, uos_sheet: str, year: int
) -> DataFrame:
    """Budget table joined with goal hours per unit and last year's units of service."""
    main = grid.tables_by_rows(cells.where(F.col("sheet") == budget_sheet), "A:J", start=6, limit=1)
    rows = by_position(main, BUDGET_HISTORICAL, ["file"])
    hours = cells.where(F.col("sheet") == hours_sheet)
    goals = grid.promote_header(
        grid.table_at(hours, "A2").where(F.col("row") > 1), ["ID", "GOAL"], SHEET,
        grid.header_names(hours, header_row=1),
    ).select("file", F.col("ID").alias("dept_id"), F.col("GOAL").cast("double").alias("budget_prod_hrs_per_uos"))
    uos = grid.first_and_last_column(
        grid.table_at(cells.where(F.col("sheet") == uos_sheet), "R3", header=False), ["file"]
    ).select("file", F.col("first").alias("dept_id"), F.col("last").cast("double").alias("budget_uos"))
    joined = (
        rows.join(goals, ["file", "dept_id"], "left")
        .join(uos, ["file", "dept_id"], "left")
        .withColumns({"year": F.lit(year), "budget_contracted_hours": F.lit(0.0)})
    )
    return _budget(_numbers(joined, ["budget_fte", "budget_prod_hrs", "budget_volume", "hourly_rate"]))


def _as_date(text: Column) -> Column:
    return F.coalesce(lenient_date(text), text.try_cast("date"))


def current_budget(cells: DataFrame) -> DataFrame:
    """Budget table with its own date, hours per unit of service derived."""
    main = grid.tables_by_rows(cells, "A:N", start=6, limit=1)
    rows = _numbers(
        by_position(main, BUDGET_CURRENT),
        ["budget_fte", "budget_contracted_hours", "budget_prod_hrs", "budget_volume", "budget_uos",
         "hourly_rate"],
    )
    return _budget(
        rows.withColumns(
            {
                "year": F.year(_as_date(F.col("as_of_date"))),
                "budget_prod_hrs_per_uos": ratio(F.col("budget_prod_hrs"), F.col("budget_uos")),
            }
        )
    )


def contracted_hours(cells: DataFrame, aliases: DataFrame, canonical: DataFrame) -> DataFrame:
    """Contracted hours by month of the end date, else of the invoice date; unknown units raise."""
    sheets = grid.select_sheets(cells, CONTRACTED_SHEETS)
    header = grid.header_names(sheets, header_row=1)
    table = grid.table_at(sheets, "A2").where(F.col("row") > 1)
    rows = grid.promote_header(table, list(CONTRACTED_HEADERS), header=header)
    named = rows.withColumnsRenamed(CONTRACTED_HEADERS).withColumn(
        "month", month_text(lenient_date(F.col("date_end"), F.col("invoice_date")))
    )
    known = resolve_alias(named, "cost_center", aliases, canonical, "fail")
    hours = [n for n in CONTRACTED_HEADERS.values() if n.endswith("_hrs")]
    kept = drop_zero(drop_null_keys(_numbers(known, hours), ["name", "total_hrs"]), "total_hrs")
    checked = kept.withColumns(
        {
            "month": resolved(F.col("month"), "contracted hours without a month"),
            "dept_id": resolved(F.col("dept_id"), "contracted hours of an unknown cost center"),
        }
    )
    return conform(checked, layouts.CONTRACTED)


def income_rows(cells: DataFrame) -> DataFrame:
    """Ledger rows below the anchor cell, with the month named in the row above the table.

    Anchors and captions are found in one scan: captions are filed under the row below theirs.
    """
    used = filled(cells)
    anchor = F.lower("value") == INCOME_ANCHOR.lower()
    caption = (F.col("col") == column_index("E")) & F.col("value").rlike(INCOME_MONTH)
    marks = used.where(anchor | caption).groupBy(
        *SHEET, (F.col("row") + F.when(anchor, 0).otherwise(1)).alias("top")
    ).agg(F.min(F.when(anchor, F.col("col"))).alias("left"), F.max(F.when(caption, F.col("value"))).alias("caption"))
    part = F.regexp_extract
    month = F.concat(part("caption", INCOME_MONTH, 2), F.lit("-"), F.lpad(part("caption", INCOME_MONTH, 1), 2, "0"))
    first = F.min(F.when(F.col("left").isNotNull(), F.struct("left", "top", month.alias("month"))))
    months = marks.groupBy(*SHEET).agg(first.alias("_at")).where("_at IS NOT NULL").select(
        *SHEET, "_at.top", resolved(F.col("_at.month"), "no month above the table").alias("month")
    )
    body = match(used.where(F.col("col").isin(list(INCOME_COLUMNS))), months, SHEET).where(F.col("row") > F.col("top"))
    return by_position(body, INCOME_COLUMNS, [*SHEET, "month"])


def unknown_cost_centers(cells: DataFrame, aliases: DataFrame, canonical: DataFrame) -> DataFrame:
    """Rows of the income statement per cost center that no alias names."""
    known = resolve_alias(income_rows(cells), "cost_center", aliases, canonical, "fail")
    return unresolved_report(known, "dept_id", "cost_center")


def income_statement(cells: DataFrame, aliases: DataFrame, canonical: DataFrame) -> DataFrame:
    """Income statement lines; an unknown cost center serves as its own id and name."""
    known = resolve_alias(income_rows(cells), "cost_center", aliases, canonical, "keep")
    measures = ["actual", "budget", "actual_ytd", "budget_ytd"]
    blanked = known.withColumns({m: F.nullif(F.col(m), F.lit(BLANK)) for m in measures})
    return conform(replace_everywhere(_numbers(blanked, measures), BLANK, ""), layouts.INCOME)


def historical_hours(
    cells: DataFrame, year: int, aliases: DataFrame, canonical: DataFrame
) -> DataFrame:
    """Hours and pay by period from repeated blocks; departments without an id are dropped."""
    columns = {column_index(k): v for k, v in HOURS_COLUMNS.items()}
    used = cells.where(F.col("col").isin(list(columns)))
    # Small, read three times and checked at once: kept rather than found again.
    spans = cut_lineage(grid.block_spans(used, "PAY PERIOD", "TOTAL"))
    require_none(spans.where(F.col("end_row").isNull()), "block without an end")
    heads = grid.block_heads(used, spans, {"period_no": (1, 0)})
    body = grid.blocks_between(used, "PAY PERIOD", "TOTAL", skip_head=4, skip_tail=2, spans=spans)
    key = [*SHEET, "block_no"]
    rows = by_position(body, columns, key).join(heads, key)
    period = F.format_string("%d-%02d", F.lit(year), F.col("period_no").cast("double").cast("int"))
    filled_in = fill_defaults(
        _numbers(rows, [*HOURS, "total_fte"]), {"reg_hrs": 0.0, "overtime_hrs": 0.0, "total_fte": 0.0}
    )
    return _period_hours(filled_in.withColumn("pay_period", period), aliases, canonical)


def current_hours(cells: DataFrame, aliases: DataFrame, canonical: DataFrame) -> DataFrame:
    """Hours and pay by period, one workbook per period; the period is in the file name."""
    # One row per column of a workbook; kept for the check, the names and the first data row.
    header = cut_lineage(grid.merge_subheader(cells, HOURS_ANCHOR, HOURS_SUBHEADERS))
    require_none(require_headers(header, list(HOURS_REQUIRED), SHEET), "required columns not found")
    tops = header.select(*SHEET, F.col("top").alias("_first")).distinct()
    body = filled(cells).join(tops, SHEET).where(F.col("row") >= F.col("_first") + 2).drop("_first")
    names = {"Department Name": "dept", **HOURS_REQUIRED}
    rows = grid.promote_header(body, list(names), header=header.drop("top"))
    typed = _numbers(rows.withColumnsRenamed(names), list(HOURS_REQUIRED.values())).withColumns(
        {
            "overtime_hrs": F.col("double_hrs") + F.col("ot_hrs"),
            "pay_period": F.format_string(
                "%s-%02d",
                F.regexp_extract("file", HOURS_FILE, 2),
                F.regexp_extract("file", HOURS_FILE, 1).cast("int"),
            ),
        }
    )
    return _period_hours(typed, aliases, canonical)


def _period_hours(rows: DataFrame, aliases: DataFrame, canonical: DataFrame) -> DataFrame:
    known = resolve_alias(rows, "dept", aliases, canonical, "drop")
    return conform(known.withColumn("start_date", period_start(F.col("pay_period"))), layouts.PERIOD_HOURS)


def hours_by_month(by_period: DataFrame) -> DataFrame:
    """Bi-weekly hours and pay shared out to calendar months; a period without a start raises."""
    placed = by_period.withColumn(
        "start_date", resolved(F.col("start_date"), "a pay period has no start date")
    )
    return periods_to_months(placed, ["dept_id", "dept_name"], HOURS, "total_fte")


def balance_months(cells: DataFrame) -> DataFrame:
    """Month per sheet from the file name, checked against the period cell B3."""
    row, col = cell_address("B3")
    b3 = cells.where((F.col("row") == row) & (F.col("col") == col)).select(*SHEET, F.col("value").alias("period"))
    sheets = cells.select(*SHEET).distinct().join(b3, SHEET, "left")
    part = F.regexp_extract
    named = F.concat_ws("-", part("file", BALANCE_FILE, 3), F.lower(part("file", BALANCE_FILE, 2)))
    inside = F.concat_ws("-", part("period", BALANCE_PERIOD, 1), F.lower(part("period", BALANCE_PERIOD, 2)))
    readable = F.col("file").rlike(BALANCE_FILE) & F.col("period").rlike(BALANCE_PERIOD)
    day = F.to_date(F.initcap(F.regexp_replace(named, "-", " ")), "yyyy MMM")
    agreed = F.when(readable & (named == inside), month_text(day))
    return sheets.select(*SHEET, resolved(agreed, "file name and period cell differ").alias("month"))


def balance_sheet(cells: DataFrame) -> DataFrame:
    """Balance sheet lines with the path of headings they stand under."""
    months = balance_months(cells)
    body = cells.where(F.col("row") >= BALANCE_FIRST_ROW - 1).select(
        *SHEET, F.col("row").cast("double").alias("row"), "col", "value", "indent"
    )
    accounts = body.where(F.col("col") == 0)
    heading = heading_rows(accounts, BALANCE_AFTER, BALANCE_HEADING, SHEET, name="value")
    texts = {0: "ledger_acct", 1: "actual", 2: "actual_prev_month", 4: "actual_prev_year"}
    values = {n: F.when(F.col("col") == c, F.col("value")) for c, n in texts.items()}
    rows = grid.by_row(
        body.unionByName(heading.withColumn("col", F.lit(0))),
        [*SHEET, "row"],
        {**values, "indent": F.when(F.col("col") == 0, F.col("indent"))},
    ).withColumn("indent", F.coalesce("indent", F.lit(0)))
    paths = outline_to_path(skip_rows(rows, "ledger_acct"), SHEET, name="ledger_acct")
    return conform(match(paths, months, SHEET), layouts.BALANCE)


def aged_receivables(rows: DataFrame) -> DataFrame:
    """Date part only of the date column."""
    return rows.withColumn("date", F.substring("date", 1, 10))
