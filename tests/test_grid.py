import random
import re
from functools import reduce

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import grid as g

PATHS = [2, 50]


def tables_of(df, axis):
    out = {}
    for r in df.collect():
        out.setdefault(r["table_no"], set()).add((r["row"], r["col"]))
    return out


@pytest.mark.parametrize("chunk", PATHS)
def test_tables_by_columns(grid, chunk):
    cells = grid("ab.c..de", "a..c..d.", "........", "xxxxxxxx")
    got = tables_of(g.tables_by_columns(cells, "1:2", chunk=chunk), "col")
    assert {n: sorted({c for _, c in t}) for n, t in got.items()} == {1: [0, 1], 2: [3], 3: [6, 7]}
    first = g.tables_by_columns(cells, "1:2", limit=2, chunk=chunk)
    assert {r[0] for r in rows(first, "table_no")} == {1, 2}


@pytest.mark.parametrize("chunk", PATHS)
def test_tables_by_rows(grid, chunk):
    cells = grid("a.", "a.", ".z", "b.", "..", "..", "cz")
    got = tables_of(g.tables_by_rows(cells, "A:A", chunk=chunk), "row")
    assert {n: sorted({r for r, _ in t}) for n, t in got.items()} == {1: [0, 1], 2: [3], 3: [6]}
    got = tables_of(g.tables_by_rows(cells, "A:B", start=1, limit=1, chunk=chunk), "row")
    assert {n: sorted({r for r, _ in t}) for n, t in got.items()} == {1: [1, 2, 3]}


def slow_table_at(lines, top, left, header):
    """Right edge by two rows, bottom by the columns found, cell by cell."""
    filled = lambda r, c: r < len(lines) and c < len(lines[r]) and lines[r][c] != "."
    first = top + 1 if header else top
    right = left
    while right < max(map(len, lines)) and (filled(top, right) or filled(first, right)):
        right += 1
    bottom = top
    while bottom < len(lines) and any(filled(bottom, c) for c in range(left, right)):
        bottom += 1
    return sorted((r, c) for r in range(top, bottom) for c in range(left, right) if filled(r, c))


@pytest.mark.parametrize("header", [True, False])
def test_table_at_matches_a_cell_walk(grid, header):
    rng = random.Random(5)
    sheets = [["".join(rng.choice("ab..") if rng.random() < 0.3 else "a" for _ in range(7)) for _ in range(6)] for _ in range(12)]
    sheets += [["a.b", "..b"], ["...", "..."], ["ab", "ab"], ["aab", "a.."]]
    cells = grid("")
    for n, lines in enumerate(sheets):
        cells = cells.unionByName(grid(*lines, file=f"f{n}" if n else None))
    got = {}
    for r in g.table_at(cells, "B1", header).collect():
        got.setdefault(r["file"] or "f0", []).append((r["row"], r["col"]))
    for n, lines in enumerate(sheets):
        assert sorted(got.get(f"f{n}", [])) == slow_table_at(lines, 0, 1, header), (n, lines)


def test_find_cell_goes_column_by_column(grid):
    cells = grid(["", "x", None], [None, None, "Key"], [None, "KEY", None], ["key", None, None])
    assert rows(g.find_cell(cells, "Key"), "row", "col") == [(3, 0)]
    assert rows(g.find_cell(cells, "key", "B1"), "row", "col") == [(2, 1)]
    assert rows(g.find_cell(cells, "key", "B4"), "row", "col") == []
    assert rows(g.find_cell(cells, "nothing")) == []


def test_ranges(grid):
    cells = grid("abc", "def", "ghi")
    assert rows(g.cell_range(cells, "B2:C3"), "value") == [("e",), ("f",), ("h",), ("i",)]
    assert rows(g.cell_range(cells, "B2"), "value") == [("e",)]
    assert rows(g.cell_value(cells, "C1", "v"), "v") == [("c",)]
    assert g.select_sheets(cells, r"^\d{4} DATA$").count() == 0


def test_next_position(grid):
    cells = grid("ab.c", "....", "a...", "x..y")
    def at(*args):
        return g.next_position(cells, *args).first()["position"]

    assert at("row", "A:B", 1) == 2 and at("row", "C", 0) == -1
    assert at("row", "A:B", 0, True) == 1 and at("row", "A:B", 2, True) == -1
    assert at("col", "1", 0, True) == 2 and at("col", "1", 3, True) == -1 and at("col", "2", 0, True) == 0
    assert at("col", "1", 2) == 3 and at("col", "2", 0) == -1


def test_headers(grid):
    cells = grid(["A", "B", "A"], ["1", "2", "3"], [None, "5", None])
    got = g.promote_header(cells, ["A", "B", "C"])
    assert rows(got, "row", "A", "B", "C") == [(1, "1", "2", None), (2, None, "5", None)]
    assert rows(g.promote_header(cells, ["A"], header_row=0), "row", "A") == [(1, "1"), (2, None)]


def test_subheader(grid):
    cells = grid(["note"], ["P", "Num", "Name", "Group", "Total"], [None, None, None, "Sub", "no"], ["p", "1", "n", "2", "3"])
    got = g.merge_subheader(cells, "num", [2])
    assert rows(got, "top", "name", "col") == [(1, "Name", 2), (1, "Num", 1), (1, "Sub", 3), (1, "Total", 4)]


def test_dropping_columns(grid):
    cells = grid("abcd", "e.gh")
    got = g.drop_columns_at(cells, [1])
    assert rows(got, "row", "col", "value") == [(0, 0, "a"), (0, 1, "c"), (0, 2, "d"), (1, 0, "e"), (1, 1, "g"), (1, 2, "h")]
    assert rows(g.first_and_last_column(cells), "row", "first", "last") == [(0, "a", "d"), (1, "e", "h")]


@pytest.mark.parametrize("chunk", PATHS)
def test_blocks(grid, chunk):
    cells = grid(
        ["PAY PERIOD"], ["7", "end"], ["h"], ["h"], ["1", "x"], ["2", "y"], ["s"], ["s"], [None, "Total"], ["between"],
        ["pay period"], ["8"], ["PAY PERIOD", "inner"], ["h"], ["3"], ["s"], ["s"], [None, "TOTAL"], [None, "TOTAL"],
    )
    spans = g.block_spans(cells, "PAY PERIOD", "TOTAL", chunk=chunk)
    assert rows(spans, "block_no", "first_row", "end_row") == [(1, 0, 8), (2, 10, 17)]
    got = g.blocks_between(cells, "PAY PERIOD", "TOTAL", chunk=chunk)
    assert rows(got.where("col = 0"), "block_no", "row", "value") == [(1, 4, "1"), (1, 5, "2"), (2, 14, "3")]
    heads = g.block_heads(cells, spans, {"no": (1, 0), "more": (1, 1)})
    assert rows(heads, "block_no", "no", "more") == [(1, "7", "end"), (2, "8", None)]


@pytest.mark.parametrize("chunk", PATHS)
def test_block_without_end(grid, chunk):
    spans = g.block_spans(grid(["PAY PERIOD"], ["1"]), "PAY PERIOD", "TOTAL", chunk=chunk)
    assert rows(spans, "first_row", "end_row") == [(0, None)]
    assert g.blocks_between(grid(["PAY PERIOD"], ["1"]), "PAY PERIOD", "TOTAL", 0, 0, chunk=chunk).count() == 0


def loop_blocks(marks):
    """Spans by a state machine over (starts, ends) of each row."""
    spans, is_open = [], False
    for row, (starts, ends) in enumerate(marks):
        if starts and not is_open:
            spans.append([len(spans) + 1, row, None])
            is_open = True
        if ends and is_open:
            spans[-1][2] = row
            is_open = False
    return [tuple(s) for s in spans]


def loop_islands(used):
    table, numbers = 0, {}
    for row, here in enumerate(used):
        if here:
            table += not (row and used[row - 1])
            numbers[row] = table
    return numbers


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_random_sheets_match_loops(grid, chunk):
    """Blocks and islands of random sheets, whose runs and spans cross chunks."""
    rng = random.Random(chunk)
    sheets = {f"s{n}": [(rng.random() < 0.3, rng.random() < 0.3, rng.random() < 0.6) for _ in range(rng.randint(1, 40))] for n in range(6)}
    frames = [
        grid(*[["S" if s else None, "E" if e else None, f"v{i}" if v else None] for i, (s, e, v) in enumerate(lines)], sheet=name)
        for name, lines in sheets.items()
    ]
    cells = reduce(lambda a, b: a.unionByName(b), frames)
    spans = g.block_spans(cells, "s", "e", chunk=chunk)
    body = g.blocks_between(cells, "s", "e", 1, 0, chunk=chunk).where("col = 2")
    islands = g.tables_by_rows(cells, "C:C", chunk=chunk)
    wanted, inside, tables = [], [], []
    for name, lines in sheets.items():
        found = loop_blocks([line[:2] for line in lines])
        wanted += [(name, *span) for span in found]
        inside += [(name, no, r, f"v{r}") for no, first, end in found if end is not None for r in range(first + 1, end) if lines[r][2]]
        tables += [(name, r, no) for r, no in loop_islands([line[2] for line in lines]).items()]
    assert rows(spans, "sheet", "block_no", "first_row", "end_row") == sorted(wanted, key=repr)
    assert rows(body, "sheet", "block_no", "row", "value") == sorted(inside, key=repr)
    assert rows(islands, "sheet", "row", "table_no") == sorted(tables, key=repr)


def test_block_plan_reads_its_input_twice(spark, grid, tmp_path):
    """Once for the markers and once for the cells."""
    grid(["S", "x"], ["1"], ["2"], [None, "E"]).write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    got = g.blocks_between(cells, "S", "E", 1, 0)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    scanned = set(re.findall(r"FileScan parquet \[[^\]]*\]", final))
    assert len(scanned) == 2, final


def test_sheets_do_not_mix(grid):
    both = grid("a.b", file="f1").unionByName(grid("abc", file="f2"))
    got = g.tables_by_columns(both, "1:1")
    assert rows(got.groupBy("file").agg(F.max("table_no").alias("n"))) == [("f1", 2), ("f2", 1)]


def test_nameless_sheets(grid):
    """Null file and sheet names are names, and columns keep the input's order."""
    lines = ["ab.c", "ab.c", "....", "xx.x"]
    named, nameless = grid(*lines), grid(*lines, file=None, sheet=None)
    for of in (
        lambda c: g.tables_by_rows(c, "A:D", chunk=2),
        lambda c: g.tables_by_columns(c, "1:2", chunk=2),
        lambda c: g.table_at(c, "A1"),
        lambda c: g.blocks_between(c, "a", "x", 1, 0, chunk=2),
    ):
        a, b = of(named), of(nameless)
        assert a.columns == b.columns == [*named.columns, *[x for x in a.columns if x not in named.columns]]
        assert rows(a.drop("file", "sheet")) == rows(b.drop("file", "sheet")) != []


def test_cells_are_moved_before_they_are_sorted(grid):
    """The sort behind a greatest text holds a shuffled part, never an input split of any number of cells."""
    cells = grid("ab", "12", ".3", "4.")
    header = g.header_names(cells, header_row=0)
    made = {
        "promoted": g.promote_header(cells, ["a", "b"], header_row=0),
        "below": g.promote_header(cells.where("row > 0"), ["a", "b"], header=header),
        "placed": g.by_position(cells, {0: "a", 1: "b"}),
        "edges": g.first_and_last_column(cells),
    }
    for name, df in made.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        above, moved, below = plan.partition("Exchange hashpartitioning(file")
        assert "SortAggregate" in above and moved and "SortAggregate" not in below, name
    assert rows(made["promoted"], "row", "a", "b") == [(1, "1", "2"), (2, None, "3"), (3, "4", None)]
    assert rows(made["below"], "row", "a", "b") == rows(made["promoted"], "row", "a", "b")
    assert rows(made["placed"], "row", "a", "b") == [(0, "a", "b"), *rows(made["promoted"], "row", "a", "b")]
    assert rows(made["edges"], "row", "first", "last") == rows(made["placed"], "row", "a", "b")
