"""Spreadsheet addresses (``B2``, ``A:F,AB``, ``1:5,10``) to 0-based indexes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_index(letters: str) -> int:
    """``A`` is 0, ``Z`` 25, ``AA`` 26."""
    value = 0
    for letter in letters.strip().upper():
        value = value * 26 + ord(letter) - 64
    return value - 1


def column_index_of(letters: Column) -> Column:
    """The same for a column of letters."""
    return F.aggregate(
        F.filter(F.split(F.upper(letters), ""), lambda c: c != F.lit("")),
        F.lit(0),
        lambda acc, c: acc * 26 + F.ascii(c) - 64,
    ) - 1


def cell_address(ref: str) -> tuple[int, int]:
    """``B2`` is row 1, column 1."""
    match = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", ref.strip())
    if match is None:
        raise ValueError(f"not a cell address: {ref!r}")
    return int(match[2]) - 1, column_index(match[1])


def _ranges(spec: str, index) -> list[tuple[int, int]]:
    pairs = []
    for item in spec.split(","):
        first, _, last = item.partition(":")
        pairs.append((index(first), index(last or first)))
    return pairs


def in_columns(col: Column, spec: str) -> Column:
    """True where a 0-based column index lies in ``A:F,AB``."""
    return _inside(col, _ranges(spec, column_index))


def in_rows(row: Column, spec: str) -> Column:
    """True where a 0-based row index lies in ``1:5,10`` (1-based numbers)."""
    return _inside(row, _ranges(spec, lambda n: int(n) - 1))


def _inside(value: Column, pairs: list[tuple[int, int]]) -> Column:
    test = F.lit(False)
    for first, last in pairs:
        test = test | value.between(first, last)
    return test
