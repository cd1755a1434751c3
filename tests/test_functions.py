import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import a1, dates, text

D = dt.date


def one(spark, ddl, values, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], ddl).select(expr).collect()]


def fnv(data: bytes) -> int:
    state = 2166136261
    for byte in data:
        state = ((state ^ byte) * 16777619) % 2**32
    return state


def test_hash_matches_a_plain_loop(spark):
    texts = ["a", "", "héé", "日本", "x" * 300, "\x00\n", "a b"]
    assert one(spark, "s string", texts, text.fnv1a(F.col("s"))) == [fnv(x.encode()) for x in texts]
    assert fnv(b"a") == 3826002220
    salted = one(spark, "s string", texts, text.hash_id(F.col("s"), "salt"))
    assert salted == [str(fnv(f"salt#{x}".encode())) for x in texts]
    assert one(spark, "s string", [None], text.hash_id(F.col("s"), "salt")) == [None]


def test_padding_keeps_longer_text(spark):
    assert one(spark, "s string", ["900", "1400", "12345", None], text.pad_left(F.col("s"), 4)) == ["0900", "1400", "12345", None]


def test_procedure_code(frame):
    df = frame(
        "code string, name string",
        (None, "HC PR 99213 X"), (None, "HC PR 99213"), (None, "HC PR A1234 X"), (None, "HC PR 1234F X"),
        ("11111", "HC PR 99213 X"), (None, None), (None, "other"),
    )
    got = [r[0] for r in df.select(text.procedure_code(F.col("code"), F.col("name"))).collect()]
    assert got == ["99213", None, "A1234", "1234F", "11111", None, None]


def test_prefix_match(spark):
    values = ["Z00.1", "z02.5", "Z003", "AZ00.1", None, "Z00"]
    got = one(spark, "s string", values, text.starts_with_any(F.col("s"), ["Z00.", "Z02."]))
    assert got == [True, True, True, False, False, False]


def test_ages_around_birthdays(frame):
    df = frame(
        "b date, d date",
        (D(2020, 2, 29), D(2023, 2, 28)), (D(2020, 2, 29), D(2023, 3, 1)), (D(2000, 6, 15), D(2020, 6, 14)),
        (D(2000, 6, 15), D(2020, 6, 15)), (D(2000, 6, 15), D(2020, 6, 16)), (None, D(2020, 1, 1)),
    )
    got = [tuple(r) for r in df.select(dates.age_years(F.col("b"), F.col("d")), dates.age_months(F.col("b"), F.col("d"))).collect()]
    assert got == [(2, 35), (3, None), (19, None), (20, None), (20, None), (None, None)]


def test_lenient_dates(frame):
    df = frame("a string, b string", ("1/5/2024", None), ("01/05/2024", None), ("?", "2/6/2024"), ("-", None), (None, None), ("13/45/2024", "3/1/2024"), ("1/5/24", None))
    got = [r[0] for r in df.select(dates.lenient_date(F.col("a"), F.col("b"))).collect()]
    assert got == [D(2024, 1, 5), D(2024, 1, 5), D(2024, 2, 6), None, None, D(2024, 3, 1), None]


def test_day_keys(spark):
    assert one(spark, "n bigint", [20240301, -1, -7, None], dates.day_key_or_null(F.col("n"))) == [D(2024, 3, 1), None, None, None]
    with pytest.raises(Exception):
        one(spark, "s string", ["2024-03-01x"], dates.day_key(F.col("s")))


def test_calendar_subtraction_clamps(spark):
    got = one(spark, "s string", ["2024-02-29 10:00:00"], dates.back("2024-02-29 10:00:00", years=1))
    assert got == [dt.datetime(2023, 2, 28, 10)]


def walked_start(year, number):
    """The period's start by walking two weeks at a time from 17 December 2022."""
    start = D(2022, 12, 17)
    while (start + dt.timedelta(20)).year >= year:
        start -= dt.timedelta(14)
    while (start + dt.timedelta(20)).year < year:
        start += dt.timedelta(14)
    start += dt.timedelta(14 * (number - 1))
    return start if number >= 1 and (start + dt.timedelta(13)).year <= year else None


def test_period_starts(spark):
    periods = [f"{y:04d}-{n:02d}" for y in range(1995, 2040) for n in (0, 1, 2, 13, 26, 27, 28)]
    got = one(spark, "p string", periods, dates.period_start(F.col("p")))
    assert got == [walked_start(int(p[:4]), int(p[5:])) for p in periods]
    assert walked_start(2022, 1) == D(2021, 12, 18) and walked_start(2024, 1) == D(2023, 12, 16)
    assert one(spark, "p string", ["2024-1", "junk", None, "2024-001"], dates.period_start(F.col("p"))) == [None] * 4


def test_month_parts_add_up(spark):
    days = [D(2023, 1, 1) + dt.timedelta(n) for n in range(900)]
    got = one(spark, "d date", days, dates.month_parts(F.col("d")))
    for day, parts in zip(days, got):
        count = {}
        for n in range(14):
            at = day + dt.timedelta(n)
            count[(at.year, at.month)] = count.get((at.year, at.month), 0) + 1
        assert {(p["day"].year, p["day"].month): p["days"] for p in parts} == count
        assert abs(sum(p["share"] for p in parts) - 1) < 1e-12


def test_addresses(spark):
    assert a1.cell_address("B2") == (1, 1) and a1.cell_address("AA10") == (9, 26)
    with pytest.raises(ValueError):
        a1.cell_address("2B")
    assert one(spark, "s string", ["A", "z", "AA", "AB", "ZZ"], a1.column_index_of(F.col("s"))) == [0, 25, 26, 27, 701]
    numbers = list(range(12))
    got = one(spark, "n int", numbers, a1.in_rows(F.col("n"), "1:3,10"))
    assert [n for n, hit in zip(numbers, got) if hit] == [0, 1, 2, 9]
    got = one(spark, "n int", numbers, a1.in_columns(F.col("n"), "A:B,F"))
    assert [n for n, hit in zip(numbers, got) if hit] == [0, 1, 5]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=30))
def test_hash_property(spark, texts):
    texts = [x for x in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in x)] or ["a"]
    assert one(spark, "s string", texts, text.fnv1a(F.col("s"))) == [fnv(x.encode()) for x in texts]


def test_random_hash_ids_are_stable(spark):
    ids = [str(random.Random(n).random()) for n in range(50)]
    first = one(spark, "s string", ids, text.hash_id(F.col("s"), "x"))
    assert first == one(spark, "s string", ids, text.hash_id(F.col("s"), "x"))
    assert rows(spark.createDataFrame([(1,)], "a int")) == [(1,)]
