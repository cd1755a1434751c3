import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import lookups as j


@pytest.fixture
def tables(frame):
    aliases = frame("alias string, id string", ("Icu", "D1"), ("LAB", "D2"), ("er ", "D3"), ("orphan", "D9"))
    canonical = frame("id string, name string", ("D1", "Intensive"), ("D2", "Laboratory"), ("D3", "Emergency"))
    return aliases, canonical


@pytest.mark.parametrize(
    "on_miss, wanted",
    [
        ("keep", [("ICU", "D1", "Intensive"), ("er", "er", "er"), ("lab", "D2", "Laboratory"), ("none", "none", "none"), ("orphan", "D9", "D9")]),
        ("drop", [("ICU", "D1", "Intensive"), ("lab", "D2", "Laboratory"), ("orphan", "D9", None)]),
        ("fail", [("ICU", "D1", "Intensive"), ("er", None, None), ("lab", "D2", "Laboratory"), ("none", None, None), ("orphan", "D9", None)]),
    ],
)
def test_aliases(frame, tables, on_miss, wanted):
    df = frame("dept string", ("ICU",), ("lab",), ("er",), ("none",), ("orphan",))
    assert rows(j.resolve_alias(df, "dept", *tables, on_miss)) == sorted(wanted, key=repr)


def test_broadcast_only_when_small(frame):
    table = frame("k int", (1,), (2,), (3,))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(j.if_small(table, table, 3)) and "ResolvedHint" not in plan(j.if_small(table, table, 2))


def test_alias_last_wins(frame, tables):
    aliases = frame("alias string, id string, seq int", ("lab", "D9", 1), ("LAB", "D2", 2))
    df = frame("dept string", ("Lab",))
    assert rows(j.resolve_alias(df, "dept", aliases, tables[1], "keep"), "dept_id") == [("D2",)]
    with pytest.raises(ValueError):
        j.resolve_alias(df, "dept", aliases, tables[1], "guess")


def test_rates(frame):
    lines = frame("code string, q int, rvu double", ("a", 2, 9.0), ("b", 3, 9.0), (None, 1, 9.0), ("zz", 1, 9.0))
    main = frame("hcpcs string, rate double, n int", ("a", 1.5, 1), ("a", 7.0, 2))
    extra = frame("hcpcs string, rate double, n int", ("a", 100.0, 1), ("b", 2.0, 2), (None, 5.0, 3))
    fees = j.priority_union([main, extra], ["hcpcs"], ["n"]).drop("n")
    assert rows(fees) == rows(frame("h string, r double", ("a", 1.5), ("b", 2.0), (None, 5.0)))
    got = j.rate_replace(lines, fees, "code", "hcpcs", "rate", "rvu", "q")
    assert {r["code"]: r["rvu"] for r in got.collect()} == {"a": 3.0, "b": 6.0, None: None, "zz": None}
    nulls = j.rate_replace(lines, fees, "code", "hcpcs", "rate", "rvu", "q", match_nulls=True)
    assert {r["code"]: r["rvu"] for r in nulls.collect()}[None] == 5.0
    assert j.rate_replace(lines, None, "code", "hcpcs", "rate", "rvu", "q") is lines


def test_joins(frame):
    a = frame("k int, x string", (1, "a"), (2, "b"), (None, "n"))
    b = frame("k int, y string", (1, "p"), (3, "q"), (None, "z"))
    assert rows(j.lookup(a, b, "k"), "x", "y") == [("a", "p"), ("b", None), ("n", None)]
    assert rows(j.known_only(a, b, "k"), "x") == [("a",)]
    assert j.onto_master(a, b, "k").count() == 3
    assert rows(j.keep_keys_in(a, b, "k"), "x") == [("a",)]
    assert rows(j.keep_keys_not_in(a, b, "k"), "x") == [("b",), ("n",)]
    assert j.attach(a, b, b.withColumnRenamed("y", "y2"), on="k").columns == ["k", "x", "y", "y2"]


def test_update_where_missing(frame):
    df = frame("k int, v string", (1, None), (2, "old"), (3, None))
    new = frame("k int, v string", (1, "n1"), (2, "n2"))
    assert rows(j.update_where_missing(df, new, "k", ["v"])) == [(1, "n1"), (2, "old"), (3, None)]


def test_dict_map(frame):
    df = frame("v string", ("a",), ("x",), (None,))
    assert [r[0] for r in df.select(j.dict_map(F.col("v"), {"a": "1"})).collect()] == ["1", None, None]
    assert [r[0] for r in df.select(j.dict_map(F.col("v"), {})).collect()] == [None] * 3
