import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.contracts import ordered
from tallyloom.operators import checks, cleaning as c


def test_filter_all_keeps_null_type(frame):
    df = frame(
        "t string, s string, d string",
        (None, "ok", "a"), ("lab", "ok", "a"), ("visit", "ok", "a"), ("visit", None, "a"), ("visit", "ok", None), ("visit", "no", "a"),
    )
    kept = c.filter_all(df, {"t": ["lab"]}, {"s": "ok"}, {"d": ["a", "b"]})
    assert rows(kept) == rows(frame("t string, s string, d string", (None, "ok", "a"), ("visit", "ok", "a")))


def test_sentinels(frame):
    df = frame("a string, n bigint", ("*Unspecified", -1), ("", 0), ("x*Unspecified", -5), (None, None))
    got = c.sentinel_to_null(df, ["a", "missing"], ["*Unspecified", ""])
    assert [r["a"] for r in got.collect()] == [None, None, "x*Unspecified", None]
    only = c.sentinel_to_null(df, ["a"], ["*Unspecified"])
    assert [r["a"] for r in only.collect()] == [None, "", "x*Unspecified", None]
    numbers = df.select(c.negative_to_null(F.col("n")), c.minus_one_to_null(F.col("n")))
    assert [tuple(r) for r in numbers.collect()] == [(None, None), (0, 0), (None, -5), (None, None)]


def test_halves_are_complete(frame):
    df = frame("d string, t string", ("ED", None), (None, None), (None, "ED Notes"), ("W", "x"), ("W", None))
    yes, no = c.split_by(df, (F.col("d") == "ED") | F.col("t").isin("ED Notes"))
    assert yes.count() == 2 and no.count() == 3
    assert (None, None) in [tuple(r) for r in no.collect()]


def test_columns(frame):
    df = frame("k int, name string, city string, x double", (1, "n", "c", 2.0))
    rest, secret = c.split_columns(df, "k", ["name"], ["city"])
    assert rest.columns == ["k", "city", "x"] and secret.columns == ["k", "name", "city"]
    layout = ordered("x int, label string, gone double")
    full = c.conform(c.ensure_columns(df, layout), layout, {"label": "name"})
    assert [f.dataType.simpleString() for f in full.schema] == ["int", "string", "double"]
    assert rows(full) == [(2, "n", None)]


def test_fill_drop_replace(frame):
    df = frame("k string, h double, t string", ("a", None, "(Blank)"), (None, 1.0, "x"), ("b", 0.0, "x(Blank)"))
    assert rows(c.fill_defaults(df, {"h": 0.0}), "h") == [(0.0,), (0.0,), (1.0,)]
    assert c.drop_null_keys(df, ["k"]).count() == 2
    assert rows(c.drop_zero(df, "h"), "k") == rows(frame("k string", ("a",), (None,)))
    assert rows(c.replace_everywhere(df, "(Blank)", ""), "t") == [("",), ("x",), ("x(Blank)",)]
    assert c.filter_equals(df, "k", "a").count() == 1
    assert rows(c.with_constant(df, "z", 1), "z") == [(1,)] * 3
    assert rows(df.select(c.ratio(F.col("h"), F.lit(0.0)).alias("r"))) == [(None,)] * 3


def test_reports_and_gates(frame):
    df = frame("id string, name string", ("1", "a"), (None, "b"), (None, "b"), (None, "(Blank)"))
    assert rows(checks.unresolved_report(df, "id", "name", ["(Blank)"])) == [("b", 2)]
    report = checks.input_report({"x": df, "y": df}, {"x": 4, "y": 5})
    assert rows(report, "input", "rows", "ok") == [("x", 4, True), ("y", 4, False)]
    with pytest.raises(ValueError, match="y"):
        checks.require_inputs(report)
    with pytest.raises(ValueError, match="gone"):
        checks.require_columns(df, ["id", "gone"], "file.csv")
    checks.require_none(df.where("id = 'zz'"), "none")
    with pytest.raises(ValueError, match="unknown"):
        checks.require_none(df.where("id is null"), "unknown")
    with pytest.raises(Exception, match="no id"):
        df.select(checks.resolved(F.col("id"), "no id")).collect()
    assert rows(df.where("id = '1'").select(checks.resolved(F.col("id"), "no id"))) == [("1",)]


def test_content_check(frame):
    df = frame("a string, b string", ("x", "x"), ("x", "y"), (None, "x"), (None, None))
    assert checks.content_check(df, F.col("a"), F.col("b")).count() == 3


def test_headers(frame):
    heads = frame("file string, name string", ("f", "A"), ("f", "B"), ("g", "A"), ("h", "Z"))
    bad = checks.require_headers(heads, ["A", "B"], ["file"])
    assert {r["file"]: sorted(r["missing"]) for r in bad.collect()} == {"g": ["B"], "h": ["A", "B"]}
