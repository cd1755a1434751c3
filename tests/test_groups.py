import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import groups as g


def test_max_row_text_and_number(frame):
    df = frame("m string, id string, x int", ("a", "9", 1), ("a", "10", 2), ("b", "5", 3), (None, "7", 4), ("c", None, 5))
    assert rows(g.max_row_per_key(df, "m", "id"), "m", "x") == [("a", 1), ("b", 3)]
    assert rows(g.max_row_per_key(df, "m", "id", numeric=True), "m", "x") == [("a", 2), ("b", 3)]


def test_dedupe_first_names_the_row(frame):
    df = frame("k string, n int, v string", ("a", 2, "late"), ("a", 1, "early"), ("b", 1, "b"), ("b", 1, "b"))
    assert rows(g.dedupe_first(df, ["k"], ["n"]), "k", "v") == [("a", "early"), ("b", "b")]


@pytest.mark.parametrize("part_rows", [100, 3])
def test_group_to_json_is_whole(frame, part_rows):
    data = [("hot", n, None if n % 2 else f"v{n}") for n in range(40)] + [("one", 5, "x"), (None, 1, "lost key")]
    got = g.group_to_json(frame("k string, n int, v string", *data), "k", ["n", "v"], "n", part_rows=part_rows).collect()
    assert {r["k"] for r in got} == {"hot", "one"}
    parts = sorted((r for r in got if r["k"] == "hot"), key=lambda r: r["part"])
    joined = [record for r in parts for record in json.loads(r["json"])]
    assert joined == [{"n": n, "v": None if n % 2 else f"v{n}"} for n in range(40)]
    if part_rows == 3:
        assert len(parts) > 1 and max(len(json.loads(r["json"])) for r in parts) <= part_rows
        assert [r["part"] for r in parts] == list(range(14))
    assert [r["json"] for r in got if r["k"] == "one"] == ['[{"n":5,"v":"x"}]']


def test_counts(frame):
    df = frame("p string, d string", ("a", "x"), ("a", "x"), ("a", "y"), ("b", "y"), ("b", "z"))
    counts = g.count_by(df, "p", "d")
    assert rows(counts) == [("a", "x", 2), ("a", "y", 1), ("b", "y", 1), ("b", "z", 1)]
    assert rows(g.groups_per_key(df, "p", "d")) == [("a", 2), ("b", 2)]
    assert rows(g.majority(counts, "p", "d", "n")) == [("a", "x")]


def test_last_k(frame):
    df = frame("p string, n int, ok boolean", *[("a", n, n > 2) for n in range(6)], ("b", 1, True), ("c", 1, None))
    got = g.last_k(df, ["p"], [F.col("n").desc()], F.col("ok"))
    assert rows(got) == [("a", 3, 3, True, True), ("b", 1, 1, True, True), ("c", 1, 0, False, False)]
    assert rows(g.top_rows(df, ["p"], [F.col("n").desc()], 2, "r"), "p", "n", "r")[:2] == [("a", 4, 2), ("a", 5, 1)]


def test_latest_by(frame):
    df = frame("p string, n int, v string", ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"))
    got = df.groupBy("p").agg(g.latest_by(F.col("v"), ["n"]).alias("l"), g.latest_by(F.col("v"), ["n"], F.col("n") < 2).alias("f"))
    assert rows(got) == [("a", "y", "x"), ("b", "z", "z")]


def test_range_and_sample(frame):
    df = frame("n int", (3,), (1,), (2,))
    assert rows(g.value_range(df, "n")) == [(1, 3)]
    assert [r["n"] for r in g.sample_first(df, ["n"], 2).collect()] == [1, 2]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = df.transform(lambda d: g.top_rows(d, ["k"], [F.col("id").desc()], 3))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2
