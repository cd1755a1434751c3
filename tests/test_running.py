import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import running as r
from tallyloom.operators.outline import insert_heading, line_numbers, outline_to_path, skip_rows


@pytest.mark.parametrize("chunk", [1, 7, 1000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_matches_a_loop(frame, chunk, inclusive):
    rng = random.Random(3)
    data = [(k, p, rng.randint(-5, 5), rng.choice([None, f"n{p}"])) for k in ("a", None) for p in rng.sample(range(200), 60)]
    got = r.running(
        frame("k string, p int, v int, s string", *data), ["k"], "p",
        sums={"total": F.col("v")}, mins={"low": F.col("v")}, lasts={"last": F.col("s")}, chunk=chunk, inclusive=inclusive,
    )
    wanted = []
    for key in ("a", None):
        total, low, last = 0, None, None
        for _, p, v, s in sorted(x for x in data if x[0] == key):
            before = (total, low, last)
            total, low, last = total + v, v if low is None else min(low, v), last if s is None else s
            wanted.append((key, p, *((total, low, last) if inclusive else before)))
    assert rows(got, "k", "p", "total", "low", "last") == sorted(wanted, key=repr)


def test_several_columns_make_a_position(frame):
    data = [(k, f, n, f"{f}{n}") for k in ("a", None) for f in ("x", "y") for n in range(5)]
    got = r.running(frame("k string, f string, n int, v string", *data), ["k"], ["f", "n"], sums={"i": F.lit(1)}, chunk=2)
    for key in ("a", None):
        found = sorted((x for x in got.collect() if x["k"] == key), key=lambda x: x["i"])
        assert [x["i"] for x in found] == list(range(1, 11)) and [x["v"] for x in found] == [v for k, _, _, v in data if k == key]


def test_nothing_runs_before_the_result(spark, frame):
    """Building the plan starts no job."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "")
    r.running(frame("k string, p int", ("a", 1)), ["k"], "p", sums={"n": F.lit(1)})
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def stack_paths(indents):
    stack, out = [], []
    for n, indent in enumerate(indents):
        if indent < len(stack):
            stack = stack[:indent]
        stack = [*stack, f"n{n}"]
        out.append("|".join(stack))
    return out


@pytest.mark.parametrize("chunk", [3, 50])
def test_outline_matches_a_stack(frame, chunk):
    rng = random.Random(9)
    lists = {"jump": [0, 3], "deep first": [2, 2, 1], "usual": [0, 1, 2, 1, 0]}
    lists["none"] = [0, 1, 1, 2]
    lists |= {f"r{i}": [rng.randint(0, 5) for _ in range(40)] for i in range(8)}
    data = [(None if key == "none" else key, n * 2, indent, f"n{n}") for key, indents in lists.items() for n, indent in enumerate(indents)]
    got = outline_to_path(frame("file string, row int, indent int, name string", *data), ["file"], chunk=chunk)
    found = {(x["file"], x["line_num"]): x["tree"] for x in got.collect()}
    lists[None] = lists.pop("none")
    for key, indents in lists.items():
        assert [found[(key, n + 1)] for n in range(len(indents))] == stack_paths(indents), key


def test_depth_comes_from_the_rows(frame):
    df = frame("file string, row int, indent int, name string", *[("f", n, n, "x") for n in range(20)])
    paths = {x["row"]: x["tree"] for x in outline_to_path(df, ["file"]).collect()}
    assert paths == {n: "|".join(["x"] * (n + 1)) for n in range(20)}
    assert outline_to_path(df.where("false"), ["file"]).count() == 0


def test_rows_are_skipped_before_numbering(frame):
    df = frame("file string, row int, name string", ("f", 1, " a "), ("f", 2, None), ("f", 3, "  "), ("f", 4, " Check - sum"), ("f", 9, "b"))
    got = line_numbers(skip_rows(df), ["file"])
    assert rows(got, "name", "line_num") == [("a", 1), ("b", 2)]


def test_heading_once(frame):
    df = frame(
        "file string, row int, name string, indent int",
        ("f", 1, "X", 0), ("f", 2, "flat", 0), ("f", 5, "X", 0), ("f", 6, "in", 1), ("f", 8, "X", 0), ("f", 9, "in", 2), ("g", 1, "X", 0), ("g", 3, "gap", 1),
    )
    added = insert_heading(df, "X", "Head", ["file"]).where("name = 'Head'")
    assert rows(added, "file", "row", "indent") == [("f", 5.5, 1)]
