import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.functions.text import hash_id
from tallyloom.operators import ids
from tallyloom.operators.ids import assign_ids, attempt_id, resolve_collisions


def ids_of(frame, values):
    df = frame("s string", *[(v,) for v in values])
    return {r[0]: r[1] for r in df.select("s", attempt_id(F.col("s"), "salt", 0)).collect()}


def test_known_new_and_null(frame):
    known = frame("person_id string, source_id string", ("old", "a"))
    df = frame("source_id string, n int", ("a", 1), ("b", 2), ("b", 3), (None, 4))
    got, pairs = assign_ids(df, known, "salt")
    new = ids_of(frame, ["b"])["b"]
    assert rows(got, "n", "person_id") == [(1, "old"), (2, new), (3, new), (4, None)]
    assert rows(pairs, "person_id", "source_id") == [(new, "b")]


def test_without_an_id_table(frame):
    known = frame("person_id string, source_id string")
    got, pairs = assign_ids(frame("source_id string", ("a",)), known, "salt")
    assert got.count() == 1 and pairs.count() == 1


def test_three_way_collision_and_taken_id(frame):
    existing = frame("person_id string, source_id string", ("X", "e1"))
    new = frame("source_id string", ("c",), ("a",), ("b",), ("d",), ("z",))
    first = F.when(F.col("source_id").isin("a", "b", "c"), "SAME").when(F.col("source_id") == "d", "X").otherwise("free")
    got = resolve_collisions(new, existing, "salt", first=first)
    found = {r["source_id"]: r["person_id"] for r in got.collect()}
    assert found["a"] == "SAME" and found["z"] == "free"
    assert len(set(found.values())) == 5 and "X" not in found.values()
    second = frame("s string", ("b",)).select(hash_id(F.concat(F.lit("b"), F.lit("#1")), "salt")).first()[0]
    assert found["b"] == second


def test_more_ids_than_values(frame, monkeypatch):
    monkeypatch.setattr(ids, "ID_SPACE", 2)
    new = frame("source_id string", ("a",), ("b",), ("c",))
    with pytest.raises(ValueError, match="more ids"):
        resolve_collisions(new, frame("person_id string, source_id string"), "salt")


def test_result_does_not_depend_on_row_order(frame):
    existing = frame("person_id string, source_id string")
    values = [(f"s{n}",) for n in range(60)]
    short = F.substring(hash_id(F.col("source_id"), "salt"), 1, 1)
    a = resolve_collisions(frame("source_id string", *values), existing, "salt", first=short)
    b = resolve_collisions(frame("source_id string", *values[::-1]), existing, "salt", first=short)
    assert rows(a, "source_id", "person_id") == rows(b, "source_id", "person_id")
    assert a.select("person_id").distinct().count() == 60
