import pytest

import compare
import corpus_pipeline
from tallyloom.llm.queries import QUERIES, SQL


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, sf, name, monkeypatch):
    monkeypatch.setattr(compare, "queries", lambda: QUERIES)
    monkeypatch.setattr(compare, "oracle_sql", lambda: SQL)
    assert compare.compare(spark, compare.connect(sf), name, sf) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_a_row_per_document(spark, sf, name):
    rows = QUERIES[name](spark, sf).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)


def test_entry_registers_them():
    import __spark_entry__

    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
