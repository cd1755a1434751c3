from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import line_dedup as L


def by_loops(docs, min_docs, min_chars):
    lower = str.maketrans(L.UPPER, L.LOWER)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    texts = [(i, (t or "").split("\n")) for i, t in docs]
    seen = Counter(k for _, lines in texts for k in {key(x) for x in lines})
    gone = lambda line: len(key(line)) >= min_chars and seen[key(line)] >= min_docs
    return Counter(
        (i, len(lines), sum(map(gone, lines)), "\n".join(x for x in lines if not gone(x))) for i, lines in texts
    )


TEXTS = [
    *[(i, f"Common line\nown {i}\n  COMMON LINE\t\nÉcole\nécole") for i in range(6)],
    (7, "common line"),
    (7, "common line"),
    (None, "common line\n\n\nx\n"),
    (None, None),
    (8, ""),
    (9, "École\n\x00\n \n\x0b x \x0c"),
    (10, "\n".join(["own", "common line"] * 3000)),
    (11, "x\r\n X\r\nx"),
]


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (3, 0), (4, 2), (99, 1)])
@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2)])
def test_against_loops(spark, min_docs, min_chars, batches, fanout):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    found = L.drop_common_lines(docs, min_docs=min_docs, min_chars=min_chars, batches=batches, fanout=fanout)
    assert Counter(map(tuple, found.collect())) == by_loops(TEXTS, min_docs, min_chars)


def hashes(spark, *numbers):
    return spark.createDataFrame([(n, -n) for n in numbers], "h1 long, h2 long")


def test_runs_are_levelled_and_leave_common_lines_out(spark):
    runs = L.LineRuns(spark, least=2, fanout=2, buckets=3)
    runs.add(hashes(spark, 1, 1, 2))
    assert [len(level) for level in runs.levels] == [1]
    runs.add(hashes(spark, 1, 2, 3))  # 1 is common already and is left out
    assert [len(level) for level in runs.levels] == [0, 1]
    assert {tuple(r) for r in runs.runs()[0].collect()} == {(1, -1, 2), (2, -2, 2), (3, -3, 1)}
    runs.add(hashes(spark, 2, 4))
    assert {r.h1 for r in runs.unseen(hashes(spark, 2, 3, 4, 5)).collect()} == {3, 4, 5}
    assert {r.h1 for r in runs.common().collect()} == {1, 2}
    names = [n for level in runs.levels for n in level]
    runs.drop()
    assert not any(spark.catalog.tableExists(n) for n in names) and runs.runs() == []


def test_merges_move_no_run(spark):
    """A batch meets a run bucket by bucket: the run's side has no exchange."""
    runs = L.LineRuns(spark, least=1, buckets=3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs.add(hashes(spark, 1, 2))
        plan = runs.unseen(hashes(spark, 1).groupBy("h1", "h2").agg(F.count("*").alias("docs")))
        assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        runs.drop()


def test_odd_rows(odd, no_documents):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(map(tuple, L.drop_common_lines(odd, min_docs=2).collect())) == by_loops(rows, 2, 1)
    assert L.drop_common_lines(no_documents).count() == 0
