import zlib

import numpy as np
import pytest

from tallyloom.llm import quality_classifier as qc


def test_scores_are_sums_of_tables():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)  # only the pair tells
    model = qc.fit(x, y)
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)
    assert ((model.scores(x) > 0.5) == (y == 1)).mean() > 0.9
    total = model.intercept
    for f, table in enumerate(model.tables):
        total += table[np.searchsorted(model.edges[f], x[5, f], "right")]
    for a, b, table in model.pairs:
        total += table[np.searchsorted(model.coarse[a], x[5, a], "right"), np.searchsorted(model.coarse[b], x[5, b], "right")]
    assert model.scores(x[5:6])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_trees_are_shallow():
    g, h = np.array([1.0, 1, -3, -3, 2, 2, 0.5, 9]), np.ones(8)
    values = qc._tree(g, h, 2, 1.0, 0.5)
    assert len(np.unique(values)) <= 4


@pytest.mark.parametrize("labels", [[], [1.0] * 5])
def test_one_class_gives_the_rate(labels):
    x = np.zeros((len(labels), len(qc.FEATURES)))
    model = qc.fit(x, np.array(labels))
    assert model.scores(np.ones((2, len(qc.FEATURES))))[0] == pytest.approx((len(labels) + 1) / (len(labels) + 2) if labels else 0.5)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = qc.quality_scores(docs, qc.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


def test_held_out_labels_are_not_read(table):
    """Other labels in the held-out part leave the model as it is."""
    docs, labels = table("documents"), table("labels")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - quality, quality) as quality")
    a, b = qc.train(docs, labels), qc.train(docs, turned)
    assert a.intercept == b.intercept and all((s == t).all() for s, t in zip(a.tables, b.tables, strict=True))


def test_odd_rows(odd, no_documents, labels):
    rows = qc.quality_scores(odd, qc.train(odd, labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert qc.quality_scores(no_documents, qc.train(no_documents, labels)).count() == 0
