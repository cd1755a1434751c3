import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import toxicity


def draw(rnd, size, most=4):
    return {int(t): int(rnd.integers(1, 5)) for t in rnd.choice(size, rnd.integers(0, most), replace=False)}


def dense(index, counts):
    """Vectors of length one by loops."""
    out = np.zeros((len(counts), len(index.terms)))
    for row, some in enumerate(counts):
        for t, n in some.items():
            out[row, t] = (1 + math.log(n)) * index.idf[t]
        out[row] /= np.linalg.norm(out[row]) or 1
    return out


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("share", [0.02, 0.2, 2.0])
def test_neighbours_are_exact(seed, share, monkeypatch):
    """Whichever terms are kept as matrices: none, a few or many."""
    monkeypatch.setattr(toxicity, "DENSE_SHARE", share)
    rnd = np.random.default_rng(seed)
    size, n = 30, int(rnd.integers(1, 500))
    examples = [(i, int(rnd.random() < 0.3), draw(rnd, size)) for i in range(n)]
    index = toxicity.build([str(i) for i in range(size)], rnd.integers(0, 50, size).astype(float), 100, examples, 7)
    index.k = 7
    mine = dense(index, [examples[name][2] for name in index.names])
    queries = [draw(rnd, size) for _ in range(30)]
    cosine = np.round(dense(index, queries) @ mine.T, 12)
    row, example, found = index.nearest(index.vectors(queries), len(queries))
    for q in range(len(queries)):
        best = np.lexsort((np.arange(n), -cosine[q]))[:7]
        assert example[row == q].tolist() == best.tolist() and np.allclose(found[row == q], cosine[q][best])
    own = toxicity.left_out(index, [examples[name][2] for name in index.names])
    assert not (own[0] == own[1]).any() and np.bincount(own[0], minlength=n).tolist() == [min(7, n - 1)] * n


def test_votes_by_loops():
    rnd = np.random.default_rng(3)
    examples = [(i, int(rnd.random() < 0.3), draw(rnd, 9)) for i in range(90)]
    index = toxicity.build([str(i) for i in range(9)], rnd.integers(0, 50, 9).astype(float), 100, examples, 9)
    queries = [{}, *[draw(rnd, 9) for _ in range(20)]]
    near = index.nearest(index.vectors(queries), len(queries))
    ones = index.labels.sum()
    weigh = {"inverse": lambda c: 1 / (1.02 - min(c, 1)), "cosine": lambda c: c, "square": lambda c: c * c}[index.weigh]
    for q, raw in enumerate(index.votes(near, len(queries))):
        votes = [(index.labels[e], weigh(c)) for r, e, c in zip(*near, strict=True) if r == q and c > 0]
        toxic, clean = sum(w for y, w in votes if y), sum(w for y, w in votes if not y)
        least = 1e-3 * (toxic + clean) / 90 + 1e-12
        assert abs(raw - (math.log(toxic / ones + least) - math.log(clean / (90 - ones) + least))) < 1e-9
    assert index.votes(near, len(queries))[0] == 0


def test_blocks_are_left_out(monkeypatch):
    """Blocks whose bound is too low are not scored."""
    monkeypatch.setattr(toxicity, "DENSE_SHARE", 2.0)
    examples = [(i, i % 2, {i // 64: 1}) for i in range(64 * 20)]
    index = toxicity.build([str(i) for i in range(20)], np.ones(20), 1000, examples, 5)
    index.k = 5
    index.weight[64:] = np.nan  # the postings of all other terms
    row, example, cosine = index.nearest(index.vectors([{0: 1}]), 1)
    assert {index.names[e] // 64 for e in example} == {0} and np.allclose(cosine, 1)


def test_document_frequencies_cover_all_documents(table):
    docs = table("documents").repartition(5)
    frequency, n = toxicity.document_frequencies(docs, ["the", "nea", "never"], "doc_id", "text")
    texts = [toxicity.stems(r.text.encode()) for r in docs.collect()]
    assert n == len(texts) and frequency[2] == 0
    assert frequency.tolist()[:2] == [sum(w in t for t in texts) for w in ("the", "nea")]


def test_stems():
    found = toxicity.stems("Élan élan-vital ABCDE abcdf x\u3000y z1z".encode())
    assert found == {"élan": 2, "vita": 1, "abcd": 2, "x\u3000y": 1, "z": 2}


def by_hand(rows, shuffled=None):
    """An index over the labelled rows of the training fold, with the given order of their labels."""
    some = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    given = [r.toxic for r in some]
    if shuffled is not None:
        given = np.random.default_rng(shuffled).permutation(given).tolist()
    found = [toxicity.stems(r.text.encode()) for r in some]
    terms = sorted({t for c in found for t in c})
    number = {t: i for i, t in enumerate(terms)}
    seen = Counter(t for c in found for t in c)
    examples = [(r.doc_id, y, {number[t]: n for t, n in c.items()}) for r, y, c in zip(some, given, found, strict=True)]
    return toxicity.build(terms, np.array([seen[t] for t in terms], float), len(some), examples, 101), examples


@pytest.fixture(scope="module")
def labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("toxic is not null").collect()


def auc(raw, labels):
    order = np.argsort(np.argsort(raw))
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(labels) - ones))


def test_no_label_leaks_into_its_own_vote(labelled_rows):
    """With shuffled labels the left-out votes tell nothing, and the calibration says so."""
    told = []
    for seed in (None, 1, 2):
        index, examples = by_hand(labelled_rows, seed)
        counts = {name: c for name, _, c in examples}
        near = toxicity.left_out(index, [counts[n] for n in index.names])
        told.append((auc(index.votes(near, len(index.labels), index.labels), index.labels), index.slope))
    assert told[0][0] > 0.95 and told[0][1] > 1
    assert all(0.44 < a < 0.56 and abs(slope) < 0.35 for a, slope in told[1:])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    index = toxicity.train(docs, labels)
    rows = toxicity.toxicity(docs.join(labels, "doc_id", "left_semi"), index).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    caught = [r.predicted for r in held if r.toxic]
    # 0.67 measured; a sixth of the toxic labels stand at texts without any telling word.
    assert sum(caught) >= 0.6 * len(caught)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.005 * len(held)
    assert all(len(r.evidence) == 3 for r in rows)


def test_odd_rows(odd, no_documents, labels):
    index = toxicity.train(odd, labels)
    rows = toxicity.toxicity(odd, index).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept = toxicity.keep_harmless(odd, index)
    assert kept.columns == odd.columns and kept.count() == sum(1 - r.predicted for r in rows)
    none = toxicity.train(no_documents, labels)
    assert toxicity.toxicity(no_documents, none).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, none).collect()} == {0.5}


def test_rare_words_of_examples_tell(spark):
    """Copies of examples whose words no other example has get the verdict of that example."""
    clean = [(i, f"plain{i} common word here and there{i % 7}", 0) for i in range(300)]
    bad = [(1000 + i, "rare " + " ".join(f"x{chr(97 + i)}{c}" for c in "qwertzuiop"), 1) for i in range(3)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in clean + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in clean + bad], "doc_id long, toxic int")
    index = toxicity.train(docs, labels, k=1, fold=None)
    copies = spark.createDataFrame([(n, t) for n, (_, t, _) in enumerate(bad + clean[:3])], "doc_id long, text string")
    rows = sorted(toxicity.toxicity(copies, index, fold=None).collect())
    assert [r.evidence[0] for r in rows[:3]] == [str(i) for i, _, _ in bad]
    assert min(r.score for r in rows[:3]) > max(r.score for r in rows[3:])
    assert {"plai", "rare", "comm"} <= set(index.terms)


@pytest.mark.parametrize("n", [0, 1, 200])
def test_an_index_arrives_whole(n):
    examples = [(i, i % 2, {i % 7: 1 + i % 3, 7: 2}) for i in range(n)]
    index = toxicity.build([f"t{i}" for i in range(8)], np.arange(8.0), 100, examples, 5)
    other = pickle.loads(pickle.dumps(index))
    assert other.terms == index.terms and other.names == index.names and (other.k, other.weigh) == (index.k, index.weigh)
    for mine, theirs in zip(*(i.nearest(i.vectors([{3: 2}]), 1) for i in (index, other)), strict=True):
        assert mine.tolist() == theirs.tolist()


def test_examples_are_bounded_by_their_bytes(spark):
    """A text that does not fit is passed over; equal rows count once."""
    rows = [(1, "aaaa bbbb", 1), (2, "cccc " * 100, 1), (3, "dddd", 0), (3, "dddd", 0), (4, None, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").distinct()
    index = toxicity.train(docs, labels, fold=None, fit_bytes=100)
    assert sorted(index.names) == ["1", "3", "4"] and set(index.terms) == {"aaaa", "bbbb", "dddd"}
