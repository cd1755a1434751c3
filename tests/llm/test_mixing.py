import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing
from tallyloom.llm.mixing import mix


@pytest.mark.parametrize("rate", [0.01, 0.7, 3.0, 40.0, 900.0, 5000.0])
def test_tables_are_the_distribution(frame, rate):
    (row,) = mixing.poisson_tables(frame("s string, rate double", ("a", rate)), "s").collect()
    assert row.cdf == sorted(row.cdf) and row.cdf[-1] == pytest.approx(1, abs=1e-9)
    total = 0.0
    for k, c in enumerate(row.cdf):
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert c == pytest.approx(total, abs=1e-9)


def by_loops(rows, weights, temperature, seed):
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len((r.text or "").encode())
    share = {s: (n**temperature if n else 0.0) if weights is None else (weights.get(s, 0.0) if n else 0.0) for s, n in sizes.items()}
    out = Counter()
    for r in rows:
        whole = sum(share.values())
        rate = sum(sizes.values()) * share[r.source] / whole / sizes[r.source] if share[r.source] and whole else 0.0
        if not rate:
            continue
        name = "null" if r.doc_id is None else r.doc_id
        u = int(hashlib.md5(f"{seed}|{name}".encode()).hexdigest()[:13], 16) / 16**13
        k, total = 0, math.exp(-rate)
        while total <= u:
            k += 1
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        out[r.doc_id, r.source] += k
    return +out


@pytest.mark.parametrize("weights", [None, {"src0": 1.0, "src3": 5.0}])
@pytest.mark.parametrize("entries", [mixing.BROADCAST_ENTRIES, 0])
def test_counts(table, monkeypatch, weights, entries):
    monkeypatch.setattr(mixing, "BROADCAST_ENTRIES", entries)
    docs = table("documents")
    got = mix(docs, weights=weights, temperature=0.5, seed=3).collect()
    assert Counter((r.doc_id, r.source) for r in got) == by_loops(docs.collect(), weights, 0.5, 3)
    for _, n in Counter(r.doc_id for r in got).items():
        assert n >= 1
    assert len({r.shuffle_key for r in got}) == len(got)


def test_shares_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = {"src1": 1.0, "src2": 3.0}
    sizes = mix(docs, weights=weights).groupBy("source").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    n = {r.source: r.n for r in sizes}
    assert set(n) == set(weights) and 2 < n["src2"] / n["src1"] < 4.5


def test_copies_are_shuffled(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "'text' as text", "'a' as source")
    ids = [r.doc_id for r in mix(docs, weights={"a": 1.0}).collect()]
    rising = sum(a < b for a, b in zip(ids, ids[1:], strict=False))
    assert 0.35 < rising / len(ids) < 0.65


def test_odd_rows(odd, no_documents):
    rows = mix(odd, weights=None, temperature=0.0, seed=1).collect()
    assert Counter((r.doc_id, r.source) for r in rows) == by_loops(odd.collect(), None, 0.0, 1)
    assert set(rows[0].asDict()) == {*odd.columns, "copy", "shuffle_key"}
    assert all(r.copy >= 1 and r._row == 3 for r in rows)
    assert mix(no_documents).count() == 0
    assert mix(odd.where("text is null")).count() == 0
