import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from tallyloom.llm import simhash
from tallyloom.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    words = WORDS.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    value = sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))
    return value - (1 << 64) if value >> 63 else value


def grouped(fps):
    """Smallest id reachable, by comparing all pairs."""
    root = {f: f for f in set(fps.values())}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(sorted(root), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
            root[find(a)] = find(b)
    smallest = {}
    for i, f in fps.items():
        smallest[find(f)] = min(i, smallest.get(find(f), i))
    return {i: smallest[find(f)] for i, f in fps.items()}


@pytest.mark.parametrize("seed", range(12))
def test_lanes_against_pairs(seed):
    rnd = np.random.default_rng(seed)
    fps, part, starts, wanted = [], [], [], set()
    for _ in range(rnd.integers(1, 8)):
        size = int(rnd.choice([1, 2, 3, 63, 64, 65, 200]))
        bases = rnd.integers(0, 2**64, size=size // 20 + 1, dtype=np.uint64)
        unit = [int(rnd.choice(bases)) ^ sum({1 << int(b) for b in rnd.integers(0, 64, rnd.integers(0, 6))}) for _ in range(size)]
        sides = sorted(rnd.integers(0, 2, size).tolist()) if rnd.random() < 0.4 else [0] * size
        starts.append(len(fps))
        for i, j in itertools.combinations(range(size), 2):
            if (unit[i] ^ unit[j]).bit_count() <= 3 and (len(set(sides)) == 1 or sides[i] != sides[j]):
                wanted.add((len(fps) + i, len(fps) + j))
        fps, part = fps + unit, part + sides
    got = set()
    for a, b in simhash.close_lanes(np.array(fps, np.uint64), np.array(part, np.int8), np.array(starts), 3):
        got |= set(zip(a.tolist(), b.tolist(), strict=True))
    assert got == wanted


def test_spanning_joins_chains():
    pairs = [(np.array([4, 3, 9]), np.array([3, 2, 8])), (np.array([2, 8]), np.array([0, 7]))]
    assert simhash.spanning(10, pairs).tolist() == [0, 1, 0, 0, 0, 5, 6, 7, 7, 7]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(frame, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(-40, 40), rnd.randint(-40, 40)) for _ in range(30)] + [(i, i + 1) for i in range(100, 140)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components(frame("a long, b long", *edges)).collect()}
    assert all(root[n] == r for n, r in got.items())
    assert set(got) == {n for a, b in edges if a != b for n in (a, b)}


def test_components_of_nothing(frame, spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("part", [4096, 2])
def test_groups_against_pairs(frame, monkeypatch, part):
    """Near copies of one text crowd the buckets; small parts spread them over pairs of parts."""
    monkeypatch.setattr(simhash, "PART", part)
    rnd = random.Random(9)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(400)]
    texts = {}
    for i in range(60):
        words = list(base) if i % 3 else [f"v{rnd.randint(0, 400)}" for _ in range(80)]
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = "Changed"
        texts[i] = " ".join(words)
    texts[60], texts[61] = texts[3].upper(), ""
    fps = {i: fingerprint(t) for i, t in texts.items()}
    found = simhash.near_duplicates(frame("doc_id long, text string", *texts.items())).collect()
    assert {r.doc_id: r.fp for r in found} == fps
    assert {r.doc_id: r.component_id for r in found} == grouped(fps)


def test_odd_rows(odd, no_documents):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.fp, r.component_id) for r in rows if r.doc_id in (1, 2, 3)} == {(0, 1)}
    assert {r.component_id for r in rows if r.doc_id in (6, 7)} == {6}
    assert sorted(r.component_id or 0 for r in rows if r.doc_id is None) == [0, 1]
    assert simhash.near_duplicates(no_documents).count() == 0
