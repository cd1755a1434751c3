import random
import re
from collections import Counter

import pytest

from tallyloom.llm import decontamination
from tallyloom.llm.decontamination import decontaminate, n_hit

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def by_loops(docs, items, width):
    windows = {}
    for item, text in items:
        found = words(text)
        for k in range(max(1, len(found) - width + 1) if found else 0):
            windows.setdefault(tuple(found[k : k + width]), set()).add(str(item) if item is not None else "null")
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        found, hit, owners = words(text), set(), set()
        for n in lengths:
            for k in range(len(found) - n + 1):
                if tuple(found[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    owners |= windows[tuple(found[k : k + n])]
        out.append((i, len(found), len(hit), sorted(owners)))
    return sorted(out, key=repr)


def found(docs, items, width=10):
    rows = decontaminate(docs, items, width=width).select("doc_id", "n_words", n_hit("spans").alias("n"), "items")
    return sorted(((r[0], r[1], r[2], list(r[3])) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 3000])
@pytest.mark.parametrize("shard_bytes", [decontamination.SHARD_BYTES, 20_000])
def test_given_tables(table, monkeypatch, block_bytes, shard_bytes):
    """Test texts in one block and in several, documents in one shard and in many."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard_bytes)
    docs, items = table("documents"), table("benchmark")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, items) == by_loops(pairs, [tuple(r) for r in items.collect()], 10)


def test_overlaps_short_items_and_bounds(frame):
    items = [(1, "a b c d"), (2, "B, c!"), (2, "c c c"), (None, "é9"), (4, ""), (5, None), (6, "z")]
    docs = [(1, "a b c d e"), (2, "x a b-c d a b c"), (3, "c c c c"), (4, "É9 é9"), (5, "a b"), (6, "c d"), (6, "z z")]
    got = found(frame("doc_id long, text string", *docs), frame("item_id long, text string", *items), width=3)
    assert got == by_loops(docs, items, 3)


def test_no_phrase_across_documents(frame):
    docs = frame("doc_id long, text string", (1, "one two three"), (2, "four five six")).coalesce(1)
    assert [r[2] for r in found(docs, frame("item_id long, text string", (1, "one two three four")), 4)] == [0, 0]


def test_proximity(frame):
    item = "alpha beta gamma delta"
    docs = [(1, "alpha beta gamma delta"), (2, "alpha x beta gamma delta"), (3, "delta y y y y y y alpha"), (4, "alpha")]
    got = decontaminate(
        frame("doc_id long, text string", *docs), frame("item_id long, text string", (9, item)), width=4, slop=1, near_terms=3
    )
    assert {r.doc_id: (list(r["items"]), list(r.near)) for r in got.collect()} == {
        1: (["9"], ["9"]), 2: ([], ["9"]), 3: ([], []), 4: ([], [])
    }


def test_an_index_can_be_written_and_read(frame, spark, tmp_path):
    docs = frame("doc_id long, text string", (1, "b a b"), (2, None))
    decontamination.index_documents(docs).write.parquet(str(tmp_path / "index"))
    (row,) = spark.read.parquet(str(tmp_path / "index")).where("size(terms) > 0").collect()
    assert row.ids[0] == 1 and row.n_words[0] == 3 and [bytes(t) for t in row.terms] == [b"b", b"a"]


def test_odd_rows(odd, no_documents, frame):
    items = frame("item_id long, text string", (1, "stands here twice and is long enough to count for something"), (2, None))
    rows = decontaminate(odd, items).collect()
    assert len(rows) == odd.count()
    assert sorted(r.doc_id for r in rows if r["items"]) == [6, 6, 7]
    assert {r.n_words for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert decontaminate(no_documents, items).count() == 0
    assert not any(r["items"] for r in decontaminate(odd, items.where("false")).collect())


def near_by_loops(docs, items, width, slop, near_terms):
    cut = lambda text: (text or "").lower().split()
    often = Counter(w for _, text in docs for w in cut(text))
    out = {}
    for i, text in docs:
        at = {}
        for k, word in enumerate(cut(text)):
            at.setdefault(word, []).append(k)
        for item, passage in items:
            words = cut(passage)
            for b in range(max(1, len(words) - width + 1)):
                window = list(enumerate(words[b : b + width]))
                rare = sorted((p for p in window if often[p[1]]), key=lambda p: often[p[1]])[:near_terms]
                if len(rare) < near_terms:
                    continue
                (o, first), *rest = rare
                if any(all(any(abs(p + q - o - x) <= slop for x in at.get(v, [])) for q, v in rest) for p in at.get(first, [])):
                    out.setdefault(i, set()).add(str(item))
    return {i: sorted(out.get(i, [])) for i, _ in docs}


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_BYTES, 300])
@pytest.mark.parametrize("shard_bytes", [decontamination.SHARD_BYTES, 400, 1])
def test_near_in_any_shards(frame, monkeypatch, block_bytes, shard_bytes):
    """Passages with a word replaced are near whether or not their shard holds that word."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontamination, "SHARD_BYTES", shard_bytes)
    rnd = random.Random(6)
    vocabulary = [f"w{min(n, rnd.randint(0, 60))}" for n in range(120)]
    items = [(n, " ".join(rnd.choices(vocabulary, k=12))) for n in range(8)]
    docs = [(n, " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30)))) for n in range(40)]
    for n, passage in items:
        changed = passage.split()
        changed[rnd.randrange(12)] = "other"
        docs.append((100 + n, " ".join(["x", *changed, "y"])))
    got = decontaminate(
        frame("doc_id long, text string", *docs).repartition(3), frame("item_id long, text string", *items), width=6, slop=1
    )
    assert {r.doc_id: list(r.near) for r in got.collect()} == near_by_loops(docs, items, 6, 1, 3)
