import re
from collections import Counter

import pytest

from tallyloom.llm import collocations as C


def by_loops(docs, least, longest, top, percent=100):
    """The phrases of ``(lang, text)``, counted and scored one by one."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {k: a for k, a in f.items() if a >= least and len(k[1]) >= 2}
    rows = {}
    for (lang, p), a in candidates.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
        if any(o == lang and len(q) > len(p) and 100 * b >= percent * a and inside(q) for (o, q), b in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


TEXTS = [
    ("en", "The big red Dog ran, the big red dog sat. The big  red\tdog ran the big red dog"),
    ("en", "big red dog. é\x00b É\x00b é\x00b ÉÀ; é\x00b é\x00b a a a a a a a"),
    ("en", "a\x01 b a b a\x01 b a b a\x01 b c a b c a b c d a b c d e"),
    ("de", "big red dog\nbig red dog\x0bbig red dog big red dog:"),
    (None, "x y x y x y x y x y"),
    (None, None),
    ("en", ""),
    ("fr", " \t .,;:!?\n"),
]


@pytest.mark.parametrize("budget", [2, 5, 1000])
@pytest.mark.parametrize("percent", [100, 60])
def test_against_loops(spark, budget, percent):
    docs = spark.createDataFrame(TEXTS * 2, "lang string, text string").repartition(3)
    found = C.collocations(docs, least=4, longest=5, top=9, budget=budget, covered_percent=percent)
    wanted = by_loops(TEXTS * 2, 4, 5, 9, percent)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) >= 10


def test_budget_changes_nothing(spark, table):
    """Longer prefixes for heavy groups, and groups dealt otherwise, give the same counts."""
    docs = table("documents")
    one = [sorted(map(tuple, C.collocations(docs, least=20, budget=b).collect())) for b in (2000, 100_000)]
    assert one[0] == one[1] and one[0]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """Filters that let everything through cost work only."""
    docs = spark.createDataFrame(TEXTS * 2, "lang string, text string")
    monkeypatch.setattr(C, "_filter", lambda places: C.np.full(C.FILTER_BITS // 8, 255, C.np.uint8))
    assert sorted(map(tuple, C.collocations(docs, least=4, top=9).collect())) == by_loops(TEXTS * 2, 4, 5, 9)


def test_walk_adds_up_leaves():
    rows = [("en", "a b ", 1, 2), ("en", "a b c ", 2, 2), ("en", "a b c d ", 4, 2), ("en", "a b d ", 8, 2), ("en", "b c ", 1, 2)]
    wanted = {("a b ", 15), ("a b c ", 6), ("a b c d ", 4), ("a b d ", 8)}
    assert {n[1:] for n in C.walk(rows, 3)} == wanted


def test_odd_rows(odd, no_documents):
    found = C.collocations(odd, least=2, top=50).collect()
    assert {r.lang for r in found} >= {"en"} and "und" not in {r.lang for r in found}
    assert C.collocations(no_documents).count() == 0
