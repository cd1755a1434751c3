import itertools
import re
from collections import Counter

import numpy as np

from tallyloom.llm import quality_rules
from tallyloom.llm.quality_rules import BOILERPLATE, CONTENT, FEATURES, Field, line_features
from tallyloom.llm.shapes import shape

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    words, seen, again = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        again += bool(WORDS.search(line)) and line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_base_counts(table):
    texts = [r.text for r in table("documents").collect()]
    texts += ["", "\n\n a \n a \n\n", " a b c d e a b c d e a", "a " * 50, "é\x0bè\x85ê　ë", "x\r\nx\r\nx", "#|<\n#|<"]
    for text in texts:
        s = shape(text.encode())
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == base_counts(text)


def test_viterbi_finds_the_best_path():
    rnd = np.random.default_rng(0)
    for _ in range(100):
        f = Field([], None, rnd.normal(size=(2, 2)), rnd.normal(size=2), rnd.normal(size=2))
        w = rnd.normal(size=(rnd.integers(1, 8), 2))

        def worth(path, f=f, w=w):
            inner = sum(w[i, k] for i, k in enumerate(path)) + sum(f.step[a, b] for a, b in itertools.pairwise(path))
            return f.first[path[0]] + f.last[path[-1]] + inner

        assert tuple(f.viterbi(w)) == max(itertools.product((0, 1), repeat=len(w)), key=worth)


def test_fit_follows_neighbours():
    """A line that looks the same in both kinds of text takes the label of those around it."""
    plain, marked = shape(b"some words here"), shape(b"*** ### | $$$")
    good, bad = line_features(plain), line_features(marked)
    texts = [np.concatenate([good] * 5)] * 20 + [np.concatenate([bad, bad, good, bad, bad])] * 20
    field = quality_rules.fit(texts, [CONTENT] * 20 + [BOILERPLATE] * 20)
    assert field.viterbi(field.weights(texts[0])) == [CONTENT] * 5
    assert field.viterbi(field.weights(texts[-1])) == [BOILERPLATE] * 5
    assert field.step[0, 0] > field.step[0, 1] and field.step[1, 1] > field.step[1, 0]


def test_unlabelled_lines_are_content():
    field = quality_rules.fit([], [])
    assert field.viterbi(field.weights(np.ones((3, len(FEATURES))))) == [CONTENT] * 3


def test_labelled_documents(table):
    docs, labels = table("documents"), table("labels")
    field = quality_rules.train(docs, labels)
    rows = quality_rules.quality_rules(docs, field).join(labels, "doc_id").where("not base_failed").collect()
    wrong = sum(r.kept != bool(r.quality) for r in rows)
    assert len(rows) > 40 and wrong <= 0.04 * len(rows)
    kept = {r.doc_id for r in quality_rules.quality_rules(docs, field).where("kept").collect()}
    assert {r.doc_id for r in quality_rules.keep_good(docs, field).collect()} == kept


def test_odd_rows(odd, no_documents, labels):
    field = quality_rules.train(odd, labels)
    rows = quality_rules.quality_rules(odd, field).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all(r.base_failed and not r.kept and r.n_words == r.word_chars == 0 for r in empty)
    kept = quality_rules.keep_good(odd, field)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert quality_rules.quality_rules(no_documents, quality_rules.train(no_documents, labels)).count() == 0
    assert quality_rules.keep_good(no_documents, field).count() == 0
