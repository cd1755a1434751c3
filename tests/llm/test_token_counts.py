import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm.token_counts import Counter, token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    with open(FILE, encoding="utf-8") as file:
        spec = file.read()
    counter, library = Counter(spec, 1000), Tokenizer.from_str(spec)

    def count(text):
        return sum(map(counter.__getitem__, text.encode().split())), len(library.encode(text, add_special_tokens=False))

    return count


def test_code_points_in_words_and_alone(both):
    points = [*range(1, 0x3000), *range(0x3000, 0x110000, 997)]
    for p in points:
        if not 0xD800 <= p < 0xE000:
            mine, wanted = both(f"Ab{chr(p)}c {chr(p)} 'S1{chr(p)}{chr(p)}'ll")
            assert mine == wanted, hex(p)


def test_random_mixtures(both):
    pieces = ["a", "B", "é", "É", "'s", "'LL", " ", "\n", "\x1c", "\x85", "\xa0", "12", "!", "<|endoftext|>",
              "<|ENDOFTEXT|>", "<|startoftext|>", "ΟΔΟΣ", "中", "😀", "‍", "the", "ing", "İ"]
    rnd = random.Random(3)
    for _ in range(5000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14)))
        mine, wanted = both(text)
        assert mine == wanted, text


def test_one_very_long_word(both):
    rnd = random.Random(5)
    mine, wanted = both("".join(rnd.choice("etaoinshr") for _ in range(20_000)))
    assert mine == wanted


def test_what_is_remembered_is_bounded_in_bytes():
    with open(FILE, encoding="utf-8") as file:
        counter = Counter(file.read(), 50)
    for n in range(300):
        counter[f"{n}".encode() * 40 + b"x" * 5000]
        counter[f"word{n}".encode()]
        counter["中".encode() * (n + 1)]
    assert 0 < len(counter) <= 50 and max(map(len, counter)) <= 64
    pieces = counter.piece.__self__
    assert 0 < len(pieces) <= 50 and max(map(len, pieces)) <= 64


def test_given_documents(spark, table):
    docs = table("documents")
    library = Tokenizer.from_file(FILE)
    got = {r.doc_id: r for r in token_counts(docs, FILE, limit=300).collect()}
    for r in docs.collect():
        n = len(library.encode(r.text, add_special_tokens=False))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes) == (n, len(r.text.encode()))
        assert got[r.doc_id].over_limit == (n > 300)


def test_odd_rows(odd, no_documents):
    rows = token_counts(odd, FILE).collect()
    assert len(rows) == odd.count()
    assert [(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (1, 2)] == [(0, 0)] * 3
    assert [r.over_limit for r in rows if r.doc_id == 4] == [True]
    assert token_counts(no_documents, FILE).count() == 0
