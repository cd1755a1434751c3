"""Counts over the lines and words of a text, for the classifiers of text quality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Fixed values of the contract: symbol characters, and the bytes that part words.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
#: Continuation bytes of UTF-8 and blanks: what is left without them counts as one code point each.
NOT_COUNTED = bytes(range(0x80, 0xC0)) + BLANKS
WINDOW = 5

CLASSES = ("other", "upper", "digit", "symbol", "shout", "stop", "pipe", "blank")


def _classes() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for name, members in (
        ("upper", bytes(range(ord("A"), ord("Z") + 1))),
        ("digit", b"0123456789"),
        ("symbol", SYMBOLS),
        ("shout", b"!?"),
        ("stop", b".,;:"),
        ("pipe", b"|"),
        ("blank", BLANKS),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


CLASS_OF = _classes()


class Numbers(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass
class Shape:
    """One row per line with a word in ``lines``: see ``LINE``; the rest are counts of the text."""

    lines: np.ndarray
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_distinct: int
    top_word: int


#: Columns of ``Shape.lines``: words, adjacent repeats, equal to an earlier line, bytes by class.
LINE = ("words", "echoes", "again", *CLASSES)


def repeat_words(ids: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more, the first included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    rank = ids.astype(np.int64)
    for k in range(1, WINDOW):  # exact: each step numbers the distinct runs of one word more
        _, rank = np.unique(rank[: len(ids) - k] << 32 | ids[k:], return_inverse=True)
    twice = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.subtract.at(cover, np.flatnonzero(twice) + WINDOW, 1)
    return int((np.cumsum(cover) > 0).sum())


def shape(text: bytes | None) -> Shape:
    """All counts of a whole text. Null is taken as empty."""
    text = text or b""
    words = text.split()
    numbers = Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    raw = np.frombuffer(text, np.uint8)
    line = np.cumsum(raw == 10)
    line -= raw == 10  # a line break belongs to the line that it ends
    n_lines = int(line[-1]) + 1 if len(raw) else 0
    classes = np.bincount(line * len(CLASSES) + CLASS_OF[raw], minlength=n_lines * len(CLASSES))
    blank = np.concatenate(([True], CLASS_OF[raw] == CLASSES.index("blank")))
    heads = np.flatnonzero(blank[:-1] & ~blank[1:])  # where words begin
    word_line = line[heads]
    per_line = np.bincount(word_line, minlength=n_lines)
    echo = np.flatnonzero((ids[1:] == ids[:-1]) & (word_line[1:] == word_line[:-1])) + 1
    seen, again = set(), []
    for k, part in enumerate(text.split(b"\n")[:n_lines]):
        again.append(bool(per_line[k]) and part in seen)
        seen.add(part)
    table = np.column_stack(
        [
            per_line,
            np.bincount(word_line[echo], minlength=n_lines),
            np.array(again, np.int64),
            classes.reshape(-1, len(CLASSES)),
        ]
    )
    return Shape(
        lines=table[per_line > 0],
        n_words=len(words),
        word_chars=len(text.translate(None, NOT_COUNTED)),
        n_symbols=len(text) - len(text.translate(None, SYMBOLS)),
        n_dup_lines=sum(again),
        n_repeat_words=repeat_words(ids),
        n_distinct=len(numbers),
        top_word=int(np.bincount(ids).max()) if len(ids) else 0,
    )
