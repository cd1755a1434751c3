"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The vocabulary is that of a tokenizer file with word ends: text is normalised, cut into words,
each word becomes byte symbols of which the last carries the word-end suffix, and the adjacent
pair of lowest rank is merged until none is left. Only counts are made: initial symbols minus
merges, no ids.
"""

from __future__ import annotations

import heapq
import json
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallyloom.llm.batches import map_texts

#: Fixed value: the word pattern of the tokenizer file, for ASCII texts.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"

#: Longer runs and words are counted anew each time, so what is remembered is bounded in bytes too.
LONGEST = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the merge list."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    signs = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [signs[b] for b in range(256)]


class Merges:
    """Counts the tokens of one word, given as the numbers of its symbols."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in merges]
        self.rank = {vocabulary[a] << 32 | vocabulary[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocabulary[a + b] for a, b in pairs]

    def count(self, symbols: list[int]) -> int:
        """Symbols left when no adjacent pair has a rank.

        A heap entry is rank and left position in one number. It is stale if another pair stands
        there now; that pair, if ranked, has an entry of its own.
        """
        left = size = len(symbols)
        rank, made = self.rank.get, self.made
        heap = [
            r << 32 | i
            for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))
            if (r := rank(a << 32 | b, -1)) >= 0
        ]
        if not heap:
            return left
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        while heap:
            top = pop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if j < 0 or (a := symbols[i]) < 0 or rank(a << 32 | symbols[j], -1) != top >> 32:
                continue
            symbols[i] = a = made[top >> 32]
            symbols[j] = -1
            after[i] = k = after[j]
            left -= 1
            if k >= 0:
                before[k] = i
                if (r := rank(a << 32 | symbols[k], -1)) >= 0:
                    push(heap, r << 32 | i)
            if (h := before[i]) >= 0 and (r := rank(symbols[h] << 32 | a, -1)) >= 0:
                push(heap, r << 32 | h)
        return left


class Pieces(dict):
    """Tokens of a word, in ASCII or byte signs; up to ``keep`` words of ``LONGEST`` signs are remembered."""

    def __init__(self, model: dict, keep: int):
        super().__init__()
        vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.keep = keep
        self.merges = Merges(vocabulary, model["merges"]).count
        signs = byte_symbols()
        signs = {s: s for s in signs} | {chr(b): signs[b] for b in range(128)}
        self.inner = {c: vocabulary[s] for c, s in signs.items()}
        self.last = {c: vocabulary[s + end] for c, s in signs.items()}

    def __missing__(self, piece: str) -> int:
        symbols = [*map(self.inner.__getitem__, piece)]
        symbols[-1] = self.last[piece[-1]]
        count = self.merges(symbols)
        if len(piece) <= LONGEST:
            if len(self) >= self.keep:
                self.clear()
            self[piece] = count
        return count


class Counter(dict):
    """Tokens of a white-space-free run of bytes, up to ``keep`` runs of ``LONGEST`` bytes are remembered.

    White space never joins a word, and no normalisation reaches across it, so runs count alone.
    ASCII runs are lower-cased and cut here; others go through the file's own normaliser and
    word splitter, whose Unicode tables are then the right ones.
    """

    def __init__(self, spec: str, keep: int):
        super().__init__()
        parsed, library = json.loads(spec), Tokenizer.from_str(spec)
        self.keep = keep
        self.normal, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.words = regex.compile(WORDS)
        self.piece = Pieces(parsed["model"], keep).__getitem__
        self.added = [t["content"] for t in parsed["added_tokens"]]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, longest_first)) or "(?!)").split

    def plain(self, text: str) -> int:
        if text.isascii():
            return sum(map(self.piece, self.words.findall(text.lower())))
        return sum(self.piece(piece) for piece, _ in self.cut(self.normal(text)))

    def __missing__(self, run: bytes) -> int:
        text = run.decode("utf-8", "replace")
        if any(token in text for token in self.added):
            parts = self.split(text)
            total = sum(map(self.plain, parts)) + len(parts) - 1
        else:
            total = self.plain(text)
        if len(run) <= LONGEST:
            if len(self) >= self.keep:
                self.clear()
            self[run] = total
        return total


@cache
def counter(spec: str, keep: int) -> Counter:
    """One per worker process: what it remembers serves that worker's later tasks too."""
    return Counter(spec, keep)


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    keep: int = 300_000,
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids each keep their
    row; an empty table gives none. Columns besides the two named ones are not looked at. The file
    is read on the driver and goes to the tasks with the code; its size does not depend on the
    data. ``keep`` words of at most ``LONGEST`` bytes are remembered per worker.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def start():
        counts = counter(spec.value, keep)

        def of(batch):
            tokens = [sum(map(counts.__getitem__, t.split())) if t else 0 for t in batch]
            return [
                pa.array([len(t) if t else 0 for t in batch], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]

        return of

    return map_texts(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", start)
