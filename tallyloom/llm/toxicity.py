"""Toxicity by nearest labelled examples: exact cosine of TF-IDF over a block-max inverted index.

Terms are words cut to their first ``STEM`` code points; every one that occurs in a labelled example, of
either label, is a term. Document frequencies are counted over all documents, and no label has a part
in any weight. The examples' postings are cut into blocks with the largest weight of each term per
block; a block is scored only if its bound reaches the k-th best cosine found so far, so the neighbours
are exact. They vote by distance, each class against its own size, and the votes are calibrated
on the examples themselves, each left out of its own neighbours.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import ID, TEXT, map_texts, text_column, texts
from tallyloom.llm.sampling import held_out, labelled

#: Bytes of words after lower-casing: a to z and whatever is not ASCII.
WORD_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
#: Code points of a word that make its term.
STEM = 4
BLOCK = 64
#: Terms in a twentieth of the examples and more are multiplied as a matrix, at most so many.
DENSE_SHARE, DENSE_TERMS = 0.05, 1024
#: Texts scored at once.
SLICE = 256
#: Distance weights to choose from: the inverse of the distance, the cosine, its square.
WEIGHTS = {
    "inverse": lambda cosine: 1 / (1.02 - np.minimum(cosine, 1.0)),
    "cosine": lambda cosine: cosine,
    "square": np.square,
}


def stems(text: bytes | None) -> Counter:
    """How often each term occurs in a whole text."""
    if not text:
        return Counter()
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    found = Counter([word[:STEM] for word in text.lower().translate(WORD_BYTES).decode().split(" ")])
    found.pop("", None)
    return found


class Vocabulary(dict):
    """Numbers of the known terms."""

    def __init__(self, terms: list[str]):
        super().__init__(zip(terms, range(len(terms)), strict=True))

    def counts(self, text: bytes | None) -> dict[int, int]:
        """Occurrences of the known terms."""
        return {self[t]: n for t, n in stems(text).items() if t in self}


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges one after the other, and which range each is of."""
    counts = ends - starts
    which = np.repeat(np.arange(len(starts)), counts)
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts), which


@dataclass
class Index:
    """Examples as postings in blocks of ``BLOCK``, with block maxima, and the calibration.

    Terms in many examples are kept as matrices, one per block. Of the others only the (term, block)
    cells that have postings are kept, so their number grows with the postings.
    """

    terms: list[str]
    idf: np.ndarray
    names: list
    labels: np.ndarray
    count: np.ndarray  # postings of each term
    example: np.ndarray  # of each posting, ordered by term, then example
    times: np.ndarray  # of each posting: how often the term occurs
    k: int
    weigh: str = "inverse"
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self):
        """Weights of the postings, and their blocks, which are made anew where an index arrives."""
        n = len(self.labels)
        term = np.repeat(np.arange(len(self.count)), self.count)
        weight = (1 + np.log(self.times)) * self.idf[term]
        length = np.sqrt(np.bincount(self.example, np.square(weight), n))
        weight /= np.where(length > 0, length, 1)[self.example]
        self.n_blocks = max(1, -(-n // BLOCK))
        often = np.argsort(-self.count, kind="stable")[:DENSE_TERMS]
        often = np.sort(often[self.count[often] >= max(2, DENSE_SHARE * n)])
        self.column = np.full(len(self.count), -1)
        self.column[often] = np.arange(len(often))
        here = self.column[term] >= 0
        self.matrices = np.zeros((self.n_blocks, len(often), BLOCK))
        self.matrices[self.example[here] // BLOCK, self.column[term[here]], self.example[here] % BLOCK] = weight[here]
        self.tops = self.matrices.max(axis=2).T if len(often) else np.zeros((0, self.n_blocks))
        term, self.posting, self.weight = term[~here], self.example[~here], weight[~here]
        at = term * self.n_blocks + self.posting // BLOCK
        first = np.flatnonzero(np.diff(at, prepend=-1))
        cell = at[first]
        self.block, self.start = cell % self.n_blocks, np.append(first, len(at))
        self.top = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        #: Where the cells of each term begin.
        self.cells = np.searchsorted(cell, np.arange(len(self.count) + 1) * self.n_blocks)

    def __getstate__(self):
        """Only what cannot be made anew, packed: a broadcast lies on the disk of every executor."""
        packed = [zlib.compress(a.astype(np.int32).tobytes(), 1) for a in (self.count, np.diff(self.example, prepend=0), self.times)]
        words = zlib.compress("\n".join(self.terms).encode(), 1)
        return words, self.idf, self.names, self.labels, packed, self.k, self.weigh, self.slope, self.offset

    def __setstate__(self, state):
        words, idf, names, labels, packed, *rest = state
        count, step, times = (np.frombuffer(zlib.decompress(a), np.int32) for a in packed)
        terms = zlib.decompress(words).decode().split("\n") if len(count) else []
        self.__init__(terms, idf, names, labels, count, np.cumsum(step, dtype=np.int32), times, *rest)

    def vectors(self, counts: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and weight of some texts, each of length one unless it has no weight at all."""
        sizes = [len(c) for c in counts]
        row = np.repeat(np.arange(len(counts)), sizes)
        term = np.fromiter(chain.from_iterable(counts), np.int64, sum(sizes))
        times = np.fromiter(chain.from_iterable(c.values() for c in counts), np.float64, sum(sizes))
        weight = (1 + np.log(times)) * self.idf[term]
        length = np.sqrt(np.bincount(row, np.square(weight), len(counts)))
        return row, term, weight / np.where(length > 0, length, 1)[row]

    def nearest(self, vectors, n: int, but: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, example and cosine of the ``k`` examples of largest cosine for each of ``n`` texts, exact.

        Of equals those that stand first; rows in order, best first. ``but`` leaves out an example per text.
        """
        k = min(self.k, len(self.labels) - (but is not None))
        if k < 1 or not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, term, weight = vectors
        column = self.column[term]
        often = column >= 0
        dense = np.zeros((n, self.matrices.shape[1]))
        dense[row[often], column[often]] = weight[often]
        row, term, weight = row[~often], term[~often], weight[~often]
        cell, which = _spread(self.cells[term], self.cells[term + 1])
        row, weight = row[which], weight[which]  # of each cell from here on
        place = row * self.n_blocks + self.block[cell]
        rest = np.bincount(place, weight * self.top[cell], n * self.n_blocks).reshape(n, -1)
        bound = dense @ self.tops + rest + 1e-9  # above any sum in another order
        cosine = np.full((n, self.n_blocks * BLOCK), -1.0)

        def score(wanted: np.ndarray) -> None:
            """Cosines of all examples of the wanted blocks, from matrices and postings."""
            here = wanted.ravel()[place]
            some, of = _spread(self.start[cell[here]], self.start[cell[here] + 1])
            flat = row[here][of] * cosine.shape[1] + self.posting[some]
            rare = np.bincount(flat, weight[here][of] * self.weight[some], cosine.size).reshape(cosine.shape)
            for b in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, b])
                span = slice(b * BLOCK, (b + 1) * BLOCK)
                if 2 * len(rows) < n:
                    cosine[rows, span] = dense[rows] @ self.matrices[b] + rare[rows, span]
                else:
                    np.copyto(cosine[:, span], dense @ self.matrices[b] + rare[:, span], where=wanted[:, b, None])
            # Rounded, so that equal vectors tie whatever the order of their sums.
            np.round(cosine, 12, out=cosine)
            cosine[:, len(self.labels) :] = -2
            if but is not None:
                cosine[np.arange(n), but] = -2

        enough = min(self.n_blocks, -(-(k + 1) // BLOCK) + 1)
        first = np.zeros((n, self.n_blocks), bool)
        np.put_along_axis(first, np.argpartition(-bound, enough - 1, axis=1)[:, :enough], True, axis=1)
        score(first)
        kth = np.partition(cosine, -k, axis=1)[:, -k]
        more = ~first & (bound >= kth[:, None])
        if more.any():
            score(more)
            kth = np.partition(cosine, -k, axis=1)[:, -k]
        row, example = np.nonzero(cosine >= kth[:, None])
        found = cosine[row, example]
        order = np.lexsort((example, -found, row))
        row, example, found = row[order], example[order], found[order]
        best = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row] < k
        return row[best], example[best], found[best]

    def votes(self, near, n: int, own: np.ndarray | None = None, k: int | None = None, weigh: str | None = None) -> np.ndarray:
        """Log odds of each of ``n`` texts: the votes of each class over the class's size.

        ``own`` are the labels of the texts if they are examples themselves: these count in no size.
        A text that shares no term with any neighbour has the odds of one to one.
        """
        row, example, cosine = near
        if k is not None:
            few = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row] < k
            row, example, cosine = row[few], example[few], cosine[few]
        weight = np.where(cosine > 0, WEIGHTS[weigh or self.weigh](cosine), 0.0)
        label = self.labels[example]
        ones, zeros = self.labels.sum(), (1 - self.labels).sum()
        toxic, clean = np.bincount(row, weight * label, n), np.bincount(row, weight * (1 - label), n)
        least = 1e-3 * (toxic + clean) / max(1, len(self.labels)) + 1e-12
        ones, zeros = (ones, zeros) if own is None else (ones - own, zeros - (1 - own))
        return np.log(toxic / np.maximum(1, ones) + least) - np.log(clean / np.maximum(1, zeros) + least)

    def scores(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.offset, -500, 500)))


def build(terms: list[str], frequency: np.ndarray, n_docs: int, examples: list[tuple[object, int, dict[int, int]]], k: int) -> Index:
    """The index of ``(name, label, counts)``, calibrated by leaving each example out once.

    The number of neighbours, up to ``k``, and the distance weight are those of the smallest log loss of
    these left-out votes: chosen among the examples alone.
    """
    idf = np.log((1 + n_docs) / (1 + frequency))
    # Examples that share their commonest telling terms (so, a language) stand together, which makes
    # block maxima tell.
    spread = np.bincount(np.fromiter(chain.from_iterable(c for _, _, c in examples), np.int64), minlength=len(terms))
    spread[2 * spread >= len(examples)] = 0
    place = np.empty(len(terms), np.int64)
    place[np.argsort(-spread, kind="stable")] = np.arange(len(terms))
    rank = lambda counts: sorted(place[t] for t in counts if spread[t] > 0)[:4]
    digest = lambda counts: zlib.crc32(repr(sorted(counts.items())).encode())
    examples = sorted(examples, key=lambda e: (rank(e[2]), str(e[0]), e[1], digest(e[2])))
    term = np.fromiter(chain.from_iterable(counts for _, _, counts in examples), np.int64)
    times = np.fromiter(chain.from_iterable(counts.values() for _, _, counts in examples), np.int32)
    example = np.repeat(np.arange(len(examples), dtype=np.int32), [len(c) for _, _, c in examples])
    order = np.argsort(term, kind="stable")
    names, labels = [e[0] for e in examples], np.array([e[1] for e in examples], float)
    count = np.bincount(term, minlength=len(terms))
    index = Index(terms, idf, names, labels, count, example[order], times[order], k)
    if len(set(labels.tolist())) == 2:
        near = left_out(index, [c for _, _, c in examples])
        tried = []
        for fewer in sorted({max(1, k // 9), max(1, k // 5), max(1, k // 2), k}):
            for weigh in WEIGHTS:
                raw = index.votes(near, len(labels), labels, fewer, weigh)
                slope, offset = _calibrate(raw, labels)
                tried.append((_log_loss(slope * raw + offset, labels), fewer, weigh, slope, offset))
        _, index.k, index.weigh, index.slope, index.offset = min(tried)
    elif len(labels):
        index.slope, index.offset = 0.0, float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    return index


def left_out(index: Index, counts: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours of the examples, in the index's order, each without itself."""
    parts = []
    for start in range(0, len(counts), SLICE // 4):
        some = counts[start : start + SLICE // 4]
        row, example, cosine = index.nearest(index.vectors(some), len(some), start + np.arange(len(some)))
        parts.append((row + start, example, cosine))
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def _log_loss(odds: np.ndarray, labels: np.ndarray) -> float:
    return round(float(np.logaddexp(0, np.where(labels == 1, -odds, odds)).mean()), 9)


def _calibrate(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic calibration with smoothed targets and a weak pull to the votes themselves."""
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    a, b, pull = 1.0, 0.0, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -500, 500)))
        w = p * (1 - p) + 1e-9
        gradient = [((p - target) * raw).sum() + pull * (a - 1), (p - target).sum() + pull * b]
        hessian = [[(w * raw * raw).sum() + pull, (w * raw).sum()], [(w * raw).sum(), w.sum() + pull]]
        a, b = np.array([a, b]) - np.linalg.solve(hessian, gradient)
    return float(a), float(b)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = 6000,
    fit_bytes: int = 32 << 20,
    k: int = 101,
    fold: tuple[int, int] | None = (3, 1),
) -> Index:
    """The index over labelled rows outside the held-out ``fold``, in hash order.

    These are at most ``fit_rows`` rows with ``fit_bytes`` bytes of text together; a text that does not fit
    into what is left of that is passed over, and equal rows count once. What reaches the driver is
    the examples' terms and how often each occurs, so it is bounded like them, and the terms'
    document frequencies over all of ``docs``.
    """
    spark = docs.sparkSession
    key = [F.xxhash64(F.col(ID).cast("string")).alias("_a"), F.xxhash64(TEXT).alias("_b"), F.col("_label").alias("_c")]
    sample = labelled(docs, labels, label_col, fit_rows, fold, id_col, text_col).select("*", *key)
    size = F.coalesce(F.octet_length(TEXT), F.lit(0)).cast("long")
    chosen, room = [], fit_bytes
    for a, b, c, n in sample.select("_a", "_b", "_c", size).distinct().orderBy("_a", "_b", "_c").limit(fit_rows).collect():
        if n <= room:
            chosen.append((a, b, c))
            room -= n
    wanted = F.broadcast(spark.createDataFrame(chosen, "_a long, _b long, _c int"))
    sample = sample.join(wanted, ["_a", "_b", "_c"], "left_semi").dropDuplicates(["_a", "_b", "_c"])

    def counted(batches):
        for batch in batches:
            found = [stems(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(2),
                    pa.array([list(c) for c in found], pa.list_(pa.string())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int32())),
                ],
                ["name", "label", "terms", "times"],
            )

    rows = sample.select(ID, TEXT, "_label").mapInArrow(counted, "name string, label int, terms array<string>, times array<int>")
    names, given, some, times = rows.toArrow().combine_chunks().columns
    # By numbers: a million strings as objects would take the driver ten times the memory.
    some, times = some.combine_chunks(), times.combine_chunks()
    coded = some.flatten().dictionary_encode()
    found = coded.dictionary.to_pylist()
    terms = sorted(found)
    place = np.argsort(np.argsort(np.array(found, object))) if found else np.zeros(0, int)
    numbers, counts = place[coded.indices.to_numpy()], times.flatten().to_numpy()
    ends = np.cumsum([0, *some.value_lengths().to_pylist()])
    examples = [
        (name, label, dict(zip(numbers[a:b].tolist(), counts[a:b].tolist(), strict=True)))
        for name, label, a, b in zip(names.to_pylist(), given.to_pylist(), ends, ends[1:], strict=False)
    ]
    frequency, n_docs = document_frequencies(docs, terms, id_col, text_col)
    return build(terms, frequency, n_docs, examples, k)


def document_frequencies(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""

    def run(batches):
        vocabulary, total, n = Vocabulary(terms), np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for text in batch.column(1).to_pylist():
                n += 1
                total[list(vocabulary.counts(text))] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], n), pa.int64())], ["term", "n"]
        )

    sums = texts(docs, id_col, text_col).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    term, n = (c.to_numpy() for c in sums.toArrow().columns)
    total = np.zeros(len(terms) + 1)
    total[term] = n  # the last place is that of -1, the number of documents
    return total[:-1], int(total[-1])


FIELDS = "score double, evidence array<string>"


def _scorer(docs: DataFrame, index: Index, evidence: int):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def start():
        index = shared.value
        vocabulary = Vocabulary(index.terms)

        def of(batch):
            scores, named = [np.zeros(0)], []
            at = {text: i for i, text in enumerate(dict.fromkeys(batch))}  # equal texts are scored once
            alone = list(at)
            for begin in range(0, len(alone), SLICE):
                some = [vocabulary.counts(t) for t in alone[begin : begin + SLICE]]
                near = index.nearest(index.vectors(some), len(some))
                scores.append(index.scores(index.votes(near, len(some))))
                row, example, cosine = near
                ends = np.searchsorted(row, np.arange(len(some) + 1))
                for a, b in zip(ends, ends[1:], strict=False):
                    named.append([index.names[e] for e in example[a : min(b, a + evidence)]])
            place = [at[text] for text in batch]
            return [pa.array(np.concatenate(scores)[place]), pa.array([named[i] for i in place], pa.list_(pa.string()))]

        return of

    return start


def toxicity(
    docs: DataFrame,
    index: Index,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    fold: tuple[int, int] | None = (3, 1),
    evidence: int = 3,
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1), ``predicted`` and ``evidence``.

    ``evidence`` has the ids (as strings) of the nearest examples. Null and empty texts, and those that
    share no term with any example, have even votes. Repeated rows and null ids each keep their row (a null id is not
    held out); an empty table gives none; other columns are not looked at. Without labels of both
    kinds the score follows the labels there are, and is 0.5 for none.
    """
    scored = map_texts(docs, id_col, text_col, FIELDS, _scorer(docs, index, evidence))
    out = held_out(F.col(id_col), *fold) if fold else F.lit(False)
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select(id_col, out.alias("held_out"), "score", predicted.alias("predicted"), "evidence")


def keep_harmless(docs: DataFrame, index: Index, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, with all their columns; each row is judged alone."""
    return docs.where(text_column(docs, text_col, FIELDS, _scorer(docs, index, 0))["score"] < threshold)
