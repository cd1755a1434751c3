"""Quality rules with line labelling by a linear-chain conditional random field.

Counts of the whole text give the base rule. The lines of a text are then labelled content or
boilerplate by Viterbi decoding, and a text is kept if enough of its words stand in content lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import TEXT, map_texts, text_column
from tallyloom.llm.sampling import labelled
from tallyloom.llm.shapes import LINE, Shape, shape

#: What the field sees of a line: shares of its words or bytes, and flags.
FEATURES = ("symbols", "pipes", "upper", "shouts", "stops", "digits", "echoes", "again")
BINS = 12
CONTENT, BOILERPLATE = 0, 1


def line_features(s: Shape) -> np.ndarray:
    """Numbers per line with a word, by ``FEATURES``."""
    at = {name: s.lines[:, i] for i, name in enumerate(LINE)}
    words = np.maximum(1, at["words"])
    size = np.maximum(1, s.lines[:, 3:].sum(axis=1))
    return np.column_stack(
        [
            (at["symbol"] + at["pipe"]) / words,
            at["pipe"] / words,
            at["upper"] / size,
            at["shout"] / words,
            at["stop"] / words,
            at["digit"] / size,
            at["echoes"] / words,
            at["again"].astype(float),
        ]
    )


@dataclass
class Field:
    """Log weights of a two-label chain: by feature and bin, between labels, at both ends."""

    edges: list[np.ndarray]
    emission: np.ndarray  # (feature, bin, label)
    step: np.ndarray  # (from, to)
    first: np.ndarray
    last: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)])

    def weights(self, x: np.ndarray) -> np.ndarray:
        """Emission weights (line, label)."""
        if not len(x):
            return np.zeros((0, 2))
        return self.emission[np.arange(len(self.edges)), self.bins(x)].sum(axis=1)

    def viterbi(self, weights: np.ndarray) -> list[int]:
        """The best labels of one text's lines; on a tie the line is content."""
        if not len(weights):
            return []
        (cc, cb), (bc, bb) = self.step.tolist()
        rows = weights.tolist()
        c, b = rows[0][0] + self.first[0], rows[0][1] + self.first[1]
        back = []
        for wc, wb in rows[1:]:
            c_from_b, b_from_b = b + bc > c + cc, b + bb > c + cb
            c, b = (b + bc if c_from_b else c + cc) + wc, (b + bb if b_from_b else c + cb) + wb
            back.append((c_from_b, b_from_b))
        label = int(b + self.last[1] > c + self.last[0])
        labels = [label]
        for came in reversed(back):
            label = int(came[label])
            labels.append(label)
        return labels[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def fit(texts: list[np.ndarray], labels: list[int], steps: int = 60, rate: float = 0.15, ridge: float = 2e-3) -> Field:
    """Maximum likelihood by gradient steps (Adam) over a bounded sample of line sequences.

    A text's label is taken for all its lines; lines that look the same in texts of both labels
    get weights near their balance. Without texts of both labels all weights are zero, and every
    line is content.
    """
    n_features = len(FEATURES)
    x = np.concatenate(texts) if texts else np.zeros((0, n_features))
    edges = []
    for f in range(n_features):
        distinct = np.unique(x[:, f])
        cuts = np.unique(np.quantile(distinct, np.linspace(0, 1, BINS)[1:-1], method="nearest")) if len(distinct) > 1 else []
        edges.append(np.asarray(cuts, float) + 1e-9)
    sizes = [(n_features, BINS, 2), (2, 2), (2,), (2,)]
    weights = [np.zeros(s) for s in sizes]
    if len(set(labels)) < 2:
        return Field(edges, *weights)

    # Longest texts first, so that those still running at a step are the first rows.
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    y = np.array([labels[i] for i in order])
    at = Field(edges, *weights).bins(np.concatenate([texts[i] for i in order]))
    begin = np.cumsum(lengths) - lengths
    alive = [int((lengths > t).sum()) for t in range(int(lengths.max()))]
    rows = [begin[:n] + t for t, n in enumerate(alive)]
    line_label = np.repeat(y, lengths)
    feature = np.broadcast_to(np.arange(n_features), at.shape)
    flat = feature * BINS + at

    def count(values: np.ndarray) -> np.ndarray:
        """Sums of (line, label) values per feature, bin and label."""
        out = [np.bincount(flat.ravel(), np.repeat(values[:, k], n_features), n_features * BINS) for k in (0, 1)]
        return np.stack(out, axis=1).reshape(sizes[0])

    wanted_lines = np.zeros((len(line_label), 2))
    wanted_lines[np.arange(len(line_label)), line_label] = 1
    wanted = [count(wanted_lines), np.zeros((2, 2)), np.zeros(2), np.zeros(2)]
    for k in (0, 1):
        wanted[1][k, k] = (lengths - 1)[y == k].sum()
        wanted[2][k] = wanted[3][k] = (y == k).sum()

    moments = [[np.zeros(s) for s in sizes] for _ in range(2)]
    for t in range(1, steps + 1):
        emission, step, first, last = weights
        e = emission[feature, at].sum(axis=1)
        forward = np.zeros_like(e)
        backward = np.zeros_like(e)
        forward[rows[0]] = e[rows[0]] + first
        for k in range(1, len(rows)):
            now = rows[k]
            forward[now] = e[now] + _log_sum(forward[now - 1][:, :, None] + step, 1)
        ends = begin + lengths - 1
        backward[ends] = last
        for k in range(len(rows) - 1, 0, -1):
            now = rows[k]
            backward[now - 1] = _log_sum(step + (e[now] + backward[now])[:, None, :], 2)
        log_z = _log_sum(forward[ends] + last, 1)
        p = np.exp(forward + backward - np.repeat(log_z, lengths)[:, None])
        inner = np.setdiff1d(np.arange(len(e)), begin)
        both = forward[inner - 1][:, :, None] + step + (e[inner] + backward[inner])[:, None, :]
        both = np.exp(both - np.repeat(log_z, lengths)[inner][:, None, None])
        expected = [count(p), both.sum(axis=0), p[begin].sum(axis=0), p[ends].sum(axis=0)]
        for i in range(4):
            gradient = (wanted[i] - expected[i]) / len(y) - ridge * weights[i]
            moments[0][i] = 0.9 * moments[0][i] + 0.1 * gradient
            moments[1][i] = 0.99 * moments[1][i] + 0.01 * gradient**2
            mean, square = moments[0][i] / (1 - 0.9**t), moments[1][i] / (1 - 0.99**t)
            weights[i] = weights[i] + rate * mean / (np.sqrt(square) + 1e-8)
    return Field(edges, *weights)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = 2000,
    fold: tuple[int, int] | None = None,
) -> Field:
    """The field, fitted on at most ``fit_rows`` labelled texts; their lines come as small numbers."""
    sample = labelled(docs, labels, label_col, fit_rows, fold, id_col, text_col)

    def run(batches):
        for batch in batches:
            x = [line_features(shape(t)).astype(np.float32).ravel().tolist() for t in batch.column(TEXT).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float32())), batch.column("_label")], ["x", "y"])

    made = sample.mapInArrow(run, "x array<float>, y int").where("size(x) > 0")
    rows = made.orderBy(F.xxhash64("x", "y"), "x", "y").limit(fit_rows).collect()
    lines = [np.array(r.x, float).reshape(-1, len(FEATURES)) for r in rows]
    return fit(lines, [CONTENT if r.y else BOILERPLATE for r in rows])


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FIELDS = f"{COUNTS}, base_failed boolean, content_share double, kept boolean"


def _judge(docs: DataFrame, field: Field, least_words: int, most_repeats: int, least_content: float):
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def start():
        def row(text):
            s = shape(text)
            labels = np.array(shared.value.viterbi(shared.value.weights(line_features(s))))
            content = int(s.lines[labels == CONTENT, 0].sum()) if len(labels) else 0
            share = content / s.n_words if s.n_words else 0.0
            failed = s.n_words < least_words or 100 * s.n_repeat_words > most_repeats * s.n_words
            return (
                s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words,
                failed, share, not failed and share >= least_content,
            )

        def of(batch):
            columns = list(zip(*map(row, batch), strict=True))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

        return of

    return start


def quality_rules(
    docs: DataFrame,
    field: Field,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = 10,
    most_repeats: int = 20,
    least_content: float = 0.5,
) -> DataFrame:
    """Per row: the id, the base counts, ``base_failed``, ``content_share`` and ``kept``.

    The base rule fails a text with fewer than ``least_words`` words, or with more than
    ``most_repeats`` per cent of its words in repeated windows. Others are kept if at least
    ``least_content`` of their words stand in lines labelled content. Null and empty texts have
    no words, a content share of 0, and fail. Repeated rows and null ids each keep their row; an
    empty table gives none; other columns are not looked at. A text is one task's work: memory
    for one grows with its length, by some tens of bytes a word.
    """
    return map_texts(docs, id_col, text_col, FIELDS, _judge(docs, field, least_words, most_repeats, least_content))


def keep_good(
    docs: DataFrame,
    field: Field,
    text_col: str = "text",
    least_words: int = 10,
    most_repeats: int = 20,
    least_content: float = 0.5,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; each row is judged alone."""
    judge = _judge(docs, field, least_words, most_repeats, least_content)
    return docs.where(text_column(docs, text_col, FIELDS, judge)["kept"])
