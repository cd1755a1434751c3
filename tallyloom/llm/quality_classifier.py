"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in a cycle over the features, each on what the others leave, so that
every feature ends up with one table from bins to log odds; the pairs of features that explain
most of the rest get tables of their own in the same way. A score is the sum of looked-up values.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import TEXT, map_texts
from tallyloom.llm.sampling import held_out, labelled
from tallyloom.llm.shapes import LINE, shape

FEATURES = (
    "words", "word_bytes", "symbols", "pipes", "upper", "shouts", "stops", "digits",
    "echoes", "repeats", "distinct", "top_word", "dup_lines", "line_words",
)


def features(text: bytes | None) -> list[float]:
    """What the model sees of a whole text: counts per word or per byte, by ``FEATURES``."""
    s = shape(text)
    total = dict(zip(LINE, s.lines.sum(axis=0).tolist(), strict=True))
    n, size, lines = max(1, s.n_words), max(1, sum(total[c] for c in LINE[3:])), max(1, len(s.lines))
    return [
        float(np.log2(1 + s.n_words)),
        s.word_chars / n,
        s.n_symbols / n,
        total["pipe"] / n,
        total["upper"] / size,
        total["shout"] / n,
        total["stop"] / n,
        total["digit"] / n,
        total["echoes"] / n,
        s.n_repeat_words / n,
        s.n_distinct / n,
        s.top_word / n,
        s.n_dup_lines / lines,
        s.n_words / lines,
    ]


@dataclass
class Additive:
    """Bin edges per feature, tables per feature and pair, and an intercept."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    intercept: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities by vectorised additions of bins."""
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for a, b, table in self.pairs:
            rows = np.searchsorted(self.coarse[a], x[:, a], "right")
            total += table[rows, np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct values, at even quantiles of what differs from the commonest value.

    A feature that is zero almost everywhere would get no cut from quantiles of all rows.
    """
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) < 2:
        return np.zeros(0)
    rest = values[values != distinct[counts.argmax()]]
    cuts = np.quantile(rest, np.linspace(0, 1, bins - 1), method="nearest")
    cuts = np.append(cuts, distinct[counts.argmax()])
    at = np.unique(np.searchsorted(distinct, cuts))
    at = np.unique(np.clip(np.concatenate((at, at + 1)), 1, len(distinct) - 1))
    return (distinct[at - 1] + distinct[at]) / 2


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """Leaf value per bin of a tree over ordered bins, from gradient and Hessian sums per bin."""
    value = np.full(len(g), _leaf(g.sum(), h.sum(), ridge))
    if depth == 0 or len(g) < 2:
        return value
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = np.where((hl >= least) & (hr >= least), gl * _leaf(gl, hl, ridge) + gr * _leaf(gr, hr, ridge), -np.inf)
    cut = int(gain.argmax())
    if gain[cut] <= g.sum() * _leaf(g.sum(), h.sum(), ridge) + 1e-12:
        return value
    sides = [_tree(g[s], h[s], depth - 1, ridge, least) for s in (slice(0, cut + 1), slice(cut + 1, None))]
    return np.concatenate(sides)


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """The best cut of both axes: its gain and the value of every cell."""
    sums = [np.cumsum(np.cumsum(x, axis=0), axis=1) for x in (g, h)]
    corners = []
    for c in sums:
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        corners.append((a, b, d, c[-1, -1] - a - b - d))
    gain = sum(gq * _leaf(gq, hq, ridge) for gq, hq in zip(*corners, strict=True))
    gain = np.where(np.minimum.reduce(corners[1]) >= least, gain, -np.inf)
    if not gain.size or not np.isfinite(gain.max()):
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [_leaf(gq[i, j], hq[i, j], ridge) for gq, hq in zip(*corners, strict=True)]
    table = np.empty_like(g)
    table[: i + 1, : j + 1], table[: i + 1, j + 1 :] = values[0], values[1]
    table[i + 1 :, : j + 1], table[i + 1 :, j + 1 :] = values[2], values[3]
    return float(gain[i, j]), table


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 120,
    pair_rounds: int = 40,
    max_pairs: int = 6,
    bins: int = 32,
    coarse_bins: int = 8,
    rate: float = 0.15,
    ridge: float = 1.0,
    least: float = 0.5,
) -> Additive:
    """Cyclic boosting on a bounded sample. One class or no rows gives the smoothed rate alone."""
    n_features = x.shape[1]
    mean = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(mean / (1 - mean)))
    edges = [_edges(x[:, f], bins) for f in range(n_features)]
    coarse = [_edges(x[:, f], coarse_bins) for f in range(n_features)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if len(np.unique(y)) < 2:
        return Additive(edges, tables, coarse, [], intercept)
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    total = np.full(len(y), intercept)

    def sums(where: np.ndarray, size: int):
        p = 1 / (1 + np.exp(-total))
        return np.bincount(where, y - p, size), np.bincount(where, p * (1 - p), size)

    for _ in range(rounds):
        for f in range(n_features):
            step = rate * _tree(*sums(at[f], len(tables[f])), 2, ridge, least)
            tables[f] += step
            total += step[at[f]]

    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    sizes = [len(e) + 1 for e in coarse]
    cells = {(a, b): rough[a] * sizes[b] + rough[b] for a, b in combinations(range(n_features), 2)}

    def square(a: int, b: int):
        g, h = sums(cells[a, b], sizes[a] * sizes[b])
        return _quadrants(g.reshape(sizes[a], sizes[b]), h.reshape(sizes[a], sizes[b]), ridge, least)

    gains = {ab: square(*ab)[0] for ab in cells}
    ranked = sorted((ab for ab in cells if gains[ab] > 0), key=lambda ab: (-gains[ab], ab))[:max_pairs]
    found = {ab: np.zeros((sizes[ab[0]], sizes[ab[1]])) for ab in ranked}
    for _ in range(pair_rounds):
        for ab in ranked:
            step = rate * square(*ab)[1]
            found[ab] += step
            total += step.reshape(-1)[cells[ab]]

    # Tables are centred on the sample, so that they can be read one by one.
    for f in range(n_features):
        middle = tables[f][at[f]].mean()
        tables[f] -= middle
        intercept += float(middle)
    for ab in ranked:
        middle = found[ab].reshape(-1)[cells[ab]].mean()
        found[ab] -= middle
        intercept += float(middle)
    return Additive(edges, tables, coarse, [(a, b, found[a, b]) for a, b in ranked], intercept)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = 6000,
    fold: tuple[int, int] | None = (4, 2),
) -> Additive:
    """The model, fitted on at most ``fit_rows`` labelled rows outside the held-out ``fold``.

    Features are made in the tasks from whole texts; only ``fit_rows`` rows of numbers are collected.
    """
    sample = labelled(docs, labels, label_col, fit_rows, fold, id_col, text_col)

    def run(batches):
        for batch in batches:
            x = [features(t) for t in batch.column(TEXT).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), batch.column("_label")], ["x", "y"]
            )

    made = sample.mapInArrow(run, "x array<double>, y int")
    rows = made.orderBy(F.xxhash64("x", "y"), "x", "y").limit(fit_rows).collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in rows], float))


def quality_scores(
    docs: DataFrame,
    model: Additive,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
    fold: tuple[int, int] | None = (4, 2),
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are scored as texts without words. Repeated rows and null ids each keep
    their row (a null id is not held out); an empty table gives none; other columns are not looked
    at. Without labels of both kinds the score is the smoothed share of the labels there are, 0.5
    for none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def of(batch):
            x = np.array([features(t) for t in batch]).reshape(-1, len(FEATURES))
            return [pa.array(shared.value.scores(x), pa.float64())]

        return of

    scored = map_texts(docs, id_col, text_col, "score double", start)
    out = held_out(F.col(id_col), *fold) if fold else F.lit(False)
    return scored.select(
        id_col, out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
