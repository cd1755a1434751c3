"""Clusters around centroids, nearest centroids found by the threshold algorithm.

Per dimension the centroids stand in a list sorted by their value there. A vector starts in every
list at its own value and walks outward, one step in all lists at a time, towards whichever
side is closer. A centroid met for the first time gets its exact distance. One that no list has
met yet differs by at least the last step's gap in every dimension, so the walk ends when the sum of
squared gaps strictly exceeds the best exact distance; equal distances go to the smaller number.
All numbers are integers, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import small_batches
from tallyloom.session import cut_lineage

#: Vectors walked at once.
SLICE = 4096


def largest(size: int) -> int:
    """Components up to this keep squared distances of ``size`` dimensions within 62 bits."""
    return int((2**62 / size) ** 0.5 / 2)


class Lists:
    """The sorted list of each dimension over ``centroids`` (numbers by dimensions)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.value = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each vector, its squared distance, and how many exact
        distances were needed in all."""
        n, size = x.shape
        k = len(self.centroids)
        who, best = np.full(n, k), np.full(n, np.iinfo(np.int64).max)
        live = np.arange(n)
        dims = np.arange(size)[None, :]
        right = np.column_stack([np.searchsorted(self.value[:, d], x[:, d]) for d in range(size)])
        left, seen, asked = right - 1, np.zeros((n, k), bool), 0
        far = np.iinfo(np.int64).max
        while len(live):
            down = np.where(left >= 0, x - self.value[np.maximum(left, 0), dims], far)
            up = np.where(right < k, self.value[np.minimum(right, k - 1), dims] - x, far)
            go_down = down <= up
            at = np.where(go_down, left, right)
            met = np.zeros_like(seen)
            met[np.arange(len(live))[:, None], self.order[at, dims]] = True
            met &= ~seen
            seen |= met
            i, j = np.nonzero(met)
            distance = np.full(seen.shape, far)
            distance[i, j] = np.square(x[i] - self.centroids[j]).sum(axis=1)
            asked += len(i)
            number = distance.argmin(axis=1)  # of equals the smallest number
            found = distance[np.arange(len(live)), number]
            better = (found < best[live]) | ((found == best[live]) & (number < who[live]))
            who[live[better]], best[live[better]] = number[better], found[better]
            frontier = np.square(np.minimum(down, up)).sum(axis=1)
            go_on = (frontier <= best[live]) & ~seen.all(axis=1)
            live, x, seen, go_down = live[go_on], x[go_on], seen[go_on], go_down[go_on]
            left, right = left[go_on] - go_down, right[go_on] + ~go_down
        return who, best, asked


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """``(_id, _vec array<int>)`` of the vectors of ``size`` finite components, ``floor(scale * x)``."""
    doubles = F.transform(vectors[vec_col], lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: F.coalesce(x.between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
    kept = vectors.where((F.size(vectors[vec_col]) == size) & finite)
    whole = F.transform(
        doubles,
        lambda x: F.when(F.abs(x * scale) <= largest(size), F.floor(x * scale))
        .otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))
        .cast("int"),
    )
    return kept.select(kept[id_col].alias("_id"), whole.alias("_vec"))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of smallest hash of seed and id, in that order; null ids come last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")).cast("binary"), 256)
    return [list(r[0]) for r in kept.orderBy(order.asc_nulls_last(), "_vec").limit(k).select("_vec").collect()]


def _slices(batches, size: int):
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            yield part.column(0), _matrix(part.column(1), size)


def _moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Every centroid at the floored mean of its vectors; one without any stays.

    Tasks emit a sum per centroid and dimension, so what is shuffled and what reaches the driver is
    as large as the centroids, whatever the number of vectors.
    """
    k, size = len(centroids), len(centroids[0])

    def sums(batches):
        lists = Lists(np.array(centroids, np.int64))
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for _, x in _slices(batches, size):
            who, _, _ = lists.nearest(x)
            order = np.argsort(who, kind="stable")
            own = np.bincount(who, minlength=k)
            some = np.flatnonzero(own)
            total[some] += np.add.reduceat(x[order], (np.cumsum(own) - own)[some], axis=0)
            count += own
        number, dim = np.divmod(np.arange(k * size), size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(dim, pa.int32()), pa.array(total.ravel()), pa.array(np.repeat(count, size))],
            ["number", "dim", "total", "n"],
        )

    parts = kept.mapInArrow(sums, "number int, dim int, total long, n long").where("n > 0")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")]
    moved = [list(c) for c in centroids]
    for row in parts.groupBy("number", "dim").agg(*exact).collect():
        moved[row.number][row.dim] = int(row.total) // int(row.n)
    return moved


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    size: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """Per kept vector: the id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid``.

    Kept are vectors of exactly ``size`` components, none null, NaN or infinite, each made a whole
    number, ``floor(scale * x)``; other vectors give no row. The first centroids are the ``k`` kept
    vectors of smallest hash of ``seed`` and id (equal ids: smaller components first; null ids last);
    fewer vectors than ``k`` make fewer centroids. Repeated rows each count and keep their row. An
    empty table, or one without a kept vector, gives none. Other columns are not looked at. A whole
    number beyond ``largest(size)`` (2**27 for 64 components) raises, because its distances may not fit a long.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kept = cut_lineage(whole_vectors(vectors, id_col, vec_col, size, scale))
    id_type = kept.schema["_id"].dataType.simpleString()
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        moved = _moved(kept, centroids)
        if moved == centroids:  # a fixed point: further rounds change nothing
            break
        centroids = moved

    def assign(batches):
        lists = Lists(np.array(centroids, np.int64))
        for ids, x in _slices(batches, size):
            who, best, _ = lists.nearest(x)
            yield pa.RecordBatch.from_arrays([ids, pa.array(who, pa.int32()), pa.array(best)], ["_id", "cluster", "distance"])

    assigned = cut_lineage(kept.mapInArrow(assign, f"_id {id_type}, cluster int, distance long"))
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("_own"))
    # One row per cluster: at most k.
    totals = {r.cluster: int(r._own) for r in per_cluster.collect()}
    facts = spark.createDataFrame(
        [(number, own, sum(totals.values()), centroids[number]) for number, own in totals.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<int>",
    )
    joined = assigned.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_digest(centroid: list[int]) -> str:
    """Hex digest of the components as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
