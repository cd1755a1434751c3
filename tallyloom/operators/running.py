"""Running aggregates along a position.

A window over a key puts that key's rows into one task, so there is one way for every size:
positions are cut into chunks, chunk totals (combined before the shuffle) are scanned per key, and
the rows per (key, chunk) on top of their chunk's carry. A small key is one chunk; a large one is
spread over as many tasks as it has chunks. Keys may be null and are compared like other values.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = 100_000


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null to null; the key columns of the left side stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(other, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def running(
    df: DataFrame,
    keys: list[str],
    position: str | list[str],
    sums: Mapping[str, Column] = {},
    mins: Mapping[str, Column] = {},
    lasts: Mapping[str, Column] = {},
    chunk: int = CHUNK,
    inclusive: bool = True,
) -> DataFrame:
    """Add running sums, minima and last non-null values up to each row, after the input's columns.

    ``position`` is a numeric column, or several columns of which the last is numeric; ``chunk``
    positions of the last one make a chunk. Rows with equal positions must carry equal values, or
    be absent. ``inclusive=False`` leaves the row itself out. The input is read twice, once for the
    few columns the totals need; nothing runs before the result is asked for.
    """
    order = [position] if isinstance(position, str) else list(position)
    last = order[-1]
    cuts = [*order[:-1], "_chunk"]
    values = {**sums, **mins, **lasts}
    rows = (W.unboundedPreceding, 0 if inclusive else -1)
    work = df.withColumns({f"_v_{n}": c for n, c in values.items()}).withColumn("_chunk", F.floor(F.col(last) / chunk))
    totals = [F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    totals += [F.min(f"_v_{n}").alias(f"_t_{n}") for n in mins]
    totals += [
        F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(last))).alias(f"_t_{n}") for n in lasts
    ]
    before = W.partitionBy(*keys).orderBy(*cuts).rowsBetween(W.unboundedPreceding, -1)
    carry = work.groupBy(*keys, *cuts).agg(*totals).select(
        *keys,
        *cuts,
        *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in sums],
        *[F.min(f"_t_{n}").over(before).alias(f"_b_{n}") for n in mins],
        *[F.last(f"_t_{n}", ignorenulls=True).over(before).alias(f"_b_{n}") for n in lasts],
    )
    inside = W.partitionBy(*keys, *cuts).orderBy(last).rowsBetween(*rows)
    joined = match(work, carry, [*keys, *cuts], "left")
    out = {}
    for n in sums:
        here = F.sum(f"_v_{n}").over(inside)
        out[n] = F.coalesce(here, F.lit(0)) + F.coalesce(F.col(f"_b_{n}"), F.lit(0))
    for n in mins:
        out[n] = F.least(F.min(f"_v_{n}").over(inside), F.col(f"_b_{n}"))
    for n in lasts:
        out[n] = F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(inside), F.col(f"_b_{n}"))
    return joined.select(*df.columns, *[c.alias(n) for n, c in out.items()])
