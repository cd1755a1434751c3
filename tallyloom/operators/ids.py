"""Surrogate id assignment."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import hash_id
from tallyloom.session import cut_lineage

#: Values of the 32-bit hash.
ID_SPACE = 2**32


def attempt_id(source_id: Column, salt: str, attempt: int) -> Column:
    """Candidate id of the n-th attempt; depends on the source id and the attempt only."""
    if attempt == 0:
        return hash_id(source_id, salt)
    return hash_id(F.concat(source_id.cast("string"), F.lit(f"#{attempt}")), salt)


def collision_losers(candidates: DataFrame, taken: DataFrame, source: str, ident: str) -> DataFrame:
    """Candidates whose id is taken already, or held by a smaller source id too.

    Holders are found with a combined-before-shuffle minimum and the losers with joins on the
    unique source id and on the id, so even an id shared by many rows stays spread out.
    """
    free = candidates.join(taken.select(ident), ident, "left_anti")
    winners = free.groupBy(ident).agg(F.min(source).alias(source))
    return candidates.join(winners.select(source), source, "left_anti")


def resolve_collisions(
    new: DataFrame,
    existing: DataFrame,
    salt: str,
    source: str = "source_id",
    ident: str = "person_id",
    first: Column | None = None,
) -> DataFrame:
    """``(ident, source)`` with ids unique within the new ones and against ``existing``.

    Every loser is hashed again with the attempt number until none is left: losers get fewer every
    round, as each id that is held has one holder. Each round is kept as a table. More ids than the
    hash has values are refused before the first round. ``first`` replaces the first-attempt id (tests force collisions with it).
    """
    start = attempt_id(F.col(source), salt, 0) if first is None else first
    pending = cut_lineage(new.select(start.alias(ident), source))
    taken = existing.select(ident)
    if pending.count() + taken.count() > ID_SPACE:
        raise ValueError("more ids than the hash has values")
    settled = None
    for attempt in count(1):
        losers = cut_lineage(collision_losers(pending, taken, source, ident))
        kept = pending.join(losers.select(source), source, "left_anti").select(ident, source)
        settled = kept if settled is None else settled.unionByName(kept)
        if losers.isEmpty():
            return settled
        taken = taken.unionByName(kept.select(ident))
        pending = cut_lineage(
            losers.select(attempt_id(F.col(source), salt, attempt).alias(ident), source)
        )


def assign_ids(
    df: DataFrame,
    existing: DataFrame,
    salt: str,
    source: str = "source_id",
    ident: str = "person_id",
) -> tuple[DataFrame, DataFrame]:
    """Join ids onto ``df``: known ones reused, new ones made. Returns (rows, new pairs).

    Rows with a null source id are kept with a null id.
    """
    known = existing.select(ident, source)
    fresh = (
        df.select(source).where(F.col(source).isNotNull()).distinct().join(known, source, "left_anti")
    )
    pairs = resolve_collisions(fresh, known, salt, source, ident)
    return df.join(known.unionByName(pairs), source, "left"), pairs
