"""Equi-joins, lookups and alias resolution.

Tables read from files are broadcast by Spark when their measured size allows; larger ones
are shuffled, and AQE splits the partitions of hot keys. Lookup tables handed in by the caller
have no size Spark knows, so ``if_small`` counts them before it asks for a broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.groups import dedupe_first


BROADCAST_ROWS = 100_000


def if_small(table: DataFrame, source: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``table``, made from ``source`` with no more rows, if the source has at most
    ``rows`` of them; else leave the join to shuffle."""
    few = source.limit(rows + 1).count() <= rows
    return F.broadcast(table) if few else table


def lookup(df: DataFrame, table: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join; rows without a match keep nulls."""
    return df.join(table, on, "left")


def onto_master(grouped: DataFrame, master: DataFrame, on: str | list[str]) -> DataFrame:
    """Right join; every master row stays."""
    return grouped.join(master, on, "right")


def known_only(df: DataFrame, table: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(table, on, "inner")


def attach(df: DataFrame, *tables: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join several tables one after the other on the same key."""
    for table in tables:
        df = df.join(table, on, "left")
    return df


def keep_keys_in(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def keep_keys_not_in(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def priority_union(sources: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """Union in which an earlier source wins a key; within a source ``order`` decides."""
    ranked = [s.withColumn("_source", F.lit(n)) for n, s in enumerate(sources)]
    both = ranked[0]
    for other in ranked[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    return dedupe_first(both, keys, ["_source", *order]).drop("_source")


def rate_replace(
    df: DataFrame,
    rates: DataFrame | None,
    code: str,
    rate_code: str,
    rate: str,
    measure: str,
    quantity: str,
    match_nulls: bool = False,
) -> DataFrame:
    """``measure`` becomes looked-up rate x quantity, null where the code is unknown.

    ``rates`` must hold one row per code. Without rates the input is returned as it is.
    ``match_nulls`` lets a null code match a null rate code.
    """
    if rates is None:
        return df
    table = rates.select(F.col(rate_code).alias("_code"), F.col(rate).alias("_rate"))
    same = F.col(code).eqNullSafe(F.col("_code")) if match_nulls else F.col(code) == F.col("_code")
    return df.join(table, same, "left").withColumn(
        measure, F.col("_rate") * F.col(quantity)
    ).drop("_code", "_rate")


def resolve_alias(
    df: DataFrame,
    column: str,
    aliases: DataFrame,
    canonical: DataFrame,
    on_miss: str,
    id_out: str = "dept_id",
    name_out: str = "dept_name",
) -> DataFrame:
    """Own name -> id -> canonical name.

    ``aliases(alias, id[, seq])``, ``canonical(id, name)``. Names match ignoring case but not
    surrounding blanks. A miss is ``keep`` (own name serves as id and name), ``drop``, or
    ``fail`` (kept with a null id, for ``require_resolved`` to report).
    """
    if on_miss not in ("keep", "drop", "fail"):
        raise ValueError(f"on_miss: {on_miss!r}")
    # Two spellings may fold to one: the last by ``seq`` wins, else the greatest id.
    wins = "seq" if "seq" in aliases.columns else "id"
    folded = aliases.groupBy(F.lower("alias").alias("_alias")).agg(F.max_by("id", wins).alias("_id"))
    names = canonical.groupBy(F.col("id").alias("_cid")).agg(F.max("name").alias("_name"))
    how = "inner" if on_miss == "drop" else "left"
    found = df.join(if_small(folded, aliases), F.lower(F.col(column)) == F.col("_alias"), how)
    own = F.col(column) if on_miss == "keep" else F.lit(None).cast("string")
    found = found.withColumn(id_out, F.coalesce("_id", own))
    found = found.join(if_small(names, canonical), F.col(id_out) == F.col("_cid"), "left")
    fallback = F.col(id_out) if on_miss == "keep" else F.lit(None).cast("string")
    return found.withColumn(name_out, F.coalesce("_name", fallback)).drop(
        "_alias", "_id", "_cid", "_name"
    )


def dict_map(value: Column, table: Mapping[str, str]) -> Column:
    """Small caller-supplied dictionary as an expression; a miss is null."""
    if not table:
        return F.lit(None).cast(T.StringType())
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def update_where_missing(
    df: DataFrame, updates: DataFrame, on: str | list[str], columns: list[str]
) -> DataFrame:
    """Fill only the cells that are still null. ``updates`` holds one row per key."""
    keys = [on] if isinstance(on, str) else list(on)
    fresh = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return df.join(fresh, on, "left").withColumns(
        {c: F.coalesce(c, f"_new_{c}") for c in columns}
    ).drop(*[f"_new_{c}" for c in columns])
