"""Surrogate ids over the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.scalars import FNV_SQL, SALT
from tallyloom.functions.text import fnv1a
from tallyloom.operators.ids import assign_ids, resolve_collisions


def salted(expr: str) -> str:
    return FNV_SQL.format(f"'{SALT}#' || {expr}")


@query(
    "assign_ids",
    f"""
SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN 'C' || CAST(o_custkey AS VARCHAR) END AS source_id,
  CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'E' || CAST(o_custkey AS VARCHAR)
    ELSE CAST({salted("'C' || CAST(o_custkey AS VARCHAR)")} AS VARCHAR) END AS person_id,
  coalesce(o_custkey % 5 <> 0 AND o_custkey % 2 <> 0, false) AS is_new FROM orders
""",
)
def assign(t):
    """Even customers have an id already, the others get one; a null source id stays without."""
    name = lambda c: F.concat(F.lit("C"), F.col(c).cast("string"))
    existing = t.customer.where(F.col("c_custkey") % 2 == 0).select(
        F.concat(F.lit("E"), F.col("c_custkey").cast("string")).alias("person_id"),
        name("c_custkey").alias("source_id"),
    )
    rows = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 5 != 0, name("o_custkey")).alias("source_id"))
    known, pairs = assign_ids(rows, existing, SALT)
    return known.join(pairs.select("source_id", F.lit(True).alias("is_new")), "source_id", "left").fillna(
        {"is_new": False}
    )


@query(
    "resolve_collisions",
    f"""
WITH c AS (SELECT c_name AS source_id, CAST(({salted("c_name")}) & 1023 AS VARCHAR) AS id0,
  CAST({salted("c_name || '#1'")} AS VARCHAR) AS id1 FROM customer WHERE c_custkey % 10 <> 0),
e AS (SELECT CAST(c_custkey % 1024 AS VARCHAR) AS id FROM customer WHERE c_custkey % 10 = 0),
w AS (SELECT id0, min(source_id) AS source_id FROM c WHERE id0 NOT IN (SELECT id FROM e) GROUP BY id0)
SELECT c.source_id, CASE WHEN w.source_id IS NOT NULL THEN c.id0 ELSE c.id1 END AS person_id
FROM c LEFT JOIN w ON w.source_id = c.source_id
""",
)
def collisions(t):
    """First ids cut to 10 bits collide massively; the holder with the least source id keeps one."""
    new = t.customer.where(F.col("c_custkey") % 10 != 0).select(F.col("c_name").alias("source_id"))
    existing = t.customer.where(F.col("c_custkey") % 10 == 0).select(
        (F.col("c_custkey") % 1024).cast("string").alias("person_id"), F.col("c_name").alias("source_id")
    )
    short = fnv1a(F.col("source_id"), f"{SALT}#").bitwiseAND(F.lit(1023).cast("bigint")).cast("string")
    return resolve_collisions(new, existing, SALT, first=short)
