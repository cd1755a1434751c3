"""Panels over lineitem and orders: person = customer, visit = shipped line."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.operators.cleaning import is_true
from tallyloom.operators.lookups import dict_map
from tallyloom.plans.panels import location_panel, provider_panel, rule_counts

AS_OF = "2001-08-01 00:00:00"
PROVIDERS = {"P0": "North", "P1": "East", "P2": "South"}


def visits(t):
    """Lines shipped before the reference date, seen as visits."""
    slot = F.col("l_suppkey") % 10
    lines = t.lineitem.where(F.col("l_shipdate") < F.lit(AS_OF).cast("timestamp_ntz"))
    return lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("person_id"),
        F.col("l_shipdate").alias("visit_at"),
        F.unix_date(F.col("l_shipdate").cast("date")).alias("visit_order"),
        F.when(slot < 5, F.concat(F.lit("P"), F.least(slot, F.lit(2)).cast("string"))).alias("provider"),
        is_true(slot < 6).alias("is_peds"),
        is_true(F.col("l_quantity") >= 48).alias("is_well"),
    )


VISITS_SQL = """
visits AS (
  SELECT o_custkey AS person_id, l_shipdate AS visit_at,
    CASE WHEN l_suppkey % 10 < 5 THEN 'P' || CAST(least(l_suppkey % 10, 2) AS VARCHAR) END AS provider,
    l_suppkey % 10 < 6 AS is_peds, l_quantity >= 48 AS is_well
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_shipdate < TIMESTAMP '2001-08-01')
"""

PROVIDER_SQL = f"""
WITH {VISITS_SQL},
recent AS (SELECT * FROM visits
  WHERE visit_at >= TIMESTAMP '1999-08-01' AND provider IN ('P0', 'P1', 'P2')),
seen AS (SELECT person_id, provider, count(*) AS n FROM recent GROUP BY ALL),
totals AS (SELECT person_id, count(*) AS providers, sum(n) AS total, max(n) AS most,
  arg_max(provider, n) AS top_provider FROM seen GROUP BY person_id),
ranked AS (SELECT person_id, provider, is_well,
  row_number() OVER (PARTITION BY person_id ORDER BY visit_at DESC, provider DESC) AS r,
  row_number() OVER (PARTITION BY person_id, is_well ORDER BY visit_at DESC, provider DESC) AS rw
  FROM recent),
lasts AS (SELECT person_id,
  max(CASE WHEN r = 1 THEN provider END) AS last_provider,
  max(CASE WHEN is_well AND rw = 1 THEN provider END) AS well_provider
  FROM ranked GROUP BY person_id),
panel AS (SELECT person_id,
  CASE WHEN providers = 1 OR most * 2 > total THEN top_provider
       WHEN well_provider IS NOT NULL THEN well_provider ELSE last_provider END AS provider,
  CASE WHEN providers = 1 THEN 1 WHEN most * 2 > total THEN 2
       WHEN well_provider IS NOT NULL THEN 3 ELSE 4 END AS cut
  FROM totals JOIN lasts USING (person_id))
"""


@query(
    "provider_panel",
    PROVIDER_SQL
    + """SELECT person_id, provider, cut,
    CASE provider WHEN 'P0' THEN 'North' WHEN 'P1' THEN 'East' ELSE 'South' END AS site FROM panel""",
)
def provider_panel_query(t):
    """Four cuts over two years of visits, then the provider's site."""
    panel = provider_panel(visits(t), AS_OF, list(PROVIDERS))
    return panel.withColumn("site", dict_map(F.col("provider"), PROVIDERS))


@query(
    "provider_panel_rule_counts",
    PROVIDER_SQL + "SELECT cut, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM panel GROUP BY cut",
)
def provider_panel_counts(t):
    return rule_counts(provider_panel(visits(t), AS_OF, list(PROVIDERS)), "cut")


LOCATION_SQL = f"""
WITH {VISITS_SQL},
recent AS (SELECT *, row_number() OVER (PARTITION BY person_id
    ORDER BY visit_at DESC, is_peds DESC) AS r,
    row_number() OVER (PARTITION BY person_id, is_well ORDER BY visit_at DESC, is_peds DESC) AS rw
  FROM visits WHERE visit_at >= TIMESTAMP '1999-08-01'),
facts AS (SELECT person_id,
  count(*) FILTER (WHERE is_peds) AS peds,
  count(*) FILTER (WHERE is_well) AS well,
  bool_or(is_peds) FILTER (WHERE is_well AND rw = 1) AS last_well_peds,
  count(*) FILTER (WHERE visit_at >= TIMESTAMP '2000-08-01') AS yr,
  count(*) FILTER (WHERE visit_at >= TIMESTAMP '2000-08-01' AND is_peds) AS yr_peds,
  count(*) FILTER (WHERE visit_at >= TIMESTAMP '2000-05-01' AND is_peds) AS peds15,
  bool_or(is_peds) FILTER (WHERE r <= 3) AS any3,
  bool_and(is_peds) FILTER (WHERE r <= 3) AS all3
  FROM recent GROUP BY person_id),
rules AS (SELECT person_id, peds15,
  CASE WHEN peds >= 3 AND all3 THEN 1
       WHEN last_well_peds AND any3 THEN 2
       WHEN well = 0 AND yr >= 3 AND yr_peds * 2 > yr AND any3 THEN 3 END AS rule
  FROM facts),
panel AS (SELECT c_custkey AS person_id, c_custkey % 6 AS age, rule,
  coalesce(c_custkey % 6 < 3 AND peds15 = 0, false) AS excluded
  FROM customer LEFT JOIN rules ON person_id = c_custkey)
SELECT person_id, age, rule, excluded, rule IS NOT NULL AND NOT excluded AS assigned FROM panel
"""


@query("location_panel", LOCATION_SQL)
def location_panel_query(t):
    """Ordered location rules with the exclusion of small children."""
    persons = t.customer.select(F.col("c_custkey").alias("person_id"), (F.col("c_custkey") % 6).alias("age"))
    return location_panel(persons, visits(t), AS_OF)


@query(
    "location_panel_rule_counts",
    f"SELECT rule, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM ({LOCATION_SQL}) WHERE assigned GROUP BY rule",
)
def location_panel_counts(t):
    persons = t.customer.select(F.col("c_custkey").alias("person_id"), (F.col("c_custkey") % 6).alias("age"))
    return rule_counts(location_panel(persons, visits(t), AS_OF).where("assigned"), "rule")
