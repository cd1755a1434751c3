"""Grouped operators over the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.functions.dates import period_start
from tallyloom.operators import groups as g
from tallyloom.operators.lookups import dict_map
from tallyloom.operators.periods import periods_to_months, unpivot_months
from tallyloom.plans.panels import rule_counts


@query(
    "group_to_json",
    """
SELECT conv_id, 0 AS part,
  CAST(to_json(list({'turn': turn, 'role': nullif(role, 'assistant'), 'n_chars': length(text)} ORDER BY turn)) AS VARCHAR) AS json
FROM conversations GROUP BY conv_id
""",
)
def group_to_json(t):
    rows = t.conversations.select(
        "conv_id", "turn", F.nullif("role", F.lit("assistant")).alias("role"), F.length("text").alias("n_chars")
    )
    return g.group_to_json(rows, "conv_id", ["turn", "role", "n_chars"], "turn")


@query(
    "max_row_per_key",
    """
SELECT o_custkey, arg_max(o_orderkey, CAST(o_orderkey AS VARCHAR)) AS by_text, max(o_orderkey) AS by_number FROM orders GROUP BY o_custkey
""",
)
def max_row_per_key(t):
    """Text order and numeric order."""
    rows = t.orders.select("o_custkey", F.col("o_orderkey").cast("string").alias("id"))
    texts = g.max_row_per_key(rows, "o_custkey", "id").select("o_custkey", F.col("id").cast("bigint").alias("by_text"))
    numbers = g.max_row_per_key(rows, "o_custkey", "id", numeric=True)
    return texts.join(numbers.select("o_custkey", F.col("id").cast("bigint").alias("by_number")), "o_custkey")


@query(
    "dedupe_first",
    "SELECT lang, source, min(doc_id) AS doc_id, arg_min(text, doc_id) AS text FROM documents GROUP BY lang, source",
)
def dedupe_first(t):
    return g.dedupe_first(t.documents.select("lang", "source", "doc_id", "text"), ["lang", "source"], ["doc_id"])


@query(
    "visit_counts",
    """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
t AS (SELECT user_id, count(*) AS kinds, sum(n) AS total, max(n) AS most, arg_max(event_type, n) AS top FROM c GROUP BY user_id)
SELECT user_id, kinds, CASE WHEN most * 10 > total * 3 THEN 1 ELSE 0 END AS leads FROM t
""",
)
def visit_counts(t):
    """Counts per (person, kind), kinds per person, and whether one kind leads."""
    counts = g.count_by(t.events, "user_id", "event_type")
    share = counts.groupBy("user_id").agg((F.max("n") * 10 > F.sum("n") * 3).cast("int").alias("leads"))
    return g.groups_per_key(t.events, "user_id", "event_type", "kinds").join(share, "user_id")


@query(
    "majority",
    """
WITH c AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, arg_max(o_orderstatus, n) AS o_orderstatus FROM c GROUP BY o_custkey HAVING max(n) * 2 > sum(n)
""",
)
def majority(t):
    return g.majority(g.count_by(t.orders, "o_custkey", "o_orderstatus"), "o_custkey", "o_orderstatus", "n")


@query(
    "last_row_per_key",
    """
SELECT user_id, arg_max(event_type, ts) AS last_kind, arg_max(event_type, ts) FILTER (WHERE value > 50) AS last_large_kind
FROM events GROUP BY user_id
""",
)
def last_row_per_key(t):
    """Last value, and last value among rows passing a test, as mergeable aggregates."""
    return t.events.groupBy("user_id").agg(
        g.latest_by(F.col("event_type"), ["ts", "event_id"]).alias("last_kind"),
        g.latest_by(F.col("event_type"), ["ts", "event_id"], F.col("value") > 50).alias("last_large_kind"),
    )


@query(
    "last_k_all_any",
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, count(*) AS last_n, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS last_hits,
  bool_or(event_type IN ('view', 'click')) AS any_hit, bool_and(event_type IN ('view', 'click')) AS all_hit
FROM r WHERE rn <= 3 GROUP BY user_id
""",
)
def last_k_all_any(t):
    return g.last_k(
        t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], F.col("event_type").isin("view", "click")
    )


@query(
    "top_k_per_key",
    """
SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank FROM orders) WHERE rank <= 5
""",
)
def top_k_per_key(t):
    return g.top_rows(
        t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5, "rank",
    ).drop("o_orderdate")


@query(
    "conditional_counts",
    """
SELECT user_id, count(*) FILTER (WHERE event_type = 'view') AS views,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS late,
  count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-25' AND event_type = 'purchase') AS late_purchases
FROM events GROUP BY user_id
""",
)
def conditional_counts(t):
    at = lambda day: F.col("ts") >= F.lit(day).cast("timestamp_ntz")
    return t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(at("2024-01-15")).alias("late"),
        F.count_if(at("2024-01-25") & (F.col("event_type") == "purchase")).alias("late_purchases"),
    )


@query(
    "distinct_and_range",
    """
WITH d AS (SELECT DISTINCT event_type FROM events), r AS (SELECT min(year(o_orderdate)) AS low, max(year(o_orderdate)) AS high FROM orders)
SELECT event_type AS item, CAST(NULL AS BIGINT) AS low, CAST(NULL AS BIGINT) AS high FROM d UNION ALL SELECT 'years', low, high FROM r
""",
)
def distinct_and_range(t):
    kinds = t.events.select(F.col("event_type").alias("item")).distinct()
    years = g.value_range(t.orders.select(F.year("o_orderdate").cast("bigint").alias("y")), "y")
    return kinds.unionByName(years.withColumn("item", F.lit("years")), allowMissingColumns=True)


@query(
    "rule_counts",
    "SELECT o_orderpriority, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY o_orderpriority",
)
def counts_per_rule(t):
    return rule_counts(t.orders, "o_orderpriority")


@query(
    "unpivot_months",
    """
SELECT l_suppkey, CASE WHEN l_suppkey % 3 = 0 THEN 'Tests' WHEN l_suppkey % 3 = 1 THEN 'Days' END AS unit,
  strftime(l_shipdate, '%Y-%m') AS month, sum(l_quantity) AS volume
FROM lineitem GROUP BY ALL HAVING sum(l_quantity) > 0
""",
)
def unpivot(t):
    """Twelve month columns per supplier and year, back to one row per month."""
    shipped = t.lineitem.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    wide = (
        shipped.groupBy("l_suppkey", "year").pivot("month", list(range(1, 13))).agg(F.sum("l_quantity"))
        .withColumnsRenamed({str(n): f"m{n}" for n in range(1, 13)})
    )
    long = unpivot_months(wide, ["l_suppkey"], [f"m{n}" for n in range(1, 13)], "year")
    unit = dict_map((F.col("l_suppkey") % 3).cast("string"), {"0": "Tests", "1": "Days"})
    return long.withColumn("unit", unit)


PERIOD_SQL = """
p AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y') || '-' || lpad(CAST(o_orderkey % 29 AS VARCHAR), 2, '0') END AS period,
  CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_orderkey % 29 AS INTEGER) AS n FROM orders),
f AS (SELECT *, DATE '2022-12-17' + CAST(14 * ceil(date_diff('day', DATE '2023-01-06', make_date(y, 1, 1)) / 14.0) AS INTEGER) AS first FROM p),
s AS (SELECT *, first + 14 * (n - 1) AS st FROM f)
"""


def period_text():
    return F.when(
        F.col("o_orderkey") % 11 != 0,
        F.format_string("%04d-%02d", F.year("o_orderdate"), (F.col("o_orderkey") % 29).cast("int")),
    )


@query(
    "period_start",
    f"""WITH {PERIOD_SQL} SELECT o_orderkey, period,
  CASE WHEN period IS NOT NULL AND n >= 1 AND year(st + 13) <= y THEN strftime(st, '%Y-%m-%d') END AS start_date FROM s""",
)
def period_starts(t):
    """Start of the bi-weekly period; numbers 0 and 28 have none."""
    rows = t.orders.select("o_orderkey", period_text().alias("period"))
    return rows.withColumn("start_date", F.date_format(period_start(F.col("period")), "yyyy-MM-dd"))


@query(
    "period_to_month",
    """
WITH o AS (SELECT o_orderpriority AS dept, CAST(o_orderdate AS DATE) AS st, o_totalprice AS amt, o_totalprice / 1000 AS fte FROM orders),
f AS (SELECT *, least(14, day(last_day(st)) - day(st) + 1) AS n, st + 13 AS en FROM o),
x AS (SELECT dept, st AS d, n, amt, fte FROM f
  UNION ALL SELECT dept, en, 14 - n, amt, fte FROM f WHERE month(st) <> month(en)),
g AS (SELECT dept, date_trunc('month', d) AS m, sum(CAST(amt AS DECIMAL(24,8)) * CAST(n AS DECIMAL(2,0))) AS amt,
  sum(CAST(fte AS DECIMAL(24,8)) * CAST(n AS DECIMAL(2,0))) AS fte FROM x GROUP BY ALL)
SELECT dept, strftime(m, '%Y-%m') AS month, CAST(amt AS DOUBLE) / 14 AS amount, CAST(fte AS DOUBLE) / day(last_day(m)) AS fte FROM g
""",
)
def period_to_month(t):
    rows = t.orders.select(
        F.col("o_orderpriority").alias("dept"), F.col("o_orderdate").cast("date").alias("start_date"),
        F.col("o_totalprice").alias("amount"), (F.col("o_totalprice") / 1000).alias("fte"),
    )
    return periods_to_months(rows, ["dept"], ["amount"], "fte")
