"""Filters, sentinel cleaning and column shaping over the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.contracts import ordered
from tallyloom.operators import cleaning as c


def marked():
    """Event type with sentinel texts in the place of three of its values."""
    kind = F.col("event_type")
    return (
        F.when(kind == "error", "*Unspecified")
        .when(kind == "view", "")
        .when(kind == "click", "x*Unspecified")
        .otherwise(kind)
    )


@query(
    "visits_filtered_null_safe",
    """
WITH v AS (SELECT event_id, nullif(event_type, 'view') AS kind,
  CASE WHEN user_id % 2 = 0 THEN 'Completed' ELSE 'Cancelled' END AS status,
  nullif('D' || CAST(user_id % 5 AS VARCHAR), 'D4') AS dept FROM events)
SELECT event_id, kind, dept FROM v
WHERE (kind IS NULL OR kind NOT IN ('error', 'click')) AND status = 'Completed' AND dept IN ('D0', 'D1', 'D4')
""",
)
def visits_filtered(t):
    """A null type passes NOT IN; a null department does not pass IN."""
    rows = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("kind"),
        F.when(F.col("user_id") % 2 == 0, "Completed").otherwise("Cancelled").alias("status"),
        F.nullif(F.concat(F.lit("D"), (F.col("user_id") % 5).cast("string")), F.lit("D4")).alias("dept"),
    )
    kept = c.filter_all(
        rows,
        not_in={"kind": ["error", "click"]},
        equals={"status": "Completed"},
        is_in={"dept": ["D0", "D1", "D4"]},
    )
    return kept.select("event_id", "kind", "dept")


@query(
    "sentinel_clean",
    """
SELECT event_id,
  CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN NULL WHEN 'click' THEN 'x*Unspecified' ELSE event_type END AS kind
FROM events
""",
)
def sentinel_clean(t):
    rows = t.events.select("event_id", marked().alias("kind"))
    return c.sentinel_to_null(rows, ["kind", "absent"], ["*Unspecified", ""])


@query(
    "sentinel_int_clean",
    """
SELECT p_partkey, CASE WHEN p_size - 10 >= 0 THEN p_size - 10 END AS not_negative,
  nullif(p_size - 10, -1) AS not_minus_one FROM part
""",
)
def sentinel_int_clean(t):
    key = F.col("p_size") - 10
    return t.part.select(
        "p_partkey",
        c.negative_to_null(key).alias("not_negative"),
        c.minus_one_to_null(key).alias("not_minus_one"),
    )


@query(
    "split_halves",
    """
SELECT CASE WHEN coalesce(nullif(event_type, 'view') IN ('error', 'click'), false) THEN 'yes' ELSE 'no' END AS half,
  count(*) AS n, sum(event_id) AS ids FROM events GROUP BY 1
""",
)
def split_halves(t):
    """Two halves that add up to the whole, null rows in the second."""
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("kind"))
    yes, no = c.split_by(rows, F.col("kind").isin("error", "click"))
    both = c.with_constant(yes, "half", "yes").unionByName(c.with_constant(no, "half", "no"))
    return both.groupBy("half").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    "sensitive_split",
    """
SELECT c_custkey, c_nationkey, c_mktsegment, c_name AS full_name, CAST(c_acctbal AS VARCHAR) IS NOT NULL AS has_balance,
  c_acctbal FROM customer
""",
)
def sensitive_split(t):
    """Vertical split into two frames and back through their key."""
    rest, secret = c.split_columns(t.customer, "c_custkey", ["c_name", "c_acctbal"], ["c_nationkey"])
    layout = ordered("c_custkey bigint, full_name string, c_acctbal double, has_balance boolean")
    typed = c.conform(
        secret.withColumn("has_balance", F.col("c_acctbal").isNotNull()), layout, {"full_name": "c_name"}
    )
    return rest.join(typed, "c_custkey")


@query(
    "fill_and_drop",
    """
SELECT event_id, event_type AS kind, coalesce(CASE WHEN user_id % 7 <> 0 THEN value END, 0) AS amount, 'web' AS channel
FROM events WHERE event_type NOT IN ('view') AND event_type = 'click' AND (user_id % 3) <> 0
""",
)
def fill_and_drop(t):
    """Null keys and zero measures dropped, null amounts filled, one status kept."""
    rows = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("kind"),
        F.when(F.col("user_id") % 7 != 0, F.col("value")).alias("amount"),
        (F.col("user_id") % 3).alias("hours"),
    )
    kept = c.drop_zero(c.drop_null_keys(rows, ["kind"]), "hours")
    filled = c.fill_defaults(c.filter_equals(kept, "kind", "click"), {"amount": 0.0})
    return c.with_constant(filled, "channel", "web").drop("hours")


@query(
    "replace_everywhere",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders
""",
)
def replace_everywhere(t):
    return c.replace_everywhere(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), "P", "")


@query(
    "ensure_columns",
    "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS DOUBLE) AS weight FROM part",
)
def ensure_columns(t):
    layout = ordered("p_partkey bigint, p_name string, unit string, weight double")
    return c.conform(c.ensure_columns(t.part, layout), layout)


@query(
    "ratio_safe",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_discount = 0 THEN 0 ELSE l_tax / l_discount END AS tax_per_discount,
  l_tax + l_discount AS both_rates, l_extendedprice * l_quantity AS scaled FROM lineitem
""",
)
def ratio_safe(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.ratio(F.col("l_tax"), F.col("l_discount")).alias("tax_per_discount"),
        (F.col("l_tax") + F.col("l_discount")).alias("both_rates"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("scaled"),
    )
    return c.fill_defaults(rows, {"tax_per_discount": 0.0})
