"""Lookups and joins over the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.operators import lookups as j
from tallyloom.operators.checks import unresolved_report

PRIORITIES = {"1-URGENT": "now", "2-HIGH": "soon", "3-MEDIUM": "later", "5-LOW": "someday"}


def id_map(t):
    """Even customers have an id."""
    return t.customer.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("source_id"),
        F.concat(F.lit("ID"), F.col("c_custkey").cast("string")).alias("person_id"),
    )


ID_MAP_SQL = "ids AS (SELECT c_custkey AS source_id, 'ID' || CAST(c_custkey AS VARCHAR) AS person_id FROM customer WHERE c_custkey % 2 = 0)"


def order_keys(t):
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("source_id"))


@query(
    "left_lookup",
    f"WITH {ID_MAP_SQL} SELECT o_orderkey, o_custkey AS source_id, person_id FROM orders LEFT JOIN ids ON o_custkey = source_id",
)
def left_lookup(t):
    return j.lookup(order_keys(t), id_map(t), "source_id")


@query(
    "inner_known",
    f"WITH {ID_MAP_SQL} SELECT o_orderkey, o_custkey AS source_id, person_id FROM orders JOIN ids ON o_custkey = source_id",
)
def inner_known(t):
    return j.known_only(order_keys(t), id_map(t), "source_id")


@query(
    "right_master",
    """
WITH g AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 450000 GROUP BY o_custkey)
SELECT c_custkey AS source_id, n, c_mktsegment FROM g RIGHT JOIN customer ON o_custkey = c_custkey
""",
)
def right_master(t):
    grouped = (
        t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 450000))
        .groupBy(F.col("o_custkey").alias("source_id")).agg(F.count("*").alias("n"))
    )
    master = t.customer.select(F.col("c_custkey").alias("source_id"), "c_mktsegment")
    return j.onto_master(grouped, master, "source_id")


@query(
    "attach_two",
    """
WITH a AS (SELECT o_custkey AS k, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
b AS (SELECT o_custkey AS k, CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) AS finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey AS k, c_name, urgent, finished FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey
""",
)
def attach_two(t):
    orders = t.orders.withColumnRenamed("o_custkey", "k")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy("k").agg(F.count("*").alias("urgent"))
    finished = orders.where(F.col("o_orderstatus") == "F").groupBy("k").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double").alias("finished")
    )
    return j.attach(t.customer.select(F.col("c_custkey").alias("k"), "c_name"), urgent, finished, on="k")


@query(
    "multi_lookup",
    """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3
""",
)
def multi_lookup(t):
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = t.region.where(F.col("r_regionkey") < 3).withColumnRenamed("r_regionkey", "n_regionkey")
    rows = j.lookup(j.lookup(t.customer, nations, "c_nationkey"), regions, "n_regionkey")
    return rows.select("c_custkey", "n_name", "r_name")


def fees(t):
    """Two fee sources that overlap; the first wins."""
    code = F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("hcpcs")
    main = t.part.where(F.col("p_size") <= 30).select(code, F.col("p_retailprice").alias("rate"))
    supplement = t.part.where(F.col("p_size").between(25, 40)).select(code, F.col("p_size").cast("double").alias("rate"))
    return j.priority_union([main, supplement], ["hcpcs"], ["rate"])


@query(
    "priority_union",
    """
SELECT 'C' || CAST(p_partkey AS VARCHAR) AS hcpcs, CASE WHEN p_size <= 30 THEN p_retailprice ELSE CAST(p_size AS DOUBLE) END AS rate
FROM part WHERE p_size <= 40
""",
)
def priority_union(t):
    return fees(t)


@query(
    "rate_replace",
    """
WITH fees AS (SELECT 'C' || CAST(p_partkey AS VARCHAR) AS hcpcs,
  CASE WHEN p_size <= 30 THEN p_retailprice ELSE CAST(p_size AS DOUBLE) END AS rate FROM part WHERE p_size <= 40),
l AS (SELECT *, CASE WHEN l_suppkey % 9 <> 0 THEN 'C' || CAST(l_partkey AS VARCHAR) END AS code FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, code, rate * l_quantity AS trvu FROM l LEFT JOIN fees ON code = hcpcs
""",
)
def rate_replace(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(F.col("l_suppkey") % 9 != 0, F.concat(F.lit("C"), F.col("l_partkey").cast("string"))).alias("code"),
        F.col("l_extendedprice").alias("trvu"), "l_quantity",
    )
    return j.rate_replace(lines, fees(t), "code", "hcpcs", "rate", "trvu", "l_quantity").drop("l_quantity")


@query(
    "semi_anti",
    """
SELECT c_custkey, 'with' AS side FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)
UNION ALL
SELECT c_custkey, 'without' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)
""",
)
def semi_anti(t):
    large = t.orders.where(F.col("o_totalprice") > 480000).select(F.col("o_custkey").alias("c_custkey"))
    people = t.customer.select("c_custkey")
    return j.keep_keys_in(people, large, "c_custkey").withColumn("side", F.lit("with")).unionByName(
        j.keep_keys_not_in(people, large, "c_custkey").withColumn("side", F.lit("without"))
    )


def alias_tables(t):
    """Mixed case, a trailing blank that must not match, and an id without a canonical name."""
    aliases = t.spark.createDataFrame(
        [("Building", "D1"), ("MACHINERY", "D2"), ("furniture ", "D3"), ("Household", "D4")],
        "alias string, id string",
    )
    return aliases, t.spark.createDataFrame([("D1", "Buildings"), ("D2", "Machines")], "id string, name string")


ALIAS_SQL = """
WITH a AS (SELECT c_custkey, c_mktsegment,
  CASE lower(c_mktsegment) WHEN 'building' THEN 'D1' WHEN 'machinery' THEN 'D2' WHEN 'furniture ' THEN 'D3' WHEN 'household' THEN 'D4' END AS found
  FROM customer),
n AS (SELECT *, CASE found WHEN 'D1' THEN 'Buildings' WHEN 'D2' THEN 'Machines' END AS nm FROM a)
"""


@query(
    "alias_keep",
    ALIAS_SQL + "SELECT c_custkey, c_mktsegment, coalesce(found, c_mktsegment) AS dept_id, coalesce(nm, found, c_mktsegment) AS dept_name FROM n",
)
def alias_keep(t):
    return j.resolve_alias(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", *alias_tables(t), "keep")


@query(
    "alias_drop",
    ALIAS_SQL + "SELECT c_custkey, c_mktsegment, found AS dept_id, nm AS dept_name FROM n WHERE found IS NOT NULL",
)
def alias_drop(t):
    return j.resolve_alias(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment", *alias_tables(t), "drop")


@query(
    "unresolved_report",
    ALIAS_SQL + "SELECT c_mktsegment, count(*) AS rows FROM n WHERE found IS NULL AND c_mktsegment <> 'AUTOMOBILE' GROUP BY c_mktsegment",
)
def unresolved(t):
    rows = j.resolve_alias(t.customer, "c_mktsegment", *alias_tables(t), "fail")
    return unresolved_report(rows, "dept_id", "c_mktsegment", ignore=["AUTOMOBILE"])


@query(
    "dict_map",
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' WHEN '3-MEDIUM' THEN 'later'
  WHEN '5-LOW' THEN 'someday' END AS label FROM orders
""",
)
def dict_map(t):
    return t.orders.select("o_orderkey", j.dict_map(F.col("o_orderpriority"), PRIORITIES).alias("label"))


@query(
    "update_where_missing",
    """
SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END, CASE WHEN s_suppkey % 2 = 0 THEN 'NEW-' || CAST(s_suppkey AS VARCHAR) END) AS s_name
FROM supplier
""",
)
def update_where_missing(t):
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("s_name"))
    updates = t.supplier.where(F.col("s_suppkey") % 2 == 0).select(
        "s_suppkey", F.concat(F.lit("NEW-"), F.col("s_suppkey").cast("string")).alias("s_name")
    )
    return j.update_where_missing(rows, updates, "s_suppkey", ["s_name"])
