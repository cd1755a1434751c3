"""Readers, writers, file choice and input checks over the driver's tables."""

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.contracts import contract, ordered
from tallyloom.operators.checks import content_check, input_report
from tallyloom.operators.cleaning import conform
from tallyloom.operators.groups import dedupe_first, sample_first
from tallyloom.session import scratch_path
from tallyloom.sources import csv, files, tables


#: Text of a written file that one task has to write.
FILE_BYTES = 32 << 20


def write_csv(df, t, label, *by):
    """CSV below the shared folder, quotes doubled as spreadsheets write them."""
    path = scratch_path(t.spark, label)
    writer = df.write.option("header", True).option("escape", '"')
    (writer.partitionBy(*by) if by else writer).csv(path)
    return path


@query(
    "csv_positional",
    """
SELECT c_custkey AS id, c_name || ', "' || c_mktsegment || '"' AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS nation, c_acctbal AS balance FROM customer
""",
)
def csv_positional(t):
    """The written header says something else; an extra trailing field is dropped."""
    rows = t.customer.select(
        F.col("c_custkey").alias("k1"),
        F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')).alias("k2"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey").cast("string")).otherwise("N/A").alias("k3"),
        F.col("c_acctbal").alias("k4"), F.lit("extra").alias("k5"),
    )
    layout = ordered("id bigint, name string, nation int, balance double")
    return csv.read_positional(t.spark, write_csv(rows, t, "positional"), layout)


@query(
    "csv_named",
    "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS day_key, o_totalprice AS amount, o_orderkey % 2 = 0 AS flag FROM orders",
)
def csv_named(t):
    """Columns found by header, in whatever order, renamed and typed."""
    rows = t.orders.select(
        F.col("o_orderpriority").alias("Unused"), F.col("o_totalprice").alias("Amount"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("Day"),
        F.when(F.col("o_orderkey") % 2 == 0, "True").otherwise("False").alias("Flag"), F.col("o_orderkey").alias("Key"),
    )
    layout = ordered("Key bigint, Day string, Amount double, Flag boolean")
    names = {"Key": "id", "Day": "day_key", "Amount": "amount", "Flag": "flag"}
    return csv.read_named(t.spark, write_csv(rows, t, "named"), layout, names)


@query(
    "csv_quoted_text",
    "SELECT doc_id, nullif(text, '') AS text, lang FROM documents",
)
def csv_quoted_text(t):
    """Texts with line breaks, quotes and commas come back whole."""
    path = scratch_path(t.spark, "quoted")
    rows = t.documents.select("doc_id", "text", "lang")
    whole = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**whole).csv(path)
    return csv.read_positional(t.spark, path, ordered("doc_id bigint, text string, lang string"), multiline=True)


def write_preamble_files(t):
    """Five hundred parts per file below three lines of preamble and a header."""
    number = F.floor(F.col("p_partkey") / 500).alias("file_no")
    body = t.part.select(
        number, F.col("p_partkey").alias("line_no"),
        F.concat_ws(",", F.col("p_partkey").cast("string"), F.lit('"a, b"'), F.col("p_name"), F.col("p_retailprice").cast("string")).alias("value"),
    )
    head = body.select("file_no").distinct().select(
        "file_no", F.posexplode(F.array(*[F.lit(x) for x in ["Fee table", "", "as of today, draft", "CODE,MOD,NAME,RATE"]]))
    ).select("file_no", (F.col("pos") - 10).cast("bigint").alias("line_no"), F.col("col").alias("value"))
    path = scratch_path(t.spark, "preamble")
    (
        body.unionByName(head).repartition("file_no").sortWithinPartitions("file_no", "line_no")
        .select("file_no", "value").write.partitionBy("file_no").text(path)
    )
    return path


@query("csv_preamble", "SELECT CAST(p_partkey AS VARCHAR) AS code, p_retailprice AS rate FROM part")
def csv_preamble(t):
    layout = ordered("code string, rate double")
    return csv.read_preamble(t.spark, write_preamble_files(t), 3, 4, {0: "code", 3: "rate"}, layout)


@query(
    "csv_preamble_quoted",
    """
SELECT doc_id, nullif(text, '') AS text, lang FROM documents WHERE doc_id IS NOT NULL
""",
)
def csv_preamble_quoted(t):
    """Texts with line breaks below a preamble that holds a quote of its own."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    body = t.documents.where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias("line_no"),
        F.concat_ws(",", F.col("doc_id").cast("string"), quoted("lang"), F.lit("unused"), quoted("text")).alias("value"),
    )
    # A preamble stands in front of a whole file, which one task writes; so there are more files of more text.
    size = body.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    count = max(4, -(-size // FILE_BYTES))
    # Dealt out row by row, whatever the ids are.
    body = body.withColumn("file_no", (F.monotonically_increasing_id() % count).cast("int"))
    head = t.spark.range(count).select(
        F.col("id").cast("int").alias("file_no"), F.posexplode(F.array(*[F.lit(x) for x in ['a 5" pipe', "", "ID,LANG,X,TEXT"]]))
    ).select("file_no", (F.col("pos") - 10).cast("bigint").alias("line_no"), F.col("col").alias("value"))
    path = scratch_path(t.spark, "preamble-quoted")
    placed = body.unionByName(head).repartitionById(count, "file_no").sortWithinPartitions("file_no", "line_no")
    placed.select("file_no", "value").write.partitionBy("file_no").text(path)
    layout = ordered("doc_id bigint, lang string, text string")
    return csv.read_preamble(t.spark, path, 2, 4, {0: "doc_id", 1: "lang", 3: "text"}, layout, multiline=True)


@query(
    "csv_mixed_headers",
    """
SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS note FROM orders
""",
)
def csv_mixed_headers(t):
    """Files whose columns stand in another order, one with a column more, read by their own headers."""
    root = scratch_path(t.spark, "mixed")
    key, amount = F.col("o_orderkey").alias("Key"), F.col("o_totalprice").alias("Amount")
    note = F.col("o_orderstatus").alias("Note")
    for rest, columns in enumerate([(key, amount, note), (note, key, amount), (F.lit("x, y").alias("More"), amount, note, key)]):
        part = t.orders.where(F.col("o_orderkey") % 3 == rest).select(*columns)
        part.write.options(header=True, escape='"').csv(f"{root}/part={rest}")
    layout = ordered("Key bigint, Amount double, Note string")
    return csv.read_by_header(t.spark, root, layout, {"Key": "id", "Amount": "amount", "Note": "note"})


@query(
    "csv_file_order",
    "SELECT event_id // 2000 AS file_no, user_id, min(event_id) AS event_id FROM events GROUP BY ALL",
)
def csv_file_order(t):
    """First row per person as the files list them."""
    rows = t.events.select(F.floor(F.col("event_id") / 2000).alias("file_no"), "event_id", "user_id")
    placed = rows.repartition("file_no").sortWithinPartitions("file_no", "event_id")
    path = write_csv(placed, t, "ordered", "file_no")
    layout = ordered("event_id bigint, user_id bigint")
    raw = csv.read_named(t.spark, path, layout, keep_order=True)
    numbered = raw.withColumn("file_no", F.regexp_extract("_file", r"file_no=(\d+)", 1).cast("bigint"))
    return dedupe_first(numbered, ["file_no", "user_id"], csv.FILE_ORDER).select("file_no", "user_id", "event_id")


@query("discover_files", "SELECT DISTINCT p_partkey // 500 AS file_no FROM part")
def discover(t):
    """Every data file below a folder."""
    found = files.discover_files(t.spark, write_preamble_files(t))
    return found.select(F.regexp_extract("path", r"file_no=(\d+)/", 1).cast("bigint").alias("file_no"))


def file_list(t):
    """One file name per order: month in brackets, year before a word, some temporary."""
    name = F.concat(
        F.when(F.col("o_orderkey") % 20 == 0, "~").otherwise(""),
        F.date_format("o_orderdate", "'('MM') 'yyyy' Dashboard '"), F.col("o_orderkey").cast("string"), F.lit(".xlsx"),
    )
    return t.orders.select(
        F.concat(F.lit("/in/"), (F.col("o_custkey") % 10).cast("string"), F.lit("/"), name).alias("path"),
        F.col("o_orderdate").alias("modified"),
    )


FILES_SQL = """
f AS (SELECT '/in/' || CAST(o_custkey % 10 AS VARCHAR) || '/' || CASE WHEN o_orderkey % 20 = 0 THEN '~' ELSE '' END ||
  strftime(o_orderdate, '(%m) %Y') || ' Dashboard ' || CAST(o_orderkey AS VARCHAR) || '.xlsx' AS path, o_orderdate AS modified,
  month(o_orderdate) AS m, year(o_orderdate) AS y, o_orderkey FROM orders),
v AS (SELECT * FROM f WHERE o_orderkey % 20 <> 0)
"""


@query(
    "latest_files",
    f"""WITH {FILES_SQL},
a AS (SELECT path, 'last two' AS choice FROM v ORDER BY path DESC LIMIT 2),
b AS (SELECT arg_max(path, (modified, path)) AS path, 'newest' AS choice FROM v WHERE m = 6),
c AS (SELECT path, 'per year' AS choice FROM (SELECT path, row_number() OVER (PARTITION BY y ORDER BY m DESC, path) AS rn FROM v WHERE y >= 1997) WHERE rn = 1)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""",
)
def latest_files(t):
    """The last two by path, the newest of a pattern, the latest month of every year."""
    seen = files.visible_files(file_list(t))
    picks = {
        "last two": files.last_n_files(seen, 2),
        "newest": files.latest_file(seen, r"^\(06\)"),
        "per year": files.latest_per_group(seen, r"(\d{4}) Dashboard", r"\((\d+)\)", 1997),
    }
    parts = [df.select("path", F.lit(name).alias("choice")) for name, df in picks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "file_attributes",
    f"WITH {FILES_SQL} SELECT path, strftime(modified, '%m') AS month, CAST(y AS VARCHAR) AS year FROM f",
)
def file_attributes(t):
    rows = files.with_file_attrs(file_list(t), "path", r"\((\d+)\) (\d{4}) ", ["month", "year"])
    return rows.drop("modified")


@query(
    "content_check",
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS left_value,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'none' ELSE strftime(o_orderdate, '%Y-%m') END AS right_value
FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 31 = 0
""",
)
def contents(t):
    """Rows whose two readings of the month differ or are missing."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    other = F.when(F.col("o_orderkey") % 50 == 0, None).when(F.col("o_orderkey") % 31 == 0, "none").otherwise(month)
    return content_check(t.orders, month, other).select("o_orderkey", "left_value", "right_value")


INPUTS = {"region": 10, "customer": 1, "orders": 1, "lineitem": 1, "events": 100, "documents": 1, "supplier": 1}


@query(
    "input_report",
    " UNION ALL ".join(
        f"SELECT '{n}' AS input, count(*) AS rows, {f} AS floor, count(*) >= {f} AS ok FROM {n}" for n, f in INPUTS.items()
    ),
)
def inputs(t):
    return input_report({n: getattr(t, n) for n in INPUTS}, INPUTS)


@query(
    "union_by_name",
    """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
""",
)
def union_by_name(t):
    people = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    firms = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return people.unionByName(firms, allowMissingColumns=True)


@query("sample_first", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5")
def sample(t):
    return sample_first(t.customer.select("c_custkey", "c_acctbal"), [F.col("c_acctbal").desc(), "c_custkey"], 5)


UPSERT_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
UNION ALL SELECT o_orderkey + 1000000000, o_totalprice FROM orders WHERE o_orderkey % 50 = 0
"""


def price_changes(t):
    """The prices, and a batch with changes, a second change of some keys, and new keys."""
    price = F.col("o_totalprice")
    key = F.col("o_orderkey")
    target = t.orders.select("o_orderkey", price.alias("price"))
    changed = t.orders.where(key % 3 == 0).select("o_orderkey", (price + 1).alias("price"), F.lit(1).alias("file_no"))
    again = t.orders.where(key % 6 == 0).select("o_orderkey", (price + 2).alias("price"), F.lit(2).alias("file_no"))
    added = t.orders.where(key % 50 == 0).select((key + 1_000_000_000).alias("o_orderkey"), price.alias("price"), F.lit(1).alias("file_no"))
    return target, changed.unionByName(again).unionByName(added)


@query("upsert_latest", UPSERT_SQL)
def upsert_latest(t):
    return tables.upsert(*price_changes(t), "o_orderkey", ["file_no"])


@query("upsert_buckets", UPSERT_SQL)
def upsert_buckets(t):
    """The same merge in place, run twice; the second run changes nothing."""
    path = scratch_path(t.spark, "buckets")
    target, updates = price_changes(t)
    tables.write_buckets(target, path, "o_orderkey", 16)
    for _ in range(2):
        tables.upsert_buckets(updates, path, "o_orderkey", ["file_no"], 16)
    return tables.read_buckets(t.spark, path)


@query("append_new", "SELECT o_orderkey, o_custkey FROM orders")
def append_new(t):
    """Two thirds are there; appending all of them twice adds the missing third once."""
    path = scratch_path(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_custkey")
    rows.where(F.col("o_orderkey") % 3 != 0).write.parquet(path)
    tables.append_new(rows, path, "o_orderkey")
    tables.append_new(rows, path, "o_orderkey")
    return tables.read_table(t.spark, path)


@query("snapshot_roundtrip", "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders")
def snapshot_roundtrip(t):
    """Written twice in its contract, read back by column."""
    path = scratch_path(t.spark, "snapshot")
    layout = ordered("id bigint, amount double, status string")
    renamed = t.orders.withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "amount", "o_orderstatus": "status"})
    tables.write_snapshot(renamed.where("id < 10"), path, layout)
    tables.write_snapshot(renamed, path, layout)
    return tables.read_table(t.spark, path, ["id", "amount"])


@query(
    "log_ingest",
    """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS name, strftime(max(o_orderdate), '%Y-%m-%d') AS modified FROM orders GROUP BY o_custkey
UNION ALL SELECT 'daily', '2024-05-01' UNION ALL SELECT 'weekly', '2024-01-01'
""",
)
def log_ingest(t):
    """Old log merged with newer times of the same and of other sources."""
    seen = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("modified"), F.min("o_orderdate").alias("before"))
    name = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    old = conform(seen.where(F.col("o_custkey") % 2 == 0).select(name.alias("source"), F.col("before").alias("modified")), tables.SOURCES_META)
    meta = t.spark.createDataFrame(
        [("daily", dt.datetime(2024, 1, 1)), ("weekly", dt.datetime(2024, 1, 1))], contract(string="dataset", timestamp="modified")
    )
    meta, sources = tables.log_ingest(meta, old, "daily", seen.select(name.alias("path"), "modified"), dt.datetime(2024, 5, 1))
    both = sources.withColumnRenamed("source", "name").unionByName(meta.withColumnRenamed("dataset", "name"))
    return both.withColumn("modified", F.date_format("modified", "yyyy-MM-dd"))
