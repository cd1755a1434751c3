"""Scalar functions over the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.functions import a1, dates, text

SALT = "warehouse"


@query(
    "ages",
    """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS seen,
  CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) - CAST(o_custkey AS INTEGER) END AS b FROM orders),
y AS (SELECT *, year(seen) - year(b) - CASE WHEN month(seen) < month(b) OR (month(seen) = month(b) AND day(seen) < day(b)) THEN 1 ELSE 0 END AS age,
  (year(seen) - year(b)) * 12 + month(seen) - month(b) - CASE WHEN day(seen) < day(b) THEN 1 ELSE 0 END AS months FROM o)
SELECT o_orderkey, age, CASE WHEN age <= 2 THEN months END AS age_in_mo_under_3 FROM y
""",
)
def ages(t):
    """Birth date = order date less customer key days; some births unknown."""
    seen = F.col("o_orderdate").cast("date")
    rows = t.orders.select(
        "o_orderkey", seen.alias("seen"),
        F.when(F.col("o_orderkey") % 13 != 0, F.date_sub(seen, F.col("o_custkey").cast("int"))).alias("born"),
    )
    return rows.select(
        "o_orderkey",
        dates.age_years(F.col("born"), F.col("seen")).alias("age"),
        dates.age_months(F.col("born"), F.col("seen")).alias("age_in_mo_under_3"),
    )


FNV_SQL = """list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),
  lambda h, b: (xor(h, b) * 16777619) & 4294967295)"""


@query(
    "hash_ids",
    f"SELECT c_custkey, {FNV_SQL.format('c_name')} AS plain, CAST({FNV_SQL.format(chr(39) + SALT + '#' + chr(39) + ' || c_name')} AS VARCHAR) AS person_id FROM customer",
)
def hash_ids(t):
    """32-bit FNV-1a, unsalted and as surrogate id."""
    return t.customer.select(
        "c_custkey",
        text.fnv1a(F.col("c_name")).alias("plain"),
        text.hash_id(F.col("c_name"), SALT).alias("person_id"),
    )


@query(
    "hash_texts",
    """
SELECT doc_id, list_reduce(list_prepend(2166136261::BIGINT,
  list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda c: CAST('0x' || c AS BIGINT))),
  lambda h, b: (xor(h, b) * 16777619) & 4294967295) AS plain FROM documents
""",
)
def hash_texts(t):
    """The hash over whole texts, many of them not ASCII."""
    return t.documents.select("doc_id", text.fnv1a(F.col("text")).alias("plain"))


@query(
    "code_from_text",
    """
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'SET' END AS code,
  CASE p_size % 4 WHEN 0 THEN 'HC PR ' || lpad(CAST(p_partkey AS VARCHAR), 5, '9') || ' ' || p_name
    WHEN 1 THEN 'HC PR ' || lpad(CAST(p_partkey AS VARCHAR), 5, '9')
    WHEN 2 THEN 'X HC PR A' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || ' x' END AS name FROM part)
SELECT p_partkey, coalesce(code, nullif(regexp_extract(name, 'HC PR ([A-Z][0-9]{4}|[0-9]{4}[A-Z]|[0-9]{5}) ', 1), '')) AS code FROM p
""",
)
def code_from_text(t):
    """Codes inside names; without the blank after the code there is no match."""
    key = F.col("p_partkey").cast("string")
    five = F.concat(F.lit("HC PR "), F.lpad(key, 5, "9"))
    name = (
        F.when(F.col("p_size") % 4 == 0, F.concat(five, F.lit(" "), F.col("p_name")))
        .when(F.col("p_size") % 4 == 1, five)
        .when(
            F.col("p_size") % 4 == 2,
            F.concat(F.lit("X HC PR A"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"), F.lit(" x")),
        )
    )
    code = F.when(F.col("p_size") % 10 == 0, "SET")
    return t.part.select("p_partkey", text.procedure_code(code, name).alias("code"))


@query(
    "prefix_match",
    r"""
WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN
  (CASE o_custkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN 'z' ELSE 'AZ' END) || '0' || CAST(o_custkey % 4 AS VARCHAR) ||
  (CASE o_custkey % 5 WHEN 0 THEN '.1' WHEN 1 THEN '3' WHEN 2 THEN '' ELSE '.' END) END AS icd FROM orders)
SELECT o_orderkey, icd, coalesce(regexp_matches(icd, '^(Z00.|Z02.)', 'i'), false) AS hit FROM c
""",
)
def prefix_match(t):
    """Case-insensitive match at the start; the dot matches any character."""
    mod = lambda n: F.col("o_custkey") % n
    icd = F.concat(
        F.when(mod(3) == 0, "Z").when(mod(3) == 1, "z").otherwise("AZ"),
        F.lit("0"),
        mod(4).cast("string"),
        F.when(mod(5) == 0, ".1").when(mod(5) == 1, "3").when(mod(5) == 2, "").otherwise("."),
    )
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 17 != 0, icd).alias("icd"))
    return rows.withColumn("hit", text.starts_with_any(F.col("icd"), ["Z00.", "Z02."]))


@query(
    "dates_and_times",
    """
WITH o AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m%d') AS k,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey * 7 AS VARCHAR) END AS tm,
  CASE o_orderkey % 5 WHEN 0 THEN '?' WHEN 1 THEN NULL WHEN 2 THEN '-' ELSE CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS d1,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'n/a' END AS d2 FROM orders)
SELECT o_orderkey, strftime(CAST(strptime(k, '%Y%m%d') AS DATE), '%Y-%m-%d') AS from_key,
  CASE WHEN o_orderkey % 10 <> 0 THEN strftime(CAST(strptime(k, '%Y%m%d') AS DATE), '%Y-%m-%d') END AS from_signed_key,
  CASE WHEN length(tm) < 4 THEN lpad(tm, 4, '0') ELSE tm END AS time_text,
  strftime(coalesce(try_strptime(d1, '%m/%d/%Y'), try_strptime(d2, '%m/%d/%Y')), '%Y-%m') AS month,
  strftime(o_orderdate - INTERVAL 2 YEAR, '%Y-%m-%d') AS two_years_back, strftime(o_orderdate - INTERVAL 15 MONTH, '%Y-%m-%d') AS months_back,
  day(last_day(o_orderdate)) AS days, substr(strftime(o_orderdate, '%Y-%m-%dT%H:%M'), 1, 10) AS day_text,
  CAST(o_orderkey % 2 AS BOOLEAN) AS flag FROM o
""",
)
def dates_and_times(t):
    day = F.col("o_orderdate")
    key = F.date_format(day, "yyyyMMdd")
    number = F.col("o_orderkey")
    shown = lambda c: F.date_format(c, "yyyy-MM-dd")
    spoken = F.concat_ws("/", F.month(day).cast("string"), F.day(day).cast("string"), F.year(day).cast("string"))
    first = F.when(number % 5 == 0, "?").when(number % 5 == 1, None).when(number % 5 == 2, "-").otherwise(spoken)
    second = F.when(number % 2 == 0, F.date_format(day, "MM/dd/yyyy")).otherwise("n/a")
    clock_key = F.when(number % 7 != 0, (number * 7).cast("string"))
    return t.orders.select(
        "o_orderkey",
        shown(dates.day_key(key)).alias("from_key"),
        shown(dates.day_key_or_null(F.when(number % 10 == 0, F.lit(-1)).otherwise(key.cast("bigint")))).alias("from_signed_key"),
        text.pad_left(clock_key, 4).alias("time_text"),
        dates.month_text(dates.lenient_date(first, second)).alias("month"),
        shown(dates.back(day, years=2)).alias("two_years_back"),
        shown(dates.back(day, months=15)).alias("months_back"),
        dates.days_in_month(day).alias("days"),
        F.substring(F.date_format(day, "yyyy-MM-dd'T'HH:mm"), 1, 10).alias("day_text"),
        (number % 2).cast("boolean").alias("flag"),
    )


@query(
    "timestamp_parts",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H%M') AS clock FROM events",
)
def timestamp_parts(t):
    return t.events.select(
        "event_id", F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day"), dates.clock(F.col("ts")).alias("clock")
    )


@query(
    "sheet_addresses",
    """
WITH p AS (SELECT p_partkey, chr(CAST(65 + p_partkey % 26 AS INTEGER)) || CASE WHEN p_size > 25 THEN chr(CAST(65 + p_size % 26 AS INTEGER)) ELSE '' END AS letters FROM part)
SELECT p_partkey, letters, CASE WHEN length(letters) = 1 THEN ascii(letters) - 65 ELSE (ascii(letters) - 64) * 26 + ascii(substr(letters, 2, 1)) - 65 END AS col,
  (CASE WHEN length(letters) = 1 THEN ascii(letters) - 65 ELSE (ascii(letters) - 64) * 26 + ascii(substr(letters, 2, 1)) - 65 END BETWEEN 0 AND 5)
  OR (CASE WHEN length(letters) = 1 THEN ascii(letters) - 65 ELSE (ascii(letters) - 64) * 26 + ascii(substr(letters, 2, 1)) - 65 END) = 27 AS hit FROM p
""",
)
def sheet_addresses(t):
    """Column letters to indexes, and membership of ``A:F,AB``."""
    letter = lambda c: F.char((F.lit(65) + F.col(c) % 26).cast("int"))
    letters = F.concat(letter("p_partkey"), F.when(F.col("p_size") > 25, letter("p_size")).otherwise(""))
    rows = t.part.select("p_partkey", letters.alias("letters")).withColumn("col", a1.column_index_of(F.col("letters")))
    return rows.withColumn("hit", a1.in_columns(F.col("col"), "A:F,AB"))
