"""Whole jobs on extracts and workbooks made from the driver's tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.grids import cells
from tallyloom.catalog.io import write_csv
from tallyloom.catalog.registry import query
from tallyloom.catalog.scalars import FNV_SQL, SALT
from tallyloom.operators.lookups import priority_union
from tallyloom.plans import clinical, finance
from tallyloom.plans.panels import panel_job
from tallyloom.plans.persons import person_job
from tallyloom.session import cut_lineage
from tallyloom.sources import csv, layouts

DAY = "1990-01-01"


def stored(df):
    """Cells kept as a table, as a workbook import leaves them; made anew for every query."""
    return cut_lineage(df)


def text_of(column):
    return F.col(column).cast("string")


def source_of(column, step=1):
    key = F.floor(F.col(column) / step) if step > 1 else F.col(column)
    return F.concat(F.lit("M"), key.cast("string"))


def shown(df, *columns):
    """Dates as text, so both engines give one value."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# ---------------------------------------------------------------- persons


def person_inputs(t):
    """Two person rows per source id; lists and portal rows from orders."""
    born = F.date_add(F.lit(DAY).cast("date"), (F.col("c_custkey") * 7 % 9000).cast("int"))
    persons = t.customer.select(
        text_of("c_custkey").alias("person_id"), source_of("c_custkey", 2).alias("source_id"), F.col("c_name").alias("name"),
        F.lit("F").alias("sex"), born.alias("dob"), F.lit("street").alias("address"), F.lit("town").alias("city"),
        F.col("c_nationkey").cast("string").alias("state"), F.lit("zip").alias("zip"), F.lit("phone").alias("phone"),
        F.lit("mail").alias("email"), F.col("c_mktsegment").alias("pcp"), F.col("c_custkey").alias("_line"),
    )
    rows = t.orders.withColumns({"source_id": source_of("o_custkey", 2), "_line": F.col("o_orderkey")})
    allergies = rows.where(F.col("o_orderpriority") == "1-URGENT").select(
        "source_id", "_line", F.col("o_orderpriority").alias("name"), F.nullif("o_orderstatus", F.lit("P")).alias("reaction"),
        F.lit("food").alias("type"), text_of("_line").alias("severity"),
    )
    problems = rows.select(
        "source_id", "_line", F.col("o_orderpriority").alias("diagnosis"), F.concat(F.lit("I"), (F.col("_line") % 100).cast("string")).alias("icd"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"), F.when(F.col("_line") % 3 == 0, "Active").otherwise("Resolved").alias("status"),
    )
    portal = rows.where(F.col("o_custkey") % 3 != 0).select(
        "source_id", "_line", F.col("o_orderstatus").alias("mychart_status"),
        F.when(F.col("_line") % 4 != 0, F.date_format("o_orderdate", "yyyyMMdd")).alias("mychart_activation_date"),
    )
    return persons, allergies, problems, portal


PERSON_SQL = """
p AS (SELECT CAST(c_custkey AS VARCHAR) AS person_id, 'M' || CAST(c_custkey // 2 AS VARCHAR) AS source_id, c_name AS name,
  DATE '1990-01-01' + CAST(c_custkey * 7 % 9000 AS INTEGER) AS dob, CAST(c_nationkey AS VARCHAR) AS state, c_mktsegment AS pcp FROM customer),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY person_id DESC) AS rn FROM p) WHERE rn = 1),
o AS (SELECT *, 'M' || CAST(o_custkey // 2 AS VARCHAR) AS source_id FROM orders),
al AS (SELECT source_id, count(*) AS allergy_count FROM o WHERE o_orderpriority = '1-URGENT' GROUP BY source_id),
pr AS (SELECT source_id, count(*) AS problem_count FROM o WHERE o_orderkey % 3 = 0 GROUP BY source_id),
ages AS (SELECT *, CAST(2001 - year(dob) - CASE WHEN month(dob) > 8 OR (month(dob) = 8 AND day(dob) > 1) THEN 1 ELSE 0 END AS INTEGER) AS age,
  CAST((2001 - year(dob)) * 12 + 8 - month(dob) - CASE WHEN 1 < day(dob) THEN 1 ELSE 0 END AS INTEGER) AS months FROM kept)
"""


@query(
    "person_job",
    f"""WITH {PERSON_SQL} SELECT person_id, 'F' AS sex, 'town' AS city, state, pcp, coalesce(allergy_count, 0) AS allergy_count, coalesce(problem_count, 0) AS problem_count, age,
  CASE WHEN age <= 2 THEN months END AS age_in_mo_under_3 FROM ages LEFT JOIN al USING (source_id) LEFT JOIN pr USING (source_id)""",
)
def person_table(t):
    """Person table without personal columns, with the sizes of lists and with ages."""
    return person_job(*person_inputs(t), as_of="2001-08-01 10:00:00", order=["_line"])["person"]


@query(
    "person_id_details",
    f"""WITH {PERSON_SQL} SELECT person_id, source_id, name, strftime(dob, '%Y-%m-%d') AS dob, 'street' AS address, 'zip' AS zip, 'phone' AS phone,
  'mail' AS email, 'town' AS city, state FROM kept""",
)
def person_details(t):
    return shown(person_job(*person_inputs(t), as_of="2001-08-01", order=["_line"])["id_details"], "dob")


@query(
    "person_portal",
    f"""WITH {PERSON_SQL}, f AS (SELECT source_id, arg_min(o_orderstatus, o_orderkey) AS mychart_status, min(o_orderkey) AS k,
  arg_min(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS d FROM o WHERE o_custkey % 3 <> 0 GROUP BY source_id)
SELECT person_id, mychart_status, CASE WHEN k % 4 <> 0 THEN d END AS mychart_activation_date FROM f JOIN p USING (source_id)""",
)
def person_portal(t):
    """First portal row per source id, for every person row with that id."""
    return shown(person_job(*person_inputs(t), as_of="2001-08-01", order=["_line"])["portal"], "mychart_activation_date")


PERSON_LISTS_SQL = f"""WITH {PERSON_SQL},
r AS (SELECT source_id, o_orderkey, 'allergy' AS list, CAST(to_json({{'name': o_orderpriority, 'reaction': nullif(o_orderstatus, 'P'), 'type': 'food',
    'severity': CAST(o_orderkey AS VARCHAR)}}) AS VARCHAR) AS record FROM o WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT source_id, o_orderkey, 'problem', CAST(to_json({{'diagnosis': o_orderpriority, 'icd': 'I' || CAST(o_orderkey % 100 AS VARCHAR),
    'start_date': strftime(o_orderdate, '%Y%m%d')}}) AS VARCHAR) FROM o WHERE o_orderkey % 3 = 0),
x AS (SELECT *, (row_number() OVER (PARTITION BY source_id, list ORDER BY o_orderkey) - 1) // SIZE AS part FROM r)
SELECT person_id, list, part, '[' || string_agg(record, ',' ORDER BY o_orderkey) || ']' AS json FROM x JOIN kept USING (source_id) GROUP BY ALL"""


@query("person_lists", PERSON_LISTS_SQL.replace("SIZE", "4"))
def person_lists(t):
    """Lists of all lengths in parts of four."""
    return person_job(*person_inputs(t), as_of="2001-08-01", order=["_line"], part_rows=4)["person_lists"]


@query("person_lists_whole", PERSON_LISTS_SQL.replace("SIZE", "100000"))
def person_lists_whole(t):
    """The same layout where every list is one part."""
    return person_job(*person_inputs(t), as_of="2001-08-01", order=["_line"])["person_lists"]


# ---------------------------------------------------------------- encounters


def id_map(t):
    """Four of five customers are known, with a birth date."""
    return t.customer.where(F.col("c_custkey") % 5 != 0).select(
        F.concat(F.lit("P"), text_of("c_custkey")).alias("person_id"), source_of("c_custkey").alias("source_id"),
        F.date_add(F.lit(DAY).cast("date"), (F.col("c_custkey") * 3 % 4000).cast("int")).alias("dob"),
    )


IDS_SQL = """
ids AS (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS person_id, 'M' || CAST(c_custkey AS VARCHAR) AS source_id,
  DATE '1990-01-01' + CAST(c_custkey * 3 % 4000 AS INTEGER) AS dob FROM customer WHERE c_custkey % 5 <> 0),
o AS (SELECT *, 'M' || CAST(o_custkey AS VARCHAR) AS source_id, CAST(o_orderdate AS DATE) AS day FROM orders)
"""


def encounter_rows(t):
    """Outpatient extract: the columns used, from orders."""
    key = F.col("o_orderkey")
    return t.orders.select(
        source_of("o_custkey").alias("source_id"),
        F.concat(F.lit("clinic "), (key % 4).cast("string")).alias("dept"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("encounter_date"),
        F.when(key % 6 != 0, (key * 3 % 2400).cast("string")).alias("encounter_time"),
        F.when(key % 8 == 0, "CC LAB").when(key % 8 == 1, None).when(key % 8 == 2, "CC PHYSICAL").otherwise("OFFICE").alias("encounter_type"),
        F.element_at(F.array(*[F.lit(x) for x in ["DOE, A", "ROE, B", "LOW, C", "OUT, X"]]), (key % 4 + 1).cast("int")).alias("service_provider"),
        (key % 2).cast("int").alias("with_pcp"),
        F.when(key % 10 != 0, "Completed").otherwise("Canceled").alias("appt_status"),
        F.lit("text").alias("diagnoses"),
        F.when(key % 9 == 0, "z00.1").when(key % 9 == 1, "J10").otherwise(None).alias("diagnoses_icd"),
        F.when(key % 5 == 0, "99999").alias("level_of_service"),
        F.concat(F.lit("HC PR "), F.lpad((key % 100000).cast("string"), 5, "0"), F.lit(" visit")).alias("level_of_service_name"),
    )


@query(
    "visit_job",
    f"""WITH {IDS_SQL},
j AS (SELECT o.*, person_id, dob, year(day) - year(dob) - CASE WHEN month(day) < month(dob) OR (month(day) = month(dob) AND day(day) < day(dob)) THEN 1 ELSE 0 END AS age,
  (year(day) - year(dob)) * 12 + month(day) - month(dob) - CASE WHEN day(day) < day(dob) THEN 1 ELSE 0 END AS months FROM o LEFT JOIN ids USING (source_id))
SELECT person_id, 'clinic ' || CAST(o_orderkey % 4 AS VARCHAR) AS dept, strftime(day, '%Y-%m-%d') AS encounter_date,
  CASE WHEN o_orderkey % 6 <> 0 THEN lpad(CAST(o_orderkey * 3 % 2400 AS VARCHAR), 4, '0') END AS encounter_time,
  CASE o_orderkey % 8 WHEN 0 THEN 'CC LAB' WHEN 1 THEN NULL WHEN 2 THEN 'CC PHYSICAL' ELSE 'OFFICE' END AS encounter_type,
  ['DOE, A', 'ROE, B', 'LOW, C', 'OUT, X'][o_orderkey % 4 + 1] AS service_provider, CASE WHEN o_orderkey % 10 <> 0 THEN 'Completed' ELSE 'Canceled' END AS appt_status,
  'text' AS diagnoses, CASE o_orderkey % 9 WHEN 0 THEN 'z00.1' WHEN 1 THEN 'J10' END AS diagnoses_icd,
  'HC PR ' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') || ' visit' AS level_of_service_name, strftime(dob, '%Y-%m-%d') AS dob,
  CAST(o_orderkey % 2 AS BOOLEAN) AS with_pcp, CASE WHEN o_orderkey % 5 = 0 THEN '99999' ELSE lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') END AS level_of_service,
  age AS encounter_age, CASE WHEN age <= 2 THEN months END AS encounter_age_in_mo_under_3 FROM j""",
)
def outpatient_visits(t):
    """Outpatient encounters with id, ages, padded times and recovered codes."""
    return shown(clinical.outpatient(encounter_rows(t), id_map(t)), "encounter_date", "dob")


def ed_rows(t):
    return t.events.select(
        source_of("user_id").alias("source_id"), F.col("ts").alias("arrival_at"),
        (F.col("ts") + F.expr("INTERVAL 95 MINUTES")).alias("departure_at"), F.col("event_type").alias("diagnosis"),
    )


@query(
    "ed_visits",
    f"""WITH {IDS_SQL} SELECT person_id, event_type AS diagnosis, strftime(ts, '%Y-%m-%d') AS arrival_date, strftime(ts, '%H%M') AS arrival_time,
  strftime(ts + INTERVAL 95 MINUTE, '%Y-%m-%d') AS departure_date, strftime(ts + INTERVAL 95 MINUTE, '%H%M') AS departure_time
FROM events LEFT JOIN ids ON source_id = 'M' || CAST(user_id AS VARCHAR)""",
)
def ed_visits(t):
    rows, _ = clinical.emergency(ed_rows(t), id_map(t))
    return shown(rows, "arrival_date", "departure_date").drop("arrival_at", "departure_at")


@query(
    "unknown_ids",
    f"""WITH {IDS_SQL} SELECT 'M' || CAST(user_id AS VARCHAR) AS source_id, count(*) AS rows FROM events
LEFT JOIN ids ON source_id = 'M' || CAST(user_id AS VARCHAR) WHERE person_id IS NULL GROUP BY 1""",
)
def unknown_ids(t):
    return clinical.emergency(ed_rows(t), id_map(t))[1]


@query(
    "inpatient_stays",
    f"""WITH {IDS_SQL} SELECT person_id, o_orderstatus AS diagnosis, o_orderpriority AS dept, strftime(day, '%Y-%m-%d') AS admission_date,
  CASE WHEN o_orderkey % 4 <> 0 THEN strftime(day, '%Y-%m-%d') END AS discharge_date FROM o LEFT JOIN ids USING (source_id)""",
)
def inpatient_stays(t):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    rows = t.orders.select(
        source_of("o_custkey").alias("source_id"), F.col("o_orderstatus").alias("diagnosis"), F.col("o_orderpriority").alias("dept"),
        day.alias("admission_key"), F.when(F.col("o_orderkey") % 4 == 0, "-1").otherwise(day).alias("discharge_key"),
    )
    return shown(clinical.inpatient(rows, id_map(t)), "admission_date", "discharge_date")


@query(
    "notes_job",
    f"""WITH {IDS_SQL}, hashed AS (SELECT 'M' || CAST(c_custkey AS VARCHAR) AS source_id, CAST({FNV_SQL.format(f"'{SALT}#M' || CAST(c_custkey AS VARCHAR)")} AS VARCHAR) AS new_id FROM customer),
n AS (SELECT o.*, coalesce(person_id, new_id) AS pid, DATE '1990-01-01' + CAST(o_custkey % 4000 AS INTEGER) AS born, nullif('W' || CAST(o_orderkey % 5 AS VARCHAR), 'W4') AS dept,
  CASE o_orderkey % 3 WHEN 0 THEN 'ED Notes' WHEN 1 THEN NULL ELSE 'Progress' END AS note_type FROM o LEFT JOIN ids USING (source_id) LEFT JOIN hashed USING (source_id))
SELECT pid AS person_id, dept, note_type, strftime(day, '%Y-%m-%d') AS service_date,
  year(day) - year(born) - CASE WHEN month(day) < month(born) OR (month(day) = month(born) AND day(day) < day(born)) THEN 1 ELSE 0 END AS encounter_age,
  CASE WHEN coalesce(dept = 'W0', false) OR coalesce(note_type = 'ED Notes', false) THEN 'ed' ELSE 'inpatient' END AS side FROM n""",
)
def notes(t):
    """Notes cleaned, given ids and split; rows with neither department nor type are inpatient."""
    out = clinical.notes_job(note_rows(t), id_map(t), SALT, ed_dept="W0")
    both = out["ed_notes"].withColumn("side", F.lit("ed")).unionByName(out["inpatient_notes"].withColumn("side", F.lit("inpatient")))
    return shown(both, "service_date")


def note_rows(t):
    key = F.col("o_orderkey")
    return t.orders.select(
        source_of("o_custkey").alias("source_id"), F.concat(F.lit("N"), text_of("o_custkey")).alias("name"),
        F.when(key % 5 == 4, clinical.UNSPECIFIED).otherwise(F.concat(F.lit("W"), (key % 5).cast("string"))).alias("dept"),
        F.when(key % 3 == 0, "ED Notes").when(key % 3 == 1, clinical.UNSPECIFIED).otherwise("Progress").alias("note_type"),
        F.col("o_orderdate").alias("service_date"),
        F.date_add(F.lit(DAY).cast("date"), (F.col("o_custkey") % 4000).cast("int")).alias("dob"),
    )


NEW_IDS_SQL = f"""WITH {IDS_SQL} SELECT DISTINCT 'M' || CAST(o_custkey AS VARCHAR) AS source_id, {{extra}}
  CAST({FNV_SQL.format(f"'{SALT}#M' || CAST(o_custkey AS VARCHAR)")} AS VARCHAR) AS person_id FROM orders WHERE o_custkey % 5 = 0"""


@query("notes_new_ids", NEW_IDS_SQL.format(extra="'N' || CAST(o_custkey AS VARCHAR) AS name,"))
def notes_new_ids(t):
    """Ids made for unknown persons, with a name for each."""
    return clinical.notes_job(note_rows(t), id_map(t), SALT, ed_dept="W0")["new_ids"]


CHARGES_SQL = f"""
{IDS_SQL},
hashed AS (SELECT 'M' || CAST(c_custkey AS VARCHAR) AS source_id, CAST({FNV_SQL.format(f"'{SALT}#M' || CAST(c_custkey AS VARCHAR)")} AS VARCHAR) AS new_id FROM customer),
fees AS (SELECT 'C' || CAST(p_partkey AS VARCHAR) AS hcpcs, CASE WHEN p_size <= 30 THEN p_retailprice ELSE CAST(p_size AS DOUBLE) END AS rate FROM part WHERE p_size <= 40)
"""


CHARGE_NULLS = ["encounter_csn", "posting_user", "modifiers", "procedure_desc", "rev_code", "rev_code_desc", "reversal_reason", "primary_payor_class", "dept", "location"]
CHARGE_NULLS_SQL = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in CHARGE_NULLS)


@query(
    "charges_job",
    f"""WITH {CHARGES_SQL}
SELECT o_orderkey AS id, coalesce(person_id, new_id) AS person_id, strftime(day, '%Y-%m-%d') AS service_date, strftime(day, '%Y-%m-%d') AS post_date, 'C' || CAST(o_orderkey % 3000 AS VARCHAR) AS procedure_code,
  CASE WHEN o_orderkey % 4 = 0 THEN 5 ELSE 2 END AS quantity, rate * CASE WHEN o_orderkey % 4 = 0 THEN 5 ELSE 2 END AS trvu,
  CASE o_orderkey % 3 WHEN 0 THEN 'Dr' END AS billing_provider, CAST(o_orderkey % 1000 AS DOUBLE) / 4 AS wrvu, CAST(o_orderkey AS DOUBLE) AS charge_amount,
  o_orderkey % 2 = 0 AS is_inactive, {CHARGE_NULLS_SQL} FROM o LEFT JOIN ids USING (source_id) LEFT JOIN hashed USING (source_id) LEFT JOIN fees ON hcpcs = 'C' || CAST(o_orderkey % 3000 AS VARCHAR)
UNION ALL SELECT -1 - s_suppkey, 'old', '1999-01-01', NULL, 'C1', 1, 1.5, NULL, NULL, NULL, NULL, {", ".join(["NULL"] * len(CHARGE_NULLS))} FROM supplier""",
)
def charges(t):
    """Two charge files written as CSV, read by header, cleaned, priced and merged; all columns."""
    return shown(charge_tables(t)["charges"], "service_date", "post_date")


@query("charges_missing_ids", NEW_IDS_SQL.format(extra=""))
def charges_missing_ids(t):
    return charge_tables(t)["missing_ids"]


def charge_tables(t):
    key = F.col("o_orderkey")

    def extract(df, quantity):
        day = F.date_format("o_orderdate", "yyyyMMdd")
        values = {
            "BillingTransactionKey": text_of("o_orderkey"), "PrimaryMRN": source_of("o_custkey"), "ServiceDateKey": day, "PostDateKey": day,
            "BillingProviderName": F.when(key % 3 == 0, "Dr").when(key % 3 == 1, clinical.UNSPECIFIED),
            "BillingProcedureCode": F.concat(F.lit("C"), (key % 3000).cast("string")), "RvuWork": (key % 1000 / 4).cast("string"),
            "ChargeAmount": key.cast("double").cast("string"),
            "BillingProcedureQuantity": F.lit(str(quantity)), "IsInactive": F.when(key % 2 == 0, "True").otherwise("False"),
        }
        blank = F.lit(None).cast("string")
        return df.select(*[values.get(f.name, blank).alias(f.name) for f in layouts.CHARGES])

    first = extract(t.orders, 2).withColumn("file_no", F.lit(1))
    second = extract(t.orders.where(key % 4 == 0), 5).withColumn("file_no", F.lit(2))
    path = write_csv(first.unionByName(second), t, "charges", "file_no")
    rows = csv.read_named(t.spark, path, layouts.CHARGES, layouts.CHARGES_NAMES, keep_order=True)

    code = F.concat(F.lit("C"), text_of("p_partkey")).alias("hcpcs")
    main = t.part.where("p_size <= 30").select(code, F.col("p_retailprice").alias("facility_trvu"))
    extra = t.part.where("p_size between 25 and 40").select(code, F.col("p_size").cast("double").alias("facility_trvu"))
    fees = priority_union([main, extra], ["hcpcs"], ["facility_trvu"])

    known = {
        "id": F.lit(-1) - F.col("s_suppkey"), "person_id": F.lit("old"), "service_date": F.lit("1999-01-01").cast("date"),
        "procedure_code": F.lit("C1"), "quantity": F.lit(1).cast("bigint"), "trvu": F.lit(1.5),
    }
    kinds = {"post_date": "date", "wrvu": "double", "charge_amount": "double", "is_inactive": "boolean"}
    empty = {c: F.lit(None).cast(kinds.get(c, "string")) for c in ["post_date", "billing_provider", "wrvu", "charge_amount", "is_inactive", *CHARGE_NULLS]}
    stored_rows = t.supplier.select(*[c.alias(n) for n, c in {**known, **empty}.items()])
    return clinical.charges_job(rows, id_map(t), SALT, fees, stored_rows, csv.FILE_ORDER)


@query(
    "imaging_job",
    """
SELECT o_orderkey AS imaging_key, strftime(o_orderdate, '%Y-%m-%d') AS scheduled_date, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS service_date,
  nullif(o_orderpriority, '5-LOW') AS dept, o_orderstatus AS modality, '' AS study_status FROM orders
""",
)
def imaging(t):
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("bigint")
    rows = t.orders.select(
        F.col("o_orderkey").alias("imaging_key"), day.alias("scheduled_key"), F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(day).alias("service_key"),
        F.when(F.col("o_orderpriority") == "5-LOW", clinical.UNSPECIFIED).otherwise(F.col("o_orderpriority")).alias("dept"),
        F.col("o_orderstatus").alias("modality"), F.lit("").alias("study_status"),
    )
    return shown(clinical.imaging_job(rows), "scheduled_date", "service_date")


@query(
    "panel_job",
    """
WITH e AS (SELECT o_custkey AS person_id, CAST(o_orderdate AS DATE) AS day, o_orderkey % 4 AS place,
  CASE o_orderkey % 4 WHEN 0 THEN 'DOE, A' WHEN 1 THEN 'ROE, B' WHEN 2 THEN 'LOW, C' END AS provider,
  CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey * 3 % 2400 ELSE 0 END AS tm,
  (o_orderkey % 8 = 2) OR (o_orderkey % 9 = 0) AS well FROM orders WHERE o_orderkey % 8 <> 0 AND o_orderkey % 10 <> 0 AND o_orderkey % 4 <> 3 AND o_custkey % 5 <> 0),
r AS (SELECT *, place IN (0, 1) AS peds, row_number() OVER (PARTITION BY person_id ORDER BY day DESC, tm DESC, place IN (0, 1) DESC) AS rn,
  row_number() OVER (PARTITION BY person_id, well ORDER BY day DESC, tm DESC, place IN (0, 1) DESC) AS rw,
  row_number() OVER (PARTITION BY person_id ORDER BY day DESC, tm DESC, provider DESC) AS pn,
  row_number() OVER (PARTITION BY person_id, well ORDER BY day DESC, tm DESC, provider DESC) AS pw
  FROM e WHERE day >= DATE '1999-08-01'),
f AS (SELECT person_id, count(*) FILTER (WHERE peds) AS n_peds, count(*) FILTER (WHERE well) AS n_well,
  bool_or(peds) FILTER (WHERE well AND rw = 1) AS well_peds, count(*) FILTER (WHERE day >= DATE '2000-08-01') AS yr,
  count(*) FILTER (WHERE day >= DATE '2000-08-01' AND peds) AS yr_peds, count(*) FILTER (WHERE day >= DATE '2000-05-01' AND peds) AS p15,
  bool_or(peds) FILTER (WHERE rn <= 3) AS any3, bool_and(peds) FILTER (WHERE rn <= 3) AS all3,
  max(provider) FILTER (WHERE pn = 1) AS last_p, max(provider) FILTER (WHERE well AND pw = 1) AS well_p FROM r GROUP BY person_id),
c AS (SELECT person_id, provider, count(*) AS n FROM r GROUP BY ALL),
m AS (SELECT person_id, count(*) AS k, sum(n) AS total, max(n) AS most, arg_max(provider, n) AS top FROM c GROUP BY person_id),
x AS (SELECT c_custkey, c_custkey % 9 = 0 AS fixed, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN coalesce(c_custkey % 6 < 3 AND p15 = 0, false) THEN NULL WHEN n_peds >= 3 AND all3 THEN 1 WHEN well_peds AND any3 THEN 2
  WHEN n_well = 0 AND yr >= 3 AND yr_peds * 2 > yr AND any3 THEN 3 END AS rule,
  CASE WHEN k = 1 THEN 1 WHEN most * 2 > total THEN 2 WHEN well_p IS NOT NULL THEN 3 WHEN k IS NOT NULL THEN 4 END AS cut, top, well_p, last_p
  FROM customer LEFT JOIN f ON f.person_id = c_custkey LEFT JOIN m ON m.person_id = c_custkey WHERE c_custkey % 5 <> 0),
y AS (SELECT *, CASE WHEN cut <= 2 THEN top WHEN cut = 3 THEN well_p ELSE last_p END AS provider FROM x)
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS person_id,
  CASE WHEN fixed THEN 'Old' WHEN rule IS NOT NULL THEN 'Kids' ELSE CASE provider WHEN 'DOE, A' THEN 'North' WHEN 'ROE, B' THEN 'North' WHEN 'LOW, C' THEN 'South' END END AS panel_location,
  CASE WHEN NOT fixed AND rule IS NULL THEN provider END AS panel_provider,
  CASE WHEN fixed THEN NULL WHEN rule IS NOT NULL THEN 'Rule ' || CAST(rule AS VARCHAR) WHEN cut IS NOT NULL THEN 'Cut ' || CAST(cut AS VARCHAR) END AS step FROM y
""",
)
def panels(t):
    """Both panels in turn over outpatient encounters; persons with a panel keep it."""
    encounters = clinical.outpatient(encounter_rows(t), id_map(t)).where(F.col("person_id").isNotNull())
    persons = id_map(t).select(
        "person_id", (F.substring("person_id", 2, 20).cast("bigint") % 6).alias("age"),
        F.when(F.substring("person_id", 2, 20).cast("bigint") % 9 == 0, "Old").alias("panel_location"),
    )
    sites = {"DOE, A": "North", "ROE, B": "North", "LOW, C": "South"}
    out = panel_job(persons, encounters, "2001-08-01", ["clinic 0", "clinic 1"], ["clinic 2"], sites, "Kids")
    head = F.substring("assignment_details", 1, 1)
    step = F.when(head == "R", F.substring("assignment_details", 1, 6)).otherwise(F.concat(F.lit("Cut "), head))
    return out.withColumn("step", step).drop("assignment_details")


# ---------------------------------------------------------------- finance


def label(column):
    """Alias spellings of five departments, one unknown."""
    return F.element_at(F.array(*[F.lit(x) for x in ["Icu ", "LAB", "er", "Clinic", "Ward"]]), (F.col(column) % 5 + 1).cast("int"))


def alias_tables(t):
    aliases = t.spark.createDataFrame([("ICU ", "D0"), ("Lab", "D1"), ("ER", "D2"), ("clinic", "D3")], "alias string, id string")
    names = [("D0", "Intensive Care"), ("D1", "Laboratory"), ("D2", "Emergency"), ("D3", "Clinics")]
    return aliases, t.spark.createDataFrame(names, "id string, name string")


def dept_sql(key: str) -> str:
    names = "CASE {0} % 5 WHEN 0 THEN 'Intensive Care' WHEN 1 THEN 'Laboratory' WHEN 2 THEN 'Emergency' WHEN 3 THEN 'Clinics' END".format(key)
    return f"CASE WHEN {key} % 5 < 4 THEN 'D' || CAST({key} % 5 AS VARCHAR) END AS dept_id, {names} AS dept_name"


def number_text(column):
    return column.cast("string")


def monthly(t):
    """Quantity per supplier, year and month, one column per month."""
    shipped = t.lineitem.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    return (
        shipped.groupBy("l_suppkey", "year").pivot("month", list(range(1, 13)))
        .agg(F.sum("l_quantity").cast("bigint").cast("string"))
        .withColumnsRenamed({str(n): f"m{n}" for n in range(1, 13)})
    )


VOLUME_SQL = """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS dept_id, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS dept_name, strftime(l_shipdate, '%Y-%m') AS month,
  sum(l_quantity) AS volume, CASE l_suppkey % 3 WHEN 0 THEN 'Days' WHEN 1 THEN 'Tests' END AS unit FROM lineitem GROUP BY ALL
"""


@query("historical_volumes", VOLUME_SQL)
def historical_volumes(t):
    """Fifty departments per sheet, years side by side, units in the first table only."""
    years = F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year")
    rows = t.lineitem.select("l_suppkey").distinct().select("l_suppkey", years).join(monthly(t), ["l_suppkey", "year"], "left").select(
        F.concat(F.lit("v"), F.floor(F.col("l_suppkey") / 50).cast("string")).alias("file"), (F.col("l_suppkey") % 50 + 2).cast("int").alias("row"), "*"
    )
    first = F.col("year") == 1995
    left = F.when(first, 0).otherwise((F.col("year") - 1996) * 15 + 16)
    body = rows.select(
        "file", "row", left.alias("left"), first.alias("first"),
        F.concat(F.lit("S"), text_of("l_suppkey")).alias("id"), F.concat(F.lit("Supplier "), text_of("l_suppkey")).alias("name"),
        F.when(F.col("l_suppkey") % 3 == 0, "Days").when(F.col("l_suppkey") % 3 == 1, "Tests").alias("unit"), *[f"m{n}" for n in range(1, 13)], "year",
    )
    heads = body.select("file", "left", "first", "year").distinct()
    def place(df, values):
        """Cells moved to their table; behind the name the first table is one column wider."""
        laid = cells(df.withColumn("file", F.concat_ws("#", "file", "left", F.col("first").cast("int"))), values)
        parts = F.split("file", "#")
        wide = F.when(F.col("col") >= 3, parts[2].cast("int")).otherwise(0)
        moved = F.col("col") - F.when(F.col("col") >= 3, 1).otherwise(0) + wide
        return laid.where((F.col("col") != 2) | (parts[2] == "1")).select(
            parts[0].alias("file"), "sheet", "row", (parts[1].cast("int") + moved).cast("int").alias("col"), "value"
        )
    months = {n + 2: F.col(f"m{n}") for n in range(1, 13)}
    grid = place(body, {0: F.col("id"), 1: F.col("name"), 2: F.col("unit"), **months})
    odd = F.col("year") % 2 == 1
    top = place(heads.withColumn("row", F.lit(0)), {3: F.when(odd, text_of("year")), 4: F.when(~odd, text_of("year"))})
    second = place(heads.withColumn("row", F.lit(1)), {0: F.lit("id"), 1: F.lit("name"), 2: F.lit("unit"), **{n + 2: F.lit(f"month {n}") for n in range(1, 13)}})
    return finance.historical_volumes(stored(grid.unionByName(top).unionByName(second)), "1:60")


def volume_workbooks(t, month, per_file, factor=1):
    """One workbook per year and ``per_file`` departments."""
    amounts = [(F.col(f"m{n}").cast("bigint") * factor).cast("string").alias(f"m{n}") for n in range(1, 13)]
    rows = monthly(t).select(
        F.concat(F.lit(f"({month:02d}) "), text_of("year"), F.lit(" Dashboard "), F.floor(F.col("l_suppkey") / per_file).cast("string")).alias("file"),
        F.dense_rank().over(_by_file(per_file)).alias("row"),
        F.concat(F.lit("S"), text_of("l_suppkey")).alias("id"), F.concat(F.lit("Supplier "), text_of("l_suppkey")).alias("name"),
        F.when(F.col("l_suppkey") % 3 == 0, "Days").when(F.col("l_suppkey") % 3 == 1, "Tests").alias("unit"), *amounts,
    )
    heads = rows.select("file").distinct().withColumn("row", F.lit(0))
    titles = {0: F.lit("ID"), 1: F.lit("Name"), 2: F.lit("Unit"), **{n + 2: F.lit(f"month {n}") for n in range(1, 13)}}
    body = cells(rows, {0: F.col("id"), 1: F.col("name"), 2: F.col("unit"), **{n + 2: F.col(f"m{n}") for n in range(1, 13)}})
    last = rows.groupBy("file").agg((F.max("row") + 3).alias("row"))
    note = cells(last, {0: F.lit("a note below the table")})
    return body.unionByName(cells(heads, titles)).unionByName(note)


@query("current_volumes", VOLUME_SQL)
def current_volumes(t):
    """One workbook per year and fifty departments."""
    return finance.current_volumes(stored(volume_workbooks(t, 6, 50)))


@query("newest_workbooks", VOLUME_SQL)
def newest_workbooks(t):
    """Two months' workbooks of each year: every month counts once, as in the newer one."""
    both = volume_workbooks(t, 9, 1_000_000_000).unionByName(volume_workbooks(t, 2, 1_000_000_000, factor=7))
    return finance.current_volumes(finance.newest_workbooks(stored(both)))


def _by_file(per_file=50):
    from pyspark.sql import Window

    return Window.partitionBy("year", F.floor(F.col("l_suppkey") / per_file)).orderBy("l_suppkey")


@query(
    "historical_budget",
    """
SELECT 'U' || CAST(p_partkey AS VARCHAR) AS dept_id, p_name AS dept_name, 2024 AS year, CAST(p_size AS DOUBLE) AS budget_fte, p_retailprice AS budget_prod_hrs,
  0.0 AS budget_contracted_hours, CAST(CASE WHEN p_size > 10 THEN p_size * 2 ELSE 0 END AS DOUBLE) AS budget_volume,
  CAST(CASE WHEN p_partkey % 4 <> 1 THEN p_partkey ELSE 0 END AS DOUBLE) AS budget_uos, CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size / 4 ELSE 0 END AS DOUBLE) AS budget_prod_hrs_per_uos,
  0.0 AS hourly_rate FROM part WHERE p_partkey % 100 <> 7
""",
)
def historical_budget(t):
    """Three sheets per workbook: budget, goals and last year's units."""
    rows = t.part.select(
        F.concat(F.lit("w"), F.floor(F.col("p_partkey") / 100).cast("string")).alias("file"), (F.col("p_partkey") % 100 + 6).cast("int").alias("row"),
        F.when(F.col("p_partkey") % 100 != 7, F.concat(F.lit("U"), text_of("p_partkey"))).alias("id"), "p_partkey", "p_name", "p_size", "p_retailprice",
    )
    budget = cells(rows, {0: F.col("id"), 1: F.col("p_name"), 2: text_of("p_size"), 5: text_of("p_retailprice"), 6: F.when(F.col("p_size") > 10, (F.col("p_size") * 2).cast("string"))})
    below = cells(rows.select("file").distinct().withColumn("row", F.lit(110)), {0: F.lit("U0"), 1: F.lit("second table")})
    goals = cells(rows.withColumn("row", F.col("row") - 4).where(F.col("p_partkey") % 3 != 0), {1: F.col("id"), 0: (F.col("p_size") / 4).cast("string")})
    filler = cells(rows.withColumn("row", F.col("row") - 4), {2: F.lit("x")})
    titles = cells(rows.select("file").distinct().withColumn("row", F.lit(1)), {0: F.lit("GOAL"), 1: F.lit("ID"), 2: F.lit("note")})
    units = cells(rows.withColumn("row", F.col("row") - 4), {17: F.col("id"), 18: F.lit("m"), 19: F.when(F.col("p_partkey") % 4 != 1, text_of("p_partkey"))})
    sheets = {"Budget": budget.unionByName(below), "Goals": goals.unionByName(filler).unionByName(titles), "UOS": units}
    grid = [df.withColumn("sheet", F.lit(n)) for n, df in sheets.items()]
    sheets = stored(grid[0].unionByName(grid[1]).unionByName(grid[2]))
    return finance.historical_budget(sheets, "Budget", "Goals", "UOS", 2024)


@query(
    "current_budget",
    """
SELECT 'U' || CAST(p_partkey AS VARCHAR) AS dept_id, p_name AS dept_name, 2025 AS year, CAST(p_size AS DOUBLE) AS budget_fte, p_retailprice AS budget_prod_hrs,
  CAST(p_size * 3 AS DOUBLE) AS budget_contracted_hours, 0.0 AS budget_volume, CAST(p_size % 5 AS DOUBLE) AS budget_uos,
  CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_retailprice / CAST(p_size % 5 AS DOUBLE) END AS budget_prod_hrs_per_uos, CAST(p_size AS DOUBLE) AS hourly_rate FROM part
""",
)
def current_budget(t):
    rows = t.part.select(
        F.concat(F.lit("w"), F.floor(F.col("p_partkey") / 100).cast("string")).alias("file"), (F.col("p_partkey") % 100 + 6).cast("int").alias("row"),
        F.concat(F.lit("U"), text_of("p_partkey")).alias("id"), "p_name", "p_size", "p_retailprice",
    )
    grid = cells(
        rows,
        {
            0: F.lit("2/28/2025"), 1: F.col("id"), 2: F.col("p_name"), 3: text_of("p_size"), 7: (F.col("p_size") * 3).cast("string"),
            8: text_of("p_retailprice"), 10: (F.col("p_size") % 5).cast("string"), 12: text_of("p_size"),
        },
    )
    return finance.current_budget(grid)


@query(
    "contracted_hours",
    f"""
SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS name, o_orderstatus AS type, dept_name, dept_id, strftime(o_orderdate, '%Y-%m') AS month,
  CAST(o_orderkey % 40 AS DOUBLE) AS reg_hrs, CAST(NULL AS DOUBLE) AS overtime_hrs, 1.5 AS call_hrs, CAST(NULL AS DOUBLE) AS holiday_hrs, CAST(NULL AS DOUBLE) AS callback_hrs,
  2.0 AS other_hrs, CAST(o_orderkey % 40 AS DOUBLE) AS total_hrs
FROM (SELECT *, {dept_sql('o_custkey')} FROM orders) WHERE o_orderkey % 40 <> 0 AND o_orderkey % 13 <> 0 AND o_custkey % 5 < 4 AND (o_orderkey // 500) % 2 = 0
""",
)
def contracted_hours(t):
    """Data sheets chosen by name, month from the end date or the invoice date."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "M/d/yyyy")
    rows = t.orders.select(
        F.concat(F.lit("k"), F.floor(key / 500).cast("string")).alias("file"), (key % 500 + 2).cast("int").alias("row"), "o_orderkey", "o_orderstatus",
        label("o_custkey").alias("dept"), (F.col("o_custkey") % 5 < 4).alias("known"), day.alias("day"),
    )
    grid = cells(
        rows,
        {
            0: F.when((key % 13 != 0) & F.col("known"), F.concat(F.lit("T"), text_of("o_orderkey"))), 1: F.col("o_orderstatus"),
            2: F.col("dept"), 3: F.when(key % 3 == 0, "?").when(key % 3 == 1, F.col("day")), 4: F.col("day"),
            5: (key % 40).cast("string"), 6: F.lit("1.5"), 7: F.lit("2"), 8: (key % 40).cast("string"),
        },
    )
    titles = ["Traveler Name", "License Type", "Cost Center", "Date End", "Invoice Date", "Regular", "On-Call", "Other ", "Total Hours"]
    heads = cells(rows.select("file").distinct().withColumn("row", F.lit(1)), {i: F.lit(x) for i, x in enumerate(titles)})
    even = F.substring("file", 2, 20).cast("bigint") % 2 == 0
    sheets = grid.unionByName(heads).withColumn("sheet", F.when(even, "2024 DATA").otherwise("NOTES"))
    return finance.contracted_hours(stored(sheets), *alias_tables(t))


@query(
    "income_statement",
    f"""
SELECT '2024-' || lpad(CAST(o_orderkey // 500 % 12 + 1 AS VARCHAR), 2, '0') AS month, 'A' || CAST(o_orderkey AS VARCHAR) AS ledger_acct,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE coalesce(dept_id, 'Ward') END AS dept_id, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE coalesce(dept_name, 'Ward') END AS dept_name,
  CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderpriority END AS spend_category, CAST(NULL AS VARCHAR) AS revenue_category,
  o_totalprice AS actual, CAST(o_orderkey AS DOUBLE) AS budget, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice * 2 END AS actual_ytd, CAST(NULL AS DOUBLE) AS budget_ytd
FROM (SELECT *, {dept_sql('o_custkey')} FROM orders)
""",
)
def income_statement(t):
    """Anchor at a varying row; blanks, unknown centers and the month above the table."""
    return finance.income_statement(income_grid(t), *alias_tables(t))


@query(
    "unknown_cost_centers",
    f"""SELECT CASE WHEN o_orderkey % 7 = 0 THEN '(Blank)' ELSE 'Ward' END AS cost_center, count(*) AS rows
FROM (SELECT *, {dept_sql('o_custkey')} FROM orders) WHERE o_orderkey % 7 = 0 OR dept_id IS NULL GROUP BY 1""",
)
def unknown_cost_centers(t):
    """Report of the cost centers that no alias names."""
    return finance.unknown_cost_centers(income_grid(t), *alias_tables(t))


def income_grid(t):
    key = F.col("o_orderkey")
    number = F.floor(key / 500)
    top = (number % 3 + 1).cast("int")
    rows = t.orders.select(
        F.concat(F.lit("i"), number.cast("string")).alias("file"), number.alias("number"), top.alias("top"), (key % 500 + top + 1).cast("int").alias("row"),
        "o_orderkey", "o_orderpriority", "o_totalprice", F.when(key % 7 == 0, "(Blank)").otherwise(label("o_custkey")).alias("center"),
    )
    body = cells(
        rows,
        {
            0: F.concat(F.lit("A"), text_of("o_orderkey")), 1: F.col("center"), 2: F.when(key % 2 == 0, "(Blank)").otherwise(F.col("o_orderpriority")),
            4: text_of("o_totalprice"), 5: text_of("o_orderkey"), 6: F.lit("unused"), 11: F.when(key % 3 != 0, (F.col("o_totalprice") * 2).cast("string")),
        },
    )
    heads = rows.select("file", "number", "top").distinct()
    title = cells(heads.withColumn("row", F.col("top")), {0: F.lit("Ledger Account"), 1: F.lit("Cost Center")})
    month = F.concat(F.lit("Month to Date: "), F.lpad((F.col("number") % 12 + 1).cast("string"), 2, "0"), F.lit("/2024"))
    above = cells(heads.withColumn("row", F.col("top") - 1), {4: month})
    return stored(body.unionByName(title).unionByName(above))


PERIOD_SQL = """CAST(DATE '2022-12-17' + CAST(14 * ceil(date_diff('day', DATE '2023-01-06', make_date({y}, 1, 1)) / 14.0) AS INTEGER) + CAST(14 * ({n} - 1) AS INTEGER) AS DATE)"""


def hour_rows(t, *extra):
    """Twenty rows per block and twenty-six blocks per year of customers."""
    block = F.floor(F.col("c_custkey") / 20)
    return t.customer.select(
        block.alias("block"), (block % 26 + 1).cast("int").alias("period"), (F.floor(block / 26) + 2023).cast("int").alias("year"),
        (F.col("c_custkey") % 20).cast("int").alias("line"), label("c_custkey").alias("dept"), "c_custkey", "c_acctbal", *extra,
    )


HOURS_SQL = f"""
h AS (SELECT c_custkey // 20 % 26 + 1 AS n, CAST(c_custkey // 20 // 26 + 2023 AS INTEGER) AS y, c_custkey, c_acctbal, {dept_sql('c_custkey')} FROM customer)
"""


@query(
    "historical_hours",
    f"""WITH {HOURS_SQL}
SELECT '2023-' || lpad(CAST(n AS VARCHAR), 2, '0') AS pay_period, dept_id, dept_name, CAST(CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 80 ELSE 0 END AS DOUBLE) AS reg_hrs,
  0.0 AS overtime_hrs, 10.0 AS prod_hrs, CAST(NULL AS DOUBLE) AS nonprod_hrs, CAST(c_custkey AS DOUBLE) AS total_hrs, c_acctbal AS total_amt, 0.5 AS total_fte,
  CASE WHEN year({PERIOD_SQL.format(y=2023, n='n')} + 13) <= 2023 THEN strftime({PERIOD_SQL.format(y=2023, n='n')}, '%Y-%m-%d') END AS start_date FROM h WHERE dept_id IS NOT NULL""",
)
def historical_hours(t):
    """Blocks between period and total marks, one sheet for every twenty-six periods."""
    rows = hour_rows(t)
    at = (F.col("period") - 1) * 30
    file = F.concat(F.lit("y"), text_of("year")).alias("file")
    body = cells(
        rows.select(file, (at + 4 + F.col("line")).cast("int").alias("row"), "dept", "c_custkey", "c_acctbal"),
        {
            0: text_of("c_custkey"), 1: F.col("dept"), 2: F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 80).cast("string")),
            4: F.lit("not read"), 6: F.lit("10"), 13: text_of("c_custkey"), 25: text_of("c_acctbal"), 27: F.lit("0.5"),
        },
    )
    blocks = rows.select(file, at.alias("at"), "period").distinct()
    line = lambda down, values: cells(blocks.withColumn("row", (F.col("at") + down).cast("int")), values)
    grid = (
        body.unionByName(line(0, {0: F.lit("Pay Period"), 1: F.lit("Period End")}))
        .unionByName(line(1, {0: text_of("period"), 1: F.lit("1/1/2023")}))
        .unionByName(line(3, {0: F.lit("Number"), 1: F.lit("Name")}))
        .unionByName(line(24, {1: F.lit("Lab"), 2: F.lit("9999")}))
        .unionByName(line(26, {1: F.lit("Total"), 2: F.lit("9999")}))
    )
    return shown(finance.historical_hours(stored(grid), 2023, *alias_tables(t)), "start_date")


CURRENT_HOURS_SQL = f"""
{HOURS_SQL},
c AS (SELECT CAST(y AS VARCHAR) || '-' || lpad(CAST(n AS VARCHAR), 2, '0') AS pay_period, dept_id, dept_name, CAST(c_custkey % 80 AS DOUBLE) AS reg_hrs,
  CAST(c_custkey % 7 + 2 AS DOUBLE) AS overtime_hrs, 10.0 AS prod_hrs, 4.0 AS nonprod_hrs, CAST(c_custkey AS DOUBLE) AS total_hrs, c_acctbal AS total_amt, 0.5 AS total_fte,
  CASE WHEN year({PERIOD_SQL.format(y='y', n='n')} + 13) <= y THEN {PERIOD_SQL.format(y='y', n='n')} END AS st FROM h WHERE dept_id IS NOT NULL)
"""


def current_hour_grid(t):
    """One workbook per period, two header rows, a leading column in some."""
    rows = hour_rows(t).withColumn(
        "file", F.concat(F.lit("PP#"), text_of("period"), F.lit(" "), text_of("year"), F.lit(" Payroll.xlsx"))
    ).withColumn("shift", (F.col("block") % 2).cast("int"))
    body = cells(
        rows.withColumn("row", F.col("line") + 5),
        {
            0: text_of("c_custkey"), 1: F.col("dept"), 2: (F.col("c_custkey") % 80).cast("string"), 3: F.lit("1"), 4: (F.col("c_custkey") % 7).cast("string"),
            5: F.lit("9"), 6: F.lit("2"), 7: F.lit("10"), 8: F.lit("4"), 9: text_of("c_custkey"), 10: text_of("c_acctbal"), 11: F.lit("0.5"),
        },
    )
    files = rows.select("file", "shift").distinct()
    first = ["Department Number", "Department Name", "Productive", None, None, "Holiday", None, "Total Productive Hours", "Total Non-Productive Hours",
             "Total Productive/Non-Productive Hours", "Total Dollars", "Total FTE"]
    second = {2: "Regular Hours", 3: "CALLBK - CALLBACK", 4: "DBLTME - DOUBLETIME", 5: "HOL", 6: "OT_1.5 - OVERTIME"}
    top = cells(files.withColumn("row", F.lit(3)), {i: F.lit(x) for i, x in enumerate(first) if x})
    below = cells(files.withColumn("row", F.lit(4)), {i: F.lit(x) for i, x in second.items()})
    moved = body.unionByName(top).unionByName(below).join(files, "file").withColumn("col", F.col("col") + F.col("shift")).drop("shift")
    lead = cells(files.where("shift = 1").withColumn("row", F.lit(3)), {0: F.lit("Period")})
    title = cells(files.withColumn("row", F.lit(0)), {0: F.lit("Payroll report")})
    return stored(moved.unionByName(lead).unionByName(title))


@query("current_hours", f"WITH {CURRENT_HOURS_SQL} SELECT * EXCLUDE (st), strftime(st, '%Y-%m-%d') AS start_date FROM c")
def current_hours(t):
    """Hours by period from two-line headers and file names."""
    return shown(finance.current_hours(current_hour_grid(t), *alias_tables(t)), "start_date")


@query(
    "hours_job",
    f"""WITH {CURRENT_HOURS_SQL},
f AS (SELECT *, least(14, day(last_day(st)) - day(st) + 1) AS n, st + 13 AS en FROM c WHERE st IS NOT NULL),
x AS (SELECT *, st AS d, n AS days FROM f UNION ALL SELECT *, en, 14 - n FROM f WHERE month(st) <> month(en)),
g AS (SELECT dept_id, dept_name, date_trunc('month', d) AS m, sum(CAST(reg_hrs AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS reg_hrs,
  sum(CAST(overtime_hrs AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS overtime_hrs, sum(CAST(prod_hrs AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS prod_hrs,
  sum(CAST(nonprod_hrs AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS nonprod_hrs, sum(CAST(total_hrs AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS total_hrs, sum(CAST(total_amt AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS total_amt,
  sum(CAST(total_fte AS DECIMAL(24,8)) * CAST(days AS DECIMAL(2,0))) AS total_fte FROM x GROUP BY ALL)
SELECT dept_id, dept_name, strftime(m, '%Y-%m') AS month, CAST(reg_hrs AS DOUBLE) / 14 AS reg_hrs, CAST(overtime_hrs AS DOUBLE) / 14 AS overtime_hrs,
  CAST(prod_hrs AS DOUBLE) / 14 AS prod_hrs, CAST(nonprod_hrs AS DOUBLE) / 14 AS nonprod_hrs, CAST(total_hrs AS DOUBLE) / 14 AS total_hrs, CAST(total_amt AS DOUBLE) / 14 AS total_amt, CAST(total_fte AS DOUBLE) / day(last_day(m)) AS total_fte FROM g""",
)
def hours_job(t):
    """From workbooks by period to calendar months."""
    return finance.hours_by_month(finance.current_hours(current_hour_grid(t), *alias_tables(t)))


@query(
    "balance_job",
    """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(o_orderkey + 20 AS DOUBLE) AS row, CAST(o_orderkey % 4 AS INTEGER) AS indent, 'A' || CAST(o_orderkey AS VARCHAR) AS acct,
    o_totalprice AS actual, CAST(o_orderkey AS DOUBLE) AS prev_month, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 END AS prev_year FROM orders WHERE o_orderkey % 11 <> 0),
k AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders),
a AS (SELECT * FROM o UNION ALL SELECT month, 7, 0, 'Net Patient Accounts Receivable', 1, NULL, NULL FROM k UNION ALL SELECT month, 7.5, 1, 'Other Receivables', NULL, NULL, NULL FROM k
  UNION ALL SELECT month, 8, 2, 'First', 2, NULL, NULL FROM k),
n AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY row) AS line_num FROM a),
d AS (SELECT *, least(line_num, line_num + 1 + min(indent - line_num) OVER (PARTITION BY month ORDER BY row)) AS depth FROM n),
p AS (SELECT *, last_value(CASE WHEN depth = 1 THEN acct END IGNORE NULLS) OVER w AS a1, last_value(CASE WHEN depth = 2 THEN acct END IGNORE NULLS) OVER w AS a2,
  last_value(CASE WHEN depth = 3 THEN acct END IGNORE NULLS) OVER w AS a3, last_value(CASE WHEN depth = 4 THEN acct END IGNORE NULLS) OVER w AS a4
  FROM d WINDOW w AS (PARTITION BY month ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT month, array_to_string(list_slice([a1, a2, a3, a4], 1, depth), '|') AS tree, line_num, acct AS ledger_acct, actual, prev_month AS actual_prev_month, prev_year AS actual_prev_year FROM p
""",
)
def balance_job(t):
    """One workbook per month: checked period, inserted heading, tree paths, line numbers."""
    key = F.col("o_orderkey")
    file = F.date_format("o_orderdate", "'('MM') 'MMM yyyy' Balance Sheet.xlsx'").alias("file")
    rows = t.orders.select(
        file, (key + 20).cast("int").alias("row"), (key % 4).cast("int").alias("indent"), "o_orderkey", "o_totalprice",
        F.when(key % 22 == 0, "Check - total").when(key % 11 == 0, "   ").otherwise(F.concat(F.lit(" A"), text_of("o_orderkey"))).alias("acct"),
    )
    def indented(df, values):
        laid = cells(df, values)
        marks = df.select("file", "row", "indent", F.lit(0).alias("col"))
        return laid.join(marks, ["file", "row", "col"], "left")
    body = indented(rows, {0: F.col("acct"), 1: text_of("o_totalprice"), 2: text_of("o_orderkey"), 3: F.lit("x"), 4: F.when(key % 2 == 0, (F.col("o_totalprice") * 2).cast("string"))})
    months = t.orders.select(file, F.date_format("o_orderdate", "yyyy - MMM").alias("period")).distinct()
    fixed = lambda row, indent, values: indented(months.withColumns({"row": F.lit(row), "indent": F.lit(indent)}), values)
    grid = (
        body.unionByName(fixed(2, 0, {0: F.lit("Period"), 1: F.col("period")}))
        .unionByName(fixed(7, 0, {0: F.lit("Net Patient Accounts Receivable"), 1: F.lit("1")}))
        .unionByName(fixed(8, 2, {0: F.lit("First"), 1: F.lit("2")}))
    )
    return finance.balance_sheet(stored(grid))


@query(
    "aged_receivables",
    "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS aged_days, o_totalprice AS total, o_custkey AS num_accts FROM orders",
)
def aged_receivables(t):
    rows = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("a"), F.col("o_orderpriority").alias("b"), F.col("o_totalprice").alias("c"), F.col("o_custkey").alias("d")
    )
    return finance.aged_receivables(csv.read_positional(t.spark, write_csv(rows, t, "aged"), layouts.AGED_AR))


@query(
    "misc_volumes",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS metric, count(*) AS volume FROM orders GROUP BY ALL",
)
def misc_volumes(t):
    rows = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("a"), "o_orderpriority").agg(F.count("*").alias("c"))
    return csv.read_positional(t.spark, write_csv(rows, t, "misc"), layouts.MISC_VOLUMES)
