"""Encounters, notes, charges and imaging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import age_months, age_years, clock, day_key, day_key_or_null
from tallyloom.functions.text import pad_left, procedure_code
from tallyloom.operators.checks import unresolved_report
from tallyloom.operators.cleaning import minus_one_to_null, sentinel_to_null, split_by
from tallyloom.operators.ids import assign_ids
from tallyloom.operators.lookups import lookup, priority_union, rate_replace
from tallyloom.sources.csv import FILE_ORDER
from tallyloom.sources.tables import upsert

# Sentinels and the columns they are cleaned in.
UNSPECIFIED = "*Unspecified"
CHARGE_SENTINELS = [UNSPECIFIED, ""]
CHARGE_TEXTS = ["billing_provider", "posting_user", "modifiers", "reversal_reason"]
NOTE_TEXTS = [
    "dept", "service", "note_type", "diagnosis",
    "author_name", "author_type", "first_author_name", "cosigner_name",
]
IMAGING_TEXTS = ["dept", "modality", "study_status"]

# Notes of these types belong to the emergency department.
ED_NOTE_TYPES = ["ED Provider Notes", "ED Notes", "ED Observation Notes"]
IMPUTED = "Imputed"

ENCOUNTER_COLUMNS = [
    "source_id", "dept", "encounter_date", "encounter_time", "encounter_type", "service_provider",
    "with_pcp", "appt_status", "diagnoses", "diagnoses_icd", "level_of_service",
    "level_of_service_name",
]


def outpatient(rows: DataFrame, id_map: DataFrame) -> DataFrame:
    """Encounters with typed dates, person id, age at the visit and recovered procedure codes."""
    day = day_key(F.col("encounter_date"))
    typed = rows.select(*ENCOUNTER_COLUMNS).withColumns(
        {
            "encounter_date": day,
            "encounter_time": pad_left(F.col("encounter_time"), 4),
            "with_pcp": F.col("with_pcp").cast("boolean"),
            "level_of_service": procedure_code(
                F.col("level_of_service"), F.col("level_of_service_name")
            ),
        }
    )
    known = lookup(typed, id_map.select("source_id", "person_id", "dob"), "source_id")
    return known.withColumns(
        {
            "encounter_age": age_years(F.col("dob"), F.col("encounter_date")),
            "encounter_age_in_mo_under_3": age_months(F.col("dob"), F.col("encounter_date")),
        }
    ).drop("source_id")


def emergency(rows: DataFrame, id_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ED encounters with dates and times of day, and the rows per unknown source id."""
    typed = rows.withColumns(
        {
            "arrival_date": F.to_date("arrival_at"),
            "departure_date": F.to_date("departure_at"),
            "arrival_time": clock(F.col("arrival_at")),
            "departure_time": clock(F.col("departure_at")),
        }
    )
    known = lookup(typed, id_map.select("source_id", "person_id"), "source_id")
    return known.drop("source_id"), unresolved_report(known, "person_id", "source_id")


def inpatient(rows: DataFrame, id_map: DataFrame) -> DataFrame:
    """Inpatient stays; negative date keys mean no date."""
    typed = rows.select(
        "source_id",
        "diagnosis",
        "dept",
        day_key_or_null(F.col("admission_key")).alias("admission_date"),
        day_key_or_null(F.col("discharge_key")).alias("discharge_date"),
    )
    return lookup(typed, id_map.select("source_id", "person_id"), "source_id").drop("source_id")


def visit_job(
    encounters: DataFrame, ed: DataFrame, stays: DataFrame, id_map: DataFrame
) -> dict[str, DataFrame]:
    """Tables ``outpatient, emergency, inpatient`` and the report ``unknown_ids``."""
    ed_rows, unknown = emergency(ed, id_map)
    return {
        "outpatient": outpatient(encounters, id_map),
        "emergency": ed_rows,
        "inpatient": inpatient(stays, id_map),
        "unknown_ids": unknown,
    }


def ed_note(dept: Column, note_type: Column, ed_dept: str, ed_types: list[str] = ED_NOTE_TYPES) -> Column:
    return (dept == ed_dept) | note_type.isin(ed_types)


def notes_job(
    rows: DataFrame, id_map: DataFrame, salt: str, ed_dept: str, ed_types: list[str] = ED_NOTE_TYPES
) -> dict[str, DataFrame]:
    """Tables ``inpatient_notes, ed_notes`` and the new pairs ``new_ids(person_id, source_id, name)``."""
    clean = sentinel_to_null(rows, NOTE_TEXTS, [UNSPECIFIED])
    aged = clean.withColumn("encounter_age", age_years(F.col("dob"), F.col("service_date")))
    known, pairs = assign_ids(aged, id_map, salt)
    ed, inpt = split_by(known, ed_note(F.col("dept"), F.col("note_type"), ed_dept, ed_types))
    # Names are looked for among the notes of new ids only.
    names = rows.join(pairs, "source_id", "left_semi").groupBy("source_id").agg(F.min("name").alias("name"))
    return {
        "inpatient_notes": inpt.drop("source_id", "name", "dob"),
        "ed_notes": ed.drop("source_id", "name", "dob"),
        "new_ids": pairs.join(names, "source_id", "left").select("person_id", "source_id", "name"),
    }


def fee_table(main: DataFrame, supplement: DataFrame, order: list[str] = FILE_ORDER) -> DataFrame:
    """One rate per code: the main table's first row, else the first of the imputed supplement.

    Both carry the columns ``order`` that sort them as in their files.
    """
    imputed = supplement.where(F.col("status_code") == IMPUTED).drop("status_code")
    return priority_union([main, imputed], ["hcpcs"], list(order)).drop(*order)


def typed_charges(rows: DataFrame) -> DataFrame:
    """Date keys to dates, sentinels to null."""
    dated = rows.withColumns(
        {"service_key": day_key(F.col("service_key")), "post_key": day_key(F.col("post_key"))}
    ).withColumnsRenamed({"service_key": "service_date", "post_key": "post_date"})
    return sentinel_to_null(dated, CHARGE_TEXTS, CHARGE_SENTINELS)


def charges_job(
    rows: DataFrame,
    id_map: DataFrame,
    salt: str,
    fees: DataFrame | None,
    target: DataFrame | None,
    order: list[str],
) -> dict[str, DataFrame]:
    """Table ``charges`` after the merge into ``target``, and the ids that were missing.

    ``rows`` holds the files to load and the columns ``order`` that sort them; the later row of
    an id wins. The missing ids are for a warning only: ids come from the person extract.
    """
    known, pairs = assign_ids(typed_charges(rows), id_map, salt)
    priced = rate_replace(known, fees, "procedure_code", "hcpcs", "facility_trvu", "trvu", "quantity")
    ready = priced.drop("source_id")
    base = ready.drop(*order).limit(0) if target is None else target
    return {"charges": upsert(base, ready, "id", order), "missing_ids": pairs}


def imaging_job(rows: DataFrame) -> DataFrame:
    """Imaging exams; -1 means not yet examined."""
    dated = rows.withColumns(
        {
            "scheduled_key": day_key(F.col("scheduled_key")),
            "service_key": day_key(minus_one_to_null(F.col("service_key"))),
        }
    ).withColumnsRenamed({"scheduled_key": "scheduled_date", "service_key": "service_date"})
    return sentinel_to_null(dated, IMAGING_TEXTS, [UNSPECIFIED])


