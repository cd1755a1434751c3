"""Persons: extracts to person, portal, id and id detail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import age_months, age_years, day_key, moment
from tallyloom.operators.cleaning import filter_equals, split_columns
from tallyloom.operators.groups import count_by, dedupe_first, group_to_json, max_row_per_key
from tallyloom.operators.lookups import attach, known_only
from tallyloom.sources.csv import FILE_ORDER

# Columns that identify a person, and those kept in both tables.
SENSITIVE = ["source_id", "name", "dob", "address", "zip", "phone", "email"]
LOCATION = ["city", "state"]


def person_lists(
    rows: DataFrame, persons: DataFrame, columns: list[str], name: str, order: list[str], part_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(``source_id, {name}_count``) and the lists themselves, ``person_id, list, part, json``."""
    counts = count_by(rows.where(F.col("source_id").isNotNull()), "source_id", out=f"{name}_count")
    texts = group_to_json(rows, "source_id", columns, order, "json", part_rows)
    named = texts.join(persons.select("person_id", "source_id"), "source_id")
    return counts, named.select("person_id", F.lit(name).alias("list"), "part", "json")


def person_job(
    persons: DataFrame,
    allergies: DataFrame,
    problems: DataFrame,
    portal: DataFrame,
    as_of,
    order: list[str] = FILE_ORDER,
    part_rows: int = 100_000,
    numeric_ids: bool = False,
    portal_after_dedupe: bool = False,
) -> dict[str, DataFrame]:
    """Tables ``person, portal, id, id_details, person_lists``.

    The inputs carry the columns ``order`` that sort them as in their files. Of several rows with
    one source id the greatest person id stays; as in the extract it compares as text unless
    ``numeric_ids``. ``person`` has the number of entries of each list, 0 for none; the lists
    stand in ``person_lists``, in parts of ``part_rows`` entries.
    """
    kept = max_row_per_key(persons, "source_id", "person_id", ties=order, numeric=numeric_ids).drop(*order)

    known = kept if portal_after_dedupe else persons
    opened = dedupe_first(
        portal.withColumn("mychart_activation_date", day_key(F.col("mychart_activation_date"))),
        ["source_id"],
        order,
    )
    portal_out = known_only(opened.drop(*order), known.select("source_id", "person_id"), "source_id")

    allergies_of, allergy = person_lists(
        allergies, kept, ["name", "reaction", "type", "severity"], "allergy", order, part_rows
    )
    problems_of, problem = person_lists(
        filter_equals(problems, "status", "Active"), kept, ["diagnosis", "icd", "start_date"], "problem", order, part_rows
    )
    now = moment(as_of)
    full = attach(kept, allergies_of, problems_of, on="source_id").withColumns(
        {
            **{c: F.coalesce(c, F.lit(0)) for c in ("allergy_count", "problem_count")},
            "age": age_years(F.col("dob"), now),
            "age_in_mo_under_3": age_months(F.col("dob"), now),
        }
    )
    person, details = split_columns(full, "person_id", SENSITIVE, LOCATION)
    return {
        "person": person,
        "portal": portal_out.drop("source_id"),
        "id": details.select("person_id", "source_id"),
        "id_details": details,
        "person_lists": allergy.unionByName(problem),
    }
