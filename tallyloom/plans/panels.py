"""Assignment of persons to a location or a provider from their visit history.

Visits are ``(person_id, visit_at, visit_order, provider, is_peds, is_well)``: ``visit_at`` decides
whether a visit lies in a time range, ``visit_order`` which of two is later. Everything per person
comes from aggregates combined before the shuffle and from a top three limited before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.contracts import contract
from tallyloom.functions.dates import back
from tallyloom.functions.text import starts_with_any
from tallyloom.operators.cleaning import ensure_columns, filter_all, is_true
from tallyloom.operators.groups import last_k
from tallyloom.operators.lookups import dict_map

# Texts written to assignment_details.
LOCATION_DETAILS = {
    1: "Rule 1: At least 3 visits in the last 2 years, and the last 3 were at peds",
    2: "Rule 2: Last well visit was in the last 2 years AND it was at peds AND at least one of the last 3 visits was at peds",
    3: "Rule 3: No well visit in 2 years AND at least 3 visits in the last 1 year AND majority with peds AND at least one of the last 3 visits was at peds",
}
PROVIDER_DETAILS = {
    1: "1st cut: Patients who have seen only one provider",
    2: "2nd cut: Patients with a majority provider",
    3: "3rd cut: Assign to provider of last well visit",
    4: "4th cut: Assign remaining patients to last provider seen",
}

# Visits that are no office visit, well visits by type and by diagnosis code.
NON_OFFICE_TYPES = [
    "CC CLINICAL SUPPORT",
    "CC NURSE VISIT",
    "CC LAB",
    "CC ANTICOAGULATION",
    "COVID-19 VACCINE",
    "PHS SILENT US",
]
WELL_TYPES = [
    "CC WELL BABY",
    "CC WELL CHILD",
    "CC WELLNESS",
    "CC MEDICARE ANNUAL WELLNESS",
    "CC PHYSICAL",
    "CC WELL WOMEN",
    "CC DOT PHYSICAL",
    "CC MEDICARE SUB AN WELL",
    "CC SPORTS PHYSICAL",
    "CC FAA PHYSICAL",
]
WELL_CODES = ["Z00.", "Z02."]

PANEL = contract(string="person_id panel_location panel_provider assignment_details")


def office_visits(encounters: DataFrame, clinics: list[str], non_office: list[str] = NON_OFFICE_TYPES) -> DataFrame:
    """Completed office visits at the given clinics; a null type counts as an office visit."""
    return filter_all(
        encounters,
        not_in={"encounter_type": non_office},
        equals={"appt_status": "Completed"},
        is_in={"dept": clinics},
    )


def panel_visits(
    encounters: DataFrame,
    peds_clinics: list[str],
    well_types: list[str] = WELL_TYPES,
    well_codes: list[str] = WELL_CODES,
) -> DataFrame:
    """Encounters in the visit shape the rules read."""
    day = F.col("encounter_date").cast("timestamp_ntz")
    minutes = F.coalesce(F.col("encounter_time").try_cast("int"), F.lit(0))
    well = is_true(F.col("encounter_type").isin(well_types)) | starts_with_any(
        F.col("diagnoses_icd"), well_codes
    )
    return encounters.select(
        "person_id",
        day.alias("visit_at"),
        (F.unix_date(F.col("encounter_date").cast("date")).cast("bigint") * 1_000_000 + minutes).alias("visit_order"),
        F.col("service_provider").alias("provider"),
        is_true(F.col("dept").isin(peds_clinics)).alias("is_peds"),
        well.alias("is_well"),
    )


def location_rules(visits: DataFrame, as_of) -> DataFrame:
    """Per person with a visit in the last two years: the first rule that holds, or null.

    1. three or more peds visits, and the last three visits all peds
    2. the latest well visit was peds, and any of the last three visits
    3. no well visit, three or more visits in the last year, most of them peds, and any of the
       last three
    ``no_recent_peds`` says that no peds visit lies in the last 15 months. Of equally late
    visits, peds ones count as later.
    """
    recent = visits.where(F.col("visit_at") >= back(as_of, years=2))
    in_year = F.col("visit_at") >= back(as_of, years=1)
    in_15_months = F.col("visit_at") >= back(as_of, months=15)
    facts = recent.groupBy("person_id").agg(
        F.count_if("is_peds").alias("peds"),
        F.max(F.when(F.col("is_well"), F.col("visit_order"))).alias("well_at"),
        F.max(F.when(F.col("is_well") & F.col("is_peds"), F.col("visit_order"))).alias("peds_well_at"),
        F.count_if(in_year).alias("year"),
        F.count_if(in_year & F.col("is_peds")).alias("year_peds"),
        (F.count_if(in_15_months & F.col("is_peds")) == 0).alias("no_recent_peds"),
    )
    # With three visits in the last year these are also its last three. The order ends with
    # every column the facts read, so both branches need the same columns and Spark runs the
    # exchanges below them (a join that makes the visits, say) once.
    three = last_k(
        recent.select("person_id", "visit_order", "is_peds", "is_well", "visit_at"),
        ["person_id"],
        [F.col(c).desc() for c in ["visit_order", "is_peds", "is_well", "visit_at"]],
        F.col("is_peds"),
    )
    rule = (
        F.when((F.col("peds") >= 3) & F.col("all_hit"), 1)
        .when((F.col("peds_well_at") == F.col("well_at")) & F.col("any_hit"), 2)
        .when(
            F.col("well_at").isNull()
            & (F.col("year") >= 3)
            & (F.col("year_peds") * 2 > F.col("year"))
            & F.col("any_hit"),
            3,
        )
    )
    return facts.join(three, "person_id").select("person_id", rule.alias("rule"), "no_recent_peds")


def location_panel(persons: DataFrame, visits: DataFrame, as_of, excluded_below_age: int = 3) -> DataFrame:
    """``persons(person_id, age)`` with ``rule``, ``excluded`` and ``assigned``.

    A person under the age limit who has recent visits but none at peds for 15 months is
    excluded; a null age never excludes.
    """
    rules = location_rules(visits, as_of)
    excluded = is_true((F.col("age") < excluded_below_age) & F.col("no_recent_peds"))
    return persons.join(rules, "person_id", "left").select(
        *[persons[c] for c in persons.columns],
        "rule",
        excluded.alias("excluded"),
        (F.col("rule").isNotNull() & ~excluded).alias("assigned"),
    )


def provider_panel(visits: DataFrame, as_of, providers: list[str], years: int = 2) -> DataFrame:
    """Per person who saw a known provider: ``(person_id, provider, cut)``.

    1 the only provider, 2 the one with more than half of the visits, 3 the one of the latest
    well visit, 4 the one of the latest visit. Of equally late visits the greater provider wins.
    """
    recent = visits.where(
        (F.col("visit_at") >= back(as_of, years=years)) & F.col("provider").isin(providers)
    )
    seen = recent.groupBy("person_id", "provider").agg(
        F.count("*").alias("n"),
        F.max("visit_order").alias("last_at"),
        F.max(F.when(F.col("is_well"), F.col("visit_order"))).alias("well_at"),
    )
    well = F.when(F.col("well_at").isNotNull(), F.struct("well_at", "provider"))
    person = seen.groupBy("person_id").agg(
        F.count("*").alias("providers"),
        F.sum("n").alias("total"),
        F.max(F.struct("n", "provider")).alias("most"),
        F.max(well)["provider"].alias("well_provider"),
        F.max(F.struct("last_at", "provider"))["provider"].alias("last_provider"),
    )
    cut = (
        F.when(F.col("providers") == 1, 1)
        .when(F.col("most.n") * 2 > F.col("total"), 2)
        .when(F.col("well_provider").isNotNull(), 3)
        .otherwise(4)
    )
    return person.withColumn("cut", cut).select(
        "person_id",
        F.when(F.col("cut") <= 2, F.col("most.provider"))
        .when(F.col("cut") == 3, F.col("well_provider"))
        .otherwise(F.col("last_provider"))
        .alias("provider"),
        "cut",
    )


def panel_job(
    persons: DataFrame,
    encounters: DataFrame,
    as_of,
    peds_clinics: list[str],
    clinics: list[str],
    provider_to_site: Mapping[str, str],
    peds_site: str,
    non_office: list[str] = NON_OFFICE_TYPES,
    well_types: list[str] = WELL_TYPES,
    well_codes: list[str] = WELL_CODES,
) -> DataFrame:
    """Panel of every person: location rules first, then provider cuts for the rest.

    Persons who have a panel location or provider already keep it. ``non_office`` are the visit
    types that are no office visit, ``well_types`` and ``well_codes`` those that are well visits.
    """
    people = ensure_columns(persons, PANEL)
    office = office_visits(encounters, [*peds_clinics, *clinics], non_office)
    visits = panel_visits(office, peds_clinics, well_types, well_codes)
    open_people = people.where(F.col("panel_location").isNull() & F.col("panel_provider").isNull())
    placed = location_panel(open_people.select("person_id", "age"), visits, as_of).where("assigned")
    placed = placed.select("person_id", "rule")
    cuts = provider_panel(visits, as_of, list(provider_to_site))
    free = F.col("panel_location").isNull() & F.col("panel_provider").isNull()
    by_rule, by_cut = F.col("rule").isNotNull(), free & F.col("rule").isNull()
    joined = people.join(placed, "person_id", "left").join(cuts, "person_id", "left")
    rule_text = {str(k): v for k, v in LOCATION_DETAILS.items()}
    cut_text = {str(k): v for k, v in PROVIDER_DETAILS.items()}
    return joined.select(
        "person_id",
        F.when(by_rule, F.lit(peds_site))
        .when(by_cut, dict_map(F.col("provider"), provider_to_site))
        .otherwise(F.col("panel_location"))
        .alias("panel_location"),
        F.when(by_cut, F.col("provider")).otherwise(F.col("panel_provider")).alias("panel_provider"),
        F.when(by_rule, dict_map(F.col("rule").cast("string"), rule_text))
        .when(by_cut, dict_map(F.col("cut").cast("string"), cut_text))
        .otherwise(F.col("assignment_details"))
        .alias("assignment_details"),
    )


def rule_counts(assigned: DataFrame, rule: str) -> DataFrame:
    """Rows per rule, and their share of all rows."""
    counts = assigned.groupBy(rule).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))
