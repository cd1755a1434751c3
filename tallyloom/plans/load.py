"""The nightly load: read extracts, run the jobs, write the tables.

Persons go first, as they make the id map; then encounters, notes, charges and imaging in any
order; panels last. Each step reads what the others wrote, so steps can run as separate
applications.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.checks import input_report, require_inputs
from tallyloom.plans import finance
from tallyloom.plans.clinical import charges_job, fee_table, imaging_job, notes_job, visit_job
from tallyloom.plans.panels import panel_job
from tallyloom.plans.persons import LOCATION, SENSITIVE, person_job
from tallyloom.session import cut_lineage, scratch
from tallyloom.sources import csv, files, layouts, tables
from tallyloom.sources.files import file_name

# Names of the extracts, and the rows a person extract must have.
PERSON_FILES = {
    "persons": ("patients.csv", layouts.PERSONS),
    "allergies": ("allergy.csv", layouts.ALLERGIES),
    "problems": ("problem-list.csv", layouts.PROBLEMS),
    "portal": ("mychart.csv", layouts.PORTAL),
}
PERSON_FLOOR = 10_000
ENCOUNTERS_FILE = "encounters.csv"
ED_FILE = "encounters-ed.csv"
INPATIENT_FILE = "encounters-inpt.csv"
NOTES_FILE = "notes-inpt-ed.csv"
IMAGING_FILE = "imaging.csv"
FEE_FILES = r"^PPRRVU.*\.csv$"


def _replace(out: Mapping[str, DataFrame], target: str) -> None:
    for name, df in out.items():
        tables.write_snapshot(df, f"{target}/{name}", df.schema)


def load_persons(
    spark: SparkSession, source: str, target: str, id_target: str, as_of, floor: int = PERSON_FLOOR
) -> None:
    """Person tables to ``target``; ids and personal columns to ``id_target``."""
    with scratch(spark):
        # Parsed once; the counts and all outputs are made from the kept rows.
        read = {
            name: cut_lineage(csv.read_positional(spark, f"{source}/{file}", layout, keep_order=True, multiline=True))
            for name, (file, layout) in PERSON_FILES.items()
        }
        require_inputs(input_report(read, {name: floor for name in read}))
        out = person_job(*read.values(), as_of=as_of)
        _replace({n: out[n] for n in ("id", "id_details")}, id_target)
        _replace({n: out[n] for n in ("person", "portal", "person_lists")}, target)


def id_map(spark: SparkSession, id_target: str) -> DataFrame:
    """Person id, source id and birth date, and nothing else; no rows before the first run."""
    return tables.read_or_empty(spark, f"{id_target}/id_details", _pick(["person_id", "source_id", "dob"]))


def _pick(names: list[str]) -> T.StructType:
    return T.StructType([layouts.PERSONS[n] for n in names])


def load_encounters(spark: SparkSession, source: str, target: str, id_target: str) -> DataFrame:
    """Encounter tables; returns the ED rows per unknown source id."""
    read = {"keep_order": False, "multiline": True}
    ed = csv.read_named(spark, f"{source}/{ED_FILE}", layouts.ED_ENCOUNTERS, layouts.ED_NAMES, **read)
    with scratch(spark):
        out = visit_job(
            csv.read_positional(spark, f"{source}/{ENCOUNTERS_FILE}", layouts.ENCOUNTERS, **read),
            cut_lineage(ed),  # for the table and for the report
            csv.read_named(spark, f"{source}/{INPATIENT_FILE}", layouts.INPATIENT, layouts.INPATIENT_NAMES, **read),
            id_map(spark, id_target),
        )
        unknown = cut_lineage(out.pop("unknown_ids"), stay=True)
        out["outpatient"] = out["outpatient"].drop("dob")
        _replace(out, target)
    return unknown


def load_notes(spark: SparkSession, source: str, target: str, id_target: str, salt: str, ed_dept: str, **types: list[str]) -> None:
    """Note tables; new ids are appended to the id map, once. ``types`` are options of ``notes_job``."""
    with scratch(spark):
        rows = csv.read_named(spark, f"{source}/{NOTES_FILE}", layouts.NOTES, layouts.NOTES_NAMES, multiline=True)
        # The map is read before it is written to; the notes are parsed once.
        out = notes_job(cut_lineage(rows), cut_lineage(id_map(spark, id_target)), salt, ed_dept, **types)
        new = cut_lineage(out.pop("new_ids"))
        _replace(out, target)
        tables.append_new(new.select("person_id", "source_id"), f"{id_target}/id", "source_id")
        details = f"{id_target}/id_details"
        layout = spark.read.parquet(details).schema if tables.exists(spark, details) else _pick(["person_id", *SENSITIVE, *LOCATION])
        named = new.select(
            *[F.col(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in layout]
        )
        tables.append_new(named, details, "source_id")


def load_fees(spark: SparkSession, folder: str, supplement: str) -> DataFrame | None:
    """Rate per procedure code from the newest main table and a supplement; None without one."""
    found = files.latest_file(files.discover_files(spark, folder), FEE_FILES).collect()
    if not found:
        return None
    main = csv.read_preamble(
        spark, found[0]["path"], layouts.FEE_SKIP, layouts.FEE_WIDTH, layouts.FEE_MAIN, layouts.FEES, keep_order=True
    )
    extra = csv.read_preamble(
        spark, f"{folder}/{supplement}", layouts.FEE_SKIP, layouts.FEE_WIDTH, layouts.FEE_SUPPLEMENT,
        layouts.FEES_SUPPLEMENT, keep_order=True,
    )
    return fee_table(main, extra)


def load_charges(
    spark: SparkSession,
    source: str,
    current: str | None,
    target: str,
    id_target: str,
    salt: str,
    fees: DataFrame | None = None,
    backfill: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Merge the last two files, or all on backfill, into the table at ``current``.

    The merged table is written to ``target``, which must be another path. Returns the file list
    loaded and the ids that were missing.
    """
    chosen = files.last_n_files(files.discover_files(spark, source), backfill=backfill)
    paths = [r["path"] for r in chosen.select("path").collect()]
    if not paths:
        raise ValueError(f"no charges files found in {source}")
    with scratch(spark):
        rows = csv.read_by_header(spark, paths, layouts.CHARGES, layouts.CHARGES_NAMES, keep_order=True)
        stored = tables.read_table(spark, current) if current else None
        out = charges_job(cut_lineage(rows), id_map(spark, id_target), salt, fees, stored, csv.FILE_ORDER)
        tables.write_snapshot(out["charges"], target, out["charges"].schema)
        missing = cut_lineage(out["missing_ids"], stay=True)
    return chosen, missing


def load_imaging(spark: SparkSession, source: str, target: str) -> None:
    rows = csv.read_named(spark, f"{source}/{IMAGING_FILE}", layouts.IMAGING, layouts.IMAGING_NAMES, multiline=True)
    _replace({"imaging": imaging_job(rows)}, target)


def load_panels(
    spark: SparkSession,
    target: str,
    as_of,
    peds_clinics: list[str],
    clinics: list[str],
    provider_to_site: Mapping[str, str],
    peds_site: str,
    **types: list[str],
) -> None:
    """Panels from the person and outpatient tables. ``types`` are options of ``panel_job``."""
    panel = panel_job(
        tables.read_table(spark, f"{target}/person", ["person_id", "age"]),
        tables.read_table(spark, f"{target}/outpatient"),
        as_of, peds_clinics, clinics, provider_to_site, peds_site, **types,
    )
    _replace({"panel": panel}, target)


def log_run(
    spark: SparkSession, current: str | None, target: str, dataset: str, sources: DataFrame | None, ran_at: dt.datetime
) -> None:
    """Write the merged ingest log to ``target``; ``sources`` is a file list."""
    if current:
        meta, seen = tables.read_table(spark, f"{current}/meta"), tables.read_table(spark, f"{current}/sources")
    else:
        meta, seen = spark.createDataFrame([], tables.META), spark.createDataFrame([], tables.SOURCES_META)
    meta, seen = tables.log_ingest(meta, seen, dataset, sources, ran_at)
    tables.write_snapshot(meta, f"{target}/meta", tables.META)
    tables.write_snapshot(seen, f"{target}/sources", tables.SOURCES_META)


def cells_of(spark: SparkSession, path: str) -> DataFrame:
    """Cell grids kept as parquet, with ``file`` cut to its base name."""
    return tables.read_table(spark, path).withColumn("file", file_name(F.col("file")))


def load_finance(
    spark: SparkSession,
    grids: Mapping[str, str],
    csv_files: Mapping[str, str],
    target: str,
    aliases: DataFrame,
    canonical: DataFrame,
    historical_year: int,
    sheets: Mapping[str, str],
    hours_year: int,
    historical_rows: str,
    first_year: int = 0,
) -> DataFrame:
    """Finance tables from cell grids (``grids``: kind -> path) and two CSV files.

    Of the workbooks of one year, from ``first_year`` on, the newest month counts.
    ``historical_rows`` are the sheet rows of the historical volume tables. Returns the income
    statement's rows per cost center without a known name.

    ``sheets`` names the workbook sheets: ``volumes, uos, budget, hours_per_volume`` and, of the
    historical workbook, ``historical_volumes, historical_uos``.
    """
    cells = {kind: cells_of(spark, path) for kind, path in grids.items()}
    past, now = cells["historical_workbook"], finance.newest_workbooks(cells["workbooks"], first_year)

    def on(df: DataFrame, sheet: str) -> DataFrame:
        return df.where(F.col("sheet") == sheets[sheet])

    with scratch(spark):
        by_period = finance.historical_hours(cells["historical_hours"], hours_year, aliases, canonical).unionByName(
            finance.current_hours(cells["hours"], aliases, canonical)
        )
        budget = finance.historical_budget(
            past, sheets["budget"], sheets["hours_per_volume"], sheets["historical_uos"], historical_year
        )
        _replace(
            {
                "volumes": finance.historical_volumes(on(past, "historical_volumes"), historical_rows).unionByName(
                    finance.current_volumes(on(now, "volumes"))
                ),
                "uos": finance.historical_volumes(on(past, "historical_uos"), historical_rows).unionByName(
                    finance.current_volumes(on(now, "uos"))
                ),
                "budget": budget.unionByName(finance.current_budget(on(now, "budget"))),
                "contracted_hours": finance.contracted_hours(cells["contracted_hours"], aliases, canonical),
                "income_statement": finance.income_statement(cells["income_statements"], aliases, canonical),
                "balance_sheet": finance.balance_sheet(cells["balance_sheets"]),
                "hours_by_period": by_period,
                "misc_volumes": csv.read_positional(spark, csv_files["misc_volumes"], layouts.MISC_VOLUMES),
                "aged_receivables": finance.aged_receivables(
                    csv.read_positional(spark, csv_files["aged_receivables"], layouts.AGED_AR)
                ),
            },
            target,
        )
        written = tables.read_table(spark, f"{target}/hours_by_period")
        _replace({"hours": finance.hours_by_month(written)}, target)
        unknown = finance.unknown_cost_centers(cells["income_statements"], aliases, canonical)
        return cut_lineage(unknown, stay=True)
