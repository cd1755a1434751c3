import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.plans import clinical, finance
from tallyloom.plans.persons import person_job
from tallyloom.sources import layouts

D = dt.date


def make(frame, layout, *records, extra=""):
    """Rows of a layout from dicts; absent fields are null."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout) + extra
    names = [f.name for f in layout] + [e.split()[0] for e in extra.split(",") if e.strip()]
    return frame(ddl, *[tuple(r.get(n) for n in names) for r in records])


def person_frames(frame):
    line = ", _line bigint"
    persons = make(
        frame, layouts.PERSONS,
        {"person_id": "10", "source_id": "m1", "name": "n", "dob": D(2021, 3, 2), "city": "c", "_line": 1},
        {"person_id": "9", "source_id": "m1", "name": "n9", "dob": D(2021, 3, 2), "city": "c9", "_line": 2},
        {"person_id": "20", "source_id": "m2", "dob": None, "_line": 3},
        {"person_id": "30", "source_id": None, "_line": 4}, extra=line,
    )
    allergies = make(
        frame, layouts.ALLERGIES,
        {"source_id": "m1", "name": "late", "_line": 9}, {"source_id": "m1", "name": "early", "severity": "high", "_line": 2}, {"source_id": "zz", "name": "no one", "_line": 3}, extra=line,
    )
    problems = make(
        frame, layouts.PROBLEMS,
        {"source_id": "m2", "diagnosis": "d", "icd": "I1", "status": "Active", "_line": 1}, {"source_id": "m2", "diagnosis": "old", "status": "Resolved", "_line": 2}, extra=line,
    )
    portal = make(
        frame, layouts.PORTAL,
        {"source_id": "m1", "mychart_status": "second", "mychart_activation_date": "20240102", "_line": 5},
        {"source_id": "m1", "mychart_status": "first", "mychart_activation_date": None, "_line": 1}, {"source_id": "zz", "mychart_status": "x", "_line": 2}, extra=line,
    )
    return persons, allergies, problems, portal


def test_persons(frame):
    out = person_job(*person_frames(frame), as_of="2024-03-01 08:00:00", order=["_line"])
    assert rows(out["person"], "person_id", "age", "age_in_mo_under_3", "city") == [("20", None, None, None), ("9", 2, 35, "c9")]
    assert not set(out["person"].columns) & {"name", "dob", "source_id", "address", "zip", "phone", "email"}
    lists = {(r["person_id"], r["list"], r["part"]): json.loads(r["json"]) for r in out["person_lists"].collect()}
    assert lists == {
        ("9", "allergy", 0): [
            {"name": "early", "reaction": None, "type": None, "severity": "high"}, {"name": "late", "reaction": None, "type": None, "severity": None},
        ],
        ("20", "problem", 0): [{"diagnosis": "d", "icd": "I1", "start_date": None}],
    }
    assert rows(out["person"], "person_id", "allergy_count", "problem_count") == [("20", 0, 1), ("9", 2, 0)]
    assert rows(out["portal"]) == [("first", None, "10"), ("first", None, "9")]
    assert rows(out["id"]) == [("20", "m2"), ("9", "m1")]


def test_person_options(frame):
    out = person_job(*person_frames(frame), as_of="2024-03-01", numeric_ids=True, portal_after_dedupe=True, order=["_line"], part_rows=1)
    assert rows(out["id"]) == [("10", "m1"), ("20", "m2")]
    assert rows(out["portal"], "person_id") == [("10",)]
    assert rows(out["person_lists"], "person_id", "list", "part") == [("10", "allergy", 0), ("10", "allergy", 1), ("20", "problem", 0)]


@pytest.fixture
def id_map(frame):
    return frame("person_id string, source_id string, dob date", ("p1", "m1", D(2022, 1, 31)))


def test_encounters(frame, id_map):
    enc = make(
        frame, layouts.ENCOUNTERS,
        {"source_id": "m1", "encounter_date": "20240229", "encounter_time": "900", "with_pcp": 1, "level_of_service_name": "HC PR 99213 X"},
        {"source_id": "m9", "encounter_date": "20240229", "encounter_time": None, "level_of_service": "set", "level_of_service_name": "HC PR 99213 X"},
    )
    out = clinical.outpatient(enc, id_map)
    got = rows(out, "person_id", "encounter_date", "encounter_time", "with_pcp", "level_of_service", "encounter_age", "encounter_age_in_mo_under_3")
    assert got == sorted([("p1", D(2024, 2, 29), "0900", True, "99213", 2, 24), (None, D(2024, 2, 29), None, None, "set", None, None)], key=repr)
    assert "source_id" not in out.columns and "name" not in out.columns


def test_ed_and_inpatient(frame, id_map):
    at = dt.datetime(2024, 1, 1, 23, 5)
    ed = frame("source_id string, arrival_at timestamp_ntz, departure_at timestamp_ntz", ("m1", at, None), ("m9", at, at + dt.timedelta(hours=1)))
    seen, unknown = clinical.emergency(ed, id_map)
    assert rows(seen, "person_id", "arrival_date", "arrival_time", "departure_time") == sorted([("p1", D(2024, 1, 1), "2305", None), (None, D(2024, 1, 1), "2305", "0005")], key=repr)
    assert rows(unknown) == [("m9", 1)]
    stays = frame("source_id string, admission_key string, discharge_key string, diagnosis string, dept string", ("m1", "20240101", "-1", "d", "w"))
    assert rows(clinical.inpatient(stays, id_map), "person_id", "admission_date", "discharge_date") == [("p1", D(2024, 1, 1), None)]


def test_notes(frame, id_map):
    at = dt.datetime(2024, 1, 30)
    notes = frame(
        "source_id string, name string, dept string, note_type string, service_date timestamp_ntz, dob date",
        ("m1", "n1", "EMERGENCY", "Progress", at, D(2000, 1, 31)), ("m2", "n2", "*Unspecified", "ED Notes", at, None), ("m2", "n2", None, "*Unspecified", at, None), (None, "n3", "W", None, at, None),
    )
    out = clinical.notes_job(notes, id_map, "salt", ed_dept="EMERGENCY")
    assert out["ed_notes"].count() == 2 and out["inpatient_notes"].count() == 2
    assert rows(out["ed_notes"].where("person_id = 'p1'"), "encounter_age") == [(23,)]
    assert rows(out["new_ids"], "source_id", "name") == [("m2", "n2")]
    assert rows(out["inpatient_notes"].where("dept = 'W'"), "person_id") == [(None,)]


def test_charges(frame, id_map):
    extra = ", f int"
    layout = [f for f in layouts.CHARGES]
    names = layouts.CHARGES_NAMES

    def charge(key, code, quantity, f, **more):
        return {"BillingTransactionKey": key, "PrimaryMRN": "m1", "ServiceDateKey": 20240101, "PostDateKey": 20240102, "BillingProcedureCode": code,
                "BillingProcedureQuantity": quantity, "RvuTotal": 7.0, "f": f, **more}

    raw = make(
        frame, layout,
        charge(1, "a", 2, 1, BillingProviderName="*Unspecified", ModifierCodes=""), charge(1, "a", 3, 2, BillingProviderName="Dr"), charge(2, "zz", 1, 1, PrimaryMRN="new"),
        extra=extra,
    ).withColumnsRenamed(names)
    fees = frame("hcpcs string, facility_trvu double", ("a", 1.5))
    out = clinical.charges_job(raw, id_map, "salt", fees, None, ["f"])
    assert rows(out["charges"], "id", "quantity", "trvu", "billing_provider") == [(1, 3, 4.5, "Dr"), (2, 1, None, None)]
    assert rows(out["missing_ids"], "source_id") == [("new",)]
    again = clinical.charges_job(raw, id_map, "salt", fees, out["charges"], ["f"])
    assert rows(again["charges"]) == rows(out["charges"])
    kept = clinical.charges_job(raw, id_map, "salt", None, None, ["f"])["charges"]
    assert rows(kept, "id", "trvu") == [(1, 7.0), (2, 7.0)]


def test_fee_table(frame):
    ddl = "hcpcs string, wrvu double, nonfacility_trvu double, facility_trvu double, n int"
    main = frame(ddl, ("a", 1.0, 1.0, 9.0, 1), ("a", 2.0, 2.0, 1.0, 2))
    extra = frame(f"{ddl}, status_code string", ("a", 0.0, 0.0, 0.0, 1, "Imputed"), ("b", 3.0, 3.0, 3.0, 2, "Imputed"), ("c", 4.0, 4.0, 4.0, 3, "Real"))
    assert rows(clinical.fee_table(main, extra, ["n"]), "hcpcs", "facility_trvu") == [("a", 9.0), ("b", 3.0)]


def test_imaging(frame):
    raw = make(
        frame, layouts.IMAGING,
        {"ImagingKey": 1, "DepartmentName": "*Unspecified", "ScheduledExamDateKey": 20240101, "ExamEndDateKey": -1, "Modality": "", "StudyStatus": "x"},
    ).withColumnsRenamed(layouts.IMAGING_NAMES)
    assert rows(clinical.imaging_job(raw), "dept", "scheduled_date", "service_date", "modality") == [(None, D(2024, 1, 1), None, "")]


@pytest.fixture
def names(frame):
    return (
        frame("alias string, id string", ("ICU", "D1"), ("Lab", "D2")),
        frame("id string, name string", ("D1", "Intensive Care"), ("D2", "Laboratory")),
    )


def months(*values):
    return [*values, *[None] * (12 - len(values))]


def test_historical_volumes(grid):
    cells = grid(
        [None, None, None, "2022", *[None] * 12, None, None, None, "2023"],
        ["Id", "Name", "Unit", *"JFMAMJJASOND", None, "Id", "Name", *"JFMAMJJASOND"],
        ["D1", "icu", "Days", *months("62", None, "5"), None, "D1", "icu", *months("1")],
        ["D2", "lab", None, *months("7"), None, "D3", "new", *months(None, "9")],
    )
    got = finance.historical_volumes(cells, "1:70")
    assert rows(got) == sorted(
        [("D1", "icu", "2022-01", 62.0, "Days"), ("D1", "icu", "2022-03", 5.0, "Days"), ("D2", "lab", "2022-01", 7.0, None), ("D1", "icu", "2023-01", 1.0, "Days"), ("D3", "new", "2023-02", 9.0, None)],
        key=repr,
    )
    with pytest.raises(Exception, match="no year"):
        finance.historical_volumes(grid(["x", "y"], ["Id", "Name"], ["D1", "n", "Days", "1"]), "1:70").collect()
    with pytest.raises(ValueError, match="go on below"):
        finance.historical_volumes(cells, "1:3")


def test_current_volumes(grid):
    cells = grid(["ID", "Name", "Unit", *"JFMAMJJASOND"], ["D1", "icu", "Days", *months("3")], [None], ["D9", "below"], file="(02) Feb 2025 Dashboard.xlsx")
    assert rows(finance.current_volumes(cells)) == [("D1", "icu", "2025-01", 3.0, "Days")]


def test_contracted_hours(grid, names):
    head = ["Traveler Name", "License Type", "Cost Center", "Date End", "Invoice Date", "Regular", "Total Hours"]
    good = [["title"], head, ["a", "RN", "icu", "1/31/2024", "x", "8", "8"], ["b", "RN", "LAB", "?", "2/1/2024", None, "4"], ["c", "RN", "zz", "?", "?", "0", "0"], [None, None, "zz", None, None, None, "1"]]
    other = grid(*good, sheet="Summary")
    got = finance.contracted_hours(grid(*good, sheet="2024 DATA").unionByName(other), *names)
    assert rows(got, "name", "dept_id", "dept_name", "month", "reg_hrs", "total_hrs") == [("a", "D1", "Intensive Care", "2024-01", 8.0, 8.0), ("b", "D2", "Laboratory", "2024-02", None, 4.0)]
    for bad, why in ((["d", "RN", "zz", "1/1/2024", None, "1", "1"], "cost center"), (["d", "RN", "lab", "?", "-", "1", "1"], "month")):
        with pytest.raises(Exception, match=why):
            finance.contracted_hours(grid(*good, bad, sheet="2024 DATA"), *names).collect()


def test_income_statement(grid, names):
    line = lambda acct, center, *rest: [acct, center, *rest]
    cells = grid(
        ["meta"], [None, None, None, None, "Month to Date: 3/2024"], ["Ledger Account", "Cost Center"],
        line("A1", "icu", "(Blank)", "rev", "1.5", "2", *[None] * 5, "10", "20"), line("A2", "Else", None, None, "3"), line("A3", "(Blank)", None, None, "4"),
    )
    got = finance.income_statement(cells, *names)
    assert rows(got, "month", "ledger_acct", "dept_id", "dept_name", "spend_category", "actual", "budget_ytd") == sorted(
        [("2024-03", "A1", "D1", "Intensive Care", "", 1.5, 20.0), ("2024-03", "A2", "Else", "Else", None, 3.0, None), ("2024-03", "A3", "", "", None, 4.0, None)], key=repr
    )
    with pytest.raises(Exception, match="no month"):
        finance.income_statement(grid(["x"], ["Ledger Account"], ["A"]), *names).collect()


def test_hours(grid, names):
    wide = lambda *v: [*v[:4], None, None, v[4], *[None] * 5, v[5], v[6], *[None] * 11, v[7], None, v[8]]
    cells = grid(
        ["PAY PERIOD"], ["3"], ["h"], ["h"], wide("1", "ICU", None, "2", "10", "1", "11", "99.5", None), wide("2", "zz", "1", "1", "1", "1", "1", "1", "1"),
        ["s"], ["s"], [None, "TOTAL"], ["PAY PERIOD"], ["28"], ["h"], ["h"], wide("1", "lab", "5", "2", "10", "1", "11", "1", "0.5"), ["s"], ["s"], [None, "TOTAL"],
    )
    got = finance.historical_hours(cells, 2022, *names)
    assert rows(got, "pay_period", "dept_id", "reg_hrs", "overtime_hrs", "total_amt", "total_fte", "start_date") == [
        ("2022-03", "D1", 0.0, 2.0, 99.5, 0.0, D(2022, 1, 15)), ("2022-28", "D2", 5.0, 2.0, 1.0, 0.5, None),
    ]
    with pytest.raises(ValueError, match="without an end"):
        finance.historical_hours(grid(["PAY PERIOD"], ["3"]), 2022, *names)


def test_current_hours_and_months(grid, names):
    first = ["Period", "Department Number", "Department Name", "x", None, None, "y", None, "Total Productive Hours", "Total Non-Productive Hours", "Total Productive/Non-Productive Hours", "Total Dollars", "Total FTE"]
    second = [None, None, None, "Regular Hours", "CALLBK - CALLBACK", "DBLTME - DOUBLETIME", "z", "OT_1.5 - OVERTIME"]
    body = ["p", "1", "icu", "80", "1", "2", "3", "4", "70", "10", "80", "1400", "1.4"]
    cells = grid(["title"], first, second, body, file="PP#3 2024 Payroll.xlsx")
    got = finance.current_hours(cells, *names)
    assert rows(got, "pay_period", "dept_name", "reg_hrs", "overtime_hrs", "total_fte", "start_date") == [("2024-03", "Intensive Care", 80.0, 6.0, 1.4, D(2024, 1, 13))]
    late = got.withColumn("start_date", F.lit(D(2024, 1, 25)))
    by_month = finance.hours_by_month(late.unionByName(late))
    assert rows(by_month, "dept_id", "month", "reg_hrs", "total_amt") == [("D1", "2024-01", 80.0, 1400.0), ("D1", "2024-02", 80.0, 1400.0)]
    fte = {r["month"]: r["total_fte"] for r in by_month.collect()}
    assert abs(fte["2024-01"] - 2 * 1.4 * 0.5 * 14 / 31) < 1e-12 and abs(fte["2024-02"] - 2 * 1.4 * 0.5 * 14 / 29) < 1e-12
    with pytest.raises(Exception, match="no start date"):
        finance.hours_by_month(got.withColumn("start_date", F.lit(None).cast("date"))).collect()
    with pytest.raises(ValueError, match="required columns"):
        finance.current_hours(grid(["title"], first[:-1], second, body, file="PP#3 2024 Payroll.xlsx"), *names)


def balance_cells(frame, period, name="(01) Jan 2024 Balance Sheet.xlsx"):
    lines = [("Assets", 0, "1"), ("Net Patient Accounts Receivable", 1, "2"), ("Gross", 2, "3"), ("Check - sum", 0, "9"), ("Liabilities", 0, "4")]
    data = [(name, "S", 2, 0, "Period", 0), (name, "S", 2, 1, period, 0)]
    for n, (acct, indent, value) in enumerate(lines):
        data += [(name, "S", 7 + n, 0, acct, indent), (name, "S", 7 + n, 1, value, 0), (name, "S", 7 + n, 4, f"{value}.5", 0)]
    return frame("file string, sheet string, row int, col int, value string, indent int", *data)


def test_balance_sheet(frame):
    got = finance.balance_sheet(balance_cells(frame, "2024 - Jan"))
    ar = "Assets|Net Patient Accounts Receivable"
    assert rows(got, "line_num", "tree", "actual", "actual_prev_year") == [
        (1, "Assets", 1.0, 1.5), (2, ar, 2.0, 2.5), (3, "Assets|Other Receivables", None, None), (4, "Assets|Other Receivables|Gross", 3.0, 3.5), (5, "Liabilities", 4.0, 4.5),
    ]
    assert rows(got.select("month").distinct()) == [("2024-01",)]
    with pytest.raises(Exception, match="differ"):
        finance.balance_sheet(balance_cells(frame, "2024 - Feb")).collect()


def test_budgets(grid):
    blank = [[None]] * 6
    budget = grid(*blank, ["D1", "icu", "2", "x", "x", "100", "50", None, "30"], [None, "no id", "1"], [None], ["D9", "next table"], sheet="Budget")
    goals = grid(["t"], ["ID", "GOAL"], ["D1", "2.5"], sheet="Goals")
    units = grid(["t"], ["t"], [*[None] * 17, "D1", "1", "77"], sheet="UOS")
    got = finance.historical_budget(budget.unionByName(goals).unionByName(units), "Budget", "Goals", "UOS", 2024)
    assert rows(got) == [("D1", "icu", 2024, 2.0, 100.0, 0.0, 50.0, 77.0, 2.5, 30.0)]
    current = grid(*blank, ["1/31/2025", "D1", "icu", "2", None, None, None, "9", "100", "50", "0", None, "30"], ["1/31/2025", "D2", "lab", "1", None, None, None, None, "100", None, "8"])
    got = finance.current_budget(current)
    assert rows(got, "dept_id", "year", "budget_uos", "budget_prod_hrs_per_uos", "budget_contracted_hours") == [("D1", 2025, 0.0, 0.0, 9.0), ("D2", 2025, 8.0, 12.5, 0.0)]


def test_aged_receivables(frame):
    df = make(frame, layouts.AGED_AR, {"date": "2024-01-31 00:00:00", "aged_days": "0-30", "total": 1.0, "num_accts": 2})
    assert rows(finance.aged_receivables(df), "date") == [("2024-01-31",)]


def test_hours_sort_no_input_split(grid, names):
    """What is sorted for the texts of a row has been moved, and so has a bounded size."""
    first = ["Department Number", "Department Name", "x", None, None, "y", None, "Total Productive Hours", "Total Non-Productive Hours", "Total Productive/Non-Productive Hours", "Total Dollars", "Total FTE"]
    second = [None, None, "Regular Hours", "CALLBK - CALLBACK", "DBLTME - DOUBLETIME", "z", "OT_1.5 - OVERTIME"]
    body = ["1", "icu", "80", "1", "2", "3", "4", "70", "10", "80", "1400", "1.4"]
    cells = grid(["title"], first, second, body, body, file="PP#3 2024 Payroll.xlsx")
    got = finance.hours_by_month(finance.current_hours(cells, *names))
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = [i for i, line in enumerate(lines) if "SortAggregate(key=[file" in line and "partial_max(CASE" in line]
    assert partial and all("SortAggregate" in lines[i - 1] for i in partial)
    assert rows(got, "dept_id", "month", "reg_hrs") == [("D1", "2024-01", 160.0)]
