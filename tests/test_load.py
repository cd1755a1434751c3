import datetime as dt
import json

import pytest
from conftest import rows

from tallyloom.plans import load
from tallyloom.sources import layouts, tables


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def world(tmp_path):
    src = tmp_path / "in"
    put(src, "patients.csv", "h", "1,0007,Doe,F,2015-05-01,st,town,ST,zip,ph,em,pcp", "2,m2,Roe,M,1980-01-01,st,town,ST,zip,ph,em,pcp")
    put(src, "allergy.csv", "h", "0007,k,nuts,hives,food,high")
    put(src, "problem-list.csv", "h", "m2,flu,J10,20240101,,Active,0", "m2,old,J11,20200101,,Resolved,0")
    put(src, "mychart.csv", "h", "0007,Active,20230405", "m2,Inactive,")
    visit = "{mrn},n,F,20150501,a,c,s,z,p,e,pcp,{dept},{day},900,OFFICE,{who},1,Completed,dx,J10,,HC PR 99213 x"
    put(
        src, "encounters.csv", "h",
        *[visit.format(mrn="0007", dept="peds", day=f"2024010{n}", who="A") for n in (1, 2, 3)],
        visit.format(mrn="m2", dept="clinic", day="20240105", who="A"),
    )
    put(src, "encounters-ed.csv", "PrimaryMRN,ArrivalInstant,DepartureInstant,ChiefComplaint,Diagnosis,Age,FirstAttending,LastAttending,More", "0007,2024-01-01 10:05:00,2024-01-01 11:00:00,c,d,8,x,y,z", "nobody,2024-01-01 10:05:00,,c,d,8,x,y,z")
    put(src, "encounters-inpt.csv", "PrimaryMRN,AdmissionDate,DischargeDate,Diagnosis,Department", "m2,20240101,-1,d,w")
    put(src, "notes-inpt-ed.csv", "mrn,name,dept,note_type,primary_diag,author_name,author_type,author_service,first_author_name,cosigner_name,service_dt,dob", "m2,Roe,ER,*Unspecified,d,a,t,s,f,c,2024-01-01 10:00:00,1980-01-01", "m3,New,W,Progress,d,a,t,s,f,c,2024-01-01 10:00:00,1990-01-01")
    put(src, "imaging.csv", "ImagingKey,DepartmentName,ScheduledExamDateKey,ExamEndDateKey,Modality,StudyStatus", "1,CT,20240101,-1,*Unspecified,done")
    names = [f.name for f in layouts.CHARGES]
    def charge(key, quantity):
        cells = {"BillingTransactionKey": key, "PrimaryMRN": "m2", "ServiceDateKey": 20240101, "PostDateKey": 20240102, "BillingProcedureCode": "99213", "BillingProcedureQuantity": quantity, "RvuTotal": 9, "IsInactive": "False"}
        return ",".join(str(cells.get(n, "")) for n in names)
    for month, quantity in ((1, 1), (2, 2), (3, 3)):
        put(tmp_path / "charges", f"2024-{month:02d}.csv", ",".join(names), charge(month, 1), charge(100, quantity))
    fee = lambda code, rate, **at: ",".join([code, *[at.get(f"c{i}", "") for i in range(1, 31)], rate])
    put(tmp_path / "fees", "PPRRVU24.csv", *["line"] * 10, "header", "99213,,,,,1,,,,,,2,1.5", "99213,26,,,,1,,,,,,2,0.5")
    put(tmp_path / "fees", "extra.csv", *["line"] * 10, "header", fee("99213", "7", c3="Imputed"), fee("X1", "4", c3="Imputed"))
    return tmp_path


def test_nightly_run(spark, world):
    src, out, ids = str(world / "in"), str(world / "out"), str(world / "ids")
    with pytest.raises(ValueError, match="too few rows"):
        load.load_persons(spark, src, out, ids, "2024-03-01")
    load.load_persons(spark, src, out, ids, "2024-03-01", floor=1)
    read = lambda name, *cols: rows(tables.read_table(spark, f"{out}/{name}"), *cols)
    assert read("person", "person_id", "age", "allergy_count", "problem_count") == [("1", 8, 1, 0), ("2", 44, 0, 1)]
    assert read("person_lists", "person_id", "list", "part", "json")[0] == ("1", "allergy", 0, '[{"name":"nuts","reaction":"hives","type":"food","severity":"high"}]')
    assert read("portal", "person_id", "mychart_activation_date") == [("1", dt.date(2023, 4, 5)), ("2", None)]

    unknown = load.load_encounters(spark, src, out, ids)
    assert rows(unknown) == [("nobody", 1)]
    assert len(read("outpatient")) == 4 and read("inpatient", "person_id", "discharge_date") == [("2", None)]
    assert read("emergency", "person_id", "arrival_time")[0] == ("1", "1005")

    for _ in range(2):
        load.load_notes(spark, src, out, ids, "salt", ed_dept="ER")
    assert len(read("ed_notes")) == 1 and len(read("inpatient_notes")) == 1
    assert tables.read_table(spark, f"{ids}/id").count() == 3
    assert rows(tables.read_table(spark, f"{ids}/id_details").where("source_id = 'm3'"), "name", "city") == [("New", None)]

    load.load_imaging(spark, src, out)
    assert read("imaging", "service_date", "modality") == [(None, None)]

    load.load_panels(spark, out, "2024-03-01", ["peds"], ["clinic"], {"A": "North"}, "Kids")
    assert read("panel", "person_id", "panel_location", "panel_provider") == [("1", "Kids", None), ("2", "North", "A")]


def test_charges_merge_file_by_file(spark, world):
    src, ids = str(world / "in"), str(world / "ids")
    load.load_persons(spark, src, str(world / "out"), ids, "2024-03-01", floor=1)
    fees = load.load_fees(spark, str(world / "fees"), "extra.csv")
    assert rows(fees, "hcpcs", "facility_trvu") == [("99213", 1.5), ("X1", 4.0)]
    first, second = str(world / "c1"), str(world / "c2")
    chosen, missing = load.load_charges(spark, str(world / "charges"), None, first, ids, "salt", fees)
    assert chosen.count() == 2 and missing.count() == 0
    assert rows(tables.read_table(spark, first), "id", "quantity", "trvu") == [(100, 3, 4.5), (2, 1, 1.5), (3, 1, 1.5)]
    chosen, _ = load.load_charges(spark, str(world / "charges"), first, second, ids, "salt", None, backfill=True)
    assert rows(tables.read_table(spark, second), "id", "trvu") == [(1, 9.0), (100, 9.0), (2, 9.0), (3, 9.0)]
    load.log_run(spark, None, str(world / "log1"), "charges", chosen, dt.datetime(2024, 3, 1))
    load.log_run(spark, str(world / "log1"), str(world / "log2"), "charges", chosen, dt.datetime(2024, 3, 2))
    assert rows(tables.read_table(spark, str(world / "log2/meta"))) == [("charges", dt.datetime(2024, 3, 2))]
    assert tables.read_table(spark, str(world / "log2/sources")).count() == 3
    assert load.load_fees(spark, src, "extra.csv") is None
    with pytest.raises(ValueError, match="no charges"):
        load.load_charges(spark, str(world / "log1" / "meta" / "_SUCCESS"), None, first, ids, "salt")


def test_finance_load(spark, frame, grid, tmp_path):
    twelve = lambda start: [str(start + n) for n in range(12)]
    sheet = [
        [None, None, None, "2023", *[None] * 15, "2024"],
        ["Id", "Name", "Unit", *"JFMAMJJASOND", "Total", None, "Id", "Name", *"JFMAMJJASOND", "Total"],
        ["D1", "icu", "Days", *twelve(1), "78", None, "D1", "icu", *twelve(11), "198"],
    ]
    blank = [[None]] * 6
    current = [["ID", "Name", "Unit", *"JFMAMJJASOND"], ["D2", "lab", "Tests", *twelve(5)]]
    older = [["ID", "Name", "Unit", *"JFMAMJJASOND"], ["D2", "lab", "Tests", *twelve(90)], ["D9", "gone", "Tests", *twelve(90)]]
    name = "(02) Feb 2025 Dashboard.xlsx"
    hours = [
        ["Department Number", "Department Name", "x", None, None, "y", None, "Total Productive Hours", "Total Non-Productive Hours", "Total Productive/Non-Productive Hours", "Total Dollars", "Total FTE"],
        [None, None, "Regular Hours", "CALLBK - CALLBACK", "DBLTME - DOUBLETIME", "z", "OT_1.5 - OVERTIME"],
        ["1", "icu", "80", "1", "2", "3", "4", "70", "10", "80", "1400", "1.4"],
    ]
    old = lambda *v: [*v[:4], None, None, v[4], *[None] * 5, v[5], v[6], *[None] * 11, v[7], None, v[8]]
    balance = "(01) Jan 2024 Balance Sheet.xlsx"
    grids = {
        "historical_workbook": grid(*sheet, sheet="Volumes 24").unionByName(grid(*sheet, sheet="UOS 24"))
        .unionByName(grid(*blank, ["D1", "icu", "2", "x", "x", "100", "50", None, "30"], sheet="Budget"))
        .unionByName(grid(["t"], ["ID", "GOAL"], ["D1", "2.5"], sheet="Goals")),
        "workbooks": grid(*older, file="/data/(01) Jan 2025 Dashboard.xlsx", sheet="Volumes")
        .unionByName(grid(*current, file=f"/data/{name}", sheet="Volumes")).unionByName(grid(*current, file=f"/data/{name}", sheet="UOS"))
        .unionByName(grid(*blank, ["1/31/2025", "D2", "lab", "2", None, None, None, "9", "100", "50", "8", None, "30"], file=f"/data/{name}", sheet="Budget")),
        "historical_hours": grid(["PAY PERIOD"], ["3"], ["h"], ["h"], old("1", "ICU", "8", "2", "10", "1", "11", "99.5", "1"), ["s"], ["s"], [None, "TOTAL"]),
        "hours": grid(*hours, file="/data/PP#3 2024 Payroll.xlsx"),
        "contracted_hours": grid(["title"], ["Traveler Name", "Cost Center", "Date End", "Total Hours"], ["a", "icu", "1/31/2024", "8"], sheet="2024 DATA"),
        "income_statements": grid([None, None, None, None, "Month to Date: 3/2024"], ["Ledger Account", "Cost Center"], ["A1", "icu", "x", "y", "1.5"], ["A2", "nowhere", "x", "y", "2"]),
        "balance_sheets": frame(
            "file string, sheet string, row int, col int, value string, indent int",
            (f"/data/{balance}", "S", 2, 1, "2024 - Jan", 0), (f"/data/{balance}", "S", 7, 0, "Assets", 0), (f"/data/{balance}", "S", 7, 1, "5", 0),
        ),
    }
    paths = {kind: str(tmp_path / "grids" / kind) for kind in grids}
    for kind, df in grids.items():
        df.write.parquet(paths[kind])
    put(tmp_path, "misc.csv", "m,n,v", "2024-01,visits,7")
    put(tmp_path, "aged.csv", "d,a,t,n", "2024-01-31 00:00:00,0-30,1.5,2")
    aliases = frame("alias string, id string", ("ICU", "D1"), ("Lab", "D2"))
    canonical = frame("id string, name string", ("D1", "Intensive Care"), ("D2", "Laboratory"))
    sheets = {"volumes": "Volumes", "uos": "UOS", "budget": "Budget", "hours_per_volume": "Goals", "historical_volumes": "Volumes 24", "historical_uos": "UOS 24"}
    out = str(tmp_path / "out")
    unknown = load.load_finance(
        spark, paths, {"misc_volumes": str(tmp_path / "misc.csv"), "aged_receivables": str(tmp_path / "aged.csv")},
        out, aliases, canonical, 2024, sheets, 2022, "1:70",
    )
    assert rows(unknown) == [("nowhere", 1)]
    read = lambda table, *cols: rows(tables.read_table(spark, f"{out}/{table}"), *cols)
    volumes = tables.read_table(spark, f"{out}/volumes")
    assert rows(volumes.groupBy(volumes.month.substr(1, 4).alias("y"), "unit").count()) == [("2023", "Days", 12), ("2024", "Days", 12), ("2025", "Tests", 12)]
    assert read("uos", "month", "volume")[12] == ("2024-01", 11.0)
    assert read("budget", "dept_id", "year", "budget_uos", "budget_prod_hrs_per_uos") == [("D1", 2024, 198.0, 2.5), ("D2", 2025, 8.0, 12.5)]
    assert read("hours_by_period", "pay_period", "reg_hrs") == [("2022-03", 8.0), ("2024-03", 80.0)]
    assert [r[0] for r in read("hours", "month")] == ["2022-01", "2024-01"]
    assert read("contracted_hours", "name", "month") == [("a", "2024-01")]
    assert read("income_statement", "ledger_acct", "actual") == [("A1", 1.5), ("A2", 2.0)]
    assert read("balance_sheet", "tree", "actual") == [("Assets", 5.0)]
    assert read("misc_volumes") == [("2024-01", "visits", 7)] and read("aged_receivables", "date", "total") == [("2024-01-31", 1.5)]


def test_line_breaks_and_short_records(spark, world):
    src, out, ids = str(world / "in"), str(world / "out"), str(world / "ids")
    load.load_persons(spark, src, out, ids, "2024-03-01", floor=1)
    head = "mrn,name,dept,note_type,primary_diag,author_name,author_type,author_service,first_author_name,cosigner_name,service_dt,dob"
    note = 'm2,Roe,ER,ED Notes,"pain, ""sharp""\nat night",a,t,s,f,c,2024-01-01 10:00:00,1980-01-01'
    put(world / "in", "notes-inpt-ed.csv", head, note)
    load.load_notes(spark, src, out, ids, "salt", ed_dept="ER")
    assert rows(tables.read_table(spark, f"{out}/ed_notes"), "person_id", "diagnosis") == [("2", 'pain, "sharp"\nat night')]
    put(world / "in", "notes-inpt-ed.csv", head, note, "m3,Short,ER")
    with pytest.raises(Exception, match="too short"):
        load.load_notes(spark, src, out, ids, "salt", ed_dept="ER")
    put(world / "in", "allergy.csv", "h", "0007,k")
    with pytest.raises(Exception, match="too short"):
        load.load_persons(spark, src, out, ids, "2024-03-01", floor=1)


def test_first_run_without_an_id_table(spark, world):
    src, out, ids = str(world / "in"), str(world / "out"), str(world / "none")
    load.load_notes(spark, src, out, ids, "salt", ed_dept="ER")
    assert rows(tables.read_table(spark, f"{ids}/id"), "source_id") == [("m2",), ("m3",)]
    assert rows(tables.read_table(spark, f"{ids}/id_details"), "source_id", "name") == [("m2", "Roe"), ("m3", "New")]
    assert load.load_encounters(spark, src, out, ids).count() == 2
    _, missing = load.load_charges(spark, str(world / "charges"), None, str(world / "c"), str(world / "nothing"), "salt")
    assert rows(missing, "source_id") == [("m2",)]


def test_part_files_keep_their_order(spark, world):
    """A folder of unequal part files: first rows and lists follow file, then line."""
    src = world / "in"
    (src / "allergy.csv").unlink()
    put(src / "allergy.csv", "b.csv", "h", *[f"0007,k,b{n},{'x' * 2000},food,low" for n in range(40)])
    put(src / "allergy.csv", "a.csv", "h", "0007,k,a0,r,food,low", "0007,k,a1,r,food,low")
    (src / "mychart.csv").unlink()
    put(src / "mychart.csv", "b.csv", "h", *["0007,late,"] * 500)
    put(src / "mychart.csv", "a.csv", "h", "0007,first,")
    load.load_persons(spark, str(src), str(world / "out"), str(world / "ids"), "2024-03-01", floor=1)
    (made,) = [r for r in tables.read_table(spark, str(world / "out" / "person_lists")).collect() if r["list"] == "allergy"]
    assert [x["name"] for x in json.loads(made["json"])] == ["a0", "a1", *[f"b{n}" for n in range(40)]]
    assert rows(tables.read_table(spark, str(world / "out" / "portal")), "mychart_status") == [("first",)]


def test_extracts_are_parsed_once(spark, world, monkeypatch):
    """Rows that Spark reads of each extract, over all jobs of a load; kept tables are gone at the end."""
    seen, kept = [], []
    real = load.cut_lineage
    monkeypatch.setattr(load, "cut_lineage", lambda df, **k: (seen.append(df.inputFiles()), kept.append(real(df, **k)))[1] or kept[-1])
    load.load_persons(spark, str(world / "in"), str(world / "out"), str(world / "ids"), "2024-03-01", floor=1)
    extracts = [f for files in seen for f in files if f.endswith(".csv")]
    assert len(extracts) == len(set(extracts)) == 4
    for df in kept:
        with pytest.raises(Exception):  # noqa: B017  the table has been removed
            df.count()
