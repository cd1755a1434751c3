import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from tallyloom.plans import panels as p

AS_OF = dt.datetime(2024, 3, 1, 9, 30)


def back(years=0, months=0):
    month = AS_OF.month - 1 - months
    return AS_OF.replace(year=AS_OF.year - years + month // 12, month=month % 12 + 1)


def location_of(visits, age):
    """The rules, one person at a time. Equally late visits: peds ones are later."""
    recent = sorted((v for v in visits if v["at"] >= back(years=2)), key=lambda v: (v["at"], v["peds"]), reverse=True)
    year = [v for v in recent if v["at"] >= back(years=1)]
    well = [v for v in recent if v["well"]]
    any3, all3 = any(v["peds"] for v in recent[:3]), all(v["peds"] for v in recent[:3])
    rule = None
    if sum(v["peds"] for v in recent) >= 3 and all3:
        rule = 1
    elif well and well[0]["peds"] and any3:
        rule = 2
    elif recent and not well and len(year) >= 3 and sum(v["peds"] for v in year) > len(year) / 2 and any3:
        rule = 3
    excluded = bool(
        recent and age is not None and age < 3
        and not any(v["peds"] and v["at"] >= back(months=15) for v in recent)
    )
    return rule, excluded, rule is not None and not excluded


def provider_of(visits, known):
    recent = sorted(
        (v for v in visits if v["at"] >= back(years=2) and v["who"] in known), key=lambda v: (v["at"], v["who"]), reverse=True
    )
    if not recent:
        return None
    counts = {}
    for v in recent:
        counts[v["who"]] = counts.get(v["who"], 0) + 1
    top = max(counts, key=counts.get)
    if len(counts) == 1:
        return top, 1
    if counts[top] > len(recent) / 2:
        return top, 2
    well = [v for v in recent if v["well"]]
    return (well[0]["who"], 3) if well else (recent[0]["who"], 4)


def random_people(count):
    rng = random.Random(11)
    people = {}
    for n in range(count):
        bias = rng.random()
        people[f"p{n}"] = [
            {
                "at": dt.datetime(2024, 3, 1) - dt.timedelta(rng.choice([rng.randint(0, 900), 30, 730, 731, 365, 366])),
                "peds": rng.random() < bias,
                "well": rng.random() < 0.15,
                "who": rng.choice(["A", "A", "B", "C", "X", None]),
            }
            for _ in range(rng.randint(0, 9))
        ]
    return people


def visit_frame(frame, people):
    data = [
        (person, v["at"], int(v["at"].timestamp()), v["who"], v["peds"], v["well"]) for person, visits in people.items() for v in visits
    ]
    return frame(
        "person_id string, visit_at timestamp_ntz, visit_order bigint, provider string, is_peds boolean, is_well boolean", *data
    )


def test_location_rules_match_a_loop(frame):
    people = random_people(400)
    ages = {person: random.Random(person).choice([None, 0, 2, 3, 40]) for person in people}
    persons = frame("person_id string, age int", *ages.items())
    got = {r["person_id"]: (r["rule"], r["excluded"], r["assigned"]) for r in p.location_panel(persons, visit_frame(frame, people), AS_OF).collect()}
    wanted = {person: location_of(visits, ages[person]) for person, visits in people.items()}
    assert got == wanted
    assert {w[0] for w in wanted.values()} == {None, 1, 2, 3} and any(w[1] and w[0] for w in wanted.values())


def test_provider_cuts_match_a_loop(frame):
    people = random_people(400)
    got = {r["person_id"]: (r["provider"], r["cut"]) for r in p.provider_panel(visit_frame(frame, people), AS_OF, ["A", "B", "C"]).collect()}
    wanted = {person: provider_of(visits, ["A", "B", "C"]) for person, visits in people.items()}
    assert got == {k: v for k, v in wanted.items() if v}
    assert {v[1] for v in got.values()} == {1, 2, 3, 4}


def test_exact_half_is_no_majority_and_edges(frame):
    day = lambda n: dt.datetime(2024, 1, n)
    visit = lambda at, who: {"at": at, "peds": False, "well": False, "who": who}
    people = {
        "half": [visit(day(1), "A"), visit(day(2), "B")],
        "unknown": [visit(day(1), "X")],
        "edge": [visit(dt.datetime(2022, 3, 1), "A")],
        "inside": [visit(dt.datetime(2022, 3, 2), "A")],
    }
    got = p.provider_panel(visit_frame(frame, people), AS_OF, ["A", "B"])
    assert rows(got) == [("half", "B", 4), ("inside", "A", 1)]


def test_job_runs_rules_then_cuts(frame):
    encounters = frame(
        "person_id string, encounter_date date, encounter_time string, encounter_type string, dept string, appt_status string, service_provider string, diagnoses_icd string",
        *[("kid", dt.date(2024, 1, n), "0900", "OFFICE", "peds", "Completed", "A", None) for n in (1, 2, 3)],
        ("adult", dt.date(2024, 1, 1), None, None, "clinic", "Completed", "A", None),
        ("adult", dt.date(2024, 1, 2), "0800", "CC LAB", "clinic", "Completed", "B", None),
        ("adult", dt.date(2024, 1, 3), "0800", "OFFICE", "elsewhere", "Completed", "B", None),
        ("adult", dt.date(2024, 1, 4), "0800", "OFFICE", "clinic", "Canceled", "B", None),
        ("tie", dt.date(2024, 1, 1), "0800", "OFFICE", "clinic", "Completed", "B", None),
        ("tie", dt.date(2024, 1, 1), "1500", "OFFICE", "clinic", "Completed", "A", None),
        ("well", dt.date(2024, 1, 1), "0800", "OFFICE", "clinic", "Completed", "A", "z00.1"),
        ("well", dt.date(2024, 1, 2), "0800", "OFFICE", "clinic", "Completed", "B", "J10"),
    )
    persons = frame("person_id string, age int", ("kid", 8), ("adult", 40), ("tie", 30), ("well", 20), ("none", None))
    got = p.panel_job(persons, encounters, AS_OF, ["peds"], ["clinic"], {"A": "North", "B": "South"}, "Kids")
    assert rows(got, "person_id", "panel_location", "panel_provider") == [
        ("adult", "North", "A"), ("kid", "Kids", None), ("none", None, None), ("tie", "North", "A"), ("well", "North", "A"),
    ]
    steps = {r["person_id"]: r["assignment_details"] for r in got.collect()}
    assert steps["kid"].startswith("Rule 1") and steps["tie"].startswith("4th cut") and steps["well"].startswith("3rd cut") and steps["none"] is None


def test_nobody_assigned(frame):
    empty = visit_frame(frame, {})
    got = p.location_panel(frame("person_id string, age int", ("a", 1)), empty, AS_OF)
    assert rows(got, "rule", "excluded", "assigned") == [(None, False, False)]


def test_join_below_both_branches_is_shuffled_once(spark):
    """Facts and last three read the same columns, so exchanges below them are shared."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"))
        right = spark.range(50).select(F.col("id").alias("k"), F.col("id").cast("string").alias("person_id"))
        visits = left.join(right, "k").select(
            "person_id", F.lit("2024-01-01").cast("timestamp_ntz").alias("visit_at"), F.col("n").alias("visit_order"),
            F.lit("A").alias("provider"), (F.col("n") % 2 == 0).alias("is_peds"), (F.col("n") % 3 == 0).alias("is_well"),
        )
        df = p.location_rules(visits, AS_OF)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
