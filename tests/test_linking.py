import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinspark.operators import acceptance, visits

D = dt.date
VISITS = (
    "visit_occurrence_id long, person_id long, visit_start_date date, visit_end_date date, source_visit_num double"
)
CONDITIONS = "id long, person_id long, condition_start_date date"
DRUGS = "id long, person_id long, drug_exposure_start_date date"
MEASURES = "id long, person_id long, measurement_date date, source_visit_num double"
JAN10 = D(2023, 1, 10)


def linked(frame, visit_rows, **events):
    schemas = {"condition_occurrence": CONDITIONS, "drug_exposure": DRUGS, "measurement": MEASURES}
    tables = {name: frame(schema, *events.get(name, [])) for name, schema in schemas.items()}
    out = visits.link_visits(tables, frame(VISITS, *visit_rows))
    return {name: {r.id: r.visit_occurrence_id for r in df.collect()} for name, df in out.items()}


def test_visit_number_wins_and_old_dates_stay_open(frame):
    out = linked(
        frame,
        [(10, 1, JAN10, JAN10, 1.0)],
        condition_occurrence=[(1, 1, D(2020, 1, 1)), (2, 1, JAN10), (3, None, JAN10), (4, 1, None), (5, 2, JAN10)],
        drug_exposure=[(1, 1, D(2023, 1, 11))],
        measurement=[(1, 1, D(2023, 1, 11), 1.0), (2, 1, JAN10, 9.0), (3, 1, JAN10, None), (4, None, JAN10, 1.0)],
    )
    assert out["condition_occurrence"] == {1: None, 2: 10, 3: None, 4: None, 5: None}
    assert out["drug_exposure"] == {1: None}
    # A number that matches no visit blocks the date rule.
    assert out["measurement"] == {1: 10, 2: None, 3: 10, 4: None}


def test_ambiguous_dates_are_refused(frame):
    two = [(10, 1, JAN10, JAN10, 1.0), (11, 1, JAN10, JAN10, 2.0)]
    with pytest.raises(ValueError, match="the first of person 1 on 2023-01-10"):
        linked(frame, two, condition_occurrence=[(1, 1, JAN10)])
    # Without an event on that day the overlap does not matter.
    assert linked(frame, two, condition_occurrence=[(1, 1, D(2023, 1, 9))])["condition_occurrence"] == {1: None}


def test_repeated_visit_numbers_are_refused(frame):
    with pytest.raises(ValueError, match="visits with the number"):
        linked(frame, [(10, 1, JAN10, JAN10, 1.0), (11, 1, D(2023, 2, 1), D(2023, 2, 1), 1.0)])
    with pytest.raises(ValueError, match="lacks columns: visit_end_date"):
        visits.require_linkable(frame("visit_occurrence_id long, person_id long, visit_start_date date, source_visit_num double"))


def test_interval_join_against_brute_force(frame):
    """Visits from one day to eighty years, a third of everything with one person."""
    rng = random.Random(7)
    base = D(1960, 1, 1)

    def person():
        return 1 if rng.random() < 0.34 else rng.randint(2, 9)

    spans = [0, 0, 1, 2, 5, 40, 63, 64, 65, 127, 128, 129, 1000, 29000, -3]
    visit_rows = []
    for i in range(160):
        start = base + dt.timedelta(days=rng.randint(-200, 9000))
        visit_rows.append((i, person(), start, start + dt.timedelta(days=rng.choice(spans)), float(i)))
    events = [(i, person(), base + dt.timedelta(days=rng.randint(-400, 12000))) for i in range(900)]

    cells = visits.visit_cells(frame(VISITS, *visit_rows))
    matches = visits.day_matches(frame(DRUGS, *events), cells, "drug_exposure_start_date")
    got = {(r.person_id, r.day): (r.visit_count, r.visit_occurrence_id) for r in matches.collect()}
    for _, who, day in events:
        hits = [v[0] for v in visit_rows if v[1] == who and v[2] <= day <= v[3]]
        key = (who, (day - D(1970, 1, 1)).days)
        assert got.get(key) == ((len(hits), min(hits)) if hits else None)


@pytest.mark.parametrize("days", [1, 2, 3, 64, 1000, 10_000, 36_586])
def test_a_visit_is_few_cells_of_any_length(frame, days):
    for first in range(-4, 4):
        start = D(1970, 1, 1) + dt.timedelta(days=first)
        rows = visits.visit_cells(frame(VISITS, (1, 1, start, start + dt.timedelta(days=days - 1), 1.0))).collect()
        assert len(rows) <= 2 * days.bit_length()
        covered = sorted(d for r in rows for d in range(r.cell << r.level, r.cell + 1 << r.level))
        assert covered == list(range(first, first + days))


def test_cells_of_all_of_the_calendar(frame):
    ages = frame(VISITS, (1, 1, D(1, 1, 1), D(9999, 12, 31), 1.0))
    assert sum(1 << r.level for r in visits.visit_cells(ages).collect()) == (D(9999, 12, 31) - D(1, 1, 1)).days + 1
    assert visits.levels_of(visits.visit_cells(ages.where("false"))) == []


def test_containment_against_brute_force(frame):
    rng = random.Random(3)
    base = D(2000, 1, 1)

    def spans(n, longest):
        out = []
        for _ in range(n):
            start = base + dt.timedelta(days=rng.randint(0, 300))
            out.append((1 if rng.random() < 0.34 else rng.randint(2, 30), start, start + dt.timedelta(days=rng.randint(0, longest))))
        return out

    periods, visit_spans = spans(80, 90), spans(600, 30) + [(99, base, base), (None, base, base)]
    found = acceptance.visits_outside_periods(
        frame("person_id long, visit_start_date date, visit_end_date date", *visit_spans),
        frame("person_id long, observation_period_start_date date, observation_period_end_date date", *periods),
    )
    outside = [
        v for v in visit_spans if not any(p[0] == v[0] and p[1] <= v[1] and v[2] <= p[2] for p in periods)
    ]
    assert found.agg(F.sum("n_visits")).first()[0] == len(outside)
    assert {(r.person_id, r.visit_start_date, r.visit_end_date) for r in found.collect()} == set(outside)


def test_containment_of_a_person_with_very_many_spans(frame):
    """Spans over decades: the latest end is carried over blocks and groups of blocks."""
    rng = random.Random(5)
    base = D(1950, 1, 1)

    def span(longest):
        start = base + dt.timedelta(days=rng.randint(0, 30_000))
        return 1, start, start + dt.timedelta(days=rng.randint(0, longest))

    periods = [span(rng.choice([30, 400, 9000])) for _ in range(40)]
    spans = list({span(rng.choice([2, 200, 5000])) for _ in range(900)}) + [(None, base, base), (1, None, base), (1, base, None)]
    visit = "person_id long, visit_start_date date, visit_end_date date"
    found = acceptance.visits_outside_periods(
        frame(visit, *spans),
        frame("person_id long, observation_period_start_date date, observation_period_end_date date", *periods),
        busy_spans=100,
    )
    whole = [v for v in spans if None not in v]
    outside = {v for v in whole if not any(p[1] <= v[1] and v[2] <= p[2] for p in periods)}
    got = {(r.person_id, r.visit_start_date, r.visit_end_date) for r in found.collect()}
    assert got == outside | {v for v in spans if None in v}


def test_cells_are_not_broadcast(frame):
    """Cells and days are many times the size of their files once a driver holds them."""
    events = frame(CONDITIONS, (1, 1, JAN10), (2, 2, JAN10))
    cells = visits.visit_cells(frame(VISITS, (10, 1, JAN10, D(2023, 3, 1), 1.0)))
    found = visits.day_matches(events, cells, "condition_start_date", [0, 1, 2, 3])
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.person_id, r.visit_count, r.visit_occurrence_id) for r in found.collect()] == [(1, 1, 10)]


def test_link_visits_returns_every_event(frame, monkeypatch):
    import catalog

    catalog.load()
    from catalog import linking

    k = "k string, person_id long, visit_occurrence_id long, "
    tables = {
        "condition_occurrence": frame(k + "condition_start_date date", ("AE:1", 1, 10, JAN10), ("AE:2", 1, 10, JAN10)),
        "drug_exposure": frame(k + "drug_exposure_start_date date", ("EX:1", 2, None, JAN10), ("EX:2", None, None, None)),
        "measurement": frame(k + "measurement_date date", ("LB:1", 1, 10, JAN10)),
    }
    monkeypatch.setattr(linking, "_linked", lambda v: tables)
    rows = {(r.table_name, r.k, r.person_id, r.event_date, r.visit_occurrence_id) for r in linking.link_visits(None).collect()}
    assert rows == {
        ("condition_occurrence", "AE:1", 1, JAN10, 10),
        ("condition_occurrence", "AE:2", 1, JAN10, 10),
        ("drug_exposure", "EX:1", 2, JAN10, None),
        ("drug_exposure", "EX:2", None, None, None),
        ("measurement", "LB:1", 1, JAN10, 10),
    }


def test_days_are_not_multiplied_by_levels(frame):
    """Days and cells are put in order once: no row is made per day and level, and nothing is joined."""
    rows = [(i, 1, D(2000, 1, 1) + dt.timedelta(days=3 * i), D(2000, 1, 1) + dt.timedelta(days=40 * i), 1.0) for i in range(50)]
    cells = visits.visit_cells(frame(VISITS, *rows, (99, None, JAN10, JAN10, 1.0)))
    levels = visits.levels_of(cells)
    events = [(i, 1, D(1999, 12, 1) + dt.timedelta(days=i // 2)) for i in range(400)] + [(900, None, JAN10), (901, 1, None)]
    found = visits.day_matches(frame(CONDITIONS, *events), cells, "condition_start_date", levels)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window ") == 1
    wanted = {}
    for day in {e[2] for e in events if e[1] and e[2]}:
        covering = [r[0] for r in rows if r[2] <= day <= r[3]]
        if covering:
            wanted[1, (day - D(1970, 1, 1)).days] = (len(covering), min(covering))
    got = {(r.person_id, r.day): (r.visit_count, r.visit_occurrence_id) for r in found.collect()}
    assert got == wanted and len(wanted) > 150
    both = {"condition_occurrence": frame(CONDITIONS, *events), "drug_exposure": frame(DRUGS, (1, 1, D(2000, 1, 5)))}
    rows = visits.day_matches_of(both, cells, levels).collect()
    assert {(r.person_id, r.day): r.visit_count for r in rows if r.table_name == "condition_occurrence"} == {
        key: n for key, (n, _) in wanted.items()
    }
    assert [tuple(r)[:2] for r in rows if r.table_name == "drug_exposure"] == [("drug_exposure", 1)]


def test_ambiguous_events_are_worked_out_once(spark, frame, monkeypatch):
    """Days and keys are both read from the written events."""
    import types

    import catalog

    catalog.load()
    from catalog import linking
    from clinspark.functions import text

    person = spark.range(1).select(text.person_id(F.lit("P1"))).first()[0]
    tables = {
        "condition_occurrence": frame("k string, person_id long, condition_start_date date", ("AE:1", person, JAN10)),
        "drug_exposure": frame("k string, person_id long, drug_exposure_start_date date", ("EX:1", person, D(2023, 1, 8))),
        "measurement": frame(
            "k string, person_id long, measurement_date date, source_visit_num double",
            ("LB:1", person, JAN10, None), ("LB:2", person, JAN10, 1.0), ("LB:3", None, JAN10, None),
        ),
    }
    monkeypatch.setattr(linking, "_events", lambda v: tables)
    visit = "USUBJID string, VISITNUM double, VISIT string, SVSTDTC string, SVENDTC string"
    sv = frame(visit, ("P1", 1.0, "a", "2023-01-08", "2023-01-10"), ("P1", 2.0, "b", "2023-01-09", "2023-01-11"))
    found = linking.link_ambiguous(types.SimpleNamespace(sv=sv))
    rows = {(r.table_name, r.k, r.person_id, r.event_date, r.visit_count) for r in found.collect()}
    assert rows == {("condition_occurrence", "AE:1", person, JAN10, 2), ("measurement", "LB:1", person, JAN10, 2)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and plan.count("Relation ") + plan.count("Relation[") >= 4
