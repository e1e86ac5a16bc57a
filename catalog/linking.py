"""Linking events to visits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import oracle_view, query
from clinspark.operators import domains, visits
from clinspark.session import stage, stage_parts

# Event rows before linking, without their own ids: table, key, person, day, visit number.
oracle_view(
    "o_events",
    """
    select 'condition_occurrence' as t, concat(dom::varchar, ':', seq::varchar) as k, person_id,
           cast(s as date) as d, null::double as num from {o_condition_rows}
    union all
    select 'drug_exposure', concat(dom::varchar, ':', seq::varchar), person_id, cast(s as date), null
    from {o_drug_rows}
    union all
    select 'measurement', concat(dom::varchar, ':', seq::varchar), person_id, cast(m as date), visit_num
    from {o_measurement_rows}""",
)


def _by_day(visit_view: str) -> str:
    return (
        """
    select e.t, e.k, e.person_id, e.d, count(v.visit_occurrence_id) as n, min(v.visit_occurrence_id) as first_id
    from {o_events} e
    left join {VISITS} v on v.person_id = e.person_id and e.d between v.visit_start_date and v.visit_end_date
    where e.num is null
    group by e.t, e.k, e.person_id, e.d"""
    ).replace("VISITS", visit_view)


oracle_view("o_by_day", _by_day("o_visit"))
oracle_view("o_by_day_clean", _by_day("o_visit_clean"))
oracle_view("o_by_day_long", _by_day("o_visit_long"))


def _events(v) -> dict[str, DataFrame]:
    """The event tables with their sequence kept as key, before ids are given."""
    parts = {
        "condition_occurrence": [domains.condition_from_ae(v.ae), domains.condition_from_mh(v.mh, check=False)],
        "drug_exposure": [domains.drug_from_ex(v.ex), domains.drug_from_cm(v.cm)],
        "measurement": [
            domains.measurement_from_lb(v.lb),
            domains.measurement_from_vs(v.vs),
            domains.measurement_from_eg(v.eg, check=False),
        ],
    }
    key = F.concat_ws(":", "_domain", F.col("_sequence").cast("bigint"))
    return {name: reduce(DataFrame.unionByName, dfs).withColumn("k", key) for name, dfs in parts.items()}


@query(
    "link_visit_number",
    """select e.k, e.person_id, e.num as source_visit_num, v.visit_occurrence_id
       from {o_events} e
       left join {o_visit} v on v.person_id = e.person_id and v.source_visit_num = e.num
       where e.num is not null""",
)
def link_visit_number(v):
    linked = visits.number_matches(_events(v)["measurement"], domains.visit_occurrence(v.sv))
    return linked.select("k", "person_id", "source_visit_num", "visit_occurrence_id")


@query(
    "link_visit_interval",
    """select person_id, d as event_date, n::bigint as visit_count, first_id as visit_occurrence_id
       from (select distinct person_id, d, n, first_id from {o_by_day} where t = 'drug_exposure') x where n > 0""",
)
def link_visit_interval(v):
    """Visits that cover each day on which a person has a drug exposure; visits last three days and overlap."""
    cells = stage(visits.visit_cells(domains.visit_occurrence(v.sv)), "visit-cells")
    found = visits.day_matches(_events(v)["drug_exposure"], cells, "drug_exposure_start_date")
    return found.select(
        "person_id", F.date_from_unix_date("day").alias("event_date"), "visit_count", "visit_occurrence_id"
    )


@query(
    "link_long_visits",
    """select t as table_name, person_id, d as event_date, n::bigint as visit_count, first_id as visit_occurrence_id
       from (select distinct t, person_id, d, n, first_id from {o_by_day_long}) x where n > 0""",
)
def link_long_visits(v):
    """All tables against visits of 1 to 10000 days, many of which overlap."""
    cells = stage(visits.visit_cells(domains.visit_occurrence(v.sv_long)), "visit-cells")
    found = visits.day_matches_of(_events(v), cells)
    day = F.date_from_unix_date("day").alias("event_date")
    return found.select("table_name", "person_id", day, "visit_count", "visit_occurrence_id")


@query(
    "link_ambiguous",
    """select t as table_name, k, person_id, d as event_date, n::bigint as visit_count from {o_by_day} where n > 1""",
)
def link_ambiguous(v):
    cells = stage(visits.visit_cells(domains.visit_occurrence(v.sv)), "visit-cells")
    # Staged: events are read for their days and again for their keys, and their dates and ids cost most to work out.
    events = {}
    for name, df in _events(v).items():
        number = [c for c in ("source_visit_num",) if c in df.columns]
        events[name] = stage(df.select("k", "person_id", visits.EVENT_DATES[name], *number), f"events-{name}")
    matches = stage_parts(visits.day_matches_of(events, cells), "visit-days", "table_name", list(events))
    parts = []
    for name, df in events.items():
        date_col = visits.EVENT_DATES[name]
        rows = visits.ambiguous_events(df, matches[name], date_col)
        day = F.col(date_col).alias("event_date")
        parts.append(rows.select(F.lit(name).alias("table_name"), "k", "person_id", day, "visit_count"))
    return reduce(DataFrame.unionByName, parts)


oracle_view(
    "o_linked",
    """
    select t, k, person_id, d, case when n = 1 then first_id end as visit_occurrence_id from {o_by_day_clean}
    union all
    select e.t, e.k, e.person_id, e.d, v.visit_occurrence_id
    from {o_events} e
    left join {o_visit_clean} v on v.person_id = e.person_id and v.source_visit_num = e.num
    where e.num is not null""",
)


def _linked(v) -> dict[str, DataFrame]:
    return visits.link_visits(_events(v), domains.visit_occurrence(v.sv_clean))


@query(
    "link_visits",
    """select t as table_name, k, person_id, d as event_date, visit_occurrence_id from {o_linked}""",
)
def link_visits(v):
    """All events of all tables, each with its visit or none."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            "k",
            "person_id",
            F.col(visits.EVENT_DATES[name]).alias("event_date"),
            "visit_occurrence_id",
        )
        for name, df in _linked(v).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _register_links(table: str, name: str) -> None:
    @query(name, "select k, visit_occurrence_id from {o_linked} where t = '" + table + "'")
    def links(v):
        return _linked(v)[table].select("k", "visit_occurrence_id")


for _table in visits.EVENT_DATES:
    _register_links(_table, "link_" + _table.partition("_")[0])
