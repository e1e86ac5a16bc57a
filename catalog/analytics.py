"""Cohort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import oracle_view, query
from catalog.views import AS_OF
from catalog.vocabulary import patient_tables
from clinspark.operators import domains, mapping
from clinspark.plans import analytics
from clinspark.session import stage


def mapped(v, name: str):
    """One event table with its terms mapped; only the rows matter, so the ids are any distinct numbers."""
    df = patient_tables(v, ids=False)[name].withColumn(mapping.TARGETS[name].id_col, F.monotonically_increasing_id())
    terms = mapping.map_terms(mapping.orphan_terms(df, mapping.TARGETS[name]), v.concept, v.rel, AS_OF)
    return mapping.apply_terms(df, mapping.TARGETS[name], stage(terms, "mapped-terms"))


oracle_view(
    "o_concept_of_event",
    """
    select e.t, e.id, m.concept_id, e.term from {o_mapped_events} e
    join {o_mapped} m on m.target_table = e.t and m.source_value = e.term and m.concept_id <> 0""",
)


@query(
    "rwe_population",
    """select (select count(distinct person_id) from {o_person}) as total_patients,
              round(avg(date_diff('day', observation_period_start_date, observation_period_end_date)), 1)
                  as avg_days_observed
       from {o_period}""",
)
def rwe_population(v):
    return analytics.population(domains.person(v.dm), domains.observation_period(v.dm, ids=False))


@query(
    "rwe_gender",
    """select coalesce(c.concept_name, 'Unknown') as gender, count(p.person_id) as patients
       from {o_person} p left join {concept} c on c.concept_id = p.gender_concept_id group by 1""",
)
def rwe_gender(v):
    return analytics.gender_distribution(domains.person(v.dm), v.concept)


@query(
    "rwe_top_conditions",
    """select c.concept_name, count(*) as occurrences
       from {o_concept_of_event} e join {concept} c on c.concept_id = e.concept_id
       where e.t = 'condition_occurrence' group by 1 order by 2 desc, 1 limit 5""",
)
def rwe_top_conditions(v):
    return analytics.top_conditions(mapped(v, "condition_occurrence"), v.concept)


@query(
    "rwe_lab_means",
    """select measurement_source_value, unit_source_value, round(avg(value_as_number), 1) as avg_value
       from {o_measurement} where value_as_number is not null group by 1, 2
       order by 3 desc, 1, 2 nulls first limit 5""",
)
def rwe_lab_means(v):
    return analytics.lab_means(domains.measurement(v.lb, v.vs, v.eg, ids=False, check=False))


@query(
    "rwe_rescue_rate",
    """select count(distinct r.person_id) as rescue_patients,
              (select count(distinct person_id) from {o_person}) as total_patients,
              round(100.0 * count(distinct r.person_id) / (select count(distinct person_id) from {o_person}), 1)
                  as rescue_rate
       from (select row_number() over (order by dom, person_id, seq) as id, person_id from {o_drug_rows}) r
       join {o_concept_of_event} e on e.t = 'drug_exposure' and e.id = r.id
       join {concept} c on c.concept_id = e.concept_id
       where lower(c.concept_name) like '%small ring%'""",
)
def rwe_rescue_rate(v):
    return analytics.rescue_rate(domains.person(v.dm), mapped(v, "drug_exposure"), v.concept, "small ring")
