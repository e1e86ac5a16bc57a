"""Checks of the patient tables, and publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import oracle_view, query
from catalog.views import AS_OF
from clinspark.contracts import CONTRACTS, schema_differences
from clinspark.operators import acceptance, domains, visits
from clinspark.plans import study
from clinspark.session import stage_path
from clinspark.sources import publication

# Patient tables with faults: people without a coded sex are missing, periods end early.
oracle_view("o_fewer_people", "select * from {o_person} where gender_source_value is not null")
oracle_view(
    "o_short_period",
    """select observation_period_id, person_id, observation_period_start_date, observation_period_end_date - 20
              as observation_period_end_date, period_type_concept_id from {o_period}""",
)


def _faulty(v) -> dict:
    periods = domains.observation_period(v.dm, ids=False, check=False).withColumn(
        "observation_period_end_date", F.date_sub("observation_period_end_date", 20)
    )
    return {
        "person": domains.person(v.dm).where("gender_source_value is not null"),
        "observation_period": periods,
        "visit_occurrence": domains.visit_occurrence(v.sv, check=False),
        "condition_occurrence": domains.condition_occurrence(v.ae, v.mh, ids=False, check=False),
        "drug_exposure": domains.drug_exposure(v.ex, v.cm, ids=False),
        "measurement": domains.measurement(v.lb, v.vs, v.eg, ids=False, check=False),
    }


def _faulty_and_linked(v) -> dict:
    """Written once, as publication does before it checks.

    Some people's visits, conditions and exposures end before they start, and some people's
    measurements refer to a visit that does not exist.
    """
    tables = _faulty(v)
    linked = visits.link_visits(tables, tables["visit_occurrence"], check=False)
    for name, every in (("visit_occurrence", 11), ("condition_occurrence", 5), ("drug_exposure", 7)):
        start, end, _ = acceptance.DATE_RANGES[name]
        early = F.when(F.col("person_id") % every == 0, F.date_sub(start, 1)).otherwise(F.col(end))
        linked[name] = linked[name].withColumn(end, early)
    lost = F.when(F.col("person_id") % 13 == 0, F.lit(-1)).otherwise(F.col("visit_occurrence_id")).cast("bigint")
    linked["measurement"] = linked["measurement"].withColumn("visit_occurrence_id", lost)
    return publication.write_stage(linked, "faulty")


_REQUIRED = {
    "person": ("o_person", ["person_id", "gender_concept_id", "year_of_birth", "race_concept_id", "ethnicity_concept_id"]),
    "observation_period": (
        "o_period",
        [
            "observation_period_id",
            "person_id",
            "observation_period_start_date",
            "observation_period_end_date",
            "period_type_concept_id",
        ],
    ),
    "visit_occurrence": (
        "o_visit",
        [
            "visit_occurrence_id",
            "person_id",
            "visit_concept_id",
            "visit_start_date",
            "visit_end_date",
            "visit_type_concept_id",
        ],
    ),
    "condition_occurrence": (
        "o_condition",
        [
            "condition_occurrence_id",
            "person_id",
            "condition_concept_id",
            "condition_start_date",
            "condition_type_concept_id",
        ],
    ),
    "drug_exposure": (
        "o_drug",
        [
            "drug_exposure_id",
            "person_id",
            "drug_concept_id",
            "drug_exposure_start_date",
            "drug_exposure_end_date",
            "drug_type_concept_id",
        ],
    ),
    "measurement": (
        "o_measurement",
        [
            "measurement_id",
            "person_id",
            "measurement_concept_id",
            "measurement_date",
            "measurement_type_concept_id",
        ],
    ),
}


def _patient_tables(v, wanted) -> dict:
    """All six tables; of the large ones the columns whose contract field is ``wanted``."""
    columns = {name: [f.name for f in fields if wanted(f)] for name, fields in CONTRACTS.items()}
    return {
        "person": domains.person(v.dm),
        "observation_period": domains.observation_period(v.dm, check=False),
        "visit_occurrence": domains.visit_occurrence(v.sv, check=False),
        "condition_occurrence": domains.condition_occurrence(
            v.ae, v.mh, check=False, columns=columns["condition_occurrence"]
        ),
        "drug_exposure": domains.drug_exposure(v.ex, v.cm, columns=columns["drug_exposure"]),
        "measurement": domains.measurement(v.lb, v.vs, v.eg, check=False, columns=columns["measurement"]),
    }


@query(
    "check_required",
    " union all ".join(
        f"select '{table}' as table_name, '{column}' as column_name, "
        f"count(*) filter (where {column} is null) as violations from {{{view}}}"
        for table, (view, columns) in _REQUIRED.items()
        for column in columns
    ),
)
def check_required(v):
    """Nulls in every required column of all six tables."""
    parts = [acceptance.required_violations(df, name) for name, df in _patient_tables(v, lambda f: f.required).items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "check_keys",
    """select 'repeated key' as "check", 'person' as table_name, 'person_id' as column_name, count(*) as violations
       from {dm}
       union all select 'repeated key', 'visit_occurrence', 'visit_occurrence_id', count(*) from {sv}
       union all select 'repeated key', 'drug_exposure', 'drug_exposure_id', count(*) from {o_drug_rows}""",
)
def check_keys(v):
    """Primary keys of all six tables; the rows of three of them are there twice."""
    tables = _patient_tables(v, lambda f: f.primary_key)
    for name in ("person", "visit_occurrence", "drug_exposure"):
        tables[name] = tables[name].unionAll(tables[name])
    return acceptance.key_violations(tables)


@query(
    "check_pk",
    """select k as person_id, count(*) as n from (select @pid(USUBJID) as k from {sv}) x
       group by k having count(*) > 1""",
)
def check_pk(v):
    """A key column that repeats: the person of each visit."""
    return acceptance.repeated_keys(domains.visit_occurrence(v.sv, ids=False, check=False), "person_id")


@query(
    "orphan_rows",
    """select v.visit_occurrence_id, v.person_id from {o_visit} v
       where not exists (select 1 from {o_fewer_people} p where p.person_id = v.person_id)""",
)
def orphan_rows(v):
    people = domains.person(v.dm).where("gender_source_value is not null")
    found = acceptance.orphan_rows(domains.visit_occurrence(v.sv), "person_id", people, "person_id")
    return found.select("visit_occurrence_id", "person_id")


@query(
    "orphan_values",
    """select o.person_id as value, count(*) as n from {o_measurement_rows} o
       where not exists (select 1 from {o_fewer_people} p where p.person_id = o.person_id) group by o.person_id""",
)
def orphan_values(v):
    people = domains.person(v.dm).where("gender_source_value is not null")
    rows = domains.measurement(v.lb, v.vs, v.eg, ids=False, check=False)
    return acceptance.orphan_values(rows, "person_id", people, "person_id")


@query(
    "date_range_violations",
    """select USUBJID, VISITNUM, SVSTDTC, SVENDTC from {sv_dirty}
       where cast(SVENDTC as date) < cast(SVSTDTC as date)""",
)
def date_range_violations(v):
    return acceptance.reversed_ranges(
        v.sv_dirty.withColumn("s", F.to_date("SVSTDTC")).withColumn("e", F.to_date("SVENDTC")), "s", "e"
    ).select("USUBJID", "VISITNUM", "SVSTDTC", "SVENDTC")


def _outside(visit_view: str) -> str:
    return """
    select v.person_id, v.visit_start_date, v.visit_end_date, count(*) as n_visits from {VISITS} v
    where not exists (select 1 from {o_short_period} p where p.person_id = v.person_id
                      and p.observation_period_start_date <= v.visit_start_date
                      and p.observation_period_end_date >= v.visit_end_date)
    group by all""".replace("VISITS", visit_view)


oracle_view("o_outside", _outside("o_visit"))
oracle_view(
    "o_visit_seeded",
    """select * replace (case when person_id % 11 = 0 then cast(visit_start_date - interval 1 day as date)
                              else visit_end_date end as visit_end_date) from {o_visit}""",
)
oracle_view("o_outside_seeded", _outside("o_visit_seeded"))


@query("visits_outside_period", "select * from {o_outside}")
def visits_outside_period(v):
    periods = domains.observation_period(v.dm, ids=False, check=False).withColumn(
        "observation_period_end_date", F.date_sub("observation_period_end_date", 20)
    )
    return acceptance.visits_outside_periods(domains.visit_occurrence(v.sv, ids=False, check=False), periods)


@query(
    "visits_outside_many_periods",
    """select v.person_id, v.visit_start_date, v.visit_end_date, count(*) as n_visits from {o_visit} v
       where not exists (select 1 from {o_drug_rows} p where p.person_id = v.person_id
                         and cast(p.s as date) <= v.visit_start_date and cast(p.e as date) >= v.visit_end_date)
       group by all""",
)
def visits_outside_many_periods(v):
    """Many overlapping periods per person: the spans of drug exposures."""
    periods = domains.drug_exposure(v.ex, v.cm, ids=False).select(
        "person_id",
        F.col("drug_exposure_start_date").alias("observation_period_start_date"),
        F.col("drug_exposure_end_date").alias("observation_period_end_date"),
    )
    return acceptance.visits_outside_periods(domains.visit_occurrence(v.sv, ids=False, check=False), periods)


# Concept ids in use, as the pipeline writes them, by column.
oracle_view(
    "o_uses",
    """
    select table_name, column_name, concept_id, count(*) as n from (
        select 'person' as table_name, 'gender_concept_id' as column_name, gender_concept_id as concept_id
        from {o_fewer_people}
        union all select 'person', 'race_concept_id', race_concept_id from {o_fewer_people}
        union all select 'person', 'ethnicity_concept_id', ethnicity_concept_id from {o_fewer_people}
        union all select 'observation_period', 'period_type_concept_id', 32880 from {o_period}
        union all select 'visit_occurrence', 'visit_concept_id', 9202 from {o_visit}
        union all select 'visit_occurrence', 'visit_type_concept_id', 32809 from {o_visit}
        union all select 'condition_occurrence', 'condition_type_concept_id', 32809 from {o_condition_rows}
        union all select 'drug_exposure', 'drug_type_concept_id', 32809 from {o_drug_rows}
        union all select 'measurement', 'measurement_type_concept_id', 32809 from {o_measurement_rows}
        union all select 'measurement', 'unit_concept_id', @unit(unit) from {o_measurement_rows}) x
    where concept_id <> 0 group by all""",
)
oracle_view(
    "o_concept_violations",
    """
    select u.table_name, u.column_name, u.concept_id::bigint as concept_id, u.n,
           case when c.concept_id is null then 'missing' else 'invalid or wrong domain' end as problem
    from {o_uses} u
    left join {concept} c on c.concept_id = u.concept_id
    where c.concept_id is null
       or not (@standard(c) and @valid(c)
               and c.domain_id = case u.column_name when 'gender_concept_id' then 'Gender' when 'race_concept_id' then 'Race'
                   when 'ethnicity_concept_id' then 'Ethnicity' when 'visit_concept_id' then 'Visit'
                   when 'unit_concept_id' then 'Unit' else 'Type Concept' end)""",
)


@query("concept_violations", "select * from {o_concept_violations}")
def concept_violations(v):
    return acceptance.concept_violations(_faulty(v), v.concept, AS_OF)


@query("missing_concepts", "select distinct concept_id from {o_concept_violations} where problem = 'missing'")
def missing_concepts(v):
    return acceptance.missing_concepts(acceptance.concept_uses(_faulty(v)), v.concept)


def _no_person(table: str, rows: str) -> str:
    return f"""
    select 'no person' as "check", '{table}' as table_name, 'person_id' as column_name, count(*) as violations
    from {{{rows}}} o where not exists (select 1 from {{o_fewer_people}} p where p.person_id = o.person_id)"""


@query(
    "acceptance",
    "select * from ("
    + " union all ".join(
        [
            _no_person("observation_period", "o_period"),
            _no_person("visit_occurrence", "o_visit"),
            _no_person("condition_occurrence", "o_condition_rows"),
            _no_person("drug_exposure", "o_drug_rows"),
            _no_person("measurement", "o_measurement_rows"),
            """
    select 'ends before start', 'observation_period', 'observation_period_end_date', count(*) from {o_short_period}
    where observation_period_end_date < observation_period_start_date""",
            """
    select 'ends before start', 'visit_occurrence', 'visit_end_date', count(*) from {o_visit_seeded}
    where visit_end_date < visit_start_date""",
            """
    select 'ends before start', 'condition_occurrence', 'condition_end_date', count(*) from {o_condition_rows}
    where case when person_id % 5 = 0 then s is not null else cast(e as date) < cast(s as date) end""",
            """
    select 'ends before start', 'drug_exposure', 'drug_exposure_end_date', count(*) from {o_drug_rows}
    where case when person_id % 7 = 0 then s is not null else cast(e as date) < cast(s as date) end""",
            """
    select 'no visit', 'measurement', 'visit_occurrence_id', count(*) from {o_measurement_rows}
    where person_id % 13 = 0""",
            """
    select 'outside observation period', 'visit_occurrence', 'visit_start_date', coalesce(sum(n_visits), 0)::bigint
    from {o_outside_seeded}""",
            """
    select concat('concept ', problem), table_name, column_name, sum(n)::bigint from {o_concept_violations}
    group by all""",
        ]
    )
    + ") x where violations > 0",
)
def acceptance_query(v):
    """All relational checks on the faulty tables."""
    return acceptance.relational_violations(_faulty_and_linked(v), v.concept, AS_OF)


@query(
    "acceptance_report",
    """select 'person' as table_name, count(*) as row_count from {dm}
       union all select 'observation_period', count(*) from {dm}
       union all select 'visit_occurrence', count(*) from {sv_clean}
       union all select 'condition_occurrence', count(*) from {o_condition_rows}
       union all select 'drug_exposure', count(*) from {o_drug_rows}
       union all select 'measurement', count(*) from {o_measurement_rows}""",
)
def acceptance_report(v):
    """A whole study: build, link, map, publish, then check and count the published tables."""
    birth = F.when(F.col("BRTHDTC").rlike("^\\d"), F.col("BRTHDTC")).otherwise("1950")
    delivery = study.Delivery(
        dm=v.dm.withColumn("BRTHDTC", birth), sv=v.sv_clean, ae=v.ae, mh=v.mh, ex=v.ex, cm=v.cm, lb=v.lb, vs=v.vs, eg=v.eg
    )
    extra = v.sql(
        """select cast(id as bigint) as concept_id, 'added' as concept_name, dom as domain_id, 'Local' as vocabulary_id,
                  'Term' as concept_class_id, 'S' as standard_concept, 'x' as concept_code,
                  date '1970-01-01' as valid_start_date, date '2099-12-31' as valid_end_date,
                  cast(null as string) as invalid_reason
           from (select 8521 as id, 'Gender' as dom union all select 9529, 'Unit' union all select 8713, 'Unit') x"""
    )
    concept = v.concept.where("concept_id <> 8713").unionByName(extra)
    root = stage_path(v.spark, "published")
    audit = stage_path(v.spark, "audit")
    study.run_study(delivery, concept, v.rel, root, "RUN-1", as_of=AS_OF, provenance_path=audit)
    publication.publish_vocabulary(concept, v.rel, root)  # another set below the same root
    return publication.acceptance_report(v.spark, root, concept, AS_OF)


@query(
    "schema_differences",
    """select 'person' as table_name, column_name, what, expected, received, n_rows
       from (values ('gender_concept_id', 'type', 'bigint', 'string'),
                    ('person_id', 'primary key', 'True', 'False'),
                    ('person_id', 'required', 'True', 'False'),
                    ('race_concept_id', 'references', 'concept', ''),
                    ('year_of_birth', 'column', 'present', 'absent'),
                    ('born', 'column', 'absent', 'present')) x (column_name, what, expected, received),
            (select count(*) as n_rows from {dm}) n""",
)
def schema_differences_query(v):
    """What a written table has otherwise than agreed: each kind of difference, and the rows concerned."""
    people = acceptance.conform(domains.person(v.dm), "person")
    declared = {f.name: f.metadata for f in people.schema}
    undeclared = {"person_id": {}, "race_concept_id": {**declared["race_concept_id"], "references": ""}}
    turned = people.select(
        *[F.col(c).alias(c, metadata=undeclared[c]) if c in undeclared else F.col(c) for c in people.columns]
    )
    text = F.col("gender_concept_id").cast("string").alias("gender_concept_id", metadata=declared["gender_concept_id"])
    turned = turned.withColumnRenamed("year_of_birth", "born")
    turned = turned.select(*[text if c == "gender_concept_id" else F.col(c) for c in turned.columns])
    path = stage_path(v.spark, "people")
    turned.write.parquet(path)
    read = v.spark.read.parquet(path)
    names = ["table_name", "column_name", "what", "expected", "received"]
    found = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row, strict=True)])
        for row in schema_differences(read, "person")
    ]
    rows = read.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("n_rows", F.explode(F.array(*found)).alias("d")).select("d.*", "n_rows")


@query(
    "lost_source_values",
    """select 'drug_exposure' as table_name, 'drug_source_concept_id' as column_name, count(*) as n_rows from {o_drug_rows}
       union all select 'measurement', 'unit_source_value', count(*) from {o_measurement_rows}
       union all select 'measurement', 'value_source_value', count(*) from {o_measurement_rows}""",
)
def lost_source_values(v):
    """Columns that keep source values and were lost on the way, with the rows that lose a value."""
    tables = {
        "condition_occurrence": domains.condition_occurrence(v.ae, v.mh, ids=False, check=False),
        "drug_exposure": domains.drug_exposure(v.ex, v.cm, ids=False).drop("drug_source_concept_id"),
        "measurement": domains.measurement(v.lb, v.vs, v.eg, ids=False, check=False).drop(
            "unit_source_value", "value_source_value"
        ),
    }
    return acceptance.lost_source_values(tables)
