"""Domains to patient tables, with the SQL that says what each must contain."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import oracle_view, query, stamped
from clinspark.operators import acceptance, checks, domains
from clinspark.operators.ids import with_dense_ids
from clinspark.session import stage_path
from clinspark.sources.domains import read_domain, write_table

# --- what the tables must be ----------------------------------------------------------------

oracle_view(
    "o_person",
    """
    select @pid(USUBJID) as person_id,
           cast(case SEX when 'M' then 8507 when 'F' then 8532 when 'U' then 8521 else 0 end as bigint)
               as gender_concept_id,
           cast(year(b) as bigint) as year_of_birth, cast(month(b) as bigint) as month_of_birth,
           cast(day(b) as bigint) as day_of_birth, @stamp(b) as birth_datetime,
           cast(case upper(RACE) when 'WHITE' then 8527 when 'BLACK OR AFRICAN AMERICAN' then 8516
                when 'ASIAN' then 8515 else 0 end as bigint) as race_concept_id,
           cast(case upper(ETHNIC) when 'HISPANIC OR LATINO' then 38003563
                when 'NOT HISPANIC OR LATINO' then 38003564 else 0 end as bigint) as ethnicity_concept_id,
           USUBJID as person_source_value, SEX as gender_source_value, RACE as race_source_value,
           ETHNIC as ethnicity_source_value
    from (select *, @lenient(BRTHDTC) as b from {dm}) x""",
)
oracle_view(
    "o_period",
    """
    select row_number() over (order by person_id) as observation_period_id, person_id,
           observation_period_start_date, observation_period_end_date, 32880::bigint as period_type_concept_id
    from (select @pid(USUBJID) as person_id, cast(@clinical(RFSTDTC) as date) as observation_period_start_date,
                 cast(@clinical(RFENDTC) as date) as observation_period_end_date from {dm}) x""",
)


def _visit_view(source: str) -> str:
    return (
        """
    select row_number() over (order by person_id, visit_start_date, source_visit_num) as visit_occurrence_id,
           person_id, 9202::bigint as visit_concept_id, visit_start_date, visit_end_date,
           32809::bigint as visit_type_concept_id, visit_source_value, source_visit_num
    from (select @pid(USUBJID) as person_id, cast(@clinical(SVSTDTC) as date) as visit_start_date,
                 cast(@clinical(SVENDTC) as date) as visit_end_date, trim(VISIT) as visit_source_value,
                 VISITNUM as source_visit_num from {"""
        + source
        + "}) x"
    )


oracle_view("o_visit", _visit_view("sv"))
oracle_view("o_visit_clean", _visit_view("sv_clean"))
oracle_view("o_visit_long", _visit_view("sv_long"))

CONDITION_COLUMNS = """person_id, 0::bigint as condition_concept_id, 32809::bigint as condition_type_concept_id,
           cast(s as date) as condition_start_date, @stamp(s) as condition_start_datetime,
           cast(e as date) as condition_end_date, @stamp(e) as condition_end_datetime,
           term as condition_source_value, verbatim as condition_verbatim_source_value,
           0::bigint as condition_source_concept_id, status as condition_status_source_value"""
oracle_view(
    "o_condition_rows",
    """
    select 1 as dom, AESEQ as seq, @pid(USUBJID) as person_id, @clinical(AESTDTC) as s, @clinical(AEENDTC) as e,
           case when trim(AEDECOD) <> '' then AEDECOD else AETERM end as term, AETERM as verbatim, AEOUT as status
    from {ae}
    union all
    select 2, MHSEQ, @pid(USUBJID), @clinical(MHSTDTC), null::timestamp, MHTERM, MHTERM, 'Medical History' from {mh}""",
)
oracle_view(
    "o_condition",
    "select row_number() over (order by dom, person_id, seq) as condition_occurrence_id, "
    + CONDITION_COLUMNS
    + " from {o_condition_rows}",
)


def _drug_rows(domain: str, rank: int) -> str:
    return (
        """select RANK as dom, DOMSEQ as seq, @pid(USUBJID) as person_id, @lenient(DOMSTDTC) as s,
                  coalesce(@lenient(DOMENDTC), @lenient(DOMSTDTC)) as e, DOMDOSE as dose, DOMDOSU as unit,
                  DOMROUTE as route, DOMTRT as term, 'DOM' as domain from {VIEW}"""
        .replace("DOM", domain)
        .replace("RANK", str(rank))
        .replace("VIEW", domain.lower())
    )


DRUG_COLUMNS = """person_id, 0::bigint as drug_concept_id, 32809::bigint as drug_type_concept_id,
           cast(s as date) as drug_exposure_start_date, @stamp(s) as drug_exposure_start_datetime,
           cast(e as date) as drug_exposure_end_date, @stamp(e) as drug_exposure_end_datetime,
           dose as quantity, unit as dose_unit_source_value, route as route_source_value, term as drug_source_value,
           0::bigint as drug_source_concept_id, domain as drug_source_domain"""
oracle_view("o_drug_rows", _drug_rows("EX", 1) + " union all " + _drug_rows("CM", 2))
oracle_view(
    "o_drug",
    "select row_number() over (order by dom, person_id, seq) as drug_exposure_id, "
    + DRUG_COLUMNS
    + " from {o_drug_rows}",
)


def _measurement_rows(domain: str, rank: int) -> str:
    return (
        """select RANK as dom, DOMSEQ as seq, @pid(USUBJID) as person_id, @clinical(DOMDTC) as m,
                  coalesce(DOMSTRESN, @number(DOMORRES)) as value, DOMORRES as raw, DOMORRESU as unit,
                  DOMTEST as term, 'DOM' as domain, VISIT as visit, VISITNUM as visit_num from {VIEW}"""
        .replace("DOM", domain)
        .replace("RANK", str(rank))
        .replace("VIEW", domain.lower())
    )


MEASUREMENT_COLUMNS = """person_id, 0::bigint as measurement_concept_id, 32809::bigint as measurement_type_concept_id,
           cast(m as date) as measurement_date, @stamp(m) as measurement_datetime, value as value_as_number,
           raw as value_source_value, cast(@unit(unit) as bigint) as unit_concept_id, unit as unit_source_value,
           0::bigint as unit_source_concept_id, term as measurement_source_value,
           0::bigint as measurement_source_concept_id, domain as measurement_source_domain,
           visit as source_visit, visit_num as source_visit_num"""
oracle_view(
    "o_measurement_rows",
    " union all ".join(_measurement_rows(d, i) for i, d in enumerate(["LB", "VS", "EG"], start=1)),
)
oracle_view(
    "o_measurement",
    "select row_number() over (order by dom, person_id, seq) as measurement_id, "
    + MEASUREMENT_COLUMNS
    + " from {o_measurement_rows}",
)


def part_of(rows: str, columns: str, rank: int, id_col: str) -> str:
    """One domain's rows, without the id that only the whole table has."""
    return f"select seq::bigint as seq, null::bigint as {id_col}, {columns} from {{{rows}}} where dom = {rank}"


def one_domain(df):
    rows = df.withColumn("seq", F.col("_sequence").cast("bigint")).drop("_domain", "_sequence")
    return stamped(rows)


# --- queries --------------------------------------------------------------------------------


@query(
    "scan_domain",
    """select USUBJID, AETERM || chr(10) || '"' || AETERM as AETERM, AEDECOD, AESTDTC, AEENDTC, AEOUT,
              cast(AESEQ as double) as AESEQ from {ae}""",
)
def scan_domain(v):
    """Adverse events as CSV, with line breaks and quotes inside the terms."""
    path = stage_path(v.spark, "ae-csv")
    term = F.col("AETERM")
    write_table(v.ae.withColumn("AETERM", F.concat(term, F.lit('\n"'), term)), path, "csv")
    return read_domain(v.spark, "AE", path, "csv", multi_line=True)


_DOMAIN_NUMBER = {
    "DM": "null",
    "SV": "VISITNUM",
    "AE": "AESEQ",
    "MH": "MHSEQ",
    "EX": "EXDOSE",
    "CM": "CMDOSE",
    "LB": "LBSEQ",
    "VS": "VSSEQ",
    "EG": "EGSEQ",
}


@query(
    "scan_domains",
    " union all ".join(
        f"""select '{name}' as domain, count(*) as n_rows, count(distinct USUBJID) as subjects,
                   round(coalesce(sum(cast({number} as double)), 0), 2) as total from {{{name.lower()}}}"""
        for name, number in _DOMAIN_NUMBER.items()
    ),
)
def scan_domains(v):
    """All nine domains written and read again, as Parquet with numbers as text, or as CSV."""
    parts = []
    for i, (name, number) in enumerate(_DOMAIN_NUMBER.items()):
        path, fmt = stage_path(v.spark, f"domain-{name}"), ("parquet", "csv")[i % 2]
        rows = getattr(v, name.lower())
        write_table(rows.select([F.col(c).cast("string") for c in rows.columns]), path, fmt)
        total = F.coalesce(F.sum(F.expr(number).cast("double")), F.lit(0.0))
        parts.append(
            read_domain(v.spark, name, path, fmt).agg(
                F.lit(name).alias("domain"),
                F.count("*").alias("n_rows"),
                F.countDistinct("USUBJID").alias("subjects"),
                F.round(total, 2).alias("total"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query("etl_person", "select * from {o_person}")
def etl_person(v):
    return stamped(domains.person(v.dm))


@query("etl_condition_ae", part_of("o_condition_rows", CONDITION_COLUMNS, 1, "condition_occurrence_id"))
def etl_condition_ae(v):
    return one_domain(domains.condition_from_ae(v.ae))


@query("etl_condition_mh", part_of("o_condition_rows", CONDITION_COLUMNS, 2, "condition_occurrence_id"))
def etl_condition_mh(v):
    return one_domain(domains.condition_from_mh(v.mh))


@query("etl_condition", "select * from {o_condition}")
def etl_condition(v):
    return stamped(domains.condition_occurrence(v.ae, v.mh))


@query("etl_drug_ex", part_of("o_drug_rows", DRUG_COLUMNS, 1, "drug_exposure_id"))
def etl_drug_ex(v):
    return one_domain(domains.drug_from_ex(v.ex))


@query("etl_drug_cm", part_of("o_drug_rows", DRUG_COLUMNS, 2, "drug_exposure_id"))
def etl_drug_cm(v):
    return one_domain(domains.drug_from_cm(v.cm))


@query("etl_drug", "select * from {o_drug}")
def etl_drug(v):
    return stamped(domains.drug_exposure(v.ex, v.cm))


@query("etl_measurement_lb", part_of("o_measurement_rows", MEASUREMENT_COLUMNS, 1, "measurement_id"))
def etl_measurement_lb(v):
    return one_domain(domains.measurement_from_lb(v.lb))


@query("etl_measurement_vs", part_of("o_measurement_rows", MEASUREMENT_COLUMNS, 2, "measurement_id"))
def etl_measurement_vs(v):
    return one_domain(domains.measurement_from_vs(v.vs))


@query("etl_measurement_eg", part_of("o_measurement_rows", MEASUREMENT_COLUMNS, 3, "measurement_id"))
def etl_measurement_eg(v):
    return one_domain(domains.measurement_from_eg(v.eg))


@query("etl_measurement", "select * from {o_measurement}")
def etl_measurement(v):
    return stamped(domains.measurement(v.lb, v.vs, v.eg))


@query("etl_observation_period", "select * from {o_period}")
def etl_observation_period(v):
    return domains.observation_period(v.dm)


@query("etl_visit", "select * from {o_visit}")
def etl_visit(v):
    return domains.visit_occurrence(v.sv)


@query(
    "surrogate_ids",
    """select row_number() over (order by l_linenumber, l_orderkey, l_partkey, l_suppkey) as row_id, * from {agg}""",
)
def surrogate_ids(v):
    """Dense ids over a leading key with seven values, one of which holds a seventh of the rows."""
    return with_dense_ids(v.agg, "row_id", ["l_linenumber", "l_orderkey", "l_partkey", "l_suppkey"])


@query(
    "check_mh",
    """select 'MH' as subject, count(*) filter (where @clinical(MHSTDTC) is null) as unparseable_dates,
              count(*) filter (where MHTERM is null) as missing_terms from {mh_dirty}""",
)
def check_mh(v):
    return checks.check_history(v.mh_dirty)


EG_CHECK = """select 'EG' as subject, count(*) filter (where @clinical(EGDTC) is null) as unparseable_dates,
              count(*) filter (where coalesce(EGSTRESN, @number(EGORRES)) is null) as non_numeric_results
              from {eg_dirty}"""


@query("check_eg", EG_CHECK)
def check_eg(v):
    return checks.check_ecg(v.eg_dirty)


DM_CHECK = """
    select 'DM observation-period' as subject, count(*) filter (where p is null) as missing_subject_ids,
           count(*) filter (where s is null) as invalid_starts, count(*) filter (where e is null) as invalid_ends,
           count(*) filter (where e < s) as reversed_periods,
           count(*) - count(distinct coalesce(p, -1)) as duplicate_subjects
    from (select @pid(USUBJID) as p, @clinical(RFSTDTC) as s, @clinical(RFENDTC) as e from {dm_dirty}) x"""


@query("check_dm", DM_CHECK)
def check_dm(v):
    return checks.check_periods(v.dm_dirty)


SV_CHECK = """
    select 'SV' as subject,
           count(*) filter (where p is null or n is null or VISIT is null or s is null or e is null)
               as invalid_required_values,
           count(*) filter (where e < s) as reversed_visits,
           count(*) - count(distinct (p, n)) as duplicate_subject_visit_numbers
    from (select @pid(USUBJID) as p, VISITNUM as n, VISIT, @clinical(SVSTDTC) as s, @clinical(SVENDTC) as e
          from {sv_dirty}) x"""


@query("check_sv", SV_CHECK)
def check_sv(v):
    return checks.check_visits(v.sv_dirty)


@query(
    "contract_report",
    f"""select subject, rule, violations from (unpivot ({EG_CHECK})
            on unparseable_dates, non_numeric_results into name rule value violations)
        union all
        select subject, rule, violations from (unpivot ({SV_CHECK})
            on invalid_required_values, reversed_visits, duplicate_subject_visit_numbers
            into name rule value violations)""",
)
def contract_report(v):
    return checks.contract_report([checks.check_ecg(v.eg_dirty), checks.check_visits(v.sv_dirty)])


@query(
    "duplicate_keys",
    """select count(*) - count(distinct (USUBJID, VISITNUM)) as repeated from {sv_dirty}""",
)
def duplicate_keys(v):
    return checks.repeated_rows(v.sv_dirty, ["USUBJID", "VISITNUM"], "repeated")


@query(
    "output_counts",
    """select 'person' as table_name, count(*) as row_count from {dm}
       union all select 'observation_period', count(*) from {dm}
       union all select 'visit_occurrence', count(*) from {sv}
       union all select 'condition_occurrence', count(*) from {o_condition_rows}
       union all select 'drug_exposure', count(*) from {o_drug_rows}
       union all select 'measurement', count(*) from {o_measurement_rows}""",
)
def output_counts(v):
    return acceptance.row_counts(
        {
            "person": domains.person(v.dm),
            "observation_period": domains.observation_period(v.dm, ids=False, check=False),
            "visit_occurrence": domains.visit_occurrence(v.sv, ids=False, check=False),
            "condition_occurrence": domains.condition_occurrence(v.ae, v.mh, ids=False, check=False),
            "drug_exposure": domains.drug_exposure(v.ex, v.cm, ids=False),
            "measurement": domains.measurement(v.lb, v.vs, v.eg, ids=False, check=False),
        }
    )


@query(
    "conform_measurement",
    """select measurement_id, person_id, measurement_concept_id, measurement_date, measurement_datetime,
              null::varchar as measurement_time, measurement_type_concept_id, 0::bigint as operator_concept_id,
              value_as_number, 0::bigint as value_as_concept_id, coalesce(unit_concept_id, 0)::bigint
                  as unit_concept_id,
              null::double as range_low, null::double as range_high, null::bigint as provider_id,
              null::bigint as visit_occurrence_id, null::bigint as visit_detail_id, measurement_source_value,
              measurement_source_concept_id, unit_source_value, unit_source_concept_id, value_source_value,
              null::bigint as measurement_event_id, 0::bigint as meas_event_field_concept_id
       from {o_measurement}""",
)
def conform_measurement(v):
    return stamped(acceptance.conform(domains.measurement(v.lb, v.vs, v.eg), "measurement"))


@query(
    "conform_cast",
    """select p_partkey as person_id, cast(nullif(trim(g), '') as bigint) as gender_concept_id,
              p_size::bigint as year_of_birth, coalesce(cast(nullif(trim(s), '') as bigint), 0)::bigint
                  as gender_source_concept_id,
              cast(nullif(trim(b), '') as timestamp)::varchar as birth_datetime, nullif(p_brand, '') as person_source_value
       from (select p_partkey, p_size, p_brand, concat(cast(p_partkey as string), '.0') as g,
                    case when p_partkey % 3 = 0 then ' ' else concat(cast(p_size as string), '.5') end as s,
                    case when p_partkey % 4 > 0 then concat('19', cast(50 + p_size % 50 as string), '-02-03') end as b
             from {part}) x""",
)
def conform_cast(v):
    raw = v.sql(
        """select concat(cast(p_partkey as string), '.0') as person_id,
                  concat(cast(p_partkey as string), '.0') as gender_concept_id,
                  concat(' ', cast(p_size as string)) as year_of_birth,
                  '0' as race_concept_id, '0' as ethnicity_concept_id,
                  case when p_partkey % 3 = 0 then ' ' else concat(cast(p_size as string), '.5') end
                      as gender_source_concept_id,
                  case when p_partkey % 4 > 0 then concat('19', cast(50 + p_size % 50 as string), '-02-03') end
                      as birth_datetime, p_brand as person_source_value
           from {part}"""
    )
    return stamped(acceptance.conform(raw, "person")).select(
        "person_id",
        "gender_concept_id",
        "year_of_birth",
        "gender_source_concept_id",
        "birth_datetime",
        "person_source_value",
    )
