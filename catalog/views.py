"""Study-shaped views over the driver tables.

The view texts are plain SQL that Spark and DuckDB both run, so a query and its
SQL counterpart start from the same rows.  ``{name}`` refers to another view or
to a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from clinspark.session import configure, on_drop, stage

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

AS_OF = "2024-01-01"

VIEWS: dict[str, str] = {
    "ord": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, cast(o_orderdate as date) as d
        from {orders}""",
    "dm": """
        select c.c_name as USUBJID,
               case c.c_custkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'U' end as SEX,
               case c.c_mktsegment when 'BUILDING' then 'WHITE' when 'FURNITURE' then 'Black or African American'
                    when 'MACHINERY' then 'ASIAN' when 'AUTOMOBILE' then 'UNKNOWN' end as RACE,
               case c.c_nationkey % 3 when 0 then 'Hispanic or Latino' when 1 then 'NOT HISPANIC OR LATINO' end
                    as ETHNIC,
               case when c.c_custkey % 11 = 0 then '  ' when c.c_custkey % 13 = 0 then 'unknown'
                    when c.c_custkey % 17 = 0 then cast(1940 + c.c_custkey % 60 as string)
                    when c.c_custkey % 19 = 0 then concat(cast(1940 + c.c_custkey % 60 as string), '-07')
                    else concat(cast(1940 + c.c_custkey % 60 as string), '-',
                                lpad(cast(1 + c.c_custkey % 12 as string), 2, '0'), '-',
                                lpad(cast(1 + c.c_custkey % 28 as string), 2, '0')) end as BRTHDTC,
               cast(o.first_d as string) as RFSTDTC, cast(o.last_d + 8 as string) as RFENDTC
        from {customer} c
        join (select o_custkey, min(d) as first_d, max(d) as last_d from {ord} group by o_custkey) o
          on o.o_custkey = c.c_custkey""",
    "dm_dirty": """
        select case when RFENDTC like '%1' then ' ' else USUBJID end as USUBJID,
               case when RFENDTC like '%2' then 'soon' else RFSTDTC end as RFSTDTC,
               case when RFENDTC like '%3' then null when RFENDTC like '%4' then '1990-01-01' else RFENDTC end
                    as RFENDTC
        from {dm}""",
    "visit_days": """
        select o_custkey, d, row_number() over (partition by o_custkey order by d) as rn
        from (select distinct o_custkey, d from {ord}) x""",
    "sv": """
        select c.c_name as USUBJID, cast(v.rn as double) as VISITNUM,
               concat('  Visit ', cast(v.rn as string)) as VISIT,
               cast(v.d as string) as SVSTDTC, cast(v.d + 2 as string) as SVENDTC
        from {visit_days} v join {customer} c on c.c_custkey = v.o_custkey""",
    "sv_clean": """
        select USUBJID, VISITNUM, VISIT, SVSTDTC, SVSTDTC as SVENDTC from {sv}""",
    "sv_long": """
        select c.c_name as USUBJID, cast(v.rn as double) as VISITNUM, 'Stay' as VISIT, cast(v.d as string) as SVSTDTC,
               cast(v.d + cast(case v.rn % 3 when 0 then v.rn % 7 when 1 then v.o_custkey * 37 % 300
                               else v.o_custkey * 7919 % 10000 end as int) as string) as SVENDTC
        from {visit_days} v join {customer} c on c.c_custkey = v.o_custkey""",
    "sv_dirty": """
        select c.c_name as USUBJID, cast(o.o_orderkey % 5 as double) as VISITNUM,
               case when o.o_orderkey % 7 = 0 then null else 'Visit' end as VISIT,
               cast(o.d as string) as SVSTDTC,
               cast(case when o.o_orderkey % 9 = 0 then o.d - 1 else o.d end as string) as SVENDTC
        from {ord} o join {customer} c on c.c_custkey = o.o_custkey""",
    "ae": """
        select concat('Customer#', lpad(cast(e.user_id as string), 9, '0')) as USUBJID,
               concat(e.event_type, ' after ', p.p_name) as AETERM,
               case when e.event_id % 7 = 0 then null when e.event_id % 5 = 0 then ' ' else upper(p.p_name) end
                    as AEDECOD,
               cast(cast(e.ts as date) as string) as AESTDTC,
               case when e.event_id % 3 = 0 then cast(cast(e.ts as date) + 1 as string) end as AEENDTC,
               case when e.value > 50 then 'RECOVERED' else 'NOT RECOVERED' end as AEOUT,
               e.event_id as AESEQ
        from {events} e
        join {part} p on p.p_partkey = e.event_id % (select count(*) from {part})""",
    "mh": """
        select c.c_name as USUBJID,
               case o.o_orderstatus when 'P' then concat('History of ', p.p_name) else p.p_name end as MHTERM,
               cast(10000 + o.o_orderkey % 10000 as string) as MHSTDTC, o.o_orderkey as MHSEQ
        from {ord} o
        join {customer} c on c.c_custkey = o.o_custkey
        join {part} p on p.p_partkey = o.o_orderkey % (select count(*) from {part})""",
    "mh_dirty": """
        select USUBJID, case when MHSEQ % 8 = 0 then null else MHTERM end as MHTERM,
               case when MHSEQ % 10 = 0 then 'not-a-date' else MHSTDTC end as MHSTDTC, MHSEQ
        from {mh}""",
    "agg": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, max(l_quantity) as q
        from {lineitem} group by l_orderkey, l_partkey, l_suppkey, l_linenumber""",
    "dosing": """
        select c.c_name as USUBJID, p.p_name, p.p_brand, p.p_type, a.l_partkey, a.l_suppkey, a.l_linenumber, a.q,
               o.o_custkey, o.d,
               ((a.l_orderkey * 100000 + a.l_partkey) * 10000 + a.l_suppkey) * 10 + a.l_linenumber as seq
        from {agg} a
        join {ord} o on o.o_orderkey = a.l_orderkey
        join {customer} c on c.c_custkey = o.o_custkey
        join {part} p on p.p_partkey = a.l_partkey""",
    "lb": """
        select x.USUBJID,
               case when x.l_linenumber % 2 = 1 then x.p_name else concat(x.p_name, ' ', x.p_type) end as LBTEST,
               case when x.l_partkey % 9 = 0 then concat('<', cast(cast(x.q as int) as string))
                    else cast(cast(x.q as int) as string) end as LBORRES,
               case x.l_linenumber when 1 then 'mg/dL' when 2 then 'MG/DL' when 3 then 'U/L' when 4 then ' g/dL '
                    when 5 then 'kg' when 6 then 'custom-unit' end as LBORRESU,
               cast(x.d as string) as LBDTC, concat('  Visit ', cast(v.rn as string)) as VISIT,
               x.seq as LBSEQ,
               case when x.l_linenumber % 2 = 0 then x.q end as LBSTRESN,
               case when x.l_suppkey % 4 = 0 then null else cast(v.rn as double) end as VISITNUM
        from {dosing} x join {visit_days} v on v.o_custkey = x.o_custkey and v.d = x.d""",
    "vs": """
        select USUBJID, LBTEST as VSTEST, LBORRES as VSORRES, LBORRESU as VSORRESU, LBDTC as VSDTC, VISIT,
               LBSEQ as VSSEQ, LBSTRESN as VSSTRESN, VISITNUM
        from {lb} where LBSTRESN is null""",
    "eg": """
        select USUBJID, LBTEST as EGTEST, LBORRES as EGORRES, LBORRESU as EGORRESU, LBDTC as EGDTC, VISIT,
               LBSEQ as EGSEQ, LBSTRESN as EGSTRESN, VISITNUM
        from {lb} where LBSTRESN is not null""",
    "eg_dirty": """
        select USUBJID, LBTEST as EGTEST, LBORRES as EGORRES, LBORRESU as EGORRESU,
               case when LBSEQ % 50 = 3 then 'not-a-date' else LBDTC end as EGDTC, LBSTRESN as EGSTRESN
        from {lb}""",
    "ex": """
        select USUBJID, p_name as EXTRT, 'mg' as EXDOSU,
               case when l_linenumber % 2 = 0 then 'ORAL' end as EXROUTE,
               cast(d + l_linenumber as string) as EXSTDTC,
               case when l_linenumber % 3 = 0 then null else cast(d + l_linenumber + 5 as string) end as EXENDTC,
               seq as EXSEQ, q as EXDOSE
        from {dosing}""",
    "cm": """
        select USUBJID, concat(p_name, ' ', p_brand) as CMTRT, 'tablet' as CMDOSU,
               case when l_linenumber % 2 = 0 then 'ORAL' end as CMROUTE,
               cast(d + l_linenumber as string) as CMSTDTC,
               case when l_linenumber % 3 = 0 then 'ongoing' else cast(d + l_linenumber + 5 as string) end as CMENDTC,
               seq as CMSEQ, q as CMDOSE
        from {dosing}""",
    "part_concept": """
        select 2000000000 + p_partkey as concept_id,
               case p_partkey % 4 when 0 then upper(p_name) when 1 then p_name
                    when 2 then concat(p_type, '-', p_name, ' level') else concat(p_brand, ' ', p_name) end
                    as concept_name,
               case p_size % 3 when 0 then 'Condition' when 1 then 'Drug' else 'Measurement' end as domain_id,
               'Local' as vocabulary_id, 'Term' as concept_class_id,
               case when p_partkey % 5 < 2 then 'S' end as standard_concept,
               p_brand as concept_code, date '1970-01-01' as valid_start_date,
               case when p_partkey % 11 = 0 then date '2000-12-31' else date '2099-12-31' end as valid_end_date,
               case when p_size > 45 then 'D' when p_size > 40 then '' end as invalid_reason
        from {part}""",
    "concept": """
        select * from {part_concept}
        union all
        select cast(id as bigint), name, dom, 'Local', 'Term', 'S', 'x',
               date '1970-01-01', date '2099-12-31', cast(null as string)
        from (select 8507 as id, 'MALE' as name, 'Gender' as dom
              union all select 8532, 'FEMALE', 'Gender' union all select 8527, 'White', 'Race'
              union all select 8516, 'Black or African American', 'Race' union all select 8515, 'Asian', 'Race'
              union all select 38003563, 'Hispanic or Latino', 'Ethnicity'
              union all select 38003564, 'Not Hispanic or Latino', 'Ethnicity'
              union all select 9202, 'Outpatient Visit', 'Visit'
              union all select 8840, 'milligram per deciliter', 'Unit' union all select 8645, 'unit per liter', 'Unit'
              union all select 8713, 'gram per deciliter', 'Measurement'
              union all select 32809, 'Case Report Form', 'Type Concept'
              union all select 32880, 'Standard algorithm', 'Type Concept') fixed""",
    "rel": """
        select distinct 2000000000 + l_partkey as concept_id_1,
               2000000000 + (l_partkey * 7 + l_suppkey) % (select count(*) from {part}) as concept_id_2,
               case when l_suppkey % 3 = 0 then 'Is a' else 'Maps to' end as relationship_id,
               date '1970-01-01' as valid_start_date,
               case when l_suppkey % 10 = 1 then date '2010-12-31' else date '2099-12-31' end as valid_end_date,
               case when l_suppkey % 8 = 0 then 'D' when l_suppkey % 8 = 1 then '' end as invalid_reason
        from {lineitem}""",
    # --- text samples for the scalar functions ---
    "date_text": """
        select o_orderkey,
               case o_orderkey % 14
                 when 0 then cast(d as string)
                 when 1 then concat(cast(d as string), 'T08:30')
                 when 2 then concat(cast(d as string), ' 23:59:59')
                 when 3 then cast(year(d) as string)
                 when 4 then concat(cast(year(d) as string), '-', lpad(cast(month(d) as string), 2, '0'))
                 when 5 then concat(cast(day(d) as string),
                                    substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', 3 * month(d) - 2, 3),
                                    cast(year(d) as string))
                 when 6 then concat(lpad(cast(month(d) as string), 2, '0'), '/', lpad(cast(day(d) as string), 2, '0'),
                                    '/', cast(year(d) as string))
                 when 7 then concat(cast(year(d) as string), lpad(cast(month(d) as string), 2, '0'),
                                    lpad(cast(day(d) as string), 2, '0'))
                 when 8 then cast(9000 + o_orderkey % 20000 as string)
                 when 9 then concat('  ', cast(10000 + o_orderkey % 90000 as string), '.0 ')
                 when 10 then concat(cast(year(d) as string), '-13-01')
                 when 11 then 'unknown'
                 when 12 then '   '
                 else concat(' ', cast(year(d) as string), '-', cast(month(d) as string), '-',
                             cast(day(d) as string)) end as txt
        from {ord}""",
    "number_text": """
        select p_partkey,
               case p_partkey % 9 when 0 then cast(p_size as string) when 1 then concat(' ', cast(p_size as string), ' ')
                    when 2 then concat('<', cast(p_size as string)) when 3 then concat(cast(p_size as string), 'd')
                    when 4 then '' when 5 then concat(cast(p_size as string), '.5')
                    when 6 then concat('-', cast(p_size as string), 'e2') when 7 then 'nan' end as first_txt,
               case when p_partkey % 2 = 0 then concat(cast(p_size as string), '.25') else p_brand end as second_txt
        from {part}""",
    "term_text": """
        select p_partkey,
               case p_partkey % 6 when 0 then concat('Q-T ', p_name, ' duration')
                    when 1 then concat(' R R  ', p_type, chr(9), 'level ')
                    when 2 then concat(p_brand, ' 5 ', upper(p_name))
                    when 3 then 'Test Level' when 4 then 'x y z'
                    else concat(p_name, '  ', p_type, ' (', cast(p_size as string), ' mg/dL)') end as term
        from {part}""",
    # --- rules, decisions and audit ---
    "runs": """
        select concat('RUN-', cast(o_custkey as string)) as run_id, max(o_orderdate) as started_at
        from {orders} group by o_custkey""",
    "decision_base": """
        select o_orderkey, d, o_orderkey - o_orderkey % 6 as t, o_orderkey + 1 as mapping_decision_id,
               concat('RUN-', cast(o_orderkey % 7 as string)) as run_id,
               case o_orderkey % 3 when 0 then 'condition_occurrence' when 1 then 'drug_exposure'
                    else 'measurement' end as target_table,
               case when o_orderkey % 2 = 0 then concat('TERM ', cast(o_orderkey - o_orderkey % 6 as string))
                    else concat(' Term  ', cast(o_orderkey - o_orderkey % 6 as string), ' ') end as source_value,
               concat('term ', cast(o_orderkey - o_orderkey % 6 as string)) as normalized_value,
               case when o_orderkey % 10 = 0 then 0 when o_orderkey % 10 = 1 then 999
                    else 2000000000 + o_custkey % (select count(*) from {part}) end as proposed_concept_id,
               cast(o_orderkey % 101 as double) / 100 as score
        from {ord}""",
    "decision": """
        select mapping_decision_id, run_id, target_table, source_value, normalized_value, proposed_concept_id,
               case when o_orderkey % 13 = 0 then proposed_concept_id end as selected_concept_id,
               'llm_zero_shot' as mapping_method, score, 'model-a' as model_name,
               'Athena_Standard' as vocabulary_version, 'candidate-selection-v1' as prompt_version,
               case when o_orderkey % 13 = 0 then 'APPROVED' when o_orderkey % 17 = 0 then 'REJECTED'
                    when proposed_concept_id = 0 then 'UNRESOLVED' when score < 0.5 then 'LOW_CONFIDENCE'
                    else 'PROPOSED' end as decision_status,
               case when o_orderkey % 13 = 0 or o_orderkey % 17 = 0 then 'QC' end as reviewed_by,
               cast(null as timestamp) as reviewed_at, cast(null as string) as review_reason,
               cast(d as timestamp) as created_at
        from {decision_base}""",
    "decision_event": """
        select distinct l_orderkey + 1 as mapping_decision_id, l_partkey * 1000 + l_linenumber as target_id
        from {lineitem}""",
    "approved": """
        select target_table, max(source_value) as source_value, normalized_value,
               2000000000 + max(t) % (select count(*) from {part}) as concept_id,
               min(mapping_decision_id) as source_decision_id, 'Ann' as approved_by, 'fits' as approval_reason,
               cast(max(d) as timestamp) as approved_at, max(t) % 18 = 0 and max(t) % 5 <> 0 as active,
               cast(max(d) as timestamp) as updated_at
        from {decision_base} group by target_table, normalized_value""",
    "rejected": """
        select target_table, max(source_value) as source_value, normalized_value,
               max(mapping_decision_id) as source_decision_id, 'Ben' as rejected_by, 'too specific' as rejection_reason,
               cast(max(d) as timestamp) as rejected_at, max(t) % 24 = 0 and max(t) % 7 <> 0 as active,
               cast(max(d) as timestamp) as updated_at
        from {decision_base} group by target_table, normalized_value""",
    "actions": """
        select o_orderkey as seq, o_orderkey % ((select count(*) from {orders}) / 2 + 5) as raw_id,
               o_orderkey, o_custkey
        from {orders}""",
    "review_actions": """
        select seq, cast(floor(raw_id) as bigint) + 1 as mapping_decision_id,
               case o_orderkey % 4 when 0 then 'approve' when 1 then 'REJECT' when 2 then 'Approve' else
                    case when o_orderkey % 9 = 0 then 'hold' else 'reject' end end as action,
               case when o_orderkey % 11 = 0 then ' ' else 'Cy' end as reviewer,
               case when o_orderkey % 19 = 0 then cast(null as string) else 'seen' end as reason,
               case when o_orderkey % 3 = 0 then 2000000000 + o_custkey % (select count(*) from {part})
                    when o_orderkey % 3 = 1 then 0 end as selected_concept_id
        from {actions}""",
    "term_names": """
        select name, form, min(p_partkey) as k from (
            select p_name as name, 0 as form, p_partkey from {part}
            union all select concat(p_name, ' ', p_brand), 1, p_partkey from {part}
            union all select concat(p_name, ' ', p_type), 2, p_partkey from {part}) x
        group by name, form""",
    "term_targets": """
        select name, form, k, 0 as i, 'condition_occurrence' as target_table from {term_names}
        union all select name, form, k, 1, 'drug_exposure' from {term_names}
        union all select name, form, k, 2, 'measurement' from {term_names}""",
    "term_decision_base": """
        select (k * 3 + form) * 3 + i + 1 as mapping_decision_id, target_table, i, name, k,
               case when k % 2 = 0 then upper(name) else concat('  ', name) end as source_value,
               lower(name) as normalized_value
        from {term_targets}""",
    "term_decision": """
        select mapping_decision_id, 'RUN-T' as run_id, target_table, source_value, normalized_value,
               2000000000 + k as proposed_concept_id, 'llm_zero_shot' as mapping_method,
               cast(k % 101 as double) / 100 as score, 'model-a' as model_name, 'v5' as vocabulary_version,
               'PROPOSED' as decision_status
        from {term_decision_base}""",
    "term_approved": """
        select b.target_table, b.source_value, b.normalized_value, c.concept_id,
               b.mapping_decision_id as source_decision_id, 'Ann' as approved_by, 'fits' as approval_reason,
               length(b.name) % 2 = 0 and length(b.name) % 5 <> 0 as active
        from {term_decision_base} b
        join (select domain_id, min(concept_id) as concept_id from {part_concept}
              where standard_concept = 'S' and (invalid_reason is null or invalid_reason = '')
              group by domain_id) c
          on c.domain_id = case b.i when 0 then 'Condition' when 1 then 'Drug' else 'Measurement' end""",
    "term_rejected": """
        select target_table, source_value, normalized_value, mapping_decision_id as source_decision_id,
               'Ben' as rejected_by, 'too specific' as rejection_reason,
               timestamp '2023-05-01 10:00:00' as rejected_at, length(name) % 3 = 0 and length(name) % 4 <> 0 as active
        from {term_decision_base}""",
    "prov_base": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber,
               case l_linenumber % 3 when 0 then 'condition_occurrence' when 1 then 'drug_exposure'
                    else 'measurement' end as target_table,
               l_orderkey * 100 + l_linenumber as target_id, concat('Term ', cast(l_partkey as string)) as source_value,
               2000000000 + l_partkey as assigned_concept_id,
               case when l_suppkey % 2 = 0 then 'llm_zero_shot' else 'deterministic_direct_match' end as mapping_method,
               cast(l_partkey % 101 as double) / 100 as score,
               case when l_suppkey % 3 = 0 then 'Pending_Human_Review' else 'System_Auto_Approved' end as reviewed_by,
               concat('RUN-', cast(l_suppkey % 5 as string)) as run_id
        from {agg}""",
    "prov_new": """
        select target_table, target_id, source_value, lower(source_value) as normalized_value, assigned_concept_id,
               mapping_method, score, 'model-a' as model_name, 'v5' as vocabulary_version, reviewed_by,
               case when l_partkey % 40 = 0 then cast(null as string) else run_id end as run_id,
               cast(null as bigint) as mapping_decision_id
        from {prov_base} where l_linenumber > 2""",
    "prov_old": """
        select ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber as provenance_id,
               target_table, target_id, source_value, lower(source_value) as normalized_value, assigned_concept_id,
               mapping_method, score, 'model-a' as model_name, 'v5' as vocabulary_version, reviewed_by,
               timestamp '2023-01-01 00:00:00' as created_at
        from {prov_base} where l_linenumber < 5""",
}

# The doses and what is delivered of them, as Spark builds them: the same rows as the texts above give, with what
# an order brings along looked up once per order instead of once per line, and one written table behind them all.  The
# order comes last, as its patient and visit are wider than the part, and lines of an order then lie side by side.
BUILT: dict[str, str] = {
    "visited": """
        select o.o_orderkey, o.o_custkey, o.d, c.c_name, v.rn
        from {ord} o
        join {customer} c on c.c_custkey = o.o_custkey
        left join {visit_days} v on v.o_custkey = o.o_custkey and v.d = o.d""",
    "doses": """
        select o.c_name, p.p_name, p.p_brand, p.p_type, a.l_orderkey, a.l_partkey, a.l_suppkey, a.l_linenumber, a.q,
               o.o_custkey, o.d, o.rn
        from {agg} a
        join {part} p on p.p_partkey = a.l_partkey
        join {visited} o on o.o_orderkey = a.l_orderkey""",
    "dosing": """
        select c_name as USUBJID, p_name, p_brand, p_type, l_partkey, l_suppkey, l_linenumber, q, o_custkey, d,
               ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber as seq
        from {doses}""",
    "dosing_on_visits": """
        select c_name as USUBJID, p_name, p_brand, p_type, l_partkey, l_suppkey, l_linenumber, q, o_custkey, d,
               ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber as seq, rn
        from {doses} where rn is not null""",
    "lb": VIEWS["lb"]
    .replace("v.rn", "x.rn")
    .replace("{dosing} x join {visit_days} v on v.o_custkey = x.o_custkey and v.d = x.d", "{dosing_on_visits} x"),
}

# Views that play the part of delivered files: written once per session, then scanned.
STORED = {"dm", "sv", "ae", "mh", "concept", "part_concept", "rel", "decision", "doses"}
# Those as large as their largest input are written as their last join or grouping leaves them.
UNSPREAD = {"doses", "rel", "mh"}
_stored: dict[tuple[str, str, str], DataFrame] = {}


@on_drop
def _forget(spark: SparkSession) -> None:
    for key in [k for k in _stored if k[0] == spark.sparkContext.applicationId]:
        del _stored[key]


def _text(name: str) -> str:
    return BUILT.get(name) or VIEWS[name]


_REFERENCE = re.compile(r"\{([a-z_]+)\}")


class Views:
    """The views as DataFrames: ``views.ae`` and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self._folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in DRIVER_TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
            elif name in VIEWS or name in BUILT:
                self._frames[name] = self._stored(name) if name in STORED else self.sql(_text(name))
            else:
                raise AttributeError(name)
        return self._frames[name]

    def _stored(self, name: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self._folder, name)
        if key not in _stored:
            rows = self.sql(_text(name))
            if name not in UNSPREAD:
                rows = rows.repartition(self.spark.sparkContext.defaultParallelism)
            _stored[key] = stage(rows, f"view-{name}")
        return _stored[key]

    def sql(self, text: str) -> DataFrame:
        needed = {name: getattr(self, name) for name in set(_REFERENCE.findall(text))}
        return self.spark.sql(text, **needed)


def duck_sql(text: str, extra: dict[str, str] | None = None) -> str:
    """One DuckDB statement: the text with the views it needs as common table expressions."""
    views = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered or name in DRIVER_TABLES:
            return
        for inner in _REFERENCE.findall(views[name]):
            visit(inner)
        ordered.append(name)

    for name in _REFERENCE.findall(text):
        visit(name)

    def plain(sql: str) -> str:
        return _REFERENCE.sub(lambda m: m.group(1), sql)

    head = ",\n".join(f"{name} as ({plain(views[name])})" for name in ordered)
    return (f"with {head}\n" if head else "") + plain(text)
