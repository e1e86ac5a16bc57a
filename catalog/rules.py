"""Proposals, reviews, rule tables and audit rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import oracle_view, query, stamped
from catalog.scalars import CONFIDENCE
from catalog.views import AS_OF
from catalog.vocabulary import all_terms, mapped_columns, patient_tables
from clinspark.operators import candidates, domains, mapping, rules
from clinspark.plans import review
from clinspark.session import stage
from clinspark.sources import publication


def now():
    return F.lit("2024-01-01 12:00:00").cast("timestamp_ntz")


# --- keyed appends --------------------------------------------------------------------------

oracle_view(
    "prov_old_run",
    """
    select b.provenance_id, b.target_table, b.target_id, b.mapping_method, 'RUN-0' as run_id from {prov_old} b""",
)
oracle_view(
    "o_prov_append",
    """
    select min(source_value) as source_value, run_id, target_table, target_id, mapping_method
    from {prov_new} n
    where run_id is not null
      and not exists (select 1 from {prov_old_run} o where o.run_id = n.run_id and o.target_table = n.target_table
                      and o.target_id = n.target_id and o.mapping_method = n.mapping_method)
    group by run_id, target_table, target_id, mapping_method
    union all
    select source_value, run_id, target_table, target_id, mapping_method from {prov_new} where run_id is null""",
)


@query(
    "provenance_append",
    """select run_id, target_table, target_id, mapping_method, source_value, count(*) as n from {o_prov_append}
       group by all""",
)
def provenance_append(v):
    """New audit rows against those a run wrote before; ids follow on."""
    old = rules.evolve_provenance(v.prov_old).withColumn("run_id", F.lit("RUN-0"))
    added = rules.append_provenance(v.prov_new, old, now())
    return added.groupBy("run_id", "target_table", "target_id", "mapping_method", "source_value").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "provenance_ids",
    """select (select max(provenance_id) from {prov_old}) + 1 as first_id,
              (select max(provenance_id) from {prov_old}) + count(*) as last_id, count(*) as n
       from {o_prov_append}""",
)
def provenance_ids(v):
    old = rules.evolve_provenance(v.prov_old).withColumn("run_id", F.lit("RUN-0"))
    added = rules.append_provenance(v.prov_new, old, now())
    return added.agg(
        F.min("provenance_id").alias("first_id"),
        F.max("provenance_id").alias("last_id"),
        F.count_distinct("provenance_id").alias("n"),
    )


@query(
    "provenance_evolve",
    """select provenance_id, target_table, target_id, source_value, normalized_value, assigned_concept_id,
              mapping_method, score, model_name, vocabulary_version, reviewed_by, @stamp(created_at) as created_at,
              null::varchar as run_id, null::bigint as mapping_decision_id
       from {prov_old}""",
)
def provenance_evolve(v):
    return stamped(rules.evolve_provenance(v.prov_old))


# --- proposals ------------------------------------------------------------------------------

PROPOSALS = """
    select run_id, target_table, source_value, proposed_concept_id, score, 'model-b' as model_name,
           'v5' as vocabulary_version, {METHOD} as mapping_method, 'candidate-selection-v1' as prompt_version,
           0.5 as minimum_score
    from {decision_base}"""


def proposals(v, method: str = "'second_pass'"):
    text = PROPOSALS.replace("{METHOD}", method)
    return v.sql(text).withColumn("minimum_score", F.col("minimum_score").cast("double"))


STATUS = """case when r.rejected_by is not null then 'REJECTED_BY_POLICY' when p.proposed_concept_id = 0 then 'UNRESOLVED'
                 when p.score < 0.5 then 'LOW_CONFIDENCE' else 'PROPOSED' end"""
oracle_view(
    "o_status",
    f"""
    select p.o_orderkey, p.run_id, p.target_table, p.source_value, p.normalized_value, p.proposed_concept_id,
           p.score, {STATUS} as decision_status, r.rejected_by as reviewed_by, r.rejection_reason as review_reason
    from {{decision_base}} p
    left join {{rejected}} r on r.target_table = p.target_table and r.normalized_value = p.normalized_value
         and r.active""",
)


@query(
    "decision_status",
    """select o_orderkey, target_table, normalized_value, decision_status, reviewed_by, review_reason
       from {o_status}""",
)
def decision_status(v):
    rows = v.decision_base.withColumn("minimum_score", F.lit(0.5))
    return rules.with_status(rows, v.rejected).select(
        "o_orderkey", "target_table", "normalized_value", "decision_status", "reviewed_by", "review_reason"
    )


@query(
    "record_decisions",
    """select (select max(mapping_decision_id) from {decision})
                  + row_number() over (order by run_id, target_table, normalized_value) as mapping_decision_id,
              run_id, target_table, source_value, normalized_value, proposed_concept_id, score, decision_status,
              reviewed_by, review_reason, '2024-01-01 12:00:00' as created_at
       from {o_status}""",
)
def record_decisions(v):
    return stamped(rules.record_decisions(proposals(v), v.decision, v.rejected, now())).select(
        "mapping_decision_id",
        "run_id",
        "target_table",
        "source_value",
        "normalized_value",
        "proposed_concept_id",
        "score",
        "decision_status",
        "reviewed_by",
        "review_reason",
        "created_at",
    )


@query(
    "record_again",
    "select count(*) as new_decisions from {ord} where o_orderkey % 3 = 0",
)
def record_again(v):
    """Proposals whose key was recorded before add nothing; a third are made by another method and are new."""
    method = "case when o_orderkey % 3 = 0 then 'second_pass' else 'llm_zero_shot' end"
    again = rules.record_decisions(proposals(v, method), v.decision, v.rejected, now())
    return again.agg(F.count(F.lit(1)).alias("new_decisions"))


@query(
    "proposal_conflicts",
    """select target_table, normalized_value, min(proposed_concept_id) as lowest, max(proposed_concept_id) as highest
       from {decision_base} group by target_table, normalized_value
       having min(proposed_concept_id) <> max(proposed_concept_id)""",
)
def proposal_conflicts(v):
    """The same terms proposed by one run with different concepts."""
    one_run = proposals(v).withColumn("run_id", F.lit("RUN-0"))
    found = rules.proposal_conflicts(one_run, v.decision)
    return found.select("target_table", "normalized_value", "lowest", "highest")


@query(
    "proposal_tally",
    """select target_table, decision_status, count(*) as decisions from {decision}
       group by target_table, decision_status""",
)
def proposal_tally(v):
    return rules.proposal_tally(v.decision)


@query(
    "active_rule",
    """select p.o_orderkey, p.target_table, p.normalized_value, a.concept_id as rule_concept_id,
              case when a.concept_id is not null then 'APPROVED' when r.rejected_by is not null then 'REJECTED' end
                  as rule_status,
              coalesce(a.approved_by, r.rejected_by) as rule_by,
              coalesce(a.approval_reason, r.rejection_reason) as rule_reason
       from {decision_base} p
       left join {approved} a on a.target_table = p.target_table and a.normalized_value = p.normalized_value and a.active
       left join {rejected} r on r.target_table = p.target_table and r.normalized_value = p.normalized_value and r.active""",
)
def active_rule(v):
    terms = v.decision_base.select("o_orderkey", "target_table", "source_value")
    return rules.active_rules(terms, v.approved, v.rejected).drop("source_value")


def replies_for(v, table: str):
    """An answer for every term of a table: its candidate concept with the highest id."""
    found = candidates.prefiltered(all_terms(v).where(F.col("target_table") == table), v.concept, AS_OF)
    text = """select domain_id, source_value, concat('ID ', cast(max(concept_id) as string)) as reply
              from {found} group by domain_id, source_value"""
    return v.spark.sql(text, found=found)


PROPOSE = """select 'RUN-9' as run_id, t.target_table, t.source_value, 'model-b' as model_name,
              case when r.rejected_by is not null then 0 else coalesce(s.concept_id, 0) end::bigint
                  as proposed_concept_id
       from {o_terms} t
       left join {term_approved} a on a.target_table = t.target_table and a.normalized_value = @key(t.source_value)
            and a.active
       left join {term_rejected} r on r.target_table = t.target_table and r.normalized_value = @key(t.source_value)
            and r.active
       left join (select domain_id, source_value, max(concept_id) as pick from {o_prefilter}
                  group by domain_id, source_value) p
            on p.domain_id = t.domain_id and p.source_value = t.source_value
       left join {o_shortlist} s on s.domain_id = t.domain_id and s.source_value = t.source_value
            and s.concept_id = p.pick
       where t.target_table = 'TABLE' and a.concept_id is null"""


def _proposed(v, table: str):
    """Unmapped terms of a table: rules first, then candidates, gate and score."""
    return rules.propose(
        patient_tables(v, ids=False)[table], table, v.concept, replies_for(v, table), v.term_approved, v.term_rejected,
        "RUN-9", "model-b", as_of=AS_OF,
    )


def _register_propose(name: str, table: str) -> None:
    @query(name, PROPOSE.replace("TABLE", table))
    def propose(v):
        return _proposed(v, table).select("run_id", "target_table", "source_value", "model_name", "proposed_concept_id")


_register_propose("propose", "drug_exposure")
_register_propose("propose_condition", "condition_occurrence")
_register_propose("propose_measurement", "measurement")


oracle_view(
    "o_drug_proposals",
    """
    select t.source_value as id, t.source_value as a, s.concept_name as b, @key(t.source_value) as key,
           r.rejected_by is not null as refused,
           case when r.rejected_by is not null then 0 else coalesce(s.concept_id, 0) end as concept_id
    from {o_terms} t
    left join {term_approved} a on a.target_table = t.target_table and a.normalized_value = @key(t.source_value)
         and a.active
    left join {term_rejected} r on r.target_table = t.target_table and r.normalized_value = @key(t.source_value)
         and r.active
    left join (select domain_id, source_value, max(concept_id) as pick from {o_prefilter}
               group by domain_id, source_value) p
         on p.domain_id = t.domain_id and p.source_value = t.source_value
    left join {o_shortlist} s on s.domain_id = t.domain_id and s.source_value = t.source_value
         and s.concept_id = p.pick
    where t.target_table = 'drug_exposure' and a.concept_id is null""",
)
oracle_view("o_scored_pairs", "select * from {o_drug_proposals} where concept_id <> 0")


@query(
    "proposal_scores",
    """select decision_status, count(*) as terms, round(avg(score), 4) as mean_score
       from (select score, case when refused then 'REJECTED_BY_POLICY' when concept_id = 0 then 'UNRESOLVED'
                                when score < 0.9 then 'LOW_CONFIDENCE' else 'PROPOSED' end as decision_status
             from (select p.key, arg_min(p.refused, p.id) as refused, arg_min(p.concept_id, p.id) as concept_id,
                          arg_min(coalesce(c.confidence, 0.0), p.id) as score
                   from {o_drug_proposals} p
                   left join ("""
    + CONFIDENCE.replace("PAIRS", "o_scored_pairs")
    + """) c on c.id = p.id
                   group by p.key) x) y
       group by decision_status""",
)
def proposal_scores(v):
    """The scores of ``propose``, by status."""
    recorded = rules.record_decisions(_proposed(v, "drug_exposure"), v.decision, v.term_rejected, now())
    return recorded.groupBy("decision_status").agg(
        F.count(F.lit(1)).alias("terms"), F.round(F.avg("score"), 4).alias("mean_score")
    )


def _all_replies(v):
    """An answer for every term: its candidate with the highest id."""
    found = candidates.prefiltered(all_terms(v), v.concept, AS_OF)
    text = """select domain_id, source_value, concat('ID ', cast(max(concept_id) as string)) as reply
              from {found} group by domain_id, source_value"""
    return v.spark.sql(text, found=found)


def _run_proposals(v, tables):
    """The store after a run's proposals."""
    store = {name: rules.empty(v.spark, name) for name in rules.SCHEMAS}
    store["approved"], store["rejected"] = v.term_approved, v.term_rejected
    new, events = review.propose_mappings(
        tables, v.concept, _all_replies(v), store, "RUN-9", "model-b", now(), 0.0, as_of=AS_OF
    )
    return {**store, "decision": new, "decision_event": stage(events, "run-events")}


oracle_view(
    "o_run_decisions",
    """
    select target_table, key, min(concept_id) as concept_id,
           case when bool_or(refused) then 'REJECTED_BY_POLICY' when min(concept_id) = 0 then 'UNRESOLVED'
                else 'PROPOSED' end as decision_status
    from (select t.target_table, @key(t.source_value) as key, r.rejected_by is not null as refused,
                 case when r.rejected_by is not null then 0 else coalesce(s.concept_id, 0) end as concept_id
          from {o_terms} t
          left join {term_approved} a on a.target_table = t.target_table and a.normalized_value = @key(t.source_value)
               and a.active
          left join {term_rejected} r on r.target_table = t.target_table and r.normalized_value = @key(t.source_value)
               and r.active
          left join (select domain_id, source_value, max(concept_id) as pick from {o_prefilter}
                     group by domain_id, source_value) p
               on p.domain_id = t.domain_id and p.source_value = t.source_value
          left join {o_shortlist} s on s.domain_id = t.domain_id and s.source_value = t.source_value
               and s.concept_id = p.pick
          where a.concept_id is null) x
    group by target_table, key""",
)


@query(
    "proposal_flow",
    """select d.target_table, d.decision_status, count(distinct d.key) as decisions, count(e.id) as events
       from {o_run_decisions} d
       join {o_mapped_events} e on e.t = d.target_table and @key(e.term) = d.key
       group by d.target_table, d.decision_status""",
)
def proposal_flow(v):
    """Unmapped terms to proposals, decisions and their events, for all three tables."""
    store = _run_proposals(v, mapped_columns(v))
    return (
        store["decision_event"]
        .join(store["decision"], "mapping_decision_id")
        .groupBy("target_table", "decision_status")
        .agg(F.count_distinct("mapping_decision_id").alias("decisions"), F.count("target_id").alias("events"))
    )


@query(
    "review_flow",
    """select t.target_table as table_name, count(e.id) as mapped, count(e.id) as audited, 0::bigint as audited_again
       from (select 'condition_occurrence' as target_table union all select 'drug_exposure'
             union all select 'measurement') t
       left join {o_run_decisions} d on d.target_table = t.target_table and d.decision_status = 'PROPOSED'
            and length(d.key) % 2 = 0
       left join {o_mapped_events} e on e.t = d.target_table and @key(e.term) = d.key
       group by t.target_table""",
)
def review_flow(v):
    """A run's proposals reviewed, made into rules and applied; the second round finds nothing to do."""
    tables = publication.write_stage(mapped_columns(v), "review-tables")
    store = _run_proposals(v, tables) | {name: rules.empty(v.spark, name) for name in ("approved", "rejected")}
    actions = store["decision"].where("decision_status = 'PROPOSED'").selectExpr(
        "mapping_decision_id as seq",
        "mapping_decision_id",
        "case when length(normalized_value) % 2 = 0 then 'approve' else 'reject' end as action",
        "'Cy' as reviewer",
        "'seen' as reason",
        "cast(null as bigint) as selected_concept_id",
    )
    done, following, _ = review.review_round(actions, tables, v.concept, store, "RUN-10", now())
    done = publication.write_stage(done, "reviewed-tables")
    following["provenance"] = stage(following["provenance"], "audit")
    _, last, _ = review.review_round(actions.limit(0), done, v.concept, following, "RUN-11", now())
    changed = [
        done[name].select(F.lit(name).alias("t"), F.lit("mapped").alias("what"), F.col(target.concept_col) != 0)
        for name, target in mapping.TARGETS.items()
    ]
    audited = following["provenance"].select("target_table", F.lit("audited"), F.lit(True))
    again = last["provenance"].select("target_table", F.lit("audited_again"), F.col("run_id") == "RUN-11")
    marks = reduce(DataFrame.union, [*changed, audited, again]).toDF("table_name", "what", "holds")
    counts = [F.count_if((F.col("what") == w) & F.col("holds")).alias(w) for w in ("mapped", "audited", "audited_again")]
    return marks.groupBy("table_name").agg(*counts)


REQUESTS = """
    select 'drug_exposure' as target_table, source_value,
           case when min(p_partkey) % 5 = 0 then 0 else 2000000000 + min(p_partkey) end as concept_id
    from (select concat(p_name, ' ', p_brand, case when p_size > 45 then ' forte' else '' end) as source_value, p_partkey
          from {part}) x
    group by source_value"""
oracle_view("o_requests", REQUESTS)


@query(
    "manual_proposal",
    """select r.source_value, r.concept_id as proposed_concept_id,
              case when r.concept_id <> 0 then 1.0::double else 0.0::double end as score, count(e.id) as events
       from {o_requests} r
       join {o_mapped_events} e on e.t = r.target_table and e.term = r.source_value
       group by r.source_value, r.concept_id""",
)
def manual_proposal(v):
    exposures = domains.drug_exposure(v.ex, v.cm, columns=["drug_exposure_id", "drug_source_value"])
    proposed, events, _ = rules.manual_proposals(v.sql(REQUESTS), {"drug_exposure": exposures}, "RUN-9")
    counts = events.groupBy("source_value").agg(F.count(F.lit(1)).alias("events"))
    return proposed.join(counts, "source_value").select("source_value", "proposed_concept_id", "score", "events")


@query(
    "manual_refused",
    """select r.target_table, r.source_value, r.concept_id from {o_requests} r
       where not exists (select 1 from {cm} c where c.CMTRT = r.source_value)""",
)
def manual_refused(v):
    tables = {"drug_exposure": domains.drug_exposure(v.ex, v.cm, ids=False)}
    return rules.manual_proposals(v.sql(REQUESTS), tables, "RUN-9")[2]


@query(
    "pending_provenance",
    """select target_table, target_id, source_value, mapping_method from {prov_new}
       where run_id = 'RUN-3' and reviewed_by = 'Pending_Human_Review'""",
)
def pending_provenance(v):
    found = rules.pending_provenance(v.prov_new, "RUN-3")
    return found.select("target_table", "target_id", "source_value", "mapping_method")


@query(
    "import_pending",
    """select target_table, source_value, assigned_concept_id as proposed_concept_id, score, mapping_method,
              'legacy-event-provenance-v1' as prompt_version, count(distinct target_id) as events
       from {prov_new} where run_id = 'RUN-3' and reviewed_by = 'Pending_Human_Review'
       group by all""",
)
def import_pending(v):
    proposed, events = rules.import_pending(v.prov_new, "RUN-3")
    key = ["target_table", "source_value", "mapping_method"]
    counts = events.groupBy(*key).agg(F.count_distinct("target_id").alias("events"))
    return proposed.join(counts, key).select(
        *key, "proposed_concept_id", "score", "prompt_version", "events"
    )


@query(
    "decision_events",
    """select d.mapping_decision_id, count(distinct e.target_id) as events
       from {decision} d
       join {decision_event} e on e.mapping_decision_id = d.mapping_decision_id and e.target_id % 2 = 1
       group by d.mapping_decision_id""",
)
def decision_events(v):
    """Events linked to decisions; half of the links exist before."""
    links = v.decision_event.join(v.decision, "mapping_decision_id")
    affected = links.select("run_id", "target_table", "mapping_method", "source_value", "target_id")
    added = rules.decision_events(affected, v.decision, v.decision_event.where("target_id % 2 = 0"))
    return added.groupBy("mapping_decision_id").agg(F.count(F.lit(1)).alias("events"))


# --- review ---------------------------------------------------------------------------------

oracle_view(
    "o_judged",
    """
    select a.*, upper(a.action) as verb, d.target_table, d.source_value, d.normalized_value,
           case when upper(a.action) = 'APPROVE' then coalesce(case when a.selected_concept_id <> 0
                then a.selected_concept_id end, d.proposed_concept_id, 0) end as cid,
           case when upper(a.action) = 'APPROVE' then 'APPROVED' else 'REJECTED' end as ns,
           case when upper(a.action) not in ('APPROVE', 'REJECT') then 'neither an approval nor a rejection'
                when trim(coalesce(a.reviewer, '')) = '' or trim(coalesce(a.reason, '')) = ''
                    then 'no reviewer or no reason'
                when d.mapping_decision_id is null then 'no such decision'
                when d.decision_status in ('APPROVED', 'REJECTED') then concat('settled before: ', d.decision_status) end
                as early
    from {review_actions} a left join {decision} d on d.mapping_decision_id = a.mapping_decision_id""",
)
oracle_view(
    "o_late",
    """
    select j.*, c.concept_name,
           case when verb <> 'APPROVE' then null when cid = 0 then 'nothing to approve: no concept'
                when c.concept_name is null then 'concept is not in the vocabulary'
                when coalesce(c.standard_concept, '') <> 'S' or coalesce(c.invalid_reason, '') <> ''
                    then 'concept is not standard'
                when c.domain_id <> case j.target_table when 'condition_occurrence' then 'Condition'
                                         when 'drug_exposure' then 'Drug' else 'Measurement' end
                    then 'concept of another domain' end as late
    from {o_judged} j left join {concept} c on c.concept_id = j.cid""",
)
oracle_view(
    "o_review",
    """
    select l.seq, l.mapping_decision_id, l.verb as action, l.reviewer, l.reason, l.target_table, l.source_value,
           l.normalized_value, l.cid as concept_id, l.concept_name, l.ns,
           coalesce(l.early, case when l.seq > s.first_seq then concat('settled before: ', s.first_ns) end, l.late) as refusal
    from {o_late} l
    left join (select mapping_decision_id, min(seq) as first_seq, arg_min(ns, seq) as first_ns from {o_late}
               where early is null and late is null group by mapping_decision_id) s
      on s.mapping_decision_id = l.mapping_decision_id""",
)


def reviewed(v):
    return rules.review(v.review_actions, v.decision, v.concept)


@query(
    "review_batch",
    """select seq, mapping_decision_id, action, reviewer, reason, target_table, source_value, normalized_value,
              concept_id, concept_name, case when refusal is null then ns end as new_status, refusal
       from {o_review}""",
)
def review_batch(v):
    return reviewed(v)


@query(
    "reviewed_decisions",
    """select d.mapping_decision_id, coalesce(r.ns, d.decision_status) as decision_status,
              case when r.ns is not null then r.concept_id else d.selected_concept_id end as selected_concept_id,
              coalesce(r.reviewer, d.reviewed_by) as reviewed_by,
              case when r.ns is not null then '2024-01-01 12:00:00' end as reviewed_at
       from {decision} d
       left join (select * from {o_review} where refusal is null) r
         on r.mapping_decision_id = d.mapping_decision_id""",
)
def reviewed_decisions(v):
    after = rules.reviewed_decisions(v.decision, reviewed(v), now())
    return stamped(
        after.select("mapping_decision_id", "decision_status", "selected_concept_id", "reviewed_by", "reviewed_at")
    )


oracle_view(
    "o_effect",
    """
    select target_table, normalized_value, arg_max(action, seq) as last_action,
           max(seq) filter (where action = 'APPROVE') as yes_seq, max(seq) filter (where action = 'REJECT') as no_seq
    from {o_review} where refusal is null group by target_table, normalized_value""",
)


def _upsert_oracle(table: str, seq: str, action: str, concept: str) -> str:
    sql = """
    select coalesce(e.target_table, o.target_table) as target_table,
           coalesce(e.normalized_value, o.normalized_value) as normalized_value,
           case when r.seq is not null then r.source_value else o.source_value end as source_value, CONCEPT
           case when r.seq is not null then r.mapping_decision_id else o.source_decision_id end as source_decision_id,
           case when r.seq is not null then r.reviewer else o.BY end as BY,
           case when e.last_action is not null then e.last_action = 'ACTION' else o.active end as active,
           case when e.last_action is not null then '2024-01-01 12:00:00' else @stamp(o.updated_at) end as updated_at
    from {TABLE} o
    full join {o_effect} e on e.target_table = o.target_table and e.normalized_value = o.normalized_value
    left join {o_review} r on r.seq = e.SEQ
    where r.seq is not null or o.target_table is not null"""
    by = "approved_by" if table == "approved" else "rejected_by"
    for old, new in {"CONCEPT": concept, "BY": by, "ACTION": action, "TABLE": table, "SEQ": seq}.items():
        sql = sql.replace(old, new)
    return sql


@query(
    "rule_upsert",
    _upsert_oracle(
        "approved",
        "yes_seq",
        "APPROVE",
        "case when r.seq is not null then r.concept_id else o.concept_id end as concept_id,",
    ),
)
def rule_upsert(v):
    """Approved rules after a batch of reviews."""
    after, _ = rules.apply_reviews(reviewed(v), v.approved, v.rejected, now())
    return stamped(after.drop("approval_reason", "approved_at"))


@query("rule_upsert_rejected", _upsert_oracle("rejected", "no_seq", "REJECT", ""))
def rule_upsert_rejected(v):
    """Rejected rules after the same batch."""
    _, after = rules.apply_reviews(reviewed(v), v.approved, v.rejected, now())
    return stamped(after.drop("rejection_reason", "rejected_at"))


# --- listings -------------------------------------------------------------------------------


@query(
    "latest_run",
    """select run_id, @stamp(started_at) as started_at from {runs} order by started_at desc, run_id desc limit 1""",
)
def latest_run(v):
    return stamped(rules.latest_run(v.runs))


@query(
    "decision_list",
    """select d.mapping_decision_id, d.target_table, d.source_value, d.proposed_concept_id,
              p.concept_name as proposed_name, d.selected_concept_id, s.concept_name as selected_name, d.score,
              d.decision_status, d.reviewed_by, coalesce(e.n, 0)::bigint as affected_events
       from {decision} d
       left join {concept} p on p.concept_id = d.proposed_concept_id
       left join {concept} s on s.concept_id = d.selected_concept_id
       left join (select mapping_decision_id, count(*) as n from {decision_event} group by 1) e
         on e.mapping_decision_id = d.mapping_decision_id
       where d.run_id = 'RUN-3'""",
)
def decision_list(v):
    return rules.list_decisions(v.decision, v.decision_event, v.concept, "RUN-3")


@query(
    "rule_list",
    """select 'approved' as kind, a.target_table, a.source_value, a.concept_id, c.concept_name, a.approved_by as by_whom,
              a.source_decision_id
       from {approved} a left join {concept} c on c.concept_id = a.concept_id where a.active
       union all
       select 'rejected', target_table, source_value, null, null, rejected_by, source_decision_id
       from {rejected} where active""",
)
def rule_list(v):
    yes = rules.list_approved(v.approved, v.concept).select(
        F.lit("approved").alias("kind"),
        "target_table",
        "source_value",
        "concept_id",
        "concept_name",
        F.col("approved_by").alias("by_whom"),
        "source_decision_id",
    )
    no = rules.list_rejected(v.rejected).select(
        F.lit("rejected").alias("kind"),
        "target_table",
        "source_value",
        F.lit(None).cast("bigint").alias("concept_id"),
        F.lit(None).cast("string").alias("concept_name"),
        F.col("rejected_by").alias("by_whom"),
        "source_decision_id",
    )
    return yes.unionByName(no)
