"""Vocabulary, deterministic mapping, approvals and candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import oracle_view, query
from catalog.views import AS_OF
from clinspark.functions import text
from clinspark.operators import candidates, domains, mapping, rules
from clinspark.session import stage, stage_path
from clinspark.sources.vocabulary import read_vocabulary, write_vocabulary

# Unmapped events as (table, domain, key, raw term), and their distinct terms.
oracle_view(
    "o_mapped_events",
    """
    select 'condition_occurrence' as t, 'Condition' as dom_id,
           row_number() over (order by dom, person_id, seq) as id, term from {o_condition_rows}
    union all
    select 'drug_exposure', 'Drug', row_number() over (order by dom, person_id, seq), term from {o_drug_rows}
    union all
    select 'measurement', 'Measurement', row_number() over (order by dom, person_id, seq), term
    from {o_measurement_rows}""",
)
oracle_view(
    "o_terms",
    """
    select distinct t as target_table, dom_id as domain_id, term as source_value, lower(trim(term)) as term_key
    from {o_mapped_events} where term is not null""",
)
oracle_view(
    "o_direct",
    """
    select k.domain_id, k.term_key, min(c.concept_id) as concept_id,
           arg_min(c.concept_name, c.concept_id) as concept_name
    from (select distinct domain_id, term_key from {o_terms}) k
    join {concept} c on lower(c.concept_name) = k.term_key and c.domain_id = k.domain_id
    where @standard(c) and @valid(c)
    group by k.domain_id, k.term_key""",
)
oracle_view(
    "o_maps_to",
    """
    select k.domain_id, k.term_key, min(c2.concept_id) as concept_id,
           arg_min(c2.concept_name, c2.concept_id) as concept_name
    from (select distinct domain_id, term_key from {o_terms}) k
    join {concept} c1 on lower(c1.concept_name) = k.term_key
    join {rel} r on r.concept_id_1 = c1.concept_id and r.relationship_id = 'Maps to'
    join {concept} c2 on c2.concept_id = r.concept_id_2 and c2.domain_id = k.domain_id
    where @current(c1) and @valid(c1) and @current(r) and @valid(r) and @standard(c2) and @valid(c2)
    group by k.domain_id, k.term_key""",
)
oracle_view(
    "o_mapped",
    """
    select t.target_table, t.domain_id, t.source_value,
           coalesce(d.concept_id, m.concept_id, 0)::bigint as concept_id,
           coalesce(d.concept_name, m.concept_name) as concept_name,
           case when d.concept_id is not null then 'deterministic_direct_match'
                when m.concept_id is not null then 'deterministic_maps_to_relation' end as mapping_method
    from {o_terms} t
    left join {o_direct} d on d.domain_id = t.domain_id and d.term_key = t.term_key
    left join {o_maps_to} m on m.domain_id = t.domain_id and m.term_key = t.term_key""",
)


def patient_tables(v, ids: bool = True) -> dict[str, DataFrame]:
    """The three mapped event tables."""
    return {
        "condition_occurrence": domains.condition_occurrence(v.ae, v.mh, ids=ids, check=False),
        "drug_exposure": domains.drug_exposure(v.ex, v.cm, ids=ids),
        "measurement": domains.measurement(v.lb, v.vs, v.eg, ids=ids, check=False),
    }


def mapped_columns(v) -> dict[str, DataFrame]:
    """The same tables under the same ids, with the columns that mapping reads and writes."""
    names = {t.table: [t.id_col, t.concept_col, t.source_col] for t in mapping.TARGETS.values()}
    return {
        "condition_occurrence": domains.condition_occurrence(
            v.ae, v.mh, check=False, columns=names["condition_occurrence"]
        ),
        "drug_exposure": domains.drug_exposure(v.ex, v.cm, columns=names["drug_exposure"]),
        "measurement": domains.measurement(v.lb, v.vs, v.eg, check=False, columns=names["measurement"]),
    }


def all_terms(v) -> DataFrame:
    tables = patient_tables(v, ids=False)
    return reduce(DataFrame.unionByName, [mapping.orphan_terms(tables[n], t) for n, t in mapping.TARGETS.items()])


def keyed(terms: DataFrame) -> DataFrame:
    return terms.select("domain_id", text.match_key(F.col("source_value")).alias("term_key")).distinct()


@query("scan_vocab", "select * replace (nullif(invalid_reason, '') as invalid_reason) from {concept}")
def scan_vocab(v):
    path = stage_path(v.spark, "concept-tsv")
    write_vocabulary(v.concept, path)
    return read_vocabulary(v.spark, "concept", path)


@query("orphan_terms", "select target_table, domain_id, source_value from {o_terms}")
def orphan_terms(v):
    return all_terms(v)


@query("standard_concepts", "select c.* from {concept} c where @standard(c) and @valid(c)")
def standard_concepts(v):
    return mapping.standard_concepts(v.concept, AS_OF)


@query(
    "valid_on",
    """select r.concept_id_1, r.concept_id_2, r.relationship_id from {rel} r
       where r.relationship_id = 'Maps to' and @current(r) and @valid(r)""",
)
def valid_on(v):
    usable = (F.col("relationship_id") == "Maps to") & mapping.not_invalid() & mapping.valid_on(AS_OF)
    return v.rel.where(usable).select("concept_id_1", "concept_id_2", "relationship_id")


@query("map_direct", "select * from {o_direct}")
def map_direct(v):
    return mapping.direct_matches(keyed(all_terms(v)), v.concept, AS_OF)


@query("map_maps_to", "select * from {o_maps_to}")
def map_maps_to(v):
    return mapping.maps_to_matches(keyed(all_terms(v)), v.concept, v.rel, AS_OF)


@query("map_deterministic", "select * from {o_mapped}")
def map_deterministic(v):
    return mapping.map_terms(all_terms(v), v.concept, v.rel, AS_OF)


@query(
    "mapping_coverage",
    """select domain_id, count(*) as terms, count(*) filter (where concept_id <> 0) as mapped_terms
       from {o_mapped} group by domain_id""",
)
def mapping_coverage(v):
    return mapping.mapping_coverage(mapping.map_terms(all_terms(v), v.concept, v.rel, AS_OF))


@query(
    "apply_deterministic",
    """select e.t as table_name, e.id, e.term, coalesce(m.concept_id, 0)::bigint as concept_id
       from {o_mapped_events} e
       left join {o_mapped} m on m.target_table = e.t and m.source_value = e.term""",
)
def apply_deterministic(v):
    tables, _, _ = mapping.map_tables(mapped_columns(v), v.concept, v.rel, "RUN-1", AS_OF)
    return _concepts_of(tables)


def _concepts_of(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.col(mapping.TARGETS[name].id_col).alias("id"),
            F.col(mapping.TARGETS[name].source_col).alias("term"),
            F.col(mapping.TARGETS[name].concept_col).alias("concept_id"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "provenance_rows",
    """select e.t as target_table, e.id as target_id, e.term as source_value, m.concept_id as assigned_concept_id,
              m.mapping_method, 1.0::double as score, 'OHDSI_Vocabulary' as model_name,
              'Athena_Standard' as vocabulary_version, 'System_Auto_Approved' as reviewed_by, 'RUN-1' as run_id
       from {o_mapped_events} e
       join {o_mapped} m on m.target_table = e.t and m.source_value = e.term and m.concept_id <> 0""",
)
def provenance_rows(v):
    _, provenance, _ = mapping.map_tables(mapped_columns(v), v.concept, v.rel, "RUN-1", AS_OF)
    return provenance.drop("normalized_value", "mapping_decision_id")


APPROVALS = """
    select a.target_table, a.normalized_value, a.concept_id, a.source_decision_id, a.approved_by, d.score,
           d.model_name, d.vocabulary_version,
           case when c.concept_name is null then 'is not in the vocabulary'
                when coalesce(c.standard_concept, '') <> 'S' or coalesce(c.invalid_reason, '') <> ''
                    then 'is not standard any more'
                when c.domain_id <> case a.target_table when 'condition_occurrence' then 'Condition'
                                         when 'drug_exposure' then 'Drug' else 'Measurement' end
                    then 'has another domain' end as problem
    from {RULES} a
    join {DECISIONS} d on d.mapping_decision_id = a.source_decision_id
    left join {concept} c on c.concept_id = a.concept_id
    where a.active"""


@query("active_approvals", APPROVALS.replace("RULES", "approved").replace("DECISIONS", "decision"))
def active_approvals(v):
    return mapping.active_approvals(v.approved, v.decision, v.concept)


oracle_view("o_approvals", APPROVALS.replace("RULES", "term_approved").replace("DECISIONS", "term_decision"))


@query(
    "apply_approved",
    """select e.t as table_name, e.id, e.term,
              case when coalesce(m.concept_id, 0) <> 0 then m.concept_id else coalesce(a.concept_id, 0) end::bigint
                  as concept_id
       from {o_mapped_events} e
       left join {o_mapped} m on m.target_table = e.t and m.source_value = e.term
       left join {o_approvals} a on a.target_table = e.t and a.normalized_value = @key(e.term) and a.problem is null""",
)
def apply_approved(v):
    """Deterministic mapping first, approved rules on what it left at 0."""
    tables, _, _ = mapping.map_tables(mapped_columns(v), v.concept, v.rel, "RUN-1", AS_OF)
    approvals = stage(mapping.active_approvals(v.term_approved, v.term_decision, v.concept), "approvals")
    done = {name: mapping.apply_approvals(df, mapping.TARGETS[name], approvals) for name, df in tables.items()}
    return _concepts_of(done)


@query(
    "approval_provenance",
    """select e.t as target_table, e.id as target_id, e.term as source_value, a.normalized_value,
              a.concept_id as assigned_concept_id, 'human_approved_mapping' as mapping_method, a.score,
              a.approved_by as reviewed_by, 'RUN-2' as run_id, a.source_decision_id as mapping_decision_id
       from {o_mapped_events} e
       join {o_approvals} a on a.target_table = e.t and a.normalized_value = @key(e.term) and a.problem is null""",
)
def approval_provenance(v):
    approvals = stage(mapping.active_approvals(v.term_approved, v.term_decision, v.concept), "approvals")
    parts = [
        mapping.provenance_of_approvals(df, mapping.TARGETS[name], approvals, "RUN-2")
        for name, df in mapped_columns(v).items()
    ]
    return reduce(DataFrame.unionByName, parts).drop("model_name", "vocabulary_version")


@query(
    "affected_events",
    """select 'drug_exposure' as target_table, source_value, count(*) as events, min(id)::bigint as first_id
       from (select term as source_value, id from {o_mapped_events} where t = 'drug_exposure') x
       group by source_value""",
)
def affected_events(v):
    """Unmapped exposures, half of them without any concept id."""
    columns = ["drug_exposure_id", "drug_concept_id", "drug_source_value"]
    events = domains.drug_exposure(v.ex, v.cm, columns=columns)
    half = F.when(F.col("drug_exposure_id") % 2 == 0, F.col("drug_concept_id"))
    rows = rules.affected_events(events.withColumn("drug_concept_id", half), "drug_exposure")
    return rows.groupBy("target_table", "source_value").agg(
        F.count(F.lit(1)).alias("events"), F.min("target_id").alias("first_id")
    )


# --- candidates -----------------------------------------------------------------------------

oracle_view(
    "o_term_words",
    """
    select domain_id, source_value, t,
           case when len(t) > 0 then t else [lower(source_value)] end as words
    from (select distinct domain_id, source_value, @tokens(source_value) as t from {o_terms}) x""",
)
oracle_view(
    "o_prefilter",
    """
    select domain_id, source_value, t, concept_id, concept_name, name_length, place
    from (select *, row_number() over (partition by domain_id, source_value
                                       order by without_primary, name_length, concept_id) as place
          from (select w.domain_id, w.source_value, w.t, c.concept_id, c.concept_name,
                       length(c.concept_name) as name_length,
                       case when contains(@squash(c.concept_name), w.primary_word) then 0 else 1 end as without_primary
                from (select *, @longest(i) as primary_word
                      from (select *, @informative(words) as i from {o_term_words}) y) w
                join {concept} c on c.domain_id = w.domain_id and @standard(c) and @valid(c)
                where len(list_filter(w.words, lambda x: contains(lower(c.concept_name), x)
                                      or contains(@squash(c.concept_name), x))) > 0) z) q""",
)


@query(
    "candidate_prefilter",
    "select domain_id, source_value, concept_id, concept_name, place::bigint as place from {o_prefilter}",
)
def candidate_prefilter(v):
    found = candidates.prefiltered(all_terms(v), v.concept, AS_OF)
    return found.select(
        "domain_id", "source_value", "concept_id", "concept_name", F.col("place").cast("bigint").alias("place")
    )


oracle_view(
    "o_overlap",
    """
    select *, len(list_intersect(list_distinct(i), list_distinct(c))) / greatest(len(list_distinct(i)), 1) as io,
           len(list_intersect(list_distinct(t), list_distinct(c))) / greatest(len(list_distinct(t)), 1) as tot
    from (select *, @informative(t) as i, @tokens(concept_name) as c from {o_prefilter}) x""",
)
oracle_view(
    "o_similar",
    """
    select a, b, cast(round_even(200.0 * (length(s) - bit_count(list_reduce(
              list_prepend(full_mask, masks::hugeint[]),
              lambda v, m: ((v + (v & m)) | (v - (v & m))) & full_mask))) / (length(s) + length(c)), 0) as bigint)
              as similarity
    from (select a, b, s, c, (1::hugeint << length(s)::hugeint) - 1 as full_mask,
                 list_transform(string_split(c, ''), lambda ch: list_sum(list_transform(range(0, length(s)),
                     lambda i: case when substr(s, (i + 1)::int, 1) = ch then (1::hugeint << i::hugeint)
                                    else 0::hugeint end))) as masks
          from (select a, b,
                       array_to_string(list_sort(string_split_regex(
                           trim(regexp_replace(lower(a), '\\W+', ' ', 'g')), ' ')), ' ') as s,
                       array_to_string(list_sort(string_split_regex(
                           trim(regexp_replace(lower(b), '\\W+', ' ', 'g')), ' ')), ' ') as c
                from (select distinct source_value as a, concept_name as b from {o_overlap}) x) y) z""",
)
oracle_view(
    "o_shortlist",
    """
    select * from (
        select o.domain_id, o.source_value, o.concept_id, o.concept_name, o.io as informative_overlap,
               o.tot as total_overlap, s.similarity,
               row_number() over (partition by o.domain_id, o.source_value
                   order by o.io desc, o.tot desc, s.similarity desc, o.name_length, o.place) as position
        from {o_overlap} o join {o_similar} s on s.a = o.source_value and s.b = o.concept_name) x
    where position <= 15""",
)


@query("candidate_top15", "select * from {o_shortlist}")
def candidate_top15(v):
    return candidates.shortlist(all_terms(v), v.concept, AS_OF)


REPLIES = """
    select domain_id, source_value,
           case length(source_value) % 4 when 0 then 'none of these'
                when 1 then concat('I pick ', cast(2000000000 + length(source_value) as string), '.')
                else concat('ID: ', cast(id as string), ' is best') end as reply
    from (select domain_id, source_value, max(concept_id) as id from {CANDIDATES} group by domain_id, source_value) x"""


oracle_view("o_replies", REPLIES.replace("CANDIDATES", "o_prefilter"))


@query(
    "gate_picks",
    """select t.domain_id, t.source_value, coalesce(p.concept_id, 0)::bigint as concept_id, p.concept_name
       from (select distinct domain_id, source_value from {o_prefilter}) t
       left join {o_replies} r on r.domain_id = t.domain_id and r.source_value = t.source_value
       left join {o_prefilter} p on p.domain_id = t.domain_id and p.source_value = t.source_value
            and p.concept_id = try_cast(nullif(regexp_extract(r.reply, '[0-9]+'), '') as bigint)""",
)
def gate_picks(v):
    found = candidates.prefiltered(all_terms(v), v.concept, AS_OF)
    replies = v.spark.sql(REPLIES.replace("CANDIDATES", "found"), found=found)
    return candidates.gate_picks(found, replies)
